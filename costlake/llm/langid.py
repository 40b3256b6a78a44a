"""Language identification: a linear-chain conditional random field labels every word, by affixes, letter n-grams and a lexicon, with learned transitions; forward-backward gives the words' marginals, and their sum the text's language.

Words get labels of their own, so a text in two languages is seen as such. Training takes a
bounded sample of labelled texts; prediction runs over whole texts, many chains at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import table, texts
from costlake.llm.toxicity import remainder

#: A run of letters; a longer one is cut into pieces, each a word.
WORD = re.compile(r"[^\W\d_]{1,40}")
#: Hashed features, as a power of two; words of a language's lexicon.
WIDTH, LEXICON = 16, 300
#: Texts that training takes at most (lowest hash of the id first), and the words of each: one window at a hashed place.
TRAIN_TEXTS, TRAIN_WORDS = 4_000, 64
ROUNDS, STEP, RIDGE = 60, 0.3, 1e-6
#: Words whose scores a worker remembers, and words of a set of chains, at most.
REMEMBERED, CHAINS = 500_000, 600_000
UNKNOWN = "und"


def features(word: str, lexicon: frozenset[str]) -> list[int]:
    """Hashed features of a lower-case word: prefixes and suffixes to 3 letters, 2- and 3-grams with edges, lexicon entry."""
    mask, crc = (1 << WIDTH) - 1, zlib.crc32
    edged = f"^{word}$".encode()
    out = [crc(edged[i : i + n]) & mask for n in (2, 3) for i in range(len(edged) - n + 1)]
    b = word.encode()
    out += [crc(b[:n], 1) & mask for n in (1, 2, 3)] + [crc(b[-n:], 2) & mask for n in (1, 2, 3)]
    if word in lexicon:
        out.append(crc(b, 3) & mask)
    return out


@dataclass(frozen=True)
class Crf:
    labels: tuple[str, ...]
    lexicon: frozenset[str]
    weights: np.ndarray  # (2 ** WIDTH, labels)
    step: np.ndarray  # (labels, labels), log
    start: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        lists = [features(w, self.lexicon) for w in words]
        at = np.cumsum([0] + [len(x) for x in lists])
        return np.add.reduceat(self.weights[np.concatenate([np.array(x) for x in lists])], at[:-1], axis=0) if words else np.zeros((0, len(self.labels)))


def marginals(ids: list[np.ndarray], score: np.ndarray, step: np.ndarray, start: np.ndarray, each: bool = False):
    """Forward-backward over chains of word numbers: for every chain the sum of its words' marginals; ``each``: also every word's."""
    k = score.shape[1]
    order = np.argsort([-len(x) for x in ids], kind="stable")
    length = np.array([len(ids[i]) for i in order])
    first = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    flat = np.concatenate([ids[i] for i in order]) if len(ids) else np.zeros(0, np.int64)
    e = score[flat]
    e = np.exp(e - e.max(axis=1, keepdims=True)) + 1e-12 if len(flat) else e
    t_mat, s_vec = np.exp(step - step.max()), np.exp(start - start.max())
    total, steps = np.zeros((len(ids), k)), int(length[0]) if len(ids) else 0
    live = np.searchsorted(-length, -np.arange(steps), side="left")  # chains longer than t
    alpha = np.zeros((len(flat), k))
    a = None
    for t in range(steps):
        at = first[: live[t]] + t
        a = (s_vec if t == 0 else a[: live[t]] @ t_mat) * e[at]
        a = a / a.sum(axis=1, keepdims=True)
        alpha[at] = a
    word = np.zeros((len(flat), k)) if each else None
    b = np.zeros((0, k))
    for t in range(steps - 1, -1, -1):
        at = first[: live[t]] + t
        now = np.ones((live[t], k))
        if len(b):
            nxt = first[: len(b)] + t + 1
            now[: len(b)] = (e[nxt] * b) @ t_mat.T
            now[: len(b)] /= now[: len(b)].sum(axis=1, keepdims=True)
        b = now
        p = alpha[at] * b
        p /= p.sum(axis=1, keepdims=True)
        total[: live[t]] += p
        if each:
            word[at] = p
    out = np.zeros_like(total)
    out[order] = total
    return (out, word, flat, order, first, length, alpha, e, t_mat) if each else out


def fit(sample: list[tuple[str, str]]) -> Crf:
    """Train on (text, language) pairs by gradient ascent on the chains' likelihood, with step sizes by each weight's past gradients."""
    labels = tuple(sorted({y for _, y in sample}))
    chains = [(WORD.findall(t.lower()), labels.index(y)) for t, y in sample]
    chains = [(w, y) for w, y in chains if w]
    k = len(labels)
    by: list[Counter] = [Counter() for _ in labels]
    for w, y in chains:
        by[y].update(w)
    lexicon = frozenset(w for c in by for w, n in c.most_common(LEXICON) if n >= 3)
    words = sorted({w for ws, _ in chains for w in ws})
    number = {w: i for i, w in enumerate(words)}
    lists = [features(w, lexicon) for w in words]
    flat = np.array([f for x in lists for f in x], dtype=np.int64)
    of = np.repeat(np.arange(len(words)), [len(x) for x in lists])
    begin = np.concatenate([[0], np.cumsum([len(x) for x in lists])[:-1]]).astype(np.int64) if words else np.zeros(0, np.int64)
    ids = [np.array([number[w] for w in ws]) for ws, _ in chains]
    y = np.array([y for _, y in chains], dtype=np.int64)
    w, step, start = np.zeros((1 << WIDTH, k)), np.zeros((k, k)), np.zeros(k)
    past = [np.full_like(x, 1e-8) for x in (w, step, start)]
    n = sum(len(x) for x in ids)
    for _ in range(ROUNDS if k > 1 and n else 0):
        score = np.add.reduceat(w[flat], begin, axis=0)
        _, p, seen, order, first, length, alpha, e, t_mat = marginals(ids, score, step, start, each=True)
        truth = np.repeat(y[order], length)
        diff = -p
        diff[np.arange(n), truth] += 1
        per_word = np.stack([np.bincount(seen, diff[:, j], minlength=len(words)) for j in range(k)], axis=1)
        g_w = np.stack([np.bincount(flat, per_word[of, j], minlength=1 << WIDTH) for j in range(k)], axis=1) / n
        inner = np.ones(n, dtype=bool)
        inner[first] = False
        at = np.flatnonzero(inner)
        joint = np.zeros((k, k))
        for s in range(0, len(at), 200_000):  # expected transitions, from both ends' marginals
            i = at[s : s + 200_000]
            pair = alpha[i - 1][:, :, None] * t_mat[None] * (p[i] / np.maximum(alpha[i - 1] @ t_mat, 1e-12))[:, None, :]
            joint += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        g_step = (np.bincount(truth[at], minlength=k) * np.eye(k) - joint) / n
        g_start = (np.bincount(y, minlength=k) - p[first].sum(axis=0)) / n
        for x, g, old in zip((w, step, start), (g_w, g_step, g_start), past):
            g = g - RIDGE * x
            old += g * g
            x += STEP * g / np.sqrt(old)
    return Crf(labels, lexicon, w, step, start)


def sample_of(labelled: DataFrame, train_texts: int = TRAIN_TEXTS) -> list[tuple[str, str]]:
    """(window of words, lang) of at most ``train_texts`` labelled rows, collected: bounded by both parameters."""
    words = F.split("text", r"\s+")
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.size("w") - TRAIN_WORDS)).cast("int")
    rows = labelled.filter("lang is not null and text is not null").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(train_texts)
    rows = rows.withColumn("w", words).select(F.array_join(F.slice("w", place + 1, TRAIN_WORDS), " ").alias("t"), F.col("lang").cast("string").alias("lang"))
    return [(r["t"], r["lang"]) for r in rows.collect()]


def predict(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, lang_pred, score of every row's whole text.

    The language with the largest sum of word marginals (ties: the first in order); score is
    that sum's share of the words. Null texts and texts without a letter: ``und``, 0. A model
    that learned no language says ``und`` of every text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[str, int] = {}
        score = np.zeros((0, max(1, len(model.labels))))

        def solve(chains: list[list[str]]) -> np.ndarray:
            nonlocal number, score
            if len(number) > REMEMBERED:
                number, score = {}, score[:0]
            fresh = list(dict.fromkeys(w for c in chains for w in c if w not in number))
            for w in fresh:
                number[w] = len(number)
            for s in range(0, len(fresh), 50_000):
                score = np.concatenate([score, model.scores(fresh[s : s + 50_000])])
            return marginals([np.array([number[w] for w in c], dtype=np.int64) for c in chains], score, model.step, model.start)

        for b in batches:
            found = [WORD.findall(t.lower()) if t else [] for t in b.column(1).to_pylist()]
            names, points = [UNKNOWN] * len(found), np.zeros(len(found))
            order = sorted((i for i, c in enumerate(found) if model.labels and any(ch.isalpha() for w in c for ch in w)), key=lambda i: -len(found[i]))
            while order:
                n = size = 0
                while n < len(order) and (n == 0 or size + len(found[order[n]]) <= CHAINS):
                    size += len(found[order[n]])
                    n += 1
                now, order = order[:n], order[n:]
                sums = solve([found[i] for i in now])
                for i, row in zip(now, sums):
                    best = int(row.argmax())
                    names[i], points[i] = model.labels[best], min(1.0, row[best] / len(found[i]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names), pa.array(points)], names=["doc_id", "lang_pred", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op3(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(sample_of(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(remainder(3) != 1)))
    return predict(docs, model).select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
