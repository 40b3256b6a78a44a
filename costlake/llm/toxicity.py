"""Toxicity: a product of Levenshtein automata and a lexicon trie finds terms, also misspelled; a context window tells quotation from abuse.

The lexicon is learned: words and word stems whose documents are nearly all marked toxic. The
trie of its terms and the Levenshtein automaton of each run as one automaton, made
deterministic as words are read (a state is the set of (trie node, edits) still alive), so a
word that resembles no term dies after a few letters.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import texts

WORD = re.compile(r"\w+")
#: Longest stem that is learned, and the shortest.
STEM_MIN, STEM_MAX = 4, 10
#: Labelled documents that the lexicon and the weights are learned from, at most (lowest hash of doc_id first).
TRAIN_ROWS = 20_000
#: Words either side of a term that its context window holds.
WINDOW = 8
#: Words that announce a quotation, and words that address the reader. Fixed values.
REPORTING = frozenset(
    "said says say wrote writes quote quoted quotes called calls word words term terms sagte sagt schrieb zitat zitiert wort dit disait écrit cite citation mot dijo dice escribió cita palabra".split()
)
SECOND_PERSON = frozenset("you your youre du dich dir dein deine ihr tu toi ton vous votre usted tú eres vosotros".split())
OPEN_QUOTES, CLOSE_QUOTES, PLAIN_QUOTES = "“„«‹", "”»›", '"'
FEATURES = ("abuse", "quoted", "addressed", "density")
#: What a misspelled term counts beside one spelled right.
MISSPELLED = 0.8


def edits_allowed(length: int) -> int:
    """Edits that a term of so many letters may differ by: none under 6, one under 10, else two."""
    return 0 if length < 6 else 1 if length < 10 else 2


class TermAutomaton:
    """Deterministic product of the lexicon trie and the terms' Levenshtein automata, built as it is used.

    match(word) gives the fewest edits to a term (None: no term). A stem (written "abc*")
    matches words that start with it. At most ``max_states`` states are kept; beyond, it
    starts anew, which costs time and changes no result.
    """

    def __init__(self, terms: list[str], max_states: int = 50_000):
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        self.room: list[int] = [0]
        for term in terms:
            body, stem = term.rstrip("*"), term.endswith("*")
            if not body:
                continue
            k, node = edits_allowed(len(body)), 0
            self.room[0] = max(self.room[0], k)
            for ch in body:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][ch]
                self.room[node] = max(self.room[node], k)
            ends = self.stem if stem else self.whole
            ends[node] = max(ends.get(node, 0), k)
        self.max_states = max_states
        self._restart()

    def _restart(self) -> None:
        self.states: list[dict[str, int]] = []
        self.accept: list[int | None] = []
        self.locked: list[int | None] = []
        self.known: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.start = self._state(self._closed({(0, 0)}, None), None)

    def _closed(self, alive: set[tuple[int, int]], _: object) -> frozenset:
        """With term letters that the word leaves out."""
        best: dict[int, int] = {}
        todo = sorted(alive, key=lambda x: x[1])
        while todo:
            node, e = todo.pop(0)
            if best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(c, e + 1) for c in self.children[node].values() if e + 1 <= self.room[c]]
        return frozenset(best.items())

    def _state(self, alive: frozenset, locked: int | None) -> int:
        stems = [e for n, e in alive if n in self.stem and e <= self.stem[n]]
        locked = min([x for x in (locked, *stems) if x is not None], default=None)
        key = (alive, locked)
        if key in self.known:
            return self.known[key]
        ends = [e for n, e in alive if n in self.whole and e <= self.whole[n]]
        self.known[key] = len(self.states)
        self.states.append({})
        self.sets.append(alive)
        self.locked.append(locked)
        self.accept.append(min([x for x in (locked, *ends) if x is not None], default=None))
        return len(self.states) - 1

    def _step(self, state: int, ch: str) -> int:
        alive: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            if e + 1 <= self.room[node]:
                alive.add((node, e + 1))  # a letter too many
            for c, child in self.children[node].items():
                cost = e + (c != ch)
                if cost <= self.room[child]:
                    alive.add((child, cost))
        after = self._closed(alive, None)
        nxt = self._state(after, self.locked[state]) if after or self.locked[state] is not None else -1
        self.states[state][ch] = nxt
        return nxt

    def match(self, word: str) -> int | None:
        if len(self.states) > self.max_states:
            self._restart()
        state, states = self.start, self.states
        for ch in word:
            nxt = states[state].get(ch)
            if nxt is None:
                nxt = self._step(state, ch)
            if nxt < 0:
                return None
            state = nxt
        return self.accept[state]


@dataclass(frozen=True)
class ToxicityModel:
    terms: tuple[str, ...]
    weights: tuple[float, ...]  # bias, then FEATURES


def _quoted(text: str, start: int, end: int) -> bool:
    """In quotation marks that open before and close after, on the same line."""
    a, b = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    left, right = text[a:start], text[end : b if b >= 0 else len(text)]
    if left.count(PLAIN_QUOTES) % 2 and PLAIN_QUOTES in right:
        return True
    opened = sum(left.count(c) for c in OPEN_QUOTES) > sum(left.count(c) for c in CLOSE_QUOTES)
    return opened and any(c in right for c in CLOSE_QUOTES)


def features(text: str | None, automaton: TermAutomaton, cache: dict[str, int | None]) -> list[float]:
    """Counts of terms meant as abuse, of quoted and of addressed ones (log scaled), and the first kind's share of the words."""
    low = (text or "").lower()
    words = WORD.findall(low)
    hits = []
    for i, w in enumerate(words):
        if w in cache:
            e = cache[w]
        else:
            e = cache[w] = automaton.match(w)
        if e is not None:
            hits.append((i, e))
    if not hits:
        return [0.0] * len(FEATURES)
    places = [m.span() for m in WORD.finditer(low)]
    exact = fuzzy = quoted = addressed = 0
    for i, e in hits:
        around = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
        if _quoted(low, *places[i]) or (not REPORTING.isdisjoint(words[max(0, i - 3) : i])):
            quoted += 1
            continue
        exact += e == 0
        fuzzy += e > 0
        addressed += not SECOND_PERSON.isdisjoint(around)
    n = exact + fuzzy
    return [math.log1p(exact + MISSPELLED * fuzzy), math.log1p(quoted), math.log1p(addressed), min(1.0, 20.0 * n / len(words))]


def learn_terms(labelled: DataFrame, n_toxic: int) -> list[str]:
    """Words and stems ("abc*") that stand in toxic documents almost alone.

    A document counts for a feature by its lowest word hash, so copies of one text count
    once or twice. A term needs ``3 + n_toxic / 400`` such counts and at most one clean
    document for 50 toxic ones; a stem stands for the longer stems and words under it.
    """
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 3))
    rows = labelled.select("toxic", words.alias("words")).withColumn("sketch", F.array_min(F.transform("words", lambda w: F.xxhash64(w))))
    rows = rows.select("toxic", "sketch", F.explode("words").alias("word"))
    stems = F.transform(F.sequence(F.lit(STEM_MIN), F.lit(STEM_MAX)), lambda n: F.when(F.length("word") >= n, F.concat(F.substring("word", F.lit(1), n), F.lit("*"))))
    rows = rows.select("toxic", "sketch", F.explode(F.array_distinct(F.concat(F.array("word"), F.filter(stems, lambda s: s.isNotNull())))).alias("term"))
    counts = rows.groupBy("term").agg(F.countDistinct(F.when(F.col("toxic") == 1, F.col("sketch"))).alias("bad"), F.countDistinct(F.when(F.col("toxic") == 0, F.col("sketch"))).alias("good"))
    need = 3 + n_toxic / 400
    found = counts.filter((F.col("bad") >= need) & (F.col("good") * 50 <= F.col("bad"))).collect()  # from TRAIN_ROWS documents
    kept: list[str] = []
    stemmed: dict[str, int] = {}
    for r in sorted(found, key=lambda r: (len(r["term"].rstrip("*")), not r["term"].endswith("*"), r["term"])):
        body = r["term"].rstrip("*")
        under = next((stemmed[body[:n]] for n in range(STEM_MIN, len(body) + 1) if body[:n] in stemmed), None)
        if under is not None:
            continue
        if r["term"].endswith("*"):
            same = next((x["bad"] for x in found if x["term"] == body), 0)
            longest = max((x["bad"] for x in found if x["term"].endswith("*") and len(x["term"]) > len(r["term"]) and x["term"].startswith(body)), default=0)
            if max(same, longest) >= 0.9 * r["bad"]:  # a longer form carries it: the stem would only reach further than seen
                continue
            stemmed[body] = r["bad"]
        kept.append(r["term"])
    return kept


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 40) -> np.ndarray:
    """Weights (bias first) by Newton's method with a ridge."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5 - 1e-9
        w[0] = math.log(rate / (1 - rate))
        return w
    ridge = np.eye(a.shape[1]) * l2 * len(y)
    ridge[0, 0] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learn lexicon and weights from at most ``train_rows`` labelled documents (both tables already cut to the rows that may be learned from).

    A document labelled more than once is toxic if any label says so; labels that are null
    count for nothing. No labels at all: an empty lexicon and scores of about one half.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    labelled = texts(docs).join(F.broadcast(marked), "doc_id").cache()  # train_rows ids at most
    try:
        n_toxic = labelled.filter("toxic = 1").count()
        terms = learn_terms(labelled, n_toxic) if n_toxic else []
        rows = measured(labelled, terms, keep=("toxic",)).select("toxic", *FEATURES).collect()
    finally:
        labelled.unpersist()
    x = np.array([[r[f] for f in FEATURES] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    y = np.array([r["toxic"] for r in rows], dtype=float)
    return ToxicityModel(tuple(terms), tuple(float(w) for w in logistic(x, y)))


def measured(docs: DataFrame, terms: list[str] | tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to keep and the features of every row's whole text."""
    kept = [f for f in docs.schema.fields if f.name in keep]
    schema = "doc_id long" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in kept) + "".join(f", {f} double" for f in FEATURES)
    term_list = list(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = TermAutomaton(term_list), {}
        for b in batches:
            for s in range(0, b.num_rows, 512):
                part = b.slice(s, 512)
                if len(cache) > 500_000:
                    cache.clear()
                x = np.array([features(t.as_py(), automaton, cache) for t in part.column("text")], dtype=float).reshape(part.num_rows, len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(part.column(f.name) for f in kept), *(pa.array(x[:, i]) for i in range(len(FEATURES)))], names=["doc_id", *(f.name for f in kept), *FEATURES])

    return docs.select("doc_id", *(f.name for f in kept), "text").mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 if score >= 0.5) of every row, in its own right: repeated rows repeat.

    A null or empty text has no term and gets the score of a text without terms.
    """
    z = F.lit(model.weights[0])
    for w, f in zip(model.weights[1:], FEATURES, strict=True):
        z = z + F.lit(w) * F.col(f)
    s = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return measured(texts(docs), model.terms).select("doc_id", s.alias("score"), F.when(s >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows whose score is under 0.5, with all their columns as they were."""
    terms, weights = list(model.terms), np.array(model.weights)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = TermAutomaton(terms), {}
        for b in batches:
            if len(cache) > 500_000:
                cache.clear()
            x = np.array([features(t.as_py(), automaton, cache) for t in b.column(at)], dtype=float).reshape(b.num_rows, len(FEATURES))
            yield b.filter(pa.array(weights[0] + x @ weights[1:] < 0))

    return docs.mapInArrow(run, docs.schema)


def remainder(n: int):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op10(spark, sf_dir: str) -> DataFrame:
    from costlake.llm.common import table

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(remainder(5) != 0))
    return score(docs, model).select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
