"""Periodic runs of words by scale-tiled distribution.

A run is a maximal stretch of words of smallest period q (words q apart are alike), at least
``LEAST`` words and two periods long. Periods fall into octaves [q0, 2 q0); in an octave a run
holds a multiple of q0 at which the words agree with those one period later, so every such
place is a boundary. A document is exploded into overlapping tiles for each octave; a tile
holds some neighbouring boundaries and two octaves of words around them, and is solved by
itself: the Z-function of the words after a boundary, and that of the words before it read
backwards, say how far they agree at every period of the octave. The pieces of runs, cut at the
tiles' margins, are shuffled by document and period and stitched where they touch.

Only boundaries at which a run can lie become tiles: all stretches of GRAM words of a run recur
in the document within the octave, so boundaries without a long enough chain of such stretches
have none. That is a bound, not a sample: no run is lost by it.

Words are what stands between ASCII blanks. A null or empty text has no words; rows are told
apart by their own number, so repeated and null ids are rows like others. A text of any length
is one row of the table; its tiles are dealt out separately.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import ensure_checkpoint_dir, mix64, table, task_count, texts

LEAST = 12
#: A run agrees with itself one period on over LEAST / 2 places or more, so one stretch of so many words recurs.
GRAM = LEAST // 2
#: First octave: periods below FIRST, boundaries at half of it; from then on octaves [q, 2 q) with boundaries at every q.
FIRST = 8
#: Words that the boundaries of a tile span, unless one octave is more; words looked at together in a task.
CORE, TOGETHER = 16_384, 500_000
RUNS = "array<struct<start: bigint, period: bigint, length: bigint>>"


def octaves(n: int) -> Iterator[tuple[int, int, int]]:
    """(least period, next octave's least, distance of boundaries) for texts of n words."""
    yield 1, FIRST, FIRST // 2
    q = FIRST
    while 2 * q <= n:
        yield q, 2 * q, q
        q *= 2


def recurrence(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How far on the GRAM words at each place next stand in the same document; a huge number if nowhere."""
    out = np.full(len(words), np.iinfo(np.int64).max)
    if len(words) < GRAM:
        return out
    x = mix64(words + 1)
    h = np.zeros(len(words) - GRAM + 1, dtype=np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[k : len(h) + k]
    at = np.flatnonzero(doc[: len(h)] == doc[GRAM - 1 :])
    order = at[np.argsort(h[at], kind="stable")]
    a, b = order[:-1], order[1:]
    same = (h[a] == h[b]) & (doc[a] == doc[b])
    out[a[same]] = (b - a)[same]
    return out


def boundaries(step_on: np.ndarray, first: np.ndarray, q0: int, q1: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, place in it) of the boundaries that can lie in a run of the octave. ``first``: where each document begins."""
    near = np.zeros(len(step_on) + 2, dtype=np.int8)
    near[1:-1] = step_on < q1
    edge = np.diff(near)
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = e - s >= max(LEAST - q1 + 1, q0, GRAM) - GRAM + 1
    s, e = s[long], e[long] + GRAM - 1
    doc = np.searchsorted(first, s, "right") - 1
    lo, hi = -(-(s - first[doc]) // step), -(-(e - first[doc]) // step)  # multiples of step from lo to hi - 1
    n = np.maximum(hi - lo, 0)
    place = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = np.unique(np.repeat(doc, n) * np.int64(1 << 40) + place)
    return key >> 40, (key & ((1 << 40) - 1)) * step


def tiles(words: np.ndarray, doc: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(document, q0, first boundary, boundaries, words around them) of every octave; the words begin q1 before the first boundary, or with the text."""
    step_on = recurrence(words, doc)
    for q0, q1, step in octaves(int(sizes.max(initial=0))):
        d, c = boundaries(step_on, first, q0, q1, step)
        if not len(d):
            continue
        new = np.concatenate([[True], (np.diff(d) != 0) | (np.diff(c) != step)])
        start = np.flatnonzero(new)
        nth = np.arange(len(d)) - np.repeat(start, np.diff(np.append(start, len(d))))
        start = np.flatnonzero(new | (nth % max(1, CORE // step) == 0))
        for a, b in zip(start.tolist(), np.append(start[1:], len(d)).tolist()):
            k, lo, hi = int(d[a]), int(c[a]), int(c[b - 1])
            base, n = int(first[k]), int(sizes[k])
            yield k, q0, lo, b - a, words[base + max(0, lo - q1) : base + min(n, hi + 2 * q1)]


def z_function(s: list[int], n: int) -> list[int]:
    """For i < n: how many words from place i on agree with those from the beginning."""
    z, left, right, size = [0] * n, 0, 0, len(s)
    for i in range(1, n):
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        elif s[i] != s[0]:
            continue
        else:
            k = 1
        while i + k < size and s[k] == s[i + k]:
            k += 1
        left, right = i, i + k
        z[i] = k
    return z


@lru_cache(maxsize=1 << 16)
def parts(q: int) -> tuple[int, ...]:
    """q divided by each of its prime factors."""
    out, rest, p = [], q, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            out.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return tuple(out)


def solve(s: list[int], q0: int, lo: int, number: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the stretches of a tile that agree with themselves one period on: the places, not the words; periods that are not smallest are left out."""
    q1, step = (FIRST, FIRST // 2) if q0 == 1 else (2 * q0, q0)
    base = max(0, lo - q1)
    open_: dict[int, tuple[int, int]] = {}
    for c in range(lo, lo + number * step, step):
        at = c - base
        after = s[at : at + 2 * q1]
        widest = min(q1 - 1, len(after))
        if widest < q0:
            continue
        before = s[max(0, at - q1) : at]
        forward = z_function(after, min(widest + 1, len(after)))
        back = z_function([*before[::-1], -1, *after[:widest][::-1], *before[::-1]], len(before) + 1 + widest)
        for q in range(q0, widest + 1):
            right = forward[q] if q < len(after) else 0
            left = back[len(before) + 1 + widest - q]
            if left + right < q or any(forward[p] >= q - p for p in parts(q)):
                continue
            x, y = c - left, c + right
            if q in open_ and x <= open_[q][1]:
                open_[q] = (min(x, open_[q][0]), max(y, open_[q][1]))
                continue
            if q in open_:
                yield q, *open_[q]
            open_[q] = (x, y)
    for q, (x, y) in open_.items():
        yield q, x, y


SIFTED = "slot long, kind int, doc_id long, q0 int, lo long, number int, body binary"


def _sift(want_clean: bool):
    """Of (slot, doc_id, text): rows of texts without tiles with their words joined, or else tiles (kind 1) and their texts (kind 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)

        def looked_at(rows: list[tuple[int, int | None, list[bytes]]]) -> pa.RecordBatch | None:
            number: dict = defaultdict(count().__next__)
            sizes = np.array([len(w) for _, _, w in rows], dtype=np.int64)
            first = np.cumsum(sizes) - sizes
            words = np.concatenate([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for _, _, w in rows])
            full = np.flatnonzero(sizes)
            found: dict[int, list] = defaultdict(list)
            for k, q0, lo, n, body in tiles(words, np.repeat(np.arange(len(rows)), sizes), first[full], sizes[full]):
                found[int(full[k])].append((q0, lo, n, None if want_clean else zip_.compress(body.astype(np.int32).tobytes())))
            out: list[tuple] = []
            for i, (slot, doc_id, w) in enumerate(rows):
                if want_clean:
                    if i not in found:
                        out.append((slot, 0, doc_id, 0, 0, 0, b" ".join(w)))
                elif i in found:
                    out.append((slot, 0, doc_id, 0, 0, 0, zip_.compress(b" ".join(w))))
                    out += [(slot, 1, doc_id, *t) for t in found[i]]
            if not out:
                return None
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["slot", "kind", "doc_id", "q0", "lo", "number", "body"])

        for b in batches:
            rows: list[tuple[int, int | None, list[bytes]]] = []
            n = 0
            for slot, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = text.as_py()
                rows.append((slot, doc_id, t.encode().split() if t else []))
                n += len(rows[-1][2])
                if n >= TOGETHER:
                    if (out := looked_at(rows)) is not None:
                        yield out
                    rows, n = [], 0
            if rows and (out := looked_at(rows)) is not None:
                yield out

    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        out = []
        for slot, q0, lo, n, body in zip(*(b.column(i).to_pylist() for i in range(5))):
            words = np.frombuffer(unzip.decompress(body), dtype=np.int32).tolist()
            out += [(slot, q, x, y) for q, x, y in solve(words, q0, lo, n)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["slot", "period", "x", "y"])


def _stitched(pieces: DataFrame) -> DataFrame:
    """slot, runs: pieces of one document and period are joined where they touch; those long enough are runs."""
    order = Window.partitionBy("slot", "period").orderBy("x", "y")
    reached = F.max("y").over(order.rowsBetween(Window.unboundedPreceding, -1))
    nth = F.sum(F.when(F.col("x") <= F.col("reached"), 0).otherwise(1)).over(order)
    whole = pieces.withColumn("reached", reached).withColumn("nth", nth).groupBy("slot", "period", "nth").agg(F.min("x").alias("start"), F.max("y").alias("y"))
    length = F.col("y") - F.col("start") + F.col("period")
    runs = whole.select("slot", "start", "period", length.alias("length")).filter((F.col("length") >= LEAST) & (F.col("length") >= 2 * F.col("period")))
    return runs.groupBy("slot").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))  # of one text


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unzip = zstandard.ZstdDecompressor()
    for b in batches:
        out = []
        for body, runs in zip(b.column(1), b.column(2).to_pylist()):
            words = unzip.decompress(body.as_py()).split()
            step = np.zeros(len(words) + 1, dtype=np.int64)
            for r in runs or []:
                step[r["start"] + r["period"]] += 1
                step[r["start"] + r["length"]] -= 1
            keep = np.cumsum(step[:-1]) == 0
            out.append(b" ".join(words[i] for i in np.flatnonzero(keep).tolist()).decode())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(out, pa.string())], names=["doc_id", "runs", "collapsed"])


def collapse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs (by start, then period), collapsed: the words joined by single blanks, without those that a run holds after its first period. A row for each row of ``docs``."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = texts(docs, id_col, text_col).withColumn("slot", F.monotonically_increasing_id()).select("slot", "doc_id", "text")
    clean = rows.mapInArrow(_sift(True), SIFTED).select("doc_id", F.array().cast(RUNS).alias("runs"), F.col("body").cast("string").alias("collapsed"))
    found = rows.mapInArrow(_sift(False), SIFTED).checkpoint()  # tiles and texts of one pass: their numbers agree
    dealt = found.filter("kind = 1").select("slot", "q0", "lo", "number", "body").repartition(4 * task_count(docs.sparkSession), "slot", "q0", "lo")  # compressed: their size says little of the work
    runs = _stitched(dealt.mapInArrow(_solved, "slot long, period long, x long, y long"))
    marked = found.filter("kind = 0").select("slot", "doc_id", "body").join(runs, "slot", "left").select("doc_id", "body", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    return clean.unionByName(marked.mapInArrow(_collapsed, f"doc_id long, runs {RUNS}, collapsed string"))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, period, length of every run."""
    return collapse(docs, id_col, text_col).select("doc_id", F.inline("runs"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id, text; one document in ten repeats its own words from some place on (by crc32 of the id)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def cycled(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        at = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, at(i))), " ")).otherwise("")

    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), F.transform(F.array(words), cycled)[0]).otherwise(F.col("text")))


def op11(spark, sf_dir: str) -> DataFrame:
    rows = collapse(with_planted_runs(texts(table(spark, sf_dir, "documents"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    rows = rows.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
