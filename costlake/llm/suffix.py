"""Suffix-array dedup: a common-prefix interval tree, stack-scanned from an enhanced suffix array; intervals whose occurrences differ to the left are the maximal repeats, with all their occurrences.

A suffix array of a whole corpus does not fit any task, so the suffixes are first cut to those
that can matter. Each 50-byte window belongs to the class of its smallest 20-byte hash, so
equal windows are in one class wherever they stand; neighbouring windows of a class form a
run. Runs whose first and last windows have the 64-bit key of an earlier document's run go as a whole. Runs
of a class that other texts share only in part get a suffix array of their own, class by
class: there the intervals decide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from costlake.llm import exchange as X
from costlake.llm.common import mix64, table, task_count, texts

LENGTH, SEED = 50, 20
#: Windows of a run, at most: a run then is at most STRIDE + LENGTH - 1 bytes.
STRIDE = LENGTH - SEED + 1
WIDE = STRIDE + LENGTH - 1
#: Suffixes sorted at a time; a class of more is compared window by window, by the windows' hashes.
SORT = 250_000
_C = 0x9E3779B97F4A7C15
_POW = {n: np.uint64(pow(_C, n, 1 << 64)) for n in (1, 2, 4, 8, 16, 32)}
ENTRY = np.dtype([("cls", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("n", "<i4")])


def _sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over every n neighbours."""
    size, cur = 1, x
    while size * 2 <= n:
        cur = op(cur[:-size], cur[size:])
        size *= 2
    return op(cur[: len(cur) - (n - size)], cur[n - size :]) if size < n else cur


def runs(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, class, content key) of a text's runs; none under LENGTH bytes."""
    n = len(text)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h1 = np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)
    h2 = h1[:-1] * _POW[1] + h1[1:]
    h4 = h2[:-2] * _POW[2] + h2[2:]
    h8 = h4[:-4] * _POW[4] + h4[4:]
    h16 = h8[:-8] * _POW[8] + h8[8:]
    h32 = h16[:-16] * _POW[16] + h16[16:]
    seed = mix64(h16[: n - SEED + 1] * _POW[4] + h4[16 : 16 + n - SEED + 1])
    low = _sliding(seed, STRIDE, np.minimum)  # of every window
    new = np.concatenate([[True], low[1:] != low[:-1]])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(low)))
    if count.max() > STRIDE:  # periodic text: cut runs at a fixed length
        pieces = -(-count // STRIDE)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, whole = np.repeat(first, pieces) + step * STRIDE, np.repeat(count, pieces)
        count = np.minimum(STRIDE, whole - step * STRIDE)
    last = first + count - 1
    full = lambda at: mix64((h32[at] * _POW[16] + h16[at + 32]) * _POW[2] + h2[at + 48])
    content = mix64(full(first) ^ mix64(full(last) + count.astype(np.uint64)))
    return first, count, low[first], content


def _classes(rows: DataFrame, buckets: int) -> DataFrame:
    """(bucket, ids of a slice's documents, place in them, class, content) of every document's distinct runs."""
    schema = "bucket int, ids binary, place binary, cls binary, content binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                ids, place, cls, content = X.id_array(part.column(0)), [], [], []
                for i, t in enumerate(part.column(1)):
                    _, _, c, k = runs((t.as_py() or "").encode())
                    if len(k):
                        k, at = np.unique(k, return_index=True)
                        place.append(np.full(len(k), i, np.uint8))
                        cls.append(c[at])
                        content.append(k)
                if not cls:
                    continue
                place, cls, content = np.concatenate(place), np.concatenate(cls), np.concatenate(content)
                bucket = (cls % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
                out = []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    o = order[x:y]
                    used, again = np.unique(place[o], return_inverse=True)
                    c = cls[o]
                    short = np.empty((len(o), 6), np.uint8)  # 48 bits of a class tell it within its bucket
                    short[:] = c.view(np.uint8).reshape(-1, 8)[:, 2:]
                    out.append((int(bucket[o[0]]), ids[used].tobytes(), again.astype(np.uint8).tobytes(), short.tobytes(), content[o].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(col, pa.int32() if i == 0 else pa.binary()) for i, col in enumerate(zip(*out))], names=["bucket", "ids", "place", "cls", "content"])

    return rows.mapInArrow(run, schema)


def _key(cls: np.ndarray, content: np.ndarray) -> np.ndarray:
    """What a document finds its run again by: 48 bits of the class, all of the content, mixed to 63."""
    return mix64(mix64(cls >> np.uint64(16)) ^ content) >> np.uint64(1)


def _judged(rows: DataFrame, buckets: int, groups: int) -> DataFrame:
    """X rows of kind 1: for each document the keys of runs that an earlier document has (bit 0 clear) or that its class shares in part (bit 0 set)."""
    def judge(group: pa.Table) -> pa.Table:
        doc, cls, content = [], [], []
        for ids, place, c, k in zip(*(group.column(n).to_pylist() for n in ("ids", "place", "cls", "content"))):
            doc.append(np.frombuffer(ids, np.int64)[np.frombuffer(place, np.uint8)])
            six = np.zeros((len(c) // 6, 8), np.uint8)
            six[:, 2:] = np.frombuffer(c, np.uint8).reshape(-1, 6)
            cls.append(six.view(np.uint64).ravel())
            content.append(np.frombuffer(k, np.uint64))
        doc, cls, content = np.concatenate(doc), np.concatenate(cls), np.concatenate(content)
        order = np.lexsort((doc, content, cls))
        doc, cls, content = doc[order], cls[order], content[order]
        new_c = np.concatenate([[True], cls[1:] != cls[:-1]])
        new_k = new_c | np.concatenate([[True], content[1:] != content[:-1]])
        in_c, in_k = np.cumsum(new_c) - 1, np.cumsum(new_k) - 1
        at = np.flatnonzero(new_c)
        several = (np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at))[in_c]
        earliest = doc[np.flatnonzero(new_k)][in_k]
        mixed = (np.add.reduceat(new_k.astype(np.int64), at) > 1)[in_c]
        go, ask = earliest < doc, several & mixed & (earliest == doc)
        hit = np.flatnonzero(go | ask)
        key = (_key(cls[hit], content[hit]) << np.uint64(1)) | ask[hit].astype(np.uint64)
        by = np.argsort(doc[hit], kind="stable")
        none = np.zeros(len(hit), np.uint8)
        return X.to_arrow(X.packed(1, X.group_of(doc[hit][by], groups), doc[hit][by], key[by], none[:0] if not len(hit) else none))

    return _classes(rows, buckets).groupBy("bucket").applyInArrow(judge, X.SCHEMA)


def _asked(group: pa.Table, classes: int) -> pa.Table:
    """From a group's texts and keys: spans that go (kind 2, back to the group) and runs to be compared (kind 3, to their class)."""
    doc, key, _ = X.entries(group, 1, (np.int64, np.uint64, np.uint8))
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    g, done, runs_, bodies = group.column("g")[0].as_py(), [], [], []
    for d, text in X.unpacked(group):
        a, b = np.searchsorted(doc, d, "left"), np.searchsorted(doc, d, "right")
        if a == b:
            continue
        mine = key[a:b]
        first, count, cls, content = runs(text)
        own = _key(cls, content)
        at = np.minimum(np.searchsorted(mine >> np.uint64(1), own), len(mine) - 1)
        found = (mine[at] >> np.uint64(1)) == own
        go = np.flatnonzero(found & ((mine[at] & np.uint64(1)) == 0))
        if len(go):
            done.append(X.merged(np.full(len(go), d), first[go], first[go] + count[go] + LENGTH - 1))
        ask = np.flatnonzero(found & ((mine[at] & np.uint64(1)) == 1))
        if len(ask):
            e = np.zeros(len(ask), ENTRY)
            e["cls"], e["doc"], e["start"], e["n"] = cls[ask] >> np.uint64(16), d, first[ask], count[ask] + LENGTH - 1
            runs_.append(e)
            padded = np.frombuffer(text + bytes(WIDE), np.uint8)
            body = np.lib.stride_tricks.sliding_window_view(padded, WIDE)[first[ask]].copy()
            body[np.arange(WIDE)[None, :] >= e["n"][:, None]] = 0
            bodies.append(body)
    out = []
    if done:
        d, s, e = (np.concatenate(x) for x in zip(*done))
        out += X.packed(2, np.full(len(d), -1 - g, np.int32), d, s, e)
    if runs_:
        e, body = np.concatenate(runs_), np.concatenate(bodies)
        bucket = (mix64(e["cls"]) % np.uint64(classes)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
        out += [(int(bucket[order[x]]), 3, e[order[x:y]].tobytes(), body[order[x:y]].tobytes(), b"") for x, y in zip(cuts[:-1], cuts[1:])]
    return X.to_arrow(out)


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last + 1) of the intervals of a suffix array that are maximal repeats of ``least`` or more.

    ``lcp[i]``: letters that suffix i shares with the one before; ``left``: the letter before
    each suffix (negative: none, which differs from all). A stack holds the open intervals of
    the common-prefix tree, each with the letter that all its suffixes have to their left, or
    DIFFER when they have not the same one.
    """
    differ, out, stack = -2, [], []  # (length, first, left letter)

    def both(a: int, b: int) -> int:
        return a if a == b and a >= 0 else differ

    n, lcp_, left_ = len(left), lcp.tolist(), left.tolist()
    for i in range(1, n + 1):
        depth = lcp_[i] if i < n else 0
        first, letter = i - 1, left_[i - 1]
        while stack and stack[-1][0] > depth:
            length, first, held = stack.pop()
            letter = both(held, letter)
            if letter == differ:
                out.append((length, first, i))
            if stack and stack[-1][0] >= depth:  # its suffixes count for the interval around it
                stack[-1] = (stack[-1][0], stack[-1][1], both(stack[-1][2], letter))
                letter = stack[-1][2]
        if depth >= least:
            if stack and stack[-1][0] == depth:
                stack[-1] = (depth, stack[-1][1], both(stack[-1][2], letter))
            else:
                stack.append((depth, first, letter))
    return out


def enhanced_array(body: np.ndarray, size: np.ndarray, least: int):
    """(text number, place, lcp, letter before) of the suffixes of ``least`` or more of short texts (rows of ``body``), in their order."""
    per = size - least + 1
    text = np.repeat(np.arange(len(size)), per)
    place = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    wide = np.concatenate([body, np.zeros_like(body)], axis=1)
    suffix = np.lib.stride_tricks.sliding_window_view(wide, body.shape[1], axis=1)[text, place]
    order = np.argsort(np.ascontiguousarray(suffix).view(f"S{body.shape[1]}").ravel(), kind="stable")
    text, place, suffix = text[order], place[order], suffix[order]
    unlike = suffix[1:] != suffix[:-1]
    same = np.where(unlike.any(axis=1), unlike.argmax(axis=1), body.shape[1])
    rest = (size[text] - place)
    lcp = np.concatenate([[0], np.minimum(same, np.minimum(rest[1:], rest[:-1]))])
    before = np.where(place > 0, body[text, np.maximum(place - 1, 0)].astype(np.int64), -1)
    return text, place, lcp, before


def _by_window(part: np.ndarray, body: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Spans of a large class that an earlier document has: windows of ``length`` in passes over shares of their hashes, some 16 * SORT in each, so memory grows with the runs only."""
    per = part["n"].astype(np.int64) - length + 1
    passes, out = max(1, -(-int(per.sum()) // (16 * SORT))), []
    power = np.array([pow(_C, j + 1, 1 << 64) for j in range(length)], dtype=np.uint64)
    for k in range(passes):
        held = []
        for s in range(0, len(part), 4096):
            b = body[s : s + 4096].astype(np.uint64) + np.uint64(1)
            h = np.zeros((len(b), b.shape[1] - length + 1), np.uint64)
            for j in range(length):
                h += b[:, j : j + h.shape[1]] * power[j]
            h = mix64(h)
            i, at = np.nonzero((np.arange(h.shape[1])[None, :] < per[s : s + 4096, None]) & (h % np.uint64(passes) == k))
            held.append((h[i, at], (i + s).astype(np.int32), at.astype(np.int8)))
        h, i, at = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((part["doc"][i], h))
        h, i, at = h[order], i[order], at[order]
        new = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        hit = np.flatnonzero(part["doc"][i] != part["doc"][i[first]])
        for s in range(0, len(hit), 65_536):  # byte for byte
            x = hit[s : s + 65_536]
            y = first[x]
            cols = np.arange(length)
            same = (body[i[x, None], at[x, None] + cols] == body[i[y, None], at[y, None] + cols]).all(axis=1)
            x = x[same]
            start = part["start"][i[x]] + at[x]
            if len(x):
                out.append(X.merged(part["doc"][i[x]], start, start + length))
    return out


def _compared(group: pa.Table, groups: int, length: int = LENGTH) -> pa.Table:
    """Spans (kind 2) to the documents' groups: those that came pass on; runs of classes are compared."""
    g = group.column("g")[0].as_py()
    if g < 0:
        rows = zip(*(group.column(n).to_pylist() for n in ("a", "b", "c")))
        return X.to_arrow([(-1 - g, 2, a, b, c) for a, b, c in rows])
    e, body, _ = X.entries(group, 3, (ENTRY, np.uint8, np.uint8))
    body = body.reshape(len(e), WIDE)
    order = np.argsort(e["cls"], kind="stable")
    e, body = e[order], body[order]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(e["cls"])) + 1, [len(e)]])
    upto = np.concatenate([[0], np.cumsum(e["n"] - length + 1)])[edge]
    out, x = [], 0
    while x < len(edge) - 1:
        y = max(x + 1, int(np.searchsorted(upto, upto[x] + SORT, "right")) - 1)
        a, b = edge[x], edge[y]
        large, x = upto[y] - upto[x] > SORT, y
        part = e[a:b]
        if large:  # one class
            out += _by_window(part, body[a:b], length)
            continue
        text, place, lcp, before = enhanced_array(body[a:b], part["n"].astype(np.int64), length)
        doc, best = part["doc"][text], np.zeros(len(text), np.int64)
        lcp = np.where(lcp >= length, lcp, 0)
        for n, first, last in maximal_repeats(lcp, before, length):
            here = doc[first:last]
            later = here > here.min()
            if later.any():
                best[first:last] = np.maximum(best[first:last], later * n)
        hit = np.flatnonzero(best)
        if len(hit):
            start = part["start"][text[hit]] + place[hit]
            out.append(X.merged(doc[hit], start, start + best[hit]))
    if not out:
        return X.to_arrow([])
    d, s, t = (np.concatenate(z) for z in zip(*out))
    return X.to_arrow(X.packed(2, X.group_of(d, groups), d, s, t))


def repeated_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(X rows of the spans to remove, the rows (doc_id, text) they belong to, groups)."""
    rows = texts(docs)
    size, tasks = X.total_bytes(rows), task_count(docs.sparkSession)
    groups = max(tasks, -(-size // X.GROUP_BYTES))
    classes = max(4 * tasks, -(-size // (6 << 20)))
    asked = X.packed_texts(rows, groups).unionByName(_judged(rows, max(2 * tasks, -(-size // (12 << 20))), groups))
    found = asked.groupBy("g").applyInArrow(lambda t: _asked(t, classes), X.SCHEMA)
    return found.groupBy("g").applyInArrow(lambda t: _compared(t, groups), X.SCHEMA), rows, groups


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every row.

    A byte goes if a 50-byte string that covers it also starts in a document of smaller
    doc_id, as the input stands. Null texts are empty. Rows of one id are one document here:
    none is smaller than the other. A null id comes after all others.
    """
    spans, rows, groups = repeated_spans(docs)

    def cut(group: pa.Table) -> pa.Table:
        doc, start, end = X.merged(*X.entries(group, 2, (np.int64, np.int64, np.int64)))
        out = []
        for d, text in X.unpacked(group):
            a, b = np.searchsorted(doc, d, "left"), np.searchsorted(doc, d, "right")
            s, e = np.minimum(start[a:b], len(text)), np.minimum(end[a:b], len(text))  # rows of one id may be shorter
            s, e = s[s < e].tolist(), e[s < e].tolist()
            kept = b"".join(text[x:y] for x, y in zip([0, *e], [*s, len(text)]))
            out.append((None if d == X.NO_ID else d, len(text), len(text) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*out)) if out else [[]] * 6
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"), cols, (pa.int64(),) * 4 + (pa.string(), pa.binary()))})

    both = X.packed_texts(rows, groups).unionByName(spans)
    return both.groupBy("g").applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op1(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).drop("kept")


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS p FROM d)),
shared AS (SELECT s, min(doc_id) AS first FROM windows GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS step FROM windows JOIN shared USING (s) WHERE doc_id > first),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b
  FROM (SELECT *, sum(if(step <= 50, 0, 1)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM gone) GROUP BY doc_id, run),
kept AS (SELECT doc_id, substr(h, 2 * coalesce(lag(b) OVER w, 0) + 1, 2 * (a - coalesce(lag(b) OVER w, 0))) AS piece, a, b FROM spans JOIN d USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY a)),
joined AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS before, max(b) AS last, sum(b - a) AS removed, count(*) AS n FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(before, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN joined USING (doc_id)
"""
