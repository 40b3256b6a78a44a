"""Byte-level BPE by overlapping chunks: pre-tokenise and encode chunks in parallel, stitch where pre-token boundaries meet again; decoding joins raw bytes.

A text is cut every ``CHUNK`` characters and each chunk reads ``OVERLAP`` characters into the
next. What follows a pre-token boundary depends on the text after it alone, so once two
neighbouring chunks share a boundary in their overlap they agree from there on: the earlier
chunk's pre-tokens count up to that place, the later one's after it. Boundaries that the cut
itself may have made are never used. A chunk pair without a common boundary (one pre-token
longer than the overlap) sends the text through whole, so the result is exact for any text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import table, task_count, texts

CHUNK, OVERLAP = 65_536, 4_096
#: Characters before a chunk's cut end in which a boundary may come from the cut (a contraction has three).
GUARD = 3
#: Pre-tokens that a worker remembers, at most.
REMEMBERED = 800_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest ranked neighbouring pair merges until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 128:
        return _merge_long(piece, ranks)
    get, none = ranks.get, 1 << 60
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]  # rank of each part with the next
    while pairs and (low := min(pairs)) != none:
        i = pairs.index(low)
        parts[i] += parts[i + 1]
        del parts[i + 1], pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap and linked parts: n log n, for pre-tokens of many bytes."""
    import heapq

    n = len(piece)
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))  # part i is piece[i:end[i]]
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop or end[i] >= stop:
            continue
        j = end[i]
        alive[j], end[i] = False, stop
        if stop < n:
            left[stop] = i
            if (r := ranks.get(piece[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if left[i] >= 0 and (r := ranks.get(piece[left[i] : stop])) is not None:
            heapq.heappush(heap, (r, left[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Encodes pre-tokens and remembers their ids, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, rank_path: str, pattern: str):
        self.ranks, self.pattern, self.known = load_ranks(rank_path), regex.compile(pattern), {}
        self.raw = [b""] * (max(self.ranks.values()) + 1)
        for piece, i in self.ranks.items():
            self.raw[i] = piece

    def packed(self, pre: list[str]) -> list[bytes]:
        known, out = self.known, []
        if len(known) > REMEMBERED:
            known.clear()
        for p in pre:
            ids = known.get(p)
            if ids is None:
                ids = array("I", merge(p.encode(), self.ranks)).tobytes()
                if len(p) < 64:
                    known[p] = ids
            out.append(ids)
        return out

    def encode(self, text: str) -> bytes:
        return b"".join(self.packed(self.pattern.findall(text)))

    def decode(self, ids: bytes) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


@functools.lru_cache(maxsize=2)
def encoder(rank_path: str, pattern: str) -> Encoder:
    """One for a worker process: the vocabulary is read once."""
    return Encoder(rank_path, pattern)


def encode(docs: DataFrame, rank_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) of every row's whole text.

    A null text is an empty one. Repeated rows and repeated ids each give their row. The rank
    file must lie at the same path on every machine.
    """
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.length("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_path, pattern)
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([enc.encode(t.as_py()) for t in part.column(1)], pa.binary())], names=["doc_id", "ids"])

    short = rows.filter(size <= chunk).mapInArrow(whole, "doc_id long, ids binary")

    # copies of a row are alike and share a key; they come back by their count
    parts = rows.filter(size > chunk).select("doc_id", F.xxhash64("text").alias("h"), size.alias("n"), "text", F.explode(F.sequence(F.lit(0), size - 1, F.lit(chunk))).alias("at"))
    parts = parts.select("doc_id", "h", "n", "at", F.substring("text", F.col("at") + 1, F.lit(chunk + overlap)).alias("text"))
    parts = parts.repartition(task_count(docs.sparkSession), "h", "at")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_path, pattern)
        for b in batches:
            for r in range(b.num_rows):
                one = b.slice(r, 1)
                text = one.column(4)[0].as_py()
                pre = enc.pattern.findall(text)
                ids = enc.packed(pre)
                ends = np.cumsum([len(p) for p in pre], dtype=np.int64) + one.column(3)[0].as_py()
                n_ids = np.array([len(x) // 4 for x in ids], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*(one.column(i) for i in range(5)), *(pa.array([x], pa.binary()) for x in (ends.tobytes(), n_ids.tobytes(), b"".join(ids)))], names=["doc_id", "h", "n", "at", "text", "ends", "n_ids", "ids"])

    done = parts.mapInArrow(pieces, "doc_id long, h long, n int, at int, text string, ends binary, n_ids binary, ids binary")

    def stitch(group: pa.Table) -> pa.Table:
        """One text's chunks: bounded by the text."""
        enc = encoder(rank_path, pattern)
        at, first, copies = group.column("at").to_pylist(), {}, 0
        for i, a in enumerate(at):
            first.setdefault(a, i)
            copies += a == 0
        order = [first[a] for a in sorted(first)]
        n = group.column("n")[0].as_py()
        get = lambda name, i, kind: np.frombuffer(group.column(name)[i].as_py(), dtype=kind)
        ends = [get("ends", i, np.int64) for i in order]
        starts = [at[i] for i in order]
        cuts = [0]
        for k in range(1, len(order)):
            limit = min(n, starts[k] + overlap)
            known = ends[k - 1][(ends[k - 1] >= starts[k]) & ((ends[k - 1] <= limit - GUARD - 1) | (limit == n))]
            heads = np.concatenate([[starts[k]], ends[k]])
            common = np.intersect1d(known, heads)
            if not len(common):
                text = "".join(group.column("text")[i].as_py()[:chunk] for i in order)
                out = enc.encode(text)
                break
            cuts.append(int(common[0]))
        else:
            cuts.append(n)
            out = b""
            pieces_ = []
            for k, i in enumerate(order):
                begin = np.concatenate([[starts[k]], ends[k][:-1]])
                upto = np.concatenate([[0], np.cumsum(get("n_ids", i, np.int32), dtype=np.int64)])
                a, b = np.searchsorted(begin, cuts[k]), np.searchsorted(begin, cuts[k + 1])
                pieces_.append(group.column("ids")[i].as_py()[4 * int(upto[a]) : 4 * int(upto[b])])
            out = b"".join(pieces_)
        return pa.table({"doc_id": pa.array([group.column("doc_id")[0].as_py()] * copies, pa.int64()), "ids": pa.array([out] * copies, pa.binary())})

    return short.unionByName(done.groupBy("doc_id", "h", "n").applyInArrow(stitch, "doc_id long, ids binary"))


def digests(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and, of the ids decoded, decoded_sha256."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(rank_path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            ids = b.column("ids").to_pylist()
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha(x) for x in ids]), pa.array([sha(enc.decode(x)) for x in ids])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op4(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return digests(encode(table(spark, sf_dir, "documents"), path, pattern), path, pattern)
