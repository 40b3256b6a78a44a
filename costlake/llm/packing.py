"""Best-fit packing: bounded-space online best-fit, a fixed number of open bins in a bitset keyed by free space; the fullest closes first.

Pieces are dealt by hash into shards of bounded size, each shard's pieces arrive longest
first, and each goes to the open bin with the least room that holds it. Only a shard's last
bins can stay part empty, so waste falls as the input grows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import table, texts

SIZE = 2048
#: Open bins of a shard; bytes of text and rows that a shard holds about.
OPEN_BINS, SHARD_BYTES, SHARD_ROWS = 32_768, 256 << 20, 400_000
#: The id after each document.
END = 0
REMEMBERED = 400_000


class Bins:
    """Open bins by free space: bit f of ``bits`` is set when a bin with f tokens free is open."""

    def __init__(self, size: int = SIZE, limit: int = OPEN_BINS):
        self.size, self.limit, self.bits, self.open, self.made = size, limit, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        b = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return b

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece of 1 to ``size`` tokens."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            free, b = self.size, self.made
            self.made += 1
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.bits |= 1 << left
            self.open += 1
        return b, self.size - free


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    """(encode a piece, memory of pieces, added tokens, where they stand) of a byte-level tokenizer file, read once for a worker.

    The file's vocabulary is loaded into the faster of the two BPE libraries at hand; ids are
    the same (a test compares them).
    """
    import tiktoken

    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    vocab, added = file["model"]["vocab"], {t["content"]: t["id"] for t in file["added_tokens"]}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves in the file
    alphabet = {chr(b): b for b in shown}
    alphabet.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))})
    ranks = {bytes(alphabet[c] for c in word): i for word, i in vocab.items() if all(c in alphabet for c in word) and word not in added}
    stands = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), {}, added, stands


def packed_ids(text: str, path: str) -> bytes:
    """Ids of a text as little-endian unsigned 32-bit integers.

    The file's added tokens are cut out of the text first and get their own id; what is between them is plain text.
    """
    enc, known, added, stands = _tokenizer(path)
    if stands is None:
        return _plain_ids(text, enc, known)
    return b"".join(np.array([added[x]], dtype="<u4").tobytes() if i % 2 else _plain_ids(x, enc, known) for i, x in enumerate(stands.split(text)))


def _plain_ids(text: str, enc, known: dict) -> bytes:
    """Ids of a text without added tokens.

    Cut before every single blank between two other characters: no pre-token spans that place,
    so the pieces encode on their own and words seen before are looked up.
    """
    words = text.split(" ")
    if "" in words[1:] or not words[0] or any(w[0].isspace() or w[-1].isspace() for w in words if w and not (w[0].isalnum() and w[-1].isalnum())):
        return np.array(enc.encode_ordinary(text), dtype="<u4").tobytes()  # runs of white space
    if len(known) > REMEMBERED:
        known.clear()
    out = [np.array(enc.encode_ordinary(words[0]), dtype="<u4").tobytes()]
    for w in words[1:]:
        ids = known.get(w)
        if ids is None:
            ids = np.array(enc.encode_ordinary(" " + w), dtype="<u4").tobytes()
            if len(w) < 64:
                known[w] = ids
        out.append(ids)
    return b"".join(out)


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, the first may be shorter."""
    if n <= size:
        return [(0, n)]
    first = n % size or size
    return [(0, first), *((s, size) for s in range(first, n, size))]


def pieces(docs: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and slot (a number within the task, to deal copies of a row apart)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, slot = np.array([END], dtype="<u4").tobytes(), 0
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part, out = b.slice(s, 256), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = packed_ids(text or "", path) + end
                    for k, (start, n) in enumerate(cut(len(ids) // 4, size)):
                        out.append((doc, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)]), slot))
                        slot += 1
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if i != 1 else pa.int32()) for i, x in enumerate(zip(*out))], names=["doc_id", "piece", "start", "length", "ids_crc32", "slot"])

    return texts(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, slot long")


def pack(docs: DataFrame, path: str, size: int = SIZE, open_bins: int = OPEN_BINS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row.

    A null text is an empty one (the end id alone). The tokenizer file's added tokens (such as
    ``<|endoftext|>``) get their own id wherever a text has them. A very long text is one row's
    work and gives as many pieces as it needs. Repeated rows are packed each for itself. An
    empty table gives no rows.
    """
    total = docs.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first()
    shards = max(1, -(-(total["rows"] or 0) // SHARD_ROWS), -(-(total["bytes"] or 0) // SHARD_BYTES))
    dealt = pieces(docs, path, size).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "slot"), F.lit(shards)).cast("int"))

    def fill(group: pa.Table) -> pa.Table:
        length, doc, piece, slot = (group.column(c).to_numpy(zero_copy_only=False) for c in ("length", "doc_id", "piece", "slot"))
        order = np.lexsort((slot, piece, np.nan_to_num(doc, nan=-1), -length))
        bins, seq, off = Bins(size, open_bins), np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        base = group.column("shard")[0].as_py() << 40
        for i, n in zip(order.tolist(), length[order].tolist()):
            b, off[i] = bins.place(n)
            seq[i] = base + b
        return group.select(["doc_id", "piece", "start", "length", "ids_crc32"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(off))

    return dealt.groupBy("shard").applyInArrow(fill, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op5(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
