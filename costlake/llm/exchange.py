"""Texts dealt to tasks by document: packed, compressed rows for a keyed exchange, so a text crosses the network small and a task reads a bounded number of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.llm.common import mix64

#: Bytes of text that one task holds, about.
GROUP_BYTES = 24 << 20
#: Columns of what is exchanged: kind 0 holds texts (a), the others what an operator puts in.
SCHEMA = "g int, kind int, a binary, b binary, c binary"
#: Stands for a null id: after all others.
NO_ID = np.iinfo(np.int64).max


def total_bytes(rows: DataFrame) -> int:
    return int(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    return (mix64(ids.view(np.uint64)) % np.uint64(groups)).astype(np.int32)


def id_array(column) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in column.to_pylist()], dtype=np.int64)


def packed_texts(rows: DataFrame, groups: int) -> DataFrame:
    """Rows of SCHEMA, kind 0: (doc_id, text) of a batch's rows that go to one group. Repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zip_ = zstandard.ZstdCompressor(level=1)
        for b in batches:
            if not b.num_rows:
                continue
            g = group_of(id_array(b.column(0)), groups)
            for k in np.unique(g).tolist():
                part = b.take(pa.array(np.flatnonzero(g == k)))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema) as w:
                    w.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([0], pa.int32()), pa.array([zip_.compress(sink.getvalue().to_pybytes())], pa.binary()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary())], names=["g", "kind", "a", "b", "c"])

    return rows.select("doc_id", "text").mapInArrow(run, SCHEMA)


def packed_batch(held: list[tuple[int, bytes]]) -> bytes:
    """Texts as kind 0 holds them, from (id or NO_ID, UTF-8 text)."""
    part = pa.record_batch([pa.array([None if d == NO_ID else d for d, _ in held], pa.int64()), pa.array([t for _, t in held], pa.large_binary())], names=["doc_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, part.schema) as w:
        w.write_batch(part)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def unpacked(group: pa.Table) -> Iterator[tuple[int, bytes]]:
    """(id or NO_ID, UTF-8 text) of the texts in a group, in no order."""
    unzip = zstandard.ZstdDecompressor()
    kinds = group.column("kind").to_pylist()
    for i in [i for i, k in enumerate(kinds) if k == 0]:
        part = pa.ipc.open_stream(unzip.decompress(group.column("a")[i].as_py(), max_output_size=1 << 31)).read_all()
        text = part.column(1).cast(pa.binary() if part.schema.field(1).type == pa.string() else pa.large_binary())
        for d, t in zip(part.column(0), text):
            yield (NO_ID if d.as_py() is None else d.as_py()), (t.as_py() or b"")


def packed(kind: int, g: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[tuple]:
    """Rows (g, kind, a, b, c) with the bytes of the entries of each group, in their order."""
    order = np.argsort(g, kind="stable")
    g, a, b, c = g[order], a[order], b[order], c[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]]) if len(g) else [0]
    return [(int(g[s]), kind, a[s:e].tobytes(), b[s:e].tobytes(), c[s:e].tobytes()) for s, e in zip(cuts[:-1], cuts[1:])]


def to_arrow(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.table({n: pa.array(cols[i], t) for i, (n, t) in enumerate(zip(("g", "kind", "a", "b", "c"), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())))})


def entries(group: pa.Table, kind: int, dtypes: tuple) -> list[np.ndarray]:
    """The arrays of a kind's rows, joined."""
    at = [i for i, k in enumerate(group.column("kind").to_pylist()) if k == kind]
    return [np.frombuffer(b"".join(group.column(n)[i].as_py() for i in at), dtype=t) for n, t in zip(("a", "b", "c"), dtypes)]


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans joined where they touch or overlap, by document and start."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    rank = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]])).astype(np.int64)
    room = int(end.max()) + 2
    reach = np.maximum.accumulate(end + rank * room)
    new = np.concatenate([[True], (start + rank * room)[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], reach[last] - rank[first] * room
