"""N-gram Jaccard join by parity sketches: tokens are XOR-hashed into bit sketches, sketches meet by the pigeonhole principle within size bands, pairs are verified exactly.

A sketch holds, for each bit, the parity of the shingles that hash there, so the Hamming
distance of two sketches is at most the sets' symmetric difference, which at likeness 0.75 is
at most (|A| + |B|) / 7. The wide sketch of a size band is cut into parts, about as many as
that bound; a part that no differing shingle falls in is equal in both. Each part is a join
key (the XOR of its shingles' hashes, which is the hash of the part's bits). ``KEYS`` parts
with enough shingles are kept for a text, by as many rounds as it takes: at a likeness of
exactly 0.75 about 18 of them are expected to agree, so a pair is missed with a probability
of the order of 1e-8, less above.

Equal sets are one node from the start. Large key groups are never paired out: they give a
star first, and only where components remain apart are their members compared, sketch against
sketch, in blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import ensure_checkpoint_dir, mix64, table, task_count, texts

WORDS, LIKE = 5, 75  # words of a shingle; hundredths
KEYS, SKETCH = 96, 2048  # parts kept of a text and band; bits of the sketch that filters pairs
SMALL = 6  # members of a key group that are all paired
BLOCK = 512  # members of a block when a large group is compared
#: Ids of texts to verify that may be broadcast; beyond, the texts are shuffled to them.
BROADCAST_IDS = 500_000
REMEMBERED = 500_000
_ODD = np.array([pow(0x9E3779B97F4A7C15 | 1, j + 1, 1 << 64) for j in range(WORDS)], dtype=np.uint64)


def shingles(text: str | None, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; one of all words when there are fewer; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(known) > REMEMBERED:
        known.clear()
    out = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) < 64:
                known[w] = h
        out.append(h)
    h = np.array(out, dtype=np.uint64)
    n = min(WORDS, len(h))
    mixed = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        mixed += mix64(h[j : len(h) - n + 1 + j]) * _ODD[j]
    return np.unique(mix64(mixed ^ np.uint64(n)))


def node_of(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes(), seed=len(s)))))


def sketch_of(s: np.ndarray) -> bytes:
    return np.packbits(np.bincount((s % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1).tobytes()


def band_of(n: int) -> int:
    """Bands grow by 4/3 from 3 shingles, so likely partners are in the same band or the next."""
    b = max(0, int(np.log(n / 3) / np.log(4 / 3)))
    while 3 * (4 / 3) ** (b + 1) <= n:
        b += 1
    while b and 3 * (4 / 3) ** b > n:
        b -= 1
    return b


@functools.lru_cache(maxsize=512)
def plan(group: int) -> tuple[int, int, int, np.ndarray]:
    """(parts, parts kept, least shingles of a part, round seeds) for pairs whose smaller set is in band ``group``."""
    low, mid = 3 * (4 / 3) ** group, 3 * (4 / 3) ** (group + 1)
    differ = int(mid / 3)
    parts = max(2, -(-7 * (differ + 1) // 10))
    rounds = max(1, -(-KEYS // parts))
    seeds = mix64(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(group))
    return parts, min(parts, KEYS), 1 if low < 12 else 2 if low < 40 else 3, seeds


def keys_of(s: np.ndarray) -> np.ndarray:
    """Join keys of a set: its parts' parity sketches, in its own band and as the larger partner of the band below."""
    out = []
    if len(s) < 3:  # only an equal set is like it
        return np.zeros(0, np.uint64)
    b = band_of(len(s))
    for group in {b, max(0, b - 1)}:
        parts, kept, least, seeds = plan(group)
        x = mix64(s[None, :] ^ seeds[:, None])
        part = ((x >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)
        at = (part + np.arange(len(seeds))[:, None] * parts)[part < kept]
        value = mix64(x[part < kept] + np.uint64(1))
        order = np.argsort(at, kind="stable")
        at, value = at[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
        if not len(first):
            continue
        size = np.diff(np.append(first, len(at)))
        parity = np.bitwise_xor.reduceat(value, first)
        key = mix64(parity ^ mix64((at[first].astype(np.uint64) << np.uint64(12)) + np.uint64(group)))
        out.append(key[size >= least])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _each(fn, schema: str, step: int = 256):
    """mapInArrow over (doc_id, text) in slices, with a memory of word hashes; further columns go to ``fn`` as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                yield from fn(part.column(0).to_pylist(), [shingles(t, known) for t in part.column(1).to_pylist()], *part.columns[2:])

    return run


def nodes(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), n, node (null without shingles), sketch of every row."""
    def fn(ids, sets, key):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([sketch_of(s) if len(s) else None for s in sets], pa.binary()), key], names=["doc_id", "n", "node", "sketch", "key"])

    schema = "doc_id long, n long, node long, sketch binary, key long"
    return docs.select("doc_id", "text", F.xxhash64("text").alias("key")).mapInArrow(_each(fn, schema), schema)


def candidates(docs: DataFrame, buckets: int) -> DataFrame:
    """Pairs (a < b) that share a key: all of a small group (kind 0), each member with the least one of a large group (kind 1)."""
    schema = "bucket int, keys binary, nodes binary"

    def fn(ids, sets):
        found = [keys_of(s) for s in sets]
        names = np.repeat(np.array([node_of(s) if len(s) else 0 for s in sets], dtype=np.int64), [len(k) for k in found])
        key = np.concatenate(found) if found else np.zeros(0, np.uint64)
        pair = np.unique(np.stack([key.view(np.int64), names], axis=1), axis=0) if len(key) else np.zeros((0, 2), np.int64)  # copies of a text count once
        bucket = (mix64(pair[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32) if len(pair) else np.zeros(0, np.int32)
        order = np.argsort(bucket, kind="stable")
        pair, bucket = pair[order], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        chunks = [c for c in np.split(np.arange(len(bucket)), cut) if len(c)]
        yield pa.RecordBatch.from_arrays([pa.array([bucket[c[0]] for c in chunks], pa.int32()), *(pa.array([pair[c, j].tobytes() for c in chunks], pa.binary()) for j in (0, 1))], names=["bucket", "keys", "nodes"])

    def meet(group: pa.Table) -> pa.Table:
        key, node = (np.frombuffer(b"".join(group.column(c).to_pylist()), np.int64) for c in ("keys", "nodes"))
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
        key, node = key[fresh], node[fresh]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        pairs = [np.zeros((0, 2), np.int64)]
        for gap in range(1, SMALL):  # members at a distance, in groups small enough
            run = np.repeat(size, size)
            inside = np.flatnonzero((run <= SMALL) & (np.arange(len(key)) + gap < np.repeat(first + size, size)))
            pairs.append(np.stack([node[inside], node[inside + gap]], axis=1))
        run, head = np.repeat(size, size), np.repeat(node[first], size)
        star = np.flatnonzero((run > SMALL) & (head != node))
        few, many = np.unique(np.concatenate(pairs), axis=0), np.unique(np.stack([head[star], node[star]], axis=1), axis=0)
        edge = np.concatenate([few, many])
        return pa.table({"kind": pa.array(np.repeat(np.array([0, 1], np.int32), [len(few), len(many)])), "a": pa.array(edge[:, 0]), "b": pa.array(edge[:, 1])})

    return docs.mapInArrow(_each(fn, schema, 1024), schema).groupBy("bucket").applyInArrow(meet, "kind int, a long, b long")


def filtered(edges: DataFrame, info: DataFrame) -> DataFrame:
    """Of the pairs (a, b): those whose sizes and sketches allow the likeness, with the sketches' distance ``far``."""
    one = lambda x: info.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    rows = edges.join(one("a"), "a").join(one("b"), "b").filter((F.col("n_a") * 100 >= F.col("n_b") * LIKE) & (F.col("n_b") * 100 >= F.col("n_a") * LIKE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if not t.num_rows:
                continue
            s = [np.frombuffer(b"".join(t.column(c).to_pylist()), np.uint64).reshape(t.num_rows, -1) for c in ("s_a", "s_b")]
            far = np.bitwise_count(s[0] ^ s[1]).sum(axis=1).astype(np.int64)
            total = t.column("n_a").to_numpy() + t.column("n_b").to_numpy()
            ok = far * 7 <= total
            yield pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[ok]) for c in ("a", "b")] + [pa.array(far[ok])], names=["a", "b", "far"])

    return rows.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long, far long")


def linked(edges: DataFrame, docs: DataFrame, info: DataFrame) -> DataFrame:
    """Of the pairs (a, b): those with 100 * intersection >= 75 * union, by their whole sets."""
    wanted = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(info.select("node", "doc", "key"), "node").checkpoint()
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    rows = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc"]) & (F.xxhash64(docs["text"]) == ids["key"])).select(F.col("node").alias("doc_id"), "text")

    def fn(names, sets):
        fit = [(i, s) for i, s in zip(names, sets) if len(s) and node_of(s) == i]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in fit], pa.int64()), pa.array([s.tobytes() for _, s in fit], pa.binary())], names=["node", "hashes"])

    sets = rows.mapInArrow(_each(fn, ""), "node long, hashes binary").dropDuplicates(["node"])
    # a set of r bytes goes once along each of its pairs
    pairs = edges.select("a", "b").join(sets.withColumnsRenamed({"node": "b", "hashes": "h_b"}), "b").join(sets.withColumnsRenamed({"node": "a", "hashes": "h_a"}), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for x, y in zip(t.column("h_a"), t.column("h_b")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= LIKE * (len(x) + len(y) - both))
            keep = np.array(ok, dtype=bool)
            yield pa.RecordBatch.from_arrays([pa.array(t.column(c).to_numpy()[keep]) for c in ("a", "b")], names=["a", "b"])

    return pairs.select("a", "b", "h_a", "h_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): for every node of the edges (a, b), the smallest node it is joined to. Large-star and small-star rounds, each cut by a checkpoint."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct().checkpoint()
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").filter("u <> v").distinct().checkpoint()
        e = small
        if not e.groupBy("u").count().filter("count > 1").limit(1).count() and not e.join(e.select(F.col("v").alias("u")).distinct(), "u", "leftsemi").limit(1).count():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()).checkpoint()


def across(edges: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components (a node without one is its own)."""
    c = lambda x: comps.withColumnsRenamed({"node": x, "comp": f"c_{x}"})
    return edges.join(c("a"), "a", "left").join(c("b"), "b", "left").withColumns({"c_a": F.coalesce("c_a", "a"), "c_b": F.coalesce("c_b", "b")}).filter("c_a <> c_b")


def large_groups(stars: DataFrame, info: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b, far) of members of large key groups that are in different components and whose sketches allow the likeness.

    ``stars`` has the pairs (key, node) of the groups' least members and the others, each
    once however many keys they share; the groups of one least member are taken together. A
    group's members are dealt into blocks, so any two blocks meet in a task of their own.
    """
    rows = stars.union(stars.select("key", F.col("key").alias("node"))).distinct()
    rows = rows.join(comps.withColumnsRenamed({"comp": "c"}), "node", "left").withColumn("c", F.coalesce("c", "node"))
    mixed = rows.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count(F.lit(1)).alias("size")).filter("low <> high").select("key", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(mixed, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node", "c", (F.col("mine") <= F.col("other")).alias("left"))
    rows = rows.join(info.select("node", "n", "sketch"), "node")

    def meet(group: pa.Table) -> pa.Table:
        node, c, n = (group.column(x).to_numpy() for x in ("node", "c", "n"))
        left = group.column("left").to_numpy(zero_copy_only=False)
        alone = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        s = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint64).reshape(len(node), -1)
        out = [np.zeros((0, 3), np.int64)]
        right = np.arange(len(node)) if alone else np.flatnonzero(~left)
        for i in np.arange(len(node)) if alone else np.flatnonzero(left):
            j = right[(c[right] != c[i]) & (node[right] > node[i] if alone else True) & (n[right] * 100 >= n[i] * LIKE) & (n[i] * 100 >= n[right] * LIKE)]
            far = np.bitwise_count(s[j] ^ s[i]).sum(axis=1).astype(np.int64)
            ok = far * 7 <= n[j] + n[i]
            j, far = j[ok], far[ok]
            out.append(np.stack([np.minimum(node[j], node[i]), np.maximum(node[j], node[i]), far], axis=1))
        x = np.concatenate(out)
        return pa.table({name: pa.array(x[:, k]) for k, name in enumerate(("a", "b", "far"))})

    return rows.groupBy("key", "i", "j").applyInArrow(meet, "a long, b long, far long").distinct()


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), n_shingles, node and comp (null without shingles) of every row."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    rows = texts(docs)
    named = nodes(rows).checkpoint()
    info = named.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("x"), F.first("n").alias("n"), F.first("sketch").alias("sketch")).select("node", F.col("x.doc_id").alias("doc"), F.col("x.key").alias("key"), "n", "sketch")
    found = candidates(rows, 4 * task_count(spark)).checkpoint()
    edges = filtered(found.select("a", "b").distinct(), info).checkpoint()
    best = edges.groupBy("b").agg(F.min(F.struct("far", "a")).alias("x")).select("x.a", "b")  # one pair a node first: most groups are whole then
    links = linked(best, rows, info).checkpoint()
    comps = components(links)
    rest = across(edges, comps).select("a", "b").join(best, ["a", "b"], "leftanti").checkpoint()
    if not rest.isEmpty():
        links = links.union(linked(rest, rows, info)).checkpoint()
        comps = components(links)
    stars = found.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("node")).distinct()
    late = large_groups(stars, info, comps).join(edges.select("a", "b"), ["a", "b"], "leftanti").checkpoint()
    if not late.isEmpty():
        links = links.union(linked(late.select("a", "b"), rows, info)).checkpoint()
        comps = components(links)
    return named.select("doc_id", "key", F.col("n").alias("n_shingles"), "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row.

    Null and empty texts, and those without words, have no shingles, link with nothing and are
    components of their own (repeated rows of them too). Repeated rows of a text have equal
    sets and so one component; a null doc_id stands after all others.
    """
    rows = placed(docs)
    first = rows.filter("node is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return rows.join(first, "comp", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, the one with the smallest doc_id (none: last) and then the smallest text hash, with all its columns.

    Each row is judged by its own text: rows of one id with unlike texts stay, and so do rows
    without an id that are like nothing else. Rows without words stay; those of one id and text
    are one.
    """
    found = placed(docs).checkpoint()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    first = found.filter("node is not null").groupBy("comp").agg(F.min(order).alias("first"))
    gone = found.join(first, "comp").filter(order != F.col("first")).select(F.col("doc_id").alias("__gone"), F.col("key").alias("__key")).distinct().checkpoint()
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    key = F.xxhash64(F.col("text").cast("string"))
    kept = docs.join(side, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone")) & (key == F.col("__key")), "leftanti")
    again = found.filter("node is not null or doc_id is not null").groupBy("doc_id", "key").count().filter("count > 1").select(F.col("doc_id").alias("__again"), F.col("key").alias("__key"))
    if again.isEmpty():
        return kept
    # of rows with one id and text, the first; a row without an id and without words is like nothing
    alike = Window.partitionBy(F.col("doc_id").cast("long"), key).orderBy(F.lit(1))
    several = F.col("doc_id").cast("long").eqNullSafe(F.col("__again")) & (key == F.col("__key"))
    rest = kept.join(again, several, "leftanti")
    return rest.unionByName(kept.join(again, several, "leftsemi").withColumn("__nth", F.row_number().over(alike)).filter("__nth = 1").drop("__nth"))


def op8(spark, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS s FROM w),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a AS x, b AS y FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, CAST(min(reach.y) AS BIGINT) AS component_id
FROM sets s JOIN reach ON reach.x = s.doc_id GROUP BY s.doc_id, len(s.s)
"""
