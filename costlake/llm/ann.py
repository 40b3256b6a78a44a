"""Approximate nearest neighbours by multi-index hashing: learned rotated binary codes, an index for each substring, pigeonhole probing, reranking by the floats.

Rotations are learned from a bounded sample (iterative quantisation); every vector gets a
code of ``BITS`` bits. Codes within Hamming radius R agree with the query's in at least one
substring up to R // m bits, so probing each substring's index that far finds all of them.
Their floats then decide. Vectors and queries meet in pairs of blocks of fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costlake.llm.common import table

BITS, SUB = 128, 8  # a code, a substring
K = 20
#: Vectors that rotations and radius are learned from, at most; share of true neighbours the radius covers there.
SAMPLE, COVER = 4_096, 0.97
#: Vectors and queries of a block.
BLOCK, QUERY_BLOCK = 8_192, 2_048
#: Values of a substring by their distance from 0.
_WEIGHT = np.array([bin(v).count("1") for v in range(1 << SUB)])
_NEAR = [np.flatnonzero(_WEIGHT <= r) for r in range(SUB + 1)]


@dataclass(frozen=True)
class Codes:
    """mean, planes: (d + 1,) and (d + 1, BITS); norm: the largest length of a vector; radius: Hamming."""

    mean: np.ndarray
    planes: np.ndarray
    norm: float
    radius: int

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        """On a sphere of one more dimension, where nearness is inner product."""
        if query:
            return np.hstack([x * (self.norm / np.linalg.norm(x, axis=1, keepdims=True)), np.zeros((len(x), 1))])
        return np.hstack([x, np.sqrt(np.maximum(0.0, self.norm**2 - (x * x).sum(axis=1, keepdims=True)))])

    def code(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """(n, BITS / 8) bytes."""
        return np.packbits((self.lift(x, query) - self.mean) @ self.planes > 0, axis=1)


def learn(sample: np.ndarray, norm: float, rows: int, k: int = K, seed: int = 7) -> Codes:
    """Rotations by iterative quantisation, as many as give BITS bits, and the radius that holds COVER of the sample's neighbours at the rank that k has among all rows."""
    rng = np.random.default_rng(seed)
    base = Codes(np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, BITS)), norm, 0)
    x = base.lift(sample, False)
    mean = x.mean(axis=0)
    _, _, axes = np.linalg.svd(x - mean, full_matrices=True)
    width = min(BITS, sample.shape[1])
    flat = (x - mean) @ axes[:width].T
    planes = []
    while sum(p.shape[1] for p in planes) < BITS:
        r = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(30):
            u, _, v = np.linalg.svd(np.where(flat @ r > 0, 1.0, -1.0).T @ flat)
            r = (u @ v).T
        planes.append(axes[:width].T @ r)
    codes = Codes(mean, np.hstack(planes)[:, :BITS], norm, BITS)
    q = sample[: min(256, len(sample))]
    scores = q @ sample.T
    scores[np.arange(len(q)), np.arange(len(q))] = -np.inf
    take = int(min(len(sample) - 1, max(1, round(k * len(sample) / max(rows, 1)))))
    if take < 1:
        return codes
    top = np.argpartition(-scores, take - 1, axis=1)[:, :take]
    a, b = codes.code(q, query=True), codes.code(sample)
    far = np.bitwise_count(a[:, None, :] ^ b[top]).sum(axis=2)
    return Codes(mean, codes.planes, norm, int(np.quantile(far, COVER, method="higher")))


class Index:
    """A block's codes, listed by the value of each substring."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable") for c in codes.T]
        self.first = [np.searchsorted(c[o], np.arange((1 << SUB) + 1)) for c, o in zip(codes.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of every code within the radius: pigeonhole probing, then the exact distance."""
        m = self.codes.shape[1]
        each, over = divmod(radius, m)
        hit = np.zeros(len(self.codes), dtype=bool)
        for s in range(m):
            reach = min(SUB, each if s <= over else each - 1)
            if reach < 0:
                continue
            first, order = self.first[s], self.order[s]
            if reach == SUB:
                hit[:] = True
                break
            for v in (_NEAR[reach] ^ int(code[s])).tolist():
                hit[order[first[v] : first[v + 1]]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ code).sum(axis=1) <= radius]


def usable(vectors: DataFrame) -> DataFrame:
    """slot (the row's own number), vec_id and v (array of double) of vectors that take part.

    Null and zero vectors, and those with null or non-finite components, take no part, nor do
    vectors of another length than most have (ties: the shorter length).
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.monotonically_increasing_id().alias("slot"), F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.filter(fine)


def search(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which ``is_query`` (a Column) holds, among all other rows.

    Fewer only where the table has fewer. Repeated ids and vectors are rows of their own;
    equal scores go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors)
    widths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("sq"))
    top = widths.orderBy(F.desc("n"), "d").first()
    if top is None:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == top["d"])
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id", "slot")).limit(SAMPLE).select("v").collect()])
    codes = learn(sample, float(np.sqrt(top["sq"])) or 1.0, top["n"], k)
    blocks, q_rows = -(-top["n"] // BLOCK), rows.filter(is_query)
    q_blocks = max(1, -(-q_rows.count() // QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("slot"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("slot", "vec_id", "v", F.lit(False).alias("q"), deal(blocks).alias("block"), each(q_blocks).alias("q_block"))
    right = q_rows.select("slot", "vec_id", "v", F.lit(True).alias("q"), each(blocks).alias("block"), deal(q_blocks).alias("q_block"))

    def meet(group: pa.Table) -> pa.Table:
        is_q = group.column("q").to_numpy(zero_copy_only=False)
        v = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(group.num_rows, -1)
        ids, slots = (group.column(c).to_numpy() for c in ("vec_id", "slot"))
        x, x_id, x_slot = v[~is_q], ids[~is_q], slots[~is_q]
        q, q_id, q_slot = v[is_q], ids[is_q], slots[is_q]
        out: list[list[np.ndarray]] = [[], [], [], []]
        if len(x) and len(q):
            index, q_codes = Index(codes.code(x)), codes.code(q, query=True)
            for i in range(len(q)):
                radius, need = codes.radius, min(k + 1, len(x))
                found = index.within(q_codes[i], radius)
                while len(found) < need and radius < BITS:  # a sparse block: look further
                    radius = min(BITS, radius + SUB)
                    found = index.within(q_codes[i], radius)
                found = found[x_slot[found] != q_slot[i]]
                score = (x[found] * q[i]).sum(axis=1)
                if len(found) > 4 * k:
                    keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                    found, score = found[keep], score[keep]
                best = np.lexsort((x_slot[found], x_id[found], -score))[:k]
                for j, col in enumerate((np.full(len(best), q_slot[i]), np.full(len(best), q_id[i]), x_id[found[best]], score[best])):
                    out[j].append(col)
        cols = [np.concatenate(c) if c else np.array([], dtype=float if j == 3 else np.int64) for j, c in enumerate(out)]
        return pa.table({n: pa.array(c, pa.float64() if n == "score" else pa.int64()) for n, c in zip(("slot", "query_id", "vec_id", "score"), cols)})

    near = left.unionByName(right).groupBy("block", "q_block").applyInArrow(meet, "slot long, query_id long, vec_id long, score double")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
