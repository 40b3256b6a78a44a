"""Recall against brute force; edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlake.llm import ann

SF = "/root/testdata/sf0.1"


def exact(ids, x, k):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = (x * q).sum(axis=1)
            out[i] = [int(j) for j in ids[np.lexsort((ids, -s))] if j != i][:k]
    return out


def test_recall_on_test_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    want = exact(ids, x, 20)
    got = {}
    for r in ann.op2(spark, SF).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_within_finds_every_code():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    codes[250:] = codes[0] ^ (rng.random((250, 16)) < 0.2) * rng.integers(0, 256, (250, 16), dtype=np.uint8)
    index = ann.Index(codes)
    for r in (0, 5, 16, 31, 40, 64):
        assert index.within(codes[0], r).tolist() == np.flatnonzero(np.bitwise_count(codes ^ codes[0]).sum(axis=1) <= r).tolist()


def test_edges(spark):
    good = [(i, [1.0 + (i % 3), float(i % 2)]) for i in range(30)]
    bad = [(100, None), (120, [0.0, 0.0]), (140, [float("nan"), 1.0]), (160, [None, 1.0]), (180, [math.inf, 1.0]), (200, [1.0, 2.0, 3.0]), (40, [2.0, 2.0]), (40, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in good + bad], "vec_id long, embedding array<double>, rank int")
    out = ann.search(df, F.col("vec_id") % 20 == 0, k=3).collect()
    assert {r["query_id"] for r in out} == {0, 20, 40} and len(out) == 12  # two rows have id 40
    first = {r["query_id"]: (r["vec_id"], r["score"]) for r in out if r["rank"] == 1}
    assert first[40] == (40, pytest.approx(8.0)) and first[0] == (40, pytest.approx(2.0)) or first[0][1] >= 2.0
    few = ann.search(df.filter("vec_id in (0, 1)"), F.col("vec_id") % 20 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1)]
    assert ann.search(df.filter("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0
