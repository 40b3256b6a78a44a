"""Runs and collapsed texts against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from costlake.llm import periodic as P

SCHEMA = "doc_id long, text string, slot int, runs string, kind int"


def words(t):
    return re.findall(r"[^ \t-\r]+", t or "")


def brute(w):
    """(start, period, length) of every run: each period by itself, multiples of a shorter one left out."""
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        x = 0
        while x + q < n:
            y = x
            while y + q < n and w[y] == w[y + q]:
                y += 1
            size = y - x + q
            if y > x and size >= max(12, 2 * q) and not any(q % p == 0 and a <= x and x + size <= a + m for a, p, m in out):
                out.append((x, q, size))
            x = max(y, x + 1)
    return sorted(out)


def collapsed(w, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rng, n, letters):
    w = [rng.choice(letters) for _ in range(n)]
    for _ in range(rng.choice([0, 1, 2, 3])):
        if n:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // rng.choice([2, 3, 5, 9])))
            for i in range(a, rng.choice([n, rng.randrange(a, n + 1)])):
                w[i] = w[a + (i - a) % p]
    return w


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("core", [8, 64, P.CORE])
def test_against_brute_force(spark, monkeypatch, core):
    monkeypatch.setattr(P, "CORE", core)
    monkeypatch.setattr(P, "TOGETHER", 700)
    rng = random.Random(core)
    rows = [(i, rng.choice([" ", "  ", "\n", "\t "]).join(random_words(rng, rng.choice([0, 3, 11, 12, 13, 40, 150, 400]), rng.choice(["a", "ab", "abc", [f"w{k}é" for k in range(60)]])))) for i in range(120)]
    rows += [(None, "a " * 20), (5, "b " * 30), (5, "b " * 30), (200, None), (201, ""), (202, " \n "), (203, "x y " * 12)]
    got = sorted((repr(r["doc_id"]), [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.collapse(frame(spark, rows)).collect())
    want = sorted((repr(d), brute(words(t)), collapsed(words(t), brute(words(t)))) for d, t in rows)
    assert got == want and sum(len(x[1]) for x in want) > 60


def test_long_text(spark):
    rng = random.Random(7)
    w = [f"w{rng.randrange(3000)}" for _ in range(90_000)]
    for a, p, b in ((5_000, 9_001, 40_000), (50_000, 3, 60_000), (70_000, 130, 70_400)):
        for i in range(a, b):
            w[i] = w[a + (i - a) % p]
    out = P.collapse(frame(spark, [(1, " ".join(w))])).first()
    runs = [tuple(r) for r in out["runs"]]
    assert [(q, n) for _, q, n in runs] == [(9_001, 35_000 + runs[0][2] - 35_000), (3, runs[1][2]), (130, runs[2][2])]
    for s, q, n in runs:
        assert all(w[i] == w[i + q] for i in range(s, s + n - q)) and w[s - 1] != w[s + q - 1] and w[s + n] != w[s + n - q]
    assert out["collapsed"] == collapsed(w, runs)


def planted(d, t):
    w = words(t)
    h, n = zlib.crc32(str(d).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def test_query_on_test_table(spark):
    rows = [(r["doc_id"], planted(r["doc_id"], r["text"])) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows = [(d, w) for d, w in rows if len(w) < 900]
    got = {r["doc_id"]: tuple(r)[1:] for r in P.op11(spark, "/root/testdata/sf0.001").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for d, w in rows:
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
        shown = (None,) * 4 if best is None else (best[0], best[2], best[1], 1000 * best[2] // best[1])
        assert got[d] == (len(runs), *shown, sha("".join(f"{s},{n},{q}\n" for s, q, n in runs)), sha(collapsed(w, runs)))


def test_empty_table_and_find_runs(spark):
    assert P.collapse(frame(spark, [])).count() == 0
    assert [tuple(r) for r in P.find_runs(frame(spark, [(3, "p q r s t u p q r s t u p"), (4, "a b")])).collect()] == [(3, 0, 6, 13)]
