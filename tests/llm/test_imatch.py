"""Edited texts against plain Python; fingerprints of equal, near and unlike texts."""

import hashlib
import math
import random
import struct

import regex
import xxhash

from costlake.llm import imatch

SF = "/root/testdata/sf0.001"


def edited(rows):
    out = {}
    for (d, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        h = len(t) // 2
        out[d] = (len(t), hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest())
    return out


def test_query_on_test_table(spark):
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want, got = edited(rows), imatch.op7(spark, SF).collect()
    assert len(got) == len(rows) and all((r["n_chars"], r["edited_sha256"]) == want[r["doc_id"]] for r in got)
    by_text = {}
    texts = dict(rows)
    for r in got:
        assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    better = sum(r["near_edited"] > r["near_next"] for r in got) / len(got)
    assert better > 0.8


def test_edges(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    long = " ".join(rng.choice(words) for _ in range(40_000))
    rows = [(5, None), (2, ""), (9, "a"), (7, "!!!"), (11, long), (12, long), (3, "𝒳é b")]
    df = spark.createDataFrame([(*r, 0, "z") for r in rows], "doc_id long, text string, h int, bucket string")
    out = {r["doc_id"]: r for r in imatch.compare(df).collect()}
    want = edited(sorted(rows))
    assert {d: (r["n_chars"], r["edited_sha256"]) for d, r in out.items()} == want
    assert out[11]["fingerprint"] == out[12]["fingerprint"] and out[11]["near_next"] == 1.0
    one = imatch.compare(df.filter("doc_id = 9")).collect()
    assert [r["near_next"] for r in one] == [1.0]
    twice = imatch.compare(df.filter("doc_id in (2, 9)").unionAll(df.filter("doc_id = 9"))).collect()
    assert sorted(r["doc_id"] for r in twice) == [2, 9, 9]


def test_empty_table(spark):
    assert imatch.compare(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def term_hashes(text):
    words = dict.fromkeys(w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w)
    return [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in words]


def cell(few):
    """Spark chains an array's elements: each is hashed with the hash before it as seed."""
    h = 42
    for x in few:
        h = xxhash.xxh64(struct.pack("<q", x), seed=h).intdigest()
    return f"{h:X}"[-6:] if few else imatch.NONE


def brute_sketch(text, lexicon):
    terms = term_hashes(text)
    kept = sorted([h for h in terms if h in lexicon] or terms)
    level = max(0, math.floor(math.log2(max(len(kept), 1) / imatch.SUBSETS)))
    at = lambda n: [h for h in kept if (h >> 32) % 2**n == 0]
    return level, [cell([h for h in at(level + d) if (h >> 24) % imatch.SUBSETS == g]) for d in range(imatch.LEVELS) for g in range(imatch.SUBSETS)]


def brute_likeness(a, b):
    if a == b:
        return 1.0
    n = imatch.SUBSETS
    cells = lambda s: {(s[0] + i // n, i % n): c for i, c in enumerate(s[1])}
    x, y = cells(a), cells(b)
    both = [k for k in x if k in y]
    used = [k for k in both if x[k] != imatch.NONE or y[k] != imatch.NONE]
    return sum(x[k] == y[k] for k in used) / len(used) if used else 0.0


def test_fingerprints_and_likeness_against_plain_python(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    held = {}
    for _, t in rows:
        for h in term_hashes(t):
            held[h] = held.get(h, 0) + 1
    n = len(rows)
    lexicon = {h for h, k in held.items() if max(1.0, imatch.BAND[0] * n) <= k <= max(1.0, imatch.BAND[1] * n)}
    assert set(imatch.lexicon(spark.read.parquet(f"{SF}/documents.parquet"))) == lexicon and 0 < len(lexicon) < len(held)
    shown = lambda s: f"{s[0]}:" + ".".join(s[1])
    own = [brute_sketch(t, lexicon) for _, t in rows]
    got = {r["doc_id"]: r for r in imatch.op7(spark, SF).collect()}
    for i, (d, t) in enumerate(rows):
        u, half = rows[(i + 1) % n][1], len(t) // 2
        changed = brute_sketch(t[: len(t) - half] + u[:half], lexicon)
        r = got[d]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (shown(own[i]), shown(changed))
        assert abs(r["near_edited"] - brute_likeness(own[i], changed)) < 1e-12 and abs(r["near_next"] - brute_likeness(own[i], own[(i + 1) % n])) < 1e-12


def test_terms_outside_the_band_never_pass(spark):
    inside = [7, -9, 2**62, 5]
    lex = imatch.slots(inside)
    assert sorted(h for s in lex for h in s) == sorted(inside) and len(lex) == 4 and imatch.slots([]) == [[]]
    near = [7 + 4 * k for k in range(1, 200)] + [-9 - 4 * k for k in range(1, 200)]   # the same slots
    df = spark.createDataFrame([(h,) for h in inside + near], "h long")
    from pyspark.sql import functions as F

    listed = F.array_contains(F.get(imatch._table(lex), F.pmod("h", F.lit(len(lex))).cast("int")), F.col("h"))
    assert sorted(r["h"] for r in df.filter(listed).collect()) == sorted(inside)
