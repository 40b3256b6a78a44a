"""Removed bytes and maximal repeats against brute force."""

import hashlib
import random

import numpy as np

from costlake.llm import suffix


def brute(rows, n=50):
    low, texts = {}, [(d, (t or "").encode()) for d, t in rows]
    for d, t in texts:
        for p in range(len(t) - n + 1):
            w = t[p : p + n]
            low[w] = min(low.get(w, 1 << 70), (1 << 62) if d is None else d)
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - n + 1):
            if low[t[p : p + n]] < ((1 << 62) if d is None else d):
                gone[p : p + n] = b"\1" * n
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made():
    rng = random.Random(4)
    text = lambda n, abc="abcdefgh é": "".join(rng.choice(abc) for _ in range(n))
    shared = [text(rng.randint(45, 120)) for _ in range(12)]
    out = []
    for _ in range(70):
        parts = [text(rng.randint(0, 80)) if rng.random() < 0.5 else rng.choice(shared) for _ in range(rng.randint(0, 6))]
        t = "".join(parts)
        if t and rng.random() < 0.4:
            p = rng.randrange(len(t))
            t = t[:p] + "X" + t[p + 1 :]
        out.append(t)
    out += ["a" * 300, "a" * 120, "ab" * 200, "b" + "ab" * 90, "x" * 49, "x" * 50, "x" * 51, "", None, "\0" * 80, "\0" * 60 + "a", out[3], out[3], text(40_000, "abc ")]
    out.append(out[-1][100:20_000])
    rows = [(7 * i % 101, t) for i, t in enumerate(out)]
    return rows + [(None, out[5] + out[6]), (rows[8][0], rows[8][1]), (rows[9][0], out[10])]


def test_removed_as_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SORT", 300)
    rows = made()
    df = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, g int, kept string").repartition(5)
    got = suffix.dedup(df).drop("kept").collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_maximal_repeats_as_brute_force():
    rng = random.Random(1)
    for _ in range(120):
        least = rng.randint(2, 4)
        ts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(least, 14))) for _ in range(rng.randint(1, 6))]
        body = np.zeros((len(ts), 16), np.uint8)
        for i, t in enumerate(ts):
            body[i, : len(t)] = np.frombuffer(t, np.uint8)
        text, place, lcp, left = suffix.enhanced_array(body, np.array([len(t) for t in ts]), least)
        got = {(n, tuple(sorted(zip(text[a:b].tolist(), place[a:b].tolist())))) for n, a, b in suffix.maximal_repeats(np.where(lcp >= least, lcp, 0), left, least)}
        where, want = {}, set()
        for i, t in enumerate(ts):
            for p in range(len(t)):
                for n in range(least, len(t) - p + 1):
                    where.setdefault(t[p : p + n], []).append((i, p))
        for s, o in where.items():
            before = {ts[i][p - 1] if p else (i, "^") for i, p in o}
            after = {ts[i][p + len(s)] if p + len(s) < len(ts[i]) else (i, "$") for i, p in o}
            if len(o) > 1 and len(before) > 1 and len(after) > 1:
                want.add((len(s), tuple(sorted(o))))
        assert got == want


def test_empty_table(spark):
    assert suffix.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_runs_alike_in_32_bits(spark):
    """Two runs of one class whose content keys have the same upper half."""
    a = "bziidcrgeqoymhluzmhnszzesgmfThe quick brown fox jumps over a lazy doynyexqwspwpz"
    b = "krmntfovsvpnozxxbolljThe quick brown fox jumps over a lazy dockauwkxftomz"
    (_, _, cls_a, key_a), (_, _, cls_b, key_b) = suffix.runs(a.encode()), suffix.runs(b.encode())
    assert cls_a == cls_b and key_a != key_b and key_a >> np.uint64(32) == key_b >> np.uint64(32)
    got = suffix.dedup(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).drop("kept").collect()
    assert sorted(tuple(r) for r in got) == brute([(1, a), (2, b)])


def test_large_class_by_windows(monkeypatch):
    """A class of more than SORT suffixes gives the same spans without a suffix array of all of it."""
    rng = np.random.default_rng(6)
    line = rng.integers(97, 123, 64)
    n, size = 400, suffix.WIDE
    body = rng.integers(97, 99, (n, size)).astype(np.uint8)
    for i in range(n):
        body[i, 8 : 8 + 40 + i % 25] = line[: 40 + i % 25]
    e = np.zeros(n, suffix.ENTRY)
    e["doc"], e["n"], e["start"] = np.arange(n) % 300, size, 1000 * np.arange(n)
    group = suffix.X.to_arrow([(0, 3, e.tobytes(), body.tobytes(), b"")])

    def spans():
        return [x.tolist() for x in suffix.X.merged(*suffix.X.entries(suffix._compared(group, 1), 2, (np.int64, np.int64, np.int64)))]

    want, seen, whole = spans(), [], suffix.enhanced_array
    monkeypatch.setattr(suffix, "SORT", 200)
    monkeypatch.setattr(suffix, "enhanced_array", lambda b, s, least: seen.append(int((s - least + 1).sum())) or whole(b, s, least))
    assert want[0] and spans() == want and max(seen, default=0) <= 200
