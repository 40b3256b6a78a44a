"""Links and components against brute force."""

import random

from costlake.llm import jaccard


def words(t):
    return [w.lower() for w in (t or "").encode().split()]


def brute(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i in range(len(rows)):
        low[find(i)] = min(low.get(find(i), 10**9), rows[i][0])
    return sorted((rows[i][0], len(sets[i]), low[find(i)]) for i in range(len(rows)))


def made():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, docs = text(60), []
    for n in (1, 3, 5, 6, 7, 8, 9, 12, 20, 33, 60, 150, 700):
        for _ in range(2):
            base = text(n)
            docs.append(base)
            for _ in range(8):
                t = list(base)
                for _ in range(rng.randint(0, max(1, n // 18))):
                    t[rng.randrange(len(t))] = rng.choice(vocab)
                docs.append(t + text(rng.randint(0, max(1, n // 8))))
    docs += [text(30) + passage + text(30) for _ in range(25)] + [["A", "b"], ["a", "B"], [], [" "]]
    rng.shuffle(docs)
    out = [(3 * i + 1, rng.choice([" ", "\n", "  \t"]).join(d)) for i, d in enumerate(docs)]
    return out + [(100_001, None), (out[5][0], out[5][1])]


def test_components_as_brute_force(spark):
    rows = made()
    df = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n int, node string")
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect())
    assert got == [x if x[1] else (x[0], 0, x[0]) for x in brute(rows)]


def test_large_groups_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = made()[:150]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()) == [x if x[1] else (x[0], 0, x[0]) for x in brute(rows)]


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_keep_first_by_text(spark):
    """Rows without an id and rows of one id are judged by their own texts."""
    rng = random.Random(2)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    a, b, c, d, e, f = (text() for _ in range(6))
    rows = [(1, a), (None, a), (None, a + " more"), (None, b), (None, c), (None, c), (None, c + " more"), (5, d), (5, e), (7, e), (8, f), (8, f), (9, None), (None, None), (None, ""), (None, "")]
    got = [(r["doc_id"], r["text"]) for r in jaccard.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    like_c = [x for x in got if (x[1] or "").startswith(c)]
    assert len(like_c) == 1 and like_c[0][0] is None
    want = [(1, a), (None, b), (5, d), (5, e), (8, f), (9, None), (None, None), (None, ""), (None, "")]
    assert sorted((x for x in got if x not in like_c), key=str) == sorted(want, key=str)
