"""Forward-backward against enumeration, held-out accuracy, code-switched and odd texts."""

import itertools

import numpy as np

from costlake.llm import langid

SF = "/root/testdata/sf0.01"


def test_marginals_as_enumeration():
    rng = np.random.default_rng(4)
    score, step, start = rng.normal(size=(6, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    ids = [rng.integers(0, 6, n) for n in (1, 4, 0, 5, 2)]
    got = langid.marginals(ids, score, step, start)
    for c, g in zip(ids, got):
        want, z = np.zeros(3), 0.0
        for path in itertools.product(range(3), repeat=len(c)):
            if not path:
                continue
            p = np.exp(start[path[0]] + sum(score[w, y] for w, y in zip(c, path)) + sum(step[a, b] for a, b in zip(path, path[1:])))
            z += p
            for y in path:
                want[y] += p
        assert np.allclose(g, want / z if z else 0)


def test_held_out_accuracy_and_odd_texts(spark):
    rows = {r["doc_id"]: r for r in langid.op3(spark, SF).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [d for d, r in rows.items() if r["held_out"] and truth[d] is not None]
    assert len(rows) == len(truth) and np.mean([rows[d]["lang_pred"] == truth[d] for d in held]) > 0.95
    model = langid.fit([("the and of that", "en"), ("der die und das", "de")] * 20)
    texts = [None, "", "12 !!", "the and the", "der die der das die", "the of " + "die und " * 40_000, "²³"]
    got = langid.predict(spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)] + [(3, "the and the", "q")], "doc_id long, text string, score string"), model).collect()
    assert sorted((r["doc_id"], r["lang_pred"]) for r in got) == [(0, "und"), (1, "und"), (2, "und"), (3, "en"), (3, "en"), (4, "de"), (5, "de"), (6, "und")]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame([(1, "a")], "doc_id long, text string"), langid.fit([])).collect()] == ["und"]
    assert langid.predict(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_long_runs_of_letters(spark):
    """The middle of a run counts, and by its length."""
    model = langid.fit([("the and of that", "en"), ("der die und das", "de")] * 20)
    en, de = "theandofthat" * 2, "derdieunddas" * 100
    rows = langid.predict(spark.createDataFrame([(1, en + de + en), (2, "the " + de)], "doc_id long, text string"), model).collect()
    assert {r["lang_pred"] for r in rows} == {"de"}
    assert [len(w) for w in langid.WORD.findall("x" * 95 + " ab")] == [40, 40, 15, 2]
