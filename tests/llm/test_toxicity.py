"""The automaton against edit distance by dynamic programming; held-out accuracy; odd inputs."""

import random

from pyspark.sql import functions as F

from costlake.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def distance(a, b, stem):
    row = list(range(len(b) + 1))  # a: term, b: word
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) if stem else row[-1]


def test_automaton_as_edit_distance():
    rng = random.Random(3)
    for _ in range(60):
        terms = ["".join(rng.choice("ab") for _ in range(rng.choice((3, 6, 7, 10, 12)))) + rng.choice(["", "", "*"]) for _ in range(rng.randint(0, 6))]
        auto = T.TermAutomaton(terms, max_states=200)
        for _ in range(60):
            w = "".join(rng.choice("ab") for _ in range(rng.randint(0, 14)))
            if terms and rng.random() < 0.5:
                w = list(rng.choice(terms).rstrip("*") + rng.choice(["", "b"]))
                if w and rng.random() < 0.7:
                    w[rng.randrange(len(w))] = rng.choice("abc")
                w = "".join(w)
            want = min([d for t in terms if (d := distance(t.rstrip("*"), w, t.endswith("*"))) <= T.edits_allowed(len(t.rstrip("*")))], default=None)
            assert auto.match(w) == want, (terms, w)


def test_held_out_accuracy(spark):
    rows = T.op10(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n.get((0, 1), 0) <= 0.01 * n[0, 0] and n.get((1, 0), 0) <= 0.2 * n[1, 1]


def test_context_and_odd_inputs(spark):
    model = T.ToxicityModel(("worthless", "stupid"), (-3.0, 6.0, -1.0, 1.0, 1.0))
    texts = ["you worthless stupid fool", "w0rd stupld worthles", 'he said "worthless" and "stupid" then', None, "", "a clean text", "«stupid»", "stupid " * 50_000]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)] + [(5, "a clean text", 0.5)], "doc_id long, text string, score double")
    got = {r["doc_id"]: r["predicted"] for r in T.score(df, model).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 0, 4: 0, 5: 0, 6: 0, 7: 1}
    assert T.score(df, model).count() == 9 and T.keep_clean(df, model).columns == df.columns
    assert sorted(r["doc_id"] for r in T.keep_clean(df, model).collect()) == [2, 3, 4, 5, 5, 6]


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(2, None)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    assert model.terms == () and 0 <= T.score(docs, model).first()["score"] <= 1
    assert T.score(docs.filter(F.lit(False)), model).count() == 0
