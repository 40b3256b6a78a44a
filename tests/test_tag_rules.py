"""Tag rules as a table: the lowest number that applies, by an interval join without nested loops."""

import datetime as dt
import random

from costlake.operators import recipes

FACT = "date string, tag_service string, tag_owner string, cost double"
SINCE, UNTIL = "2001-01-01", "2001-12-31"


def days(n):
    return (dt.date(2001, 1, 1) + dt.timedelta(days=n)).isoformat()


def brute(fact, rules):
    out = {}
    for date, service, owner, cost in fact:
        hit = [(n, new) for n, s, o, a, b, new in rules if s == service and (a or SINCE) <= date <= (b or UNTIL) and SINCE <= date <= UNTIL
               and (o == "any" or (o == "null") == (owner is None))]
        key = (date, min(hit)[1] if hit else service)
        c, k = out.get(key, (0.0, 0))
        out[key] = (c + cost, k + 1)
    return {k: (round(c, 6), n) for k, (c, n) in out.items()}


def patched(spark, fact, rules):
    df = recipes.tag_patch(spark.createDataFrame(fact, FACT), spark.createDataFrame(rules, recipes.RULE_SCHEMA), SINCE, UNTIL)
    return df, {(r["date"], r["tag_service"]): (round(r["cost"], 6), r["row_count"]) for r in df.collect()}


def test_ten_thousand_rules(spark):
    rng = random.Random(5)
    fact = [(days(rng.randrange(-20, 380)), rng.choice(["a", "b", "c", None]), rng.choice(["x", None]), float(rng.randrange(1, 900)) / 4) for _ in range(3000)]
    rules = []
    for n in rng.sample(range(50_000), 10_000):
        a = rng.randrange(-60, 400)
        rules.append((n, rng.choice("abcdefgh"), rng.choice(["null", "set", "any"]), rng.choice([days(a)] * 20 + [None]), rng.choice([days(a + rng.choice([0, 3, 40, 200]))] * 20 + [None]), f"new{n % 13}"))
    df, got = patched(spark, fact, rules)
    assert got == brute(fact, rules)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_bounds_owner_and_order(spark):
    fact = [("2001-03-01", "a", None, 1.0), ("2001-03-01", "a", "x", 2.0), ("2001-03-31", "a", None, 4.0), ("2001-04-01", "a", None, 8.0), ("2002-01-01", "a", None, 16.0), ("2001-03-05", None, None, 32.0)]
    rules = [(7, "a", "any", "2001-03-01", "2001-03-31", "late"), (3, "a", "null", "2001-03-31", "2001-03-31", "day"), (9, "a", "set", None, None, "set"), (1, "a", "any", "2001-04-02", "2001-04-01", "never")]
    _, got = patched(spark, fact, rules)
    assert got == {("2001-03-01", "late"): (3.0, 2), ("2001-03-31", "day"): (4.0, 1), ("2001-04-01", "a"): (8.0, 1), ("2002-01-01", "a"): (16.0, 1), ("2001-03-05", None): (32.0, 1)}
    _, got = patched(spark, fact, rules[:0] or [(1, "zz", "any", None, None, "q")])
    assert got == brute(fact, [])


def test_rules_that_cover_a_month_shrink_to_the_lowest(spark):
    rules = spark.createDataFrame([(n, "a", "any", None, None, f"v{n}") for n in range(500)], recipes.RULE_SCHEMA)
    bins = recipes.rule_bins(rules, SINCE, UNTIL).collect()
    assert len(bins) == 12 and {r["number"] for r in bins} == {0}
