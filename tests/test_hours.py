"""The hour fact: its window, the daily fact summed from it, and the recipes that read it."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators import facts, recipes
from costlake.plans.pipeline import build_hourly, fixture_pipeline
from costlake.plans.sinks import partitions, read_table
from costlake.sources.fixture import AS_OF

SINCE = facts.hour_start(AS_OF)


def rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(repr(tuple(round(v, 8) if isinstance(v, float) else v for v in r)) for r in df.select(*cols).collect())


def test_window_is_whole_months():
    assert SINCE == "2000-09-01" and facts.hour_start(dt.date(2023, 3, 31), 30) == "2023-03-01"


def test_facts_and_recipes_from_the_written_hours(spark, tmp_path):
    p = fixture_pipeline(spark, SF_SMALL)
    hours_path, usage_path = str(tmp_path / "hours"), str(tmp_path / "usage")
    build_hourly(p, hours_path, usage_path)
    hours = read_table(spark, hours_path)
    assert min(partitions(spark, hours_path, "date")) >= SINCE
    # two levels: the day's fact summed from the hours is the day's fact
    assert rows(read_table(spark, usage_path)) == rows(p.usage_daily().where(F.col("date") >= SINCE))
    # the recipes read the fact: folders are pruned by the window, other columns are not read
    for df in (recipes.hourly_usage(hours, "2001-10-01"), recipes.base_load(hours, AS_OF, "2001-10-01")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.split("\n") if "Scan parquet" in x)
        assert "PartitionFilters: [isnotnull(date" in scan and "2001-10-01" in scan and "resource_name" not in scan
        assert df.count() > 0
    live = fixture_pipeline(spark, SF_SMALL, grain="hour").usage_hourly()
    assert rows(recipes.hourly_usage(hours)) == rows(recipes.hourly_usage(live))
    assert rows(recipes.base_load(hours, AS_OF, SINCE)) == rows(recipes.base_load(live, AS_OF, SINCE))
    # a later run restates its days and forgets those before the window
    later = AS_OF + dt.timedelta(days=62)
    out = build_hourly(type(p)(spark, p.cur, later, p.dims), hours_path, days=30)
    assert min(partitions(spark, hours_path, "date")) >= facts.hour_start(later) > SINCE and out["hours"]["written"] == []


def test_base_load_counts_hours_without_rows(spark):
    at = lambda d, h, cost, bucket="Compute": (d, f"{d} {h:02d}", float(cost), bucket)
    data = [at("2001-09-01", h, 10 + h) for h in range(24)] + [at("2001-09-02", h, 5) for h in range(23)]
    data += [at("2001-09-03", 4, 7), at("2001-09-03", 4, 1), at("2001-09-03", 5, -2), at("2001-10-05", 1, 9, "Storage"), at("2001-11-02", 0, 4), at("2001-08-31", 1, 99)]
    df = spark.createDataFrame(data, "date string, hour string, cost double, pricing_bucket string")
    got = {r["date_month"]: r for r in recipes.base_load(df, AS_OF, "2001-09-01").collect()}
    assert set(got) == {"2001-09", "2001-11"}                      # no compute hour in October
    sep, nov = got["2001-09"], got["2001-11"]
    assert sep["days"] == 30 and abs(sep["base_load_hourly_cost"] - (10 + 0 - 2) / 30) < 1e-9
    assert abs(sep["avg_peak_hourly_cost"] - (33 + 5 + 8) / 30) < 1e-9
    assert nov["days"] == 4 and nov["base_load_hourly_cost"] == 0 and nov["avg_peak_hourly_cost"] == 1.0
    assert recipes.base_load(df.limit(0), AS_OF, "2001-09-01").count() == 0


def test_hourly_usage_takes_all_hours_and_line_types(spark):
    from costlake.plans.catalog import QUERIES

    hours = fixture_pipeline(spark, SF_SMALL, grain="hour").only("Compute").stage01()
    got = QUERIES["hourly_usage"](spark, SF_SMALL)
    assert got.agg(F.min("hour")).first()[0] < SINCE
    want = hours.where(F.col("pricing_bucket") == "Compute").select("hour", "product_code").distinct()
    assert rows(got, ["hour", "product_code"]) == rows(want, ["hour", "product_code"])


def test_base_load_takes_all_months_and_line_types(spark):
    from costlake.plans.catalog import QUERIES

    hours = fixture_pipeline(spark, SF_SMALL, grain="hour").only("Compute").stage01()
    months = {r[0] for r in hours.where(F.col("pricing_bucket") == "Compute").select("date_month").distinct().collect()}
    got = QUERIES["base_load"](spark, SF_SMALL)
    assert {r["date_month"] for r in got.collect()} == months and min(months) < SINCE[:7]
    # its window is a scalar of the hours' own shuffle: the lines are read once
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Scan parquet") == 1


def test_base_load_without_a_window_starts_with_its_first_month(spark):
    at = lambda d, h, cost: (d, f"{d} {h:02d}", float(cost), "Compute")
    data = [at("1997-02-27", h, 28) for h in range(24)] + [at("2001-11-02", 0, 4), (None, None, 1.0, "Compute")]
    df = spark.createDataFrame(data, "date string, hour string, cost double, pricing_bucket string")
    got = {r["date_month"]: r for r in recipes.base_load(df, AS_OF).collect()}
    assert {m: r["days"] for m, r in got.items()} == {"1997-02": 28, "2001-11": 4}
    assert got["1997-02"]["base_load_hourly_cost"] == 1.0 and got["2001-11"]["avg_peak_hourly_cost"] == 1.0
    assert recipes.base_load(df.limit(0), AS_OF).count() == 0
