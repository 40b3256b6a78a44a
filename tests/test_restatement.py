"""Restatement (FIXTURES.md section 4): the 65-day window is rebuilt, older days are not."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_MID
from costlake.operators import facts
from costlake.plans.pipeline import Pipeline, build_full, build_incremental
from costlake.plans.sinks import partitions, read_table
from costlake.sources.dims import load_dims
from costlake.sources.fixture import AS_OF, cur_from_lineitem


def day(n):
    return (AS_OF - dt.timedelta(days=n)).isoformat()


def on_day(n):
    return F.to_date("line_item_usage_start_date") == F.lit(day(n)).cast("date")


def read(spark, path):
    return read_table(spark, path)


def rows(df, cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_restatement(spark, tmp_path):
    cur = cur_from_lineitem(spark, SF_MID).cache()
    usage_path, bill_path = str(tmp_path / "usage"), str(tmp_path / "bill")
    dims = load_dims(spark)
    build_full(Pipeline(spark, cur, AS_OF, dims), usage_path, bill_path)
    before = read(spark, usage_path)
    before_rows = {d: rows(before.where(F.col("date") == d), ["date", "cost", "unblended_cost"]) for d in (day(80),)}

    usage_line = (F.col("line_item_line_item_type") == "Usage") & (F.col("line_item_product_code") == "AmazonEC2")
    doubled = lambda c: F.col(c) * 2
    edited = (cur
              .withColumn("line_item_net_unblended_cost",
                          F.when((on_day(10) | on_day(80)) & usage_line, doubled("line_item_net_unblended_cost"))
                          .otherwise(F.col("line_item_net_unblended_cost")).cast("decimal(24,10)"))
              .withColumn("line_item_unblended_cost",
                          F.when((on_day(10) | on_day(80)) & usage_line, doubled("line_item_unblended_cost"))
                          .otherwise(F.col("line_item_unblended_cost")).cast("decimal(24,10)"))
              .where(~on_day(20)))
    moved = (cur.where(on_day(3) & usage_line).limit(1)
             .withColumn("line_item_usage_start_date", F.lit(day(40) + " 05:00:00").cast("timestamp_ntz"))
             .withColumn("year", F.lit("2001")).withColumn("month", F.lit(str(int(day(40)[5:7])))))
    edited = edited.unionByName(moved).cache()

    out = build_incremental(Pipeline(spark, edited, AS_OF, dims), usage_path, bill_path)
    assert day(20) in out["dropped_days"]
    assert day(20) not in partitions(spark, usage_path, "date")

    fresh = Pipeline(spark, edited, AS_OF, dims)
    cols = ["date", "account_id", "resource_name", "usage_type", "cost", "unblended_cost", "usage"]
    got = read(spark, usage_path)
    window = facts.restate_start(AS_OF)
    assert rows(got.where(F.col("date") >= window), cols) == rows(fresh.usage_daily().where(F.col("date") >= window), cols)
    # the change 80 days back is older than the window: the daily fact keeps the old values
    assert rows(got.where(F.col("date") == day(80)), ["date", "cost", "unblended_cost"]) == before_rows[day(80)]

    # the bill restates whole months from month(as_of - 65d) = 2001-08, so the 80-day change shows there
    bill = read(spark, bill_path)
    bcols = ["date_month", "line_item_type", "account_id", "product_code", "pricing_unit", "unblended_cost", "days_in_month"]
    since = facts.bill_restate_month(AS_OF)
    assert since == "2001-08"
    assert rows(bill.where(F.col("date_month") >= since), bcols) == \
        rows(fresh.bill().where(F.col("date_month") >= since), bcols)

    # restating twice changes nothing
    first = rows(got, cols)
    build_incremental(Pipeline(spark, edited, AS_OF, dims), usage_path, bill_path)
    assert rows(read(spark, usage_path), cols) == first
