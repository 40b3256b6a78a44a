"""Window arithmetic of the loads: months touched by the restated window, slices, anchors."""

import datetime as dt

from pyspark.sql import functions as F

from costlake.operators import facts
from costlake.sources.contract import date_slice, months_back, restatement_months


def test_window_crossing_a_year(spark):
    as_of = dt.date(2001, 2, 10)                   # 65 days back: 2000-12-07
    n = restatement_months(as_of, 65)
    assert n == 2
    df = spark.createDataFrame([(y, m) for y in ("2000", "2001") for m in map(str, range(1, 13))], "year string, month string")
    kept = {(r.year, r.month) for r in months_back(df, as_of, n).collect()}
    assert kept == {("2000", "12"), ("2001", "1"), ("2001", "2")}


def test_window_anchors():
    as_of = dt.date(2001, 7, 31)
    assert facts.restate_start(as_of) == "2001-05-27"
    assert facts.bill_restate_month(as_of) == "2001-05"
    assert facts.full_load_start(as_of) == "1999-07-31"
    assert facts.full_load_start(dt.date(2004, 2, 29)) == "2002-02-28"


def test_date_slice_bounds_are_inclusive(spark):
    df = spark.createDataFrame([("2001-07-01 00:00:00",), ("2001-07-07 23:59:59",), ("2001-07-08 00:00:00",)], "t string")
    df = df.select(F.to_timestamp_ntz("t").alias("line_item_usage_start_date"))
    got = [str(r[0]) for r in date_slice(df, "2001-07-01 00:00:00", "2001-07-07 23:59:59").collect()]
    assert sorted(got) == ["2001-07-01 00:00:00", "2001-07-07 23:59:59"]
