"""Invariants: no fan-out through the joins, shares sum to one, guards raise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators import views
from costlake.plans.pipeline import fixture_pipeline
from costlake.sources.dims import DuplicateKeyError, assert_unique, load_dims


@pytest.fixture(scope="module")
def pipe(spark):
    return fixture_pipeline(spark, SF_SMALL)


def total(df, col):
    return df.agg(F.sum(F.col(col).cast("decimal(38,10)")).alias("t")).collect()[0].t


def test_unblended_total_survives_every_stage(pipe):
    s00, s01 = pipe.stage00(), pipe.stage01()
    bill = pipe.bill()
    assert s00.count() == s01.count()          # left joins against unique keys: no fan-out
    t00, t01 = total(s00, "unblended_cost"), total(s01, "unblended_cost")
    assert t00 == t01
    # the bill keeps two years of months
    t01_window = total(s01.where(F.col("date_month") >= "1999-11"), "unblended_cost")
    assert abs(float(total(bill, "unblended_cost")) - float(t01_window)) < 1e-6


def test_stage00_drops_free_and_null_rate_usage(spark, pipe):
    s00 = pipe.stage00()
    # templates 28 (rate 0) and 29 (rate null) are t3.nano usage: both must be gone
    assert s00.where(F.col("compute_instance_type") == "t3.nano").count() == 0


def test_date_week_is_monday(pipe):
    rows = pipe.stage00().select("date_week").distinct().collect()
    assert rows and all(dt.date.fromisoformat(r.date_week).weekday() == 0 for r in rows)


def test_iceberg_shares(pipe):
    ice = views.discount_iceberg(pipe.bill())
    by_type = ice.groupBy("date_month", "iceberg_type").agg(F.sum("percent_of_type").alias("s")).collect()
    by_month = ice.groupBy("date_month").agg(F.sum("percent_of_total").alias("s")).collect()
    assert by_type and all(abs(r.s - 1) < 1e-9 for r in by_type)
    assert by_month and all(abs(r.s - 1) < 1e-9 for r in by_month)


def test_marketplace_override(pipe):
    rows = pipe.stage00().where(F.col("billing_entity") == "AWS Marketplace").select(
        "product_code", "product_name", "product_family").distinct().collect()
    assert {(r.product_code, r.product_name, r.product_family) for r in rows} == {
        ("AWSMarketplace", "Marketplace", "Marketplace App")}


def test_bill_lines(pipe):
    lines = {(r.line_item_type, r.bill_line) for r in pipe.bill().select("line_item_type", "bill_line").distinct().collect()}
    assert ("Credit", "Credits") in lines
    assert ("SavingsPlanNegation", "Savings Plan") in lines
    assert ("RIFee", "Charges") in lines
    assert ("Tax", "Tax") in lines


def test_duplicate_key_raises(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y")], "pricing_unit string, pricing_bucket string")
    with pytest.raises(DuplicateKeyError):
        assert_unique(df, ["pricing_unit"], "dim_pricing_buckets")


def test_duplicate_key_in_file_raises(spark, tmp_path):
    from costlake.sources import dims as D

    for name, rows in D.SEEDS.items():
        cols = D.SCHEMAS[name].names
        lines = [",".join(cols)] + [",".join('"' + (v or "").replace('"', '""') + '"' for v in r) for r in rows]
        if name == "dim_aws_products":
            lines.append('"AmazonEC2","EC2 again"')
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(DuplicateKeyError):
        load_dims(spark, str(tmp_path))


def test_hourly_grain_sums_to_daily(spark):
    daily = fixture_pipeline(spark, SF_SMALL).stage00()
    hourly = fixture_pipeline(spark, SF_SMALL, grain="hour").stage00()
    assert total(daily, "cost") == total(hourly, "cost")


def test_instance_lines_take_their_group_from_a_tag(spark):
    from costlake.plans.pipeline import Pipeline
    from costlake.sources.fixture import AS_OF, cur_from_lineitem

    cur = cur_from_lineitem(spark, SF_SMALL)
    plain = Pipeline(spark, cur, AS_OF, load_dims(spark)).stage00()
    tagged = Pipeline(spark, cur, AS_OF, load_dims(spark), resource_tags=("resource_tags_user_service",)).stage00()
    inst = (F.col("compute_instance_type") == "c5.xlarge") & (F.col("line_item_type") == "Usage")
    assert {r.resource_name for r in plain.where(inst).select("resource_name").distinct().collect()} == {""}
    names = {r.resource_name for r in tagged.where(inst).select("resource_name").distinct().collect()}
    assert names and all(n.startswith("svc") for n in names)
    assert total(plain, "cost") == total(tagged, "cost")
