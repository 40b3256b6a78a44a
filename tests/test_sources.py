"""Dimension files of any order and place, and usage times with a zone."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators import recipes
from costlake.plans.pipeline import Pipeline
from costlake.sources import dims as D
from costlake.sources.contract import conform, months_back
from costlake.sources.fixture import AS_OF, cur_from_lineitem


def test_parquet_dimensions_by_url(spark, tmp_path):
    for name, rows in D.SEEDS.items():
        df = spark.createDataFrame(rows, D.SCHEMAS[name])
        df.select(*reversed(df.columns), F.lit(1).alias("extra")).write.parquet(f"{tmp_path}/{name}.parquet")
    dims = D.load_dims(spark, f"file://{tmp_path}/")
    assert dims.buckets.rows == len(D.PRICING_BUCKETS) and dims.specs.df.columns == D.SCHEMAS["dim_instance_specs"].names
    assert sorted(map(tuple, dims.buckets.df.collect())) == sorted(D.PRICING_BUCKETS)


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "dim_pricing_buckets.csv").write_text("pricing_bucket,pricing_unit\nStorage,GB-Month\n")
    row = D.load_dim(spark, "dim_pricing_buckets", str(tmp_path)).df.first()
    assert (row.pricing_unit, row.pricing_bucket) == ("GB-Month", "Storage")
    (tmp_path / "dim_aws_products.csv").write_text("product_code\nAmazonEC2\n")
    with pytest.raises(ValueError):
        D.load_dim(spark, "dim_aws_products", str(tmp_path))


def test_a_full_spec_list(spark, tmp_path):
    """As many machine types as the published list has: every one gets its processor count."""
    one = dict(zip(D.SCHEMAS["dim_instance_specs"].names, D.INSTANCE_SPECS[2]))
    rows = [tuple({**one, "instance_type": f"m{i}.large", "instance_spec": f"m{i}.large", "vcpu": str(i % 96 + 1)}.values()) for i in range(975)]
    for name, seed in {**D.SEEDS, "dim_instance_specs": rows}.items():
        spark.createDataFrame(seed, D.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    dims = D.load_dims(spark, str(tmp_path))
    assert dims.specs.rows == 975 and dims.spec_attrs.df.where("processor_vcpu is null").count() == 0


def test_pipeline_asks_for_dimensions(spark):
    with pytest.raises(ValueError):
        Pipeline(spark, cur_from_lineitem(spark, SF_SMALL), AS_OF)


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Pacific/Auckland", "UTC"])
def test_zoned_usage_start_is_utc_in_any_session(spark, zone, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    cur = cur_from_lineitem(spark, SF_SMALL).limit(4)
    times = ["2001-07-01 03:00:00", "2001-10-28 08:30:00", "2001-10-28 09:30:00", "1969-12-31 23:59:59"]
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        n = F.row_number().over(__import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("line_item_resource_id", "line_item_usage_amount", "line_item_unblended_cost"))
        at = F.element_at(F.array(*[F.lit(t) for t in times]), n).cast("timestamp")
        cur.withColumn("line_item_usage_start_date", at).write.parquet(str(tmp_path / "cur"))
        spark.conf.set("spark.sql.session.timeZone", zone)
        got = sorted(str(r[0]) for r in conform(spark.read.parquet(str(tmp_path / "cur"))).select("line_item_usage_start_date").collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == sorted(times)


def test_months_match_padded_folders(spark):
    df = spark.createDataFrame([("2001", "05"), ("2001", "5"), ("2001", "11")], "year string, month string")
    assert months_back(df, dt.date(2001, 5, 9), 0).count() == 2


def test_small_growth_has_a_deviation(spark):
    rows = [(f"2001-10-{d:02d}", "b", 1.0 + 0.000004 * (d % 2), 1.0) for d in range(1, 29)]
    fact = spark.createDataFrame(rows, "date string, resource_name string, storage_total_tb double, cost double").withColumns(
        {"pricing_bucket": F.lit("Storage"), "product_code": F.lit("AmazonS3")})
    got = recipes.storage_idle(fact, dt.date(2001, 10, 28), max_growth=1.0).first()
    assert got.stddev_delta == pytest.approx(4.07e-06, rel=0.01)


def test_unit_cost_keeps_cost_without_transactions(spark):
    fact = spark.createDataFrame([("2001-10-01", "s1", 3.0), ("2001-10-01", "s2", 5.0)], "date string, tag_service string, cost double")
    log = spark.createDataFrame([("2001-10-01", "s1", 2)], "date string, service string, transactions long")
    got = {r.service: (r.cost, r.cost_per_transaction) for r in recipes.unit_cost(fact, log).collect()}
    assert got == {"s1": (3.0, 1.5), "s2": (5.0, None)}


def test_fixture_parts_grow_with_the_lines(spark, monkeypatch):
    """A part is what one task folds: on larger tables there are more of them, not larger ones."""
    from costlake.sources import fixture

    want = fixture.cur_from_lineitem(spark, SF_SMALL).count()
    assert fixture.cur_from_lineitem(spark, SF_SMALL, partitions=2).rdd.getNumPartitions() == 2
    monkeypatch.setattr(fixture, "PART_ROWS", 1000)
    cur = fixture.cur_from_lineitem(spark, SF_SMALL, partitions=2)
    assert cur.rdd.getNumPartitions() == -(-want // 1000) and cur.count() == want


def test_queries_bring_the_jit_limit_to_a_plain_session(spark):
    from costlake.plans.catalog import QUERIES

    name = "spark.sql.codegen.hugeMethodLimit"
    ours = spark.conf.get(name)
    try:
        for given, want in (("65535", ours), ("20000", "20000")):      # a caller's own limit stays
            spark.conf.set(name, given)
            QUERIES["clean_lineitems"](spark, SF_SMALL)
            assert spark.conf.get(name) == want
    finally:
        spark.conf.set(name, ours)
