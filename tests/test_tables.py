"""Views over written fact tables equal views over the in-memory pipeline."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators import recipes, views
from costlake.plans.pipeline import build_full, fixture_pipeline
from costlake.plans.sinks import read_table
from costlake.sources.dims import BROADCAST_BYTES, CELL_BYTES, Dim
from costlake.sources.fixture import AS_OF


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_views_from_tables(spark, tmp_path):
    p = fixture_pipeline(spark, SF_SMALL)
    usage_path, bill_path = str(tmp_path / "usage"), str(tmp_path / "bill")
    build_full(p, usage_path, bill_path)
    import os
    ckpt = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    left = os.listdir(os.path.join(ckpt, "costlake")) if os.path.isdir(os.path.join(ckpt, "costlake")) else []
    assert not [d for d in left if d.startswith("stage01-")]      # the intermediate table is removed
    usage, bill = read_table(spark, usage_path), read_table(spark, bill_path)
    assert dict(usage.dtypes)["date"] == "string" and dict(bill.dtypes)["date_month"] == "string"
    assert rows(views.discount_iceberg(bill)) == rows(views.discount_iceberg(p.bill()))
    assert rows(views.wow_cost_movers(usage, AS_OF)) == rows(views.wow_cost_movers(p.usage_daily(), AS_OF))
    assert rows(recipes.invoice_summary(bill)) == rows(recipes.invoice_summary(p.bill()))
    assert rows(views.cpu_ratecard(usage, AS_OF)) == rows(views.cpu_ratecard(p.usage_daily(), AS_OF))


def test_large_dimension_is_not_broadcast(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("k"))
    small, large = Dim(df, 3), Dim(df, BROADCAST_BYTES // CELL_BYTES + 1)
    assert "ResolvedHint" in small.joinable()._jdf.queryExecution().logical().toString() or \
        "broadcast" in small.joinable()._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large.joinable()._jdf.queryExecution().logical().toString().lower()


def test_buying_options_as_array(spark):
    """Options given as an array are shown joined by ', ', same as the text form."""
    p = fixture_pipeline(spark, SF_SMALL)
    text = p.dims.buying.df
    arr = text.withColumn("buy_options", F.split("buy_options", ", "))
    fact = p.usage_daily()
    assert rows(views.buying_efficiency(fact, arr, AS_OF)) == rows(views.buying_efficiency(fact, text, AS_OF))


def test_ratecard_percentiles_are_exact_at_any_size(spark):
    """One group of 130,000 values, one of repeated values, one of a single value, one without a rate."""
    big = spark.range(130_000).select(F.lit("a").alias("os"), (F.pmod(F.xxhash64("id"), F.lit(1_000_003)) + 1).cast("double").alias("cost"))
    few = spark.createDataFrame([("b", float(x)) for x in (3, 3, 3, 9, 12, 12)] + [("c", 5.0), ("d", None)], "os string, cost double")
    fact = big.union(few).select(
        F.lit("Compute").alias("pricing_bucket"), F.lit("AmazonEC2").alias("product_code"), F.lit("2001-10-01").alias("date"),
        F.lit("Intel Xeon").alias("compute_processor_line"), F.lit("c5").alias("compute_instance_type_family"),
        F.col("os").alias("compute_os"), F.lit(None).cast("string").alias("compute_software"), F.lit("OnDemand").alias("pricing_regime"),
        F.lit("Intel").alias("compute_processor_vendor"), F.lit(1.0).alias("usage"), "cost", F.lit(2).alias("compute_processor_vcpu"))
    got = {r.compute_os: r for r in views.cpu_ratecard(fact, AS_OF).collect()}
    want = {r.compute_os: r for r in views.ratecard_rows(fact, AS_OF).groupBy("compute_os").agg(
        F.percentile("_r", list(views.PERCENTILES)).alias("p"), F.count(F.lit(1)).alias("n"), F.sum("cost").alias("cost")).collect()}
    assert set(got) == set(want) == {"a", "b", "c", "d"}
    for k, w in want.items():
        shown = [got[k][f"rate_cents_p{p}"] for p in (25, 50, 75, 95)]
        assert shown == [None] * 4 if w.p is None else all(abs(x - 100 * y) < 1e-9 for x, y in zip(shown, w.p))
        assert got[k].instance_hours == w.n and got[k].cost == w.cost
