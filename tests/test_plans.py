"""Plan shape: pruned scan, partition filters, broadcast dimension joins, no Python UDFs."""

import datetime as dt
import re

import pytest

from conftest import SF_SMALL
from costlake.operators.clean import clean
from costlake.plans.catalog import QUERIES
from costlake.plans.pipeline import Pipeline, fixture_pipeline
from costlake.sources.contract import months_back
from costlake.sources.dims import load_dims
from costlake.sources.fixture import AS_OF, cur_from_lineitem


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cur_table(spark, tmp_path_factory):
    """The fixture CUR written as a real CUR drop: Parquet partitioned by year/month, plus a junk column."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("cur") / "cur")
    (cur_from_lineitem(spark, SF_SMALL).withColumn("identity_line_item_id", F.lit("junk"))
     .write.partitionBy("year", "month").parquet(path))
    return path


def test_scan_is_pruned_and_partition_filtered(spark, cur_table):
    cur = spark.read.parquet(cur_table)
    p = plan(clean(months_back(cur, AS_OF, 2)))
    assert "identity_line_item_id" not in p.split("ReadSchema")[1].split("\n")[0]
    assert "PartitionFilters: [" in p and "PartitionFilters: []" not in p


def test_months_back_reads_only_those_partitions(spark, cur_table):
    cur = spark.read.parquet(cur_table)
    months = {(r.year, r.month) for r in months_back(cur, AS_OF, 2).select("year", "month").distinct().collect()}
    assert months == {(2001, 9), (2001, 10), (2001, 11)}


def test_stage01_joins_are_broadcast(spark):
    p = plan(fixture_pipeline(spark, SF_SMALL).stage01())
    assert p.count("BroadcastHashJoin") >= 4
    assert "SortMergeJoin" not in p


def test_stage00_single_exchange_on_group_key(spark, cur_table):
    p = plan(clean(spark.read.parquet(cur_table)))
    assert p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p


def test_incremental_reads_whole_bill_months(spark):
    from costlake.sources.contract import restatement_months

    # 2001-11-04 - 65 days = 2001-08-31: the window touches August to November
    assert restatement_months(AS_OF, 65) == 3
    assert restatement_months(dt.date(2023, 3, 5), 65) == 3


def test_fact_filters_reach_the_scan(spark, cur_table):
    """Line-type filter of the fact goes into the Parquet reader; the window's months prune partitions."""
    from costlake.plans.pipeline import Pipeline

    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        cur = spark.read.parquet(cur_table)
        p = plan(Pipeline(spark, months_back(cur, AS_OF, 2), AS_OF, load_dims(spark)).usage_incremental())
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in p.split("\n") if "Scan parquet" in line)
    pushed = scan[scan.index("PushedFilters"):scan.index("ReadSchema")]
    assert "In(line_item_line_item_type, [DiscountedUsage,SavingsPlanCoveredUsage,Usage])" in pushed
    assert "PartitionFilters: [" in scan and "PartitionFilters: []" not in scan


def test_stage00_combines_map_side_before_the_shuffle(spark, cur_table):
    """A hot key (one account with a third of the lines) is folded per task before the exchange."""
    p = plan(clean(spark.read.parquet(cur_table)))
    exchange = p.index("Exchange hashpartitioning")
    partial = p.find("partial_sum", exchange)       # plan text lists the consumer first
    assert partial > exchange, "expected a partial (map-side) aggregate below the stage-00 exchange"


def test_bill_is_a_plain_hash_aggregate(spark):
    for name in ("bill_monthly", "invoice_summary"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        assert "ObjectHashAggregate" not in p and "SortAggregate" not in p


def final_plan(df) -> str:
    """The plan as it ran, subqueries too, without the plans it began with: shared shuffles show as reused."""
    df.collect()
    out, skip = [], None
    for line in plan(df).split("\n"):
        node = re.search(r"[^\s:+-]", line)
        at = node.start() if node else 0
        if skip is not None and at >= skip:
            continue
        skip = at if "== Initial Plan ==" in line else None
        out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("name", ["discount_iceberg", "cpu_ratecard", "growth_projection", "wow_cost_movers", "wow_cost_movers_fixed"])
def test_raw_lines_are_read_once(spark, name):
    text = final_plan(QUERIES[name](spark, SF_SMALL))
    assert text.count("Scan parquet") == 1 and "Initial Plan" in text


def test_iceberg_shares_without_windows(spark):
    p = plan(QUERIES["discount_iceberg"](spark, SF_SMALL))
    assert "Window" not in p and "NestedLoop" not in p


def test_tag_rules_are_an_equi_join(spark):
    p = plan(QUERIES["tag_rules"](spark, SF_SMALL))
    assert "NestedLoop" not in p and "Cartesian" not in p
