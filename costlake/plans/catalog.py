"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query runs the whole chain over the test-data folder: lineitem -> raw CUR (fixture
adapter) -> stage 00 -> stage 01 -> fact -> view. Nothing is sampled or capped; the only
``limit`` is the top-50 of ``storage_growth``, which is the report itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from costlake.functions import units
from costlake.operators import facts, recipes, views
from costlake.operators.clean import clean
from costlake.plans.pipeline import FIXTURE_TAGS, build_full, fixture_pipeline
from costlake.plans.sinks import full_load, read_table, restate
from costlake.session import ensure_checkpoint_dir, use_jit_limit
from costlake.sources.contract import date_slice, months_back
from costlake.sources.fixture import AS_OF, cur_from_lineitem, edited_cur
from costlake.sources.dims import Dim
from costlake.sources.local import local_table

# Our own curated maps for the tag recipes (a user keeps these as small tables).
ENV_MAP = [("prod", "production"), ("production", "production"), ("prd", "production"),
           ("oldprod", "production"), ("dev", "development"), ("devel", "development")]
SYSTEM_MAP = [("svc1", "checkout"), ("svc2", "checkout"), ("svc7", "search")]
TAG_RULES = [(1, "svc3", "null", "2001-04-18", "2001-05-07", "svc3-v2")]
DRIVER_MAP = [(f"svc{i}", "customers" if i < 5 else "orders") for i in range(10)]


def _schema(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Parts in which the test lines are read, at least: the files a real drop would have.
CUR_PARTS = 16


def _p(spark, sf_dir, **kw):
    use_jit_limit(spark)
    return fixture_pipeline(spark, sf_dir, partitions=CUR_PARTS, **kw)


def q_clean_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p(spark, sf_dir).stage00()


def q_units_by_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 with the unit rules as a table: dictionary of the lines' combinations, looked up."""
    rules = local_table(spark, units.rule_rows(), T.StructType.fromDDL(units.RULE_SCHEMA))
    return replace(_p(spark, sf_dir), unit_rules=rules).stage00()


def q_enriched_lineitems(spark, sf_dir):
    return _p(spark, sf_dir).stage01()


def q_source_months_back(spark, sf_dir):
    cur = cur_from_lineitem(spark, sf_dir, AS_OF)
    return clean(months_back(cur, AS_OF, 2))


def q_source_date_slice(spark, sf_dir):
    """S3: stage 00 over the debugging slice of one week of raw lines."""
    cur = cur_from_lineitem(spark, sf_dir, AS_OF)
    return clean(date_slice(cur, "2001-10-01 00:00:00", "2001-10-07 23:59:59"))


def q_usage_daily(spark, sf_dir):
    return _p(spark, sf_dir).usage_daily()


def q_usage_incremental(spark, sf_dir):
    return _p(spark, sf_dir).usage_incremental()


def _folder(spark: SparkSession) -> str:
    """A new folder for tables in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/costlake/tables-{uuid.uuid4().hex}"


#: Months of stage 01 at a time in the registered full loads.
LOAD_MONTHS = 13


def q_usage_full_load(spark, sf_dir):
    """The daily fact as the stepwise full build publishes it."""
    folder = _folder(spark)
    build_full(_p(spark, sf_dir), f"{folder}/usage", f"{folder}/bill", LOAD_MONTHS)
    return read_table(spark, f"{folder}/usage")


def q_bill_full_load(spark, sf_dir):
    """The bill as the stepwise full build publishes it."""
    folder = _folder(spark)
    build_full(_p(spark, sf_dir), f"{folder}/usage", f"{folder}/bill", LOAD_MONTHS)
    return read_table(spark, f"{folder}/bill")


def q_usage_restated(spark, sf_dir):
    """The whole daily fact after a restatement from edited raw lines (dearer, late and vanished ones)."""
    p, path = _p(spark, sf_dir), f"{_folder(spark)}/usage"
    full_load(p.usage_daily(), path, "date")
    restate(p.over(edited_cur(p.cur)).usage_incremental(), path, "date", facts.restate_start(AS_OF))
    return read_table(spark, path)


def q_bill_restated(spark, sf_dir):
    """The whole bill after a restatement that writes only months whose fingerprint changed."""
    p, path = _p(spark, sf_dir), f"{_folder(spark)}/bill"
    full_load(p.bill(), path, "date_month")
    restate(p.over(edited_cur(p.cur)).bill_incremental(), path, "date_month", facts.bill_restate_month(AS_OF), changed_only=True)
    return read_table(spark, path)


def q_bill_monthly(spark, sf_dir):
    return _p(spark, sf_dir).bill()


def q_bill_incremental(spark, sf_dir):
    return _p(spark, sf_dir).bill_incremental()


def q_discount_iceberg(spark, sf_dir):
    return views.discount_iceberg(_p(spark, sf_dir).bill())


def q_cpu_ratecard(spark, sf_dir):
    return views.cpu_ratecard(_p(spark, sf_dir).only("Compute").usage_daily(), AS_OF)


def q_cpu_ratecard_approx(spark, sf_dir):
    return views.cpu_ratecard(_p(spark, sf_dir).only("Compute").usage_daily(), AS_OF, approx_accuracy=10000)


def q_buying_efficiency(spark, sf_dir):
    p = _p(spark, sf_dir)
    return views.buying_efficiency(p.usage_daily(), p.dims.buying, AS_OF)


def q_wow_cost_movers(spark, sf_dir):
    return views.wow_cost_movers(_p(spark, sf_dir).usage_daily(), AS_OF)


def q_wow_cost_movers_fixed(spark, sf_dir):
    return views.wow_cost_movers(_p(spark, sf_dir).usage_daily(), AS_OF, fixed=True)


def q_bucket_spend(spark, sf_dir):
    return recipes.bucket_spend(_p(spark, sf_dir).only("Compute").usage_daily(), AS_OF)


def q_storage_growth(spark, sf_dir):
    return recipes.storage_growth(_p(spark, sf_dir).only("Storage").usage_daily(), AS_OF)


def q_storage_idle(spark, sf_dir):
    return recipes.storage_idle(_p(spark, sf_dir).only("Storage").usage_daily(), AS_OF)


def _tagged_fact(spark, sf_dir):
    return _p(spark, sf_dir, tags=FIXTURE_TAGS).usage_daily()


def q_env_mapping(spark, sf_dir):
    env = Dim(local_table(spark, ENV_MAP, _schema("tag_env", "environment")), len(ENV_MAP))
    return recipes.env_mapping(_tagged_fact(spark, sf_dir), env)


def q_system_mapping(spark, sf_dir):
    m = Dim(local_table(spark, SYSTEM_MAP, _schema("tag_service", "tag_system")), len(SYSTEM_MAP))
    return recipes.system_mapping(_tagged_fact(spark, sf_dir), m)


def q_tag_patch(spark, sf_dir):
    rules = local_table(spark, TAG_RULES, T.StructType.fromDDL(recipes.RULE_SCHEMA))
    return recipes.tag_patch(_tagged_fact(spark, sf_dir), rules, facts.full_load_start(AS_OF), AS_OF.isoformat())


def q_tag_rules(spark, sf_dir):
    """G7 with as many rules as there are orders."""
    rules = recipes.rules_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet"))
    return recipes.tag_patch(_tagged_fact(spark, sf_dir), rules, facts.full_load_start(AS_OF), AS_OF.isoformat())


def q_invoice_summary(spark, sf_dir):
    return recipes.invoice_summary(_p(spark, sf_dir).bill())


def q_tag_coverage(spark, sf_dir):
    return recipes.tag_coverage(_tagged_fact(spark, sf_dir))


def q_unit_cost(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return recipes.unit_cost(_tagged_fact(spark, sf_dir), recipes.work_log_from_orders(orders))


def q_usage_hourly(spark, sf_dir):
    return _p(spark, sf_dir, grain="hour").usage_hourly()


def q_usage_from_hours(spark, sf_dir):
    return _p(spark, sf_dir, grain="hour").usage_from_hours()


def q_hourly_usage(spark, sf_dir):
    """G11 over all hours and line types, not only those that the hour fact keeps."""
    return recipes.hourly_usage(_p(spark, sf_dir, grain="hour").only("Compute").stage01())


def q_cost_ma7(spark, sf_dir):
    return recipes.cost_ma7(_p(spark, sf_dir).usage_daily())


def q_base_load(spark, sf_dir):
    """G13 over all months and line types, not only those that the hour fact keeps."""
    return recipes.base_load(_p(spark, sf_dir, grain="hour").only("Compute").stage01(), AS_OF)


def q_growth_alerts(spark, sf_dir):
    return recipes.growth_alerts(_p(spark, sf_dir).only("Storage").usage_daily(), AS_OF)


def q_driver_projection(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    dm = Dim(local_table(spark, DRIVER_MAP, _schema("tag_service", "driver")), len(DRIVER_MAP))
    return recipes.driver_projection(_tagged_fact(spark, sf_dir), dm, recipes.driver_units_from_orders(orders), AS_OF)


def q_growth_projection(spark, sf_dir):
    return recipes.growth_projection(_p(spark, sf_dir).usage_daily(), AS_OF)


def q_reconcile(spark, sf_dir):
    from costlake.sources.contract import conform
    p = _p(spark, sf_dir)
    return recipes.reconcile(conform(p.cur), p.bill(), facts.years_back(AS_OF, 2).strftime("%Y-%m"))


def q_reconcile_daily(spark, sf_dir):
    from costlake.sources.contract import conform
    p = _p(spark, sf_dir)
    return recipes.reconcile_daily(conform(p.cur), p.usage_daily(), facts.full_load_start(AS_OF))


def q_reconcile_invoices(spark, sf_dir):
    bill = _p(spark, sf_dir).bill()
    return recipes.reconcile_invoices(bill, recipes.invoices_from_bill(bill))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_lineitems": q_clean_lineitems,
    "units_by_rule_table": q_units_by_rule_table,
    "enriched_lineitems": q_enriched_lineitems,
    "source_months_back": q_source_months_back,
    "source_date_slice": q_source_date_slice,
    "usage_daily": q_usage_daily,
    "usage_incremental": q_usage_incremental,
    "usage_full_load": q_usage_full_load,
    "bill_full_load": q_bill_full_load,
    "usage_restated": q_usage_restated,
    "bill_restated": q_bill_restated,
    "bill_monthly": q_bill_monthly,
    "bill_incremental": q_bill_incremental,
    "discount_iceberg": q_discount_iceberg,
    "cpu_ratecard": q_cpu_ratecard,
    "cpu_ratecard_approx": q_cpu_ratecard_approx,
    "buying_efficiency": q_buying_efficiency,
    "wow_cost_movers": q_wow_cost_movers,
    "wow_cost_movers_fixed": q_wow_cost_movers_fixed,
    "bucket_spend": q_bucket_spend,
    "storage_growth": q_storage_growth,
    "storage_idle": q_storage_idle,
    "env_mapping": q_env_mapping,
    "system_mapping": q_system_mapping,
    "tag_patch": q_tag_patch,
    "tag_rules": q_tag_rules,
    "invoice_summary": q_invoice_summary,
    "tag_coverage": q_tag_coverage,
    "unit_cost": q_unit_cost,
    "usage_hourly": q_usage_hourly,
    "usage_from_hours": q_usage_from_hours,
    "hourly_usage": q_hourly_usage,
    "cost_ma7": q_cost_ma7,
    "base_load": q_base_load,
    "growth_alerts": q_growth_alerts,
    "driver_projection": q_driver_projection,
    "growth_projection": q_growth_projection,
    "reconcile": q_reconcile,
    "reconcile_daily": q_reconcile_daily,
    "reconcile_invoices": q_reconcile_invoices,
}
