"""Stage 00: clean raw CUR lines and aggregate them to a daily grain.

Plan shape: one Parquet scan (55 columns) -> filter -> project -> partial aggregate ->
one shuffle on the group key -> final aggregate -> project. Map-side partial aggregation
collapses a hot key to one row per task before the shuffle, so a skewed account or
bucket does not land whole on one reducer.

Columns that are functions of other group keys (calendar fields of ``date``,
``days_in_month`` of ``year``/``month``, ``usage_type`` of ``usage_type_orig``, processor
vendor/line of the processor name, the version tag) are derived *after* the aggregate:
the shuffle key is narrower and the regexes run once per group instead of once per line.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions import cleaning as fx
from costlake.functions import units
from costlake.functions.measures import dsum
from costlake.session import ensure_checkpoint_dir
from costlake.sources.contract import conform
from costlake.sources.dims import Dim, small_side

VERSION = "0.1.0"

# grouping keys computed per line, in output order
LINE_KEYS = [
    "year", "month", "date", "account_id", "billing_entity", "legal_entity", "invoice_id", "resource_name",
    "line_item_type", "usage_type_orig", "region_code", "location", "operation", "currency_code",
    "product_code", "product_name", "product_family", "product_group", "product_servicecode",
    "pricing_unit", "pricing_unit_orig", "pricing_regime", "product_description", "savings_plan_arn",
    "reserved_instance_arn", "compute_instance_spec", "compute_instance_type", "compute_instance_family",
    "compute_instance_type_family", "compute_availability_zone", "compute_capacity_status",
    "compute_processor_name", "compute_storage", "compute_os", "compute_software", "storage_class",
    "storage_volume_type", "storage_volume_api", "storage_user_volume",
]

STAGE00_DIMS = [
    "year", "month", "date", "date_week", "date_month", "day_of_week", "etl_version", "account_id",
    "billing_entity", "legal_entity", "invoice_id", "resource_name", "line_item_type", "usage_type",
    "usage_type_orig", "region_code", "location", "operation", "currency_code", "product_code", "product_name",
    "product_family", "product_group", "product_servicecode", "pricing_unit", "pricing_unit_orig",
    "pricing_regime", "product_description", "savings_plan_arn", "reserved_instance_arn",
    "compute_instance_spec", "compute_instance_type", "compute_instance_family", "compute_instance_type_family",
    "compute_availability_zone", "compute_capacity_status", "compute_processor_name", "compute_processor_vendor",
    "compute_processor_line", "compute_storage", "compute_os", "compute_software", "storage_class",
    "storage_volume_type", "storage_volume_api", "storage_user_volume", "days_in_month",
]
STAGE00_MEASURES = [
    "record_cnt", "usage", "cost", "cost_without_edp", "unblended_cost", "net_unblended_cost",
    "edp_discount", "private_rate_discount", "total_discount", "public_cost",
]


def billable(cur: DataFrame) -> DataFrame:
    """Drop always-free usage. Three-valued: a Usage line with a null rate is dropped too."""
    free = (F.col("line_item_line_item_type") == "Usage") & (F.col("pricing_public_on_demand_rate") == "0.0000000000")
    return cur.where(~free)


@functools.lru_cache(maxsize=64)
def _line_columns(tags: tuple[tuple[str, str], ...], resource_tag_fallbacks: tuple[str, ...],
                  hour_keys: tuple[str, ...], looked_up: bool = False) -> tuple[Column, ...]:
    """The per-line projection of stage 00. Built once per parameter set: the expressions are
    unresolved trees over column names, so every query can reuse them (building one costs
    thousands of calls into the JVM)."""
    c = fx.c
    entity = c("bill_billing_entity")
    market = entity == "AWS Marketplace"
    line_type = c("line_item_line_item_type")
    return (
        c("year"), c("month"),
        fx.date_text(c("line_item_usage_start_date")).alias("date"),
        c("line_item_usage_account_id").alias("account_id"),
        entity.alias("billing_entity"),
        c("line_item_legal_entity").alias("legal_entity"),
        c("bill_invoice_id").alias("invoice_id"),
        fx.resource_name(c("line_item_resource_id"), [c(t) for t in resource_tag_fallbacks]).alias("resource_name"),
        line_type.alias("line_item_type"),
        c("line_item_usage_type").alias("usage_type_orig"),
        c("product_region").alias("region_code"),
        c("product_location").alias("location"),
        fx.operation(c("line_item_operation")).alias("operation"),
        c("line_item_currency_code").alias("currency_code"),
        F.when(market, F.lit("AWSMarketplace")).otherwise(c("line_item_product_code")).alias("product_code"),
        F.when(market, F.lit("Marketplace")).otherwise(c("product_product_name")).alias("product_name"),
        F.when(market, F.lit("Marketplace App")).otherwise(c("product_product_family")).alias("product_family"),
        F.when(market, c("product_product_name")).otherwise(c("product_group")).alias("product_group"),
        F.when(market, c("product_product_name")).otherwise(c("product_servicecode")).alias("product_servicecode"),
        (c("clean_unit") if looked_up else units.case_of({f: c(src) for f, src in units.FIELDS.items()})).alias("pricing_unit"),
        c("pricing_unit").alias("pricing_unit_orig"),
        fx.pricing_regime(c("pricing_term"), line_type, c("discount_private_rate_discount")).alias("pricing_regime"),
        fx.first_nonblank(c("product_bundle_description"), c("product_description"), c("product_group_description"),
                          c("line_item_line_item_description")).alias("product_description"),
        c("savings_plan_savings_plan_a_r_n").alias("savings_plan_arn"),
        c("reservation_reservation_a_r_n").alias("reserved_instance_arn"),
        fx.instance_spec(c("product_instance_type")).alias("compute_instance_spec"),
        F.lower(c("product_instance_type")).alias("compute_instance_type"),
        fx.instance_family(c("product_instance_family"), c("product_bundle")).alias("compute_instance_family"),
        fx.instance_type_family(c("product_instance_type_family"), c("product_instance_type")).alias("compute_instance_type_family"),
        fx.availability_zone(c("product_availability_zone"), c("line_item_availability_zone")).alias("compute_availability_zone"),
        c("product_capacitystatus").alias("compute_capacity_status"),
        c("product_physical_processor").alias("compute_processor_name"),
        c("product_storage").alias("compute_storage"),
        c("product_operating_system").alias("compute_os"),
        c("product_pre_installed_sw").alias("compute_software"),
        fx.storage_class(c("product_storage_class"), c("line_item_usage_type")).alias("storage_class"),
        c("product_volume_type").alias("storage_volume_type"),
        c("product_volume_api_name").alias("storage_volume_api"),
        c("product_uservolume").alias("storage_user_volume"),
        *[c(src).alias(out) for out, src in tags],
        *[fx.hour_text(c("line_item_usage_start_date")).alias(h) for h in hour_keys],
        # measures, still exact decimals
        c("line_item_usage_amount").alias("_amount"),
        fx.accrual_cost(line_type, c("line_item_net_unblended_cost"), c("reservation_net_effective_cost"),
                        c("savings_plan_net_savings_plan_effective_cost")).alias("_cost"),
        fx.cost_without_edp(line_type, c("line_item_net_unblended_cost"), c("discount_edp_discount"),
                            c("reservation_effective_cost"), c("savings_plan_savings_plan_effective_cost")).alias("_cost_wo_edp"),
        c("line_item_unblended_cost").alias("_unblended"),
        c("line_item_net_unblended_cost").alias("_net_unblended"),
        c("discount_edp_discount").alias("_edp"),
        c("discount_private_rate_discount").alias("_private"),
        c("discount_total_discount").alias("_total_discount"),
        c("pricing_public_on_demand_cost").alias("_public"),
        )


def clean(cur: DataFrame, tags: Mapping[str, str] | None = None,
          resource_tag_fallbacks: Sequence[str] = (), grain: str = "day",
          keep_units: DataFrame | None = None, unit_rules: DataFrame | None = None) -> DataFrame:
    """Stage 00 over raw CUR.

    ``tags`` maps output names to CUR tag columns that become extra dimensions (the
    "site-specific tags"); ``resource_tag_fallbacks`` are tag columns that name the group
    an instance or volume belongs to. ``grain="hour"`` adds an ``hour`` key
    (``yyyy-MM-dd HH``) for intraday analysis. ``keep_units`` (a small frame with a
    ``pricing_unit`` column, or a ``Dim``) keeps only lines with those cleaned units, before the
    shuffle. ``unit_rules`` (a table of ``units.RULE_SCHEMA``) names the units instead of the
    built-in rules: a first pass over eight columns makes the dictionary of combinations, cut off by a
    checkpoint and counted, and the lines meet it by a broadcast that its size allows.
    """
    if grain not in ("day", "hour"):
        raise ValueError(f"grain must be 'day' or 'hour', not {grain!r}")
    hour_keys = ["hour"] if grain == "hour" else []
    tags = dict(tags or {})
    tag_sources = list(dict.fromkeys(list(tags.values()) + list(resource_tag_fallbacks)))
    raw = billable(conform(cur, tag_sources))
    if unit_rules is not None:
        ensure_checkpoint_dir(cur.sparkSession)
        named = units.dictionary(raw, unit_rules).checkpoint()
        raw = units.look_up(raw, Dim(named, named.count()).joinable())
    cleaned = raw.select(*_line_columns(tuple(tags.items()), tuple(resource_tag_fallbacks), tuple(hour_keys), unit_rules is not None))

    if keep_units is not None:
        kept = small_side(keep_units).select("pricing_unit").distinct()
        cleaned = cleaned.join(kept, "pricing_unit", "left_semi")

    keys = LINE_KEYS + list(tags) + hour_keys
    aggs, out = _agg_and_output(tuple(tags), tuple(hour_keys))
    return cleaned.groupBy(*keys).agg(*aggs).select(*out)


@functools.lru_cache(maxsize=64)
def _agg_and_output(tags: tuple[str, ...], hour_keys: tuple[str, ...]) -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    """Aggregates and the post-aggregate projection of stage 00 (reusable, see _line_columns)."""
    c = fx.c

    def dsum(name: str):
        return F.sum(name).cast("double")

    aggs = (
        F.count(F.lit(1)).alias("record_cnt"),
        F.sum("_amount").alias("_amount"),
        dsum("_cost").alias("cost"),
        dsum("_cost_wo_edp").alias("cost_without_edp"),
        dsum("_unblended").alias("unblended_cost"),
        dsum("_net_unblended").alias("net_unblended_cost"),
        dsum("_edp").alias("edp_discount"),
        dsum("_private").alias("private_rate_discount"),
        dsum("_total_discount").alias("total_discount"),
        dsum("_public").alias("public_cost"),
    )
    derived = {
        "date_week": fx.week_text(c("date")),
        "date_month": fx.month_text(c("date")),
        "day_of_week": fx.day_of_week(c("date")),
        "etl_version": F.lit(VERSION),
        "usage_type": fx.usage_type(c("usage_type_orig")),
        "compute_processor_vendor": fx.processor_vendor(c("compute_processor_name")),
        "compute_processor_line": fx.processor_line(c("compute_processor_name")),
        "days_in_month": fx.days_in_month(c("year"), c("month")),
        # sum(amount / divisor) == sum(amount) / divisor: the unit is part of the key
        "usage": c("_amount").cast("double") / fx.usage_divisor(c("pricing_unit_orig")),
    }
    out = [derived[n].alias(n) if n in derived else c(n) for n in STAGE00_DIMS]
    out += [c(t) for t in list(tags) + list(hour_keys)]
    out += [derived[n].alias(n) if n in derived else c(n) for n in STAGE00_MEASURES]
    return aggs, tuple(out)


def rollup(hours: DataFrame, tags: Sequence[str] = ()) -> DataFrame:
    """Stage 00 by day from stage 00 by hour: the hours' exact sums are summed, the raw lines are not read again."""
    sums = [F.sum("record_cnt").alias("record_cnt")] + [dsum(m).alias(m) for m in STAGE00_MEASURES[1:]]
    return hours.groupBy(*STAGE00_DIMS, *tags).agg(*sums).select(*STAGE00_DIMS, *tags, *STAGE00_MEASURES)
