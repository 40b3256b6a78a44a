"""Raw CUR contract (S1-S3): required columns, optional columns, types, source filters.

A real CUR table has 300+ columns; stage 00 reads 55 of them. Selecting through
``conform`` keeps the scan pruned to those (Parquet ``ReadSchema``) and gives every
downstream step the same types whatever the writer used.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(24,10)"

TEXT_COLUMNS = [
    "line_item_usage_account_id", "bill_billing_entity", "line_item_legal_entity", "bill_invoice_id",
    "line_item_resource_id", "line_item_line_item_type", "line_item_usage_type", "line_item_operation",
    "line_item_currency_code", "line_item_product_code", "line_item_line_item_description",
    "line_item_availability_zone", "product_region", "product_location", "product_product_name",
    "product_product_family", "product_group", "product_servicecode", "product_group_description",
    "product_resource_type", "product_bundle_description", "product_description", "product_instance_type",
    "product_instance_family", "product_bundle", "product_instance_type_family", "product_availability_zone",
    "product_capacitystatus", "product_physical_processor", "product_storage", "product_operating_system",
    "product_pre_installed_sw", "product_storage_class", "product_volume_type", "product_volume_api_name",
    "product_uservolume", "pricing_unit", "pricing_term", "savings_plan_savings_plan_a_r_n",
    "reservation_reservation_a_r_n", "pricing_public_on_demand_rate",
]

MONEY_COLUMNS = [
    "line_item_usage_amount", "line_item_unblended_cost", "line_item_net_unblended_cost",
    "reservation_effective_cost", "reservation_net_effective_cost",
    "savings_plan_savings_plan_effective_cost", "savings_plan_net_savings_plan_effective_cost",
    "pricing_public_on_demand_cost",
]

# present only under some contracts (enterprise discount, private pricing); absent -> 0
OPTIONAL_MONEY_COLUMNS = ["discount_edp_discount", "discount_private_rate_discount", "discount_total_discount"]

REQUIRED = ["year", "month", "line_item_usage_start_date"] + TEXT_COLUMNS + MONEY_COLUMNS


def conform(cur: DataFrame, tag_columns: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Project raw CUR onto the 55 columns we read (+ caller's tag columns), typed.

    Partition columns ``year``/``month`` become text, the month unpadded whatever the folder
    says (Spark infers them as int). A zoned usage start becomes its UTC wall clock. Absent
    optional discount columns are added as zero.
    """
    present = set(cur.columns)
    missing = [c for c in REQUIRED if c not in present]
    if missing:
        raise ValueError(f"CUR input lacks required columns: {missing}")
    absent_tags = [c for c in tag_columns if c not in present]
    if absent_tags:
        raise ValueError(f"CUR input lacks tag columns: {absent_tags}")
    optional = tuple(c for c in OPTIONAL_MONEY_COLUMNS if c in present)
    zoned = isinstance(cur.schema["line_item_usage_start_date"].dataType, T.TimestampType)
    return cur.select(*_conform_columns(optional, tuple(tag_columns), zoned))


def utc_wall_clock(ts: Column) -> Column:
    """A zoned timestamp as its UTC wall clock without a zone: the same in any session time zone."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def _conform_columns(optional_present: tuple[str, ...], tag_columns: tuple[str, ...], zoned: bool) -> tuple[Column, ...]:
    start = F.col("line_item_usage_start_date")
    cols: list[Column] = [
        F.col("year").cast("string").alias("year"),
        F.col("month").cast("int").cast("string").alias("month"),
        (utc_wall_clock(start) if zoned else start).alias("line_item_usage_start_date"),
    ]
    cols += [F.col(c).cast("string").alias(c) for c in TEXT_COLUMNS]
    cols += [F.col(c).cast(MONEY).alias(c) for c in MONEY_COLUMNS]
    for c in OPTIONAL_MONEY_COLUMNS:
        cols.append((F.col(c).cast(MONEY) if c in optional_present else F.lit(0).cast(MONEY)).alias(c))
    cols += [F.col(c).cast("string").alias(c) for c in tag_columns]
    return tuple(cols)


def month_start(d: dt.date, back: int) -> dt.date:
    y, m = divmod(d.year * 12 + d.month - 1 - back, 12)
    return dt.date(y, m + 1, 1)


def _in_months(cur: DataFrame, months: set[tuple[int, int]]) -> DataFrame:
    cond = F.lit(False)
    for y, m in sorted(months):
        cond = cond | ((F.col("year").cast("int") == y) & (F.col("month").cast("int") == m))
    return cur.where(cond)


def months_back(cur: DataFrame, as_of: dt.date, n_prior: int) -> DataFrame:
    """Keep the ``as_of`` month and ``n_prior`` months before it, by partition values.

    The predicate is on the ``year``/``month`` partition columns themselves (not on a date
    derived from a timestamp), so a partitioned scan prunes whole directories.
    """
    pairs = {(month_start(as_of, k).year, month_start(as_of, k).month) for k in range(n_prior + 1)}
    return _in_months(cur, pairs)


def usage_months(cur: DataFrame, first: dt.date, last: dt.date, final: bool) -> DataFrame:
    """Lines used in the months from ``first`` to ``last`` (days of those months).

    A line is billed in its usage month or the one after, so those partitions are read, the
    usage start decides. The ``final`` step of a load has no month after it and takes what lies
    beyond its last day too.
    """
    end = month_start(last, -1)
    n = (end.year - first.year) * 12 + end.month - first.month
    months = {(m.year, m.month) for m in (month_start(first, -k) for k in range(n + (0 if final else 1)))}
    ts, ty = F.col("line_item_usage_start_date"), cur.schema["line_item_usage_start_date"].dataType
    rows = _in_months(cur, months).where(ts >= F.lit(f"{first.replace(day=1)} 00:00:00").cast(ty))
    return rows if final else rows.where(ts < F.lit(f"{end} 00:00:00").cast(ty))


def restatement_months(as_of: dt.date, days: int) -> int:
    """Number of prior calendar months a ``days``-long restated window touches."""
    start = as_of - dt.timedelta(days=days)
    return (as_of.year - start.year) * 12 + (as_of.month - start.month)


def date_slice(cur: DataFrame, start: str, end: str) -> DataFrame:
    """S3: a date-bounded debugging slice of the raw lines (inclusive bounds)."""
    ts = F.col("line_item_usage_start_date")
    ty = cur.schema["line_item_usage_start_date"].dataType     # bounds in the column's own type
    return cur.where(ts.between(F.lit(start).cast(ty), F.lit(end).cast(ty)))
