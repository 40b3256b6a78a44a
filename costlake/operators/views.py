"""Analysis views over the facts.

Sorting is left to the caller (``sort=True`` reproduces the published ``order by``): a
global sort is a range shuffle that most consumers (dashboards, files) do not need.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.functions.measures import dsum, xsum
from costlake.operators.enrich import DAYS_PER_MONTH
from costlake.sources.dims import small_side

# ---------------------------------------------------------------- discount iceberg (V1-V6)

ICEBERG_KEYS = ["date_month", "bill_line", "pricing_bucket", "billing_entity", "line_item_type", "product_code",
                "product_description"]
NEGATIVE_TYPES = ("EdpDiscount", "PrivateRateDiscount", "Credit", "SavingsPlanNegation")
USAGE_TYPES = ("SavingsPlanCoveredUsage", "DiscountedUsage", "Usage")


def discount_iceberg(bill: DataFrame, sort: bool = False) -> DataFrame:
    """Net charges against each discount class per month (V1-V6), with shares.

    Charges are accrual cost; discounts (EDP, private rate, credits, savings-plan negation,
    reserved-instance savings rebuilt from public minus pre-EDP cost) stay negative.
    ``percent_of_type`` divides by the month's total of the same sign class,
    ``percent_of_total`` by the month's total of absolute values.
    """
    lt = F.col("line_item_type")
    # what a reservation saved: public price less the price before EDP (EDP applies after it)
    saved = F.when(lt == "DiscountedUsage", F.col("cost_without_edp") - F.col("public_cost")).when(
        lt == "RiVolumeDiscount", F.col("unblended_cost"))
    # the bill is read once: each group carries its charge row and, if it has one, its part of
    # the reservations' row, which a second, small aggregate puts together
    grouped = bill.where(F.col("billing_entity") == "AWS").groupBy(*ICEBERG_KEYS).agg(
        xsum("accrual_cost").alias("accrual_cost"), xsum("unblended_cost").alias("unblended_cost"),
        xsum(saved).alias("saved"))
    reserved = lt.isin("DiscountedUsage", "RiVolumeDiscount")
    charge = F.struct(F.col("bill_line"), lt.alias("line_item_type"), F.col("accrual_cost"), F.col("unblended_cost"))
    relief = F.struct(F.lit("Reserved Instances").alias("bill_line"), F.lit("RiDiscount").alias("line_item_type"),
                      F.col("accrual_cost"), F.col("saved").alias("unblended_cost"))
    keys = ["date_month", "pricing_bucket", "billing_entity", "product_code", "product_description"]
    both = (grouped.select(*keys, F.explode(F.when(reserved, F.array(charge, relief)).otherwise(F.array(charge))).alias("r"))
            .groupBy(*keys, F.col("r.bill_line").alias("bill_line"), F.col("r.line_item_type").alias("line_item_type"))
            .agg(dsum("r.accrual_cost").alias("accrual_cost"), dsum("r.unblended_cost").alias("unblended_cost")))
    bl = F.col("bill_line")
    iceberg_cost = (F.when(bl == "Reserved Instances", F.col("unblended_cost"))
                    .when(lt.isin(*NEGATIVE_TYPES), F.col("unblended_cost"))
                    .when(lt.isin(*USAGE_TYPES), F.col("accrual_cost"))
                    .when(lt == "Tax", F.col("unblended_cost"))
                    .otherwise(F.lit(0.0)))
    iceberg_line = (F.when(F.col("product_code").like("%Support%"), F.lit("Support"))
                    .when(lt == "Credit", F.lit("Credits"))
                    .when(bl == "Charges", F.lit("Net Charges"))
                    .otherwise(bl))
    calced = both.select(
        # a wall-clock month start (no time zone), as the warehouse's plain timestamp
        F.to_timestamp_ntz(F.concat(F.col("date_month"), F.lit("-01"))).alias("date_month"),
        iceberg_line.alias("iceberg_bill_line"), "product_code", "product_description",
        iceberg_cost.alias("iceberg_cost"))
    final = (calced.withColumn("iceberg_type", F.when(F.col("iceberg_cost") >= 0, F.lit("Net Charges"))
                               .otherwise(F.lit("Discounts")))
             .groupBy("date_month", "iceberg_bill_line", "product_code", "product_description", "iceberg_type")
             .agg(dsum("iceberg_cost").alias("iceberg_cost"))
             .where(F.col("iceberg_cost") != 0))
    # two levels of totals: one row for each calendar month, so the side that is broadcast is bounded by
    # the months of the bill; both readers of ``final`` share its shuffle, so the bill is still read once
    cost = F.col("iceberg_cost")
    of_type = {k: dsum(F.when(F.col("iceberg_type") == k, cost)).alias(k) for k in ("Net Charges", "Discounts")}
    totals = final.groupBy(F.col("date_month").alias("_month")).agg(*of_type.values(), dsum(F.abs(cost)).alias("_whole"))
    type_total = F.when(F.col("iceberg_type") == "Discounts", F.col("Discounts")).otherwise(F.col("Net Charges"))
    out = final.join(F.broadcast(totals), F.col("date_month").eqNullSafe(F.col("_month"))).select(
        "date_month", "iceberg_bill_line", "product_code", "product_description", "iceberg_type", "iceberg_cost",
        F.try_divide(cost, type_total).alias("percent_of_type"),
        F.try_divide(F.abs(cost), F.col("_whole")).alias("percent_of_total"))
    return out.orderBy(F.col("date_month").desc(), F.col("product_code").asc()) if sort else out


# ---------------------------------------------------------------- CPU rate card (V7-V9)

PERCENTILES = (0.25, 0.50, 0.75, 0.95)


RATECARD_KEYS = ["date", "vendor_family", "compute_os", "compute_software", "compute_instance_type_family",
                 "pricing_regime", "compute_processor_vendor"]


def ratecard_rows(fact: DataFrame, as_of: dt.date) -> DataFrame:
    """EC2 compute rows of the last year with the rate-card keys and the unit rate ``_r``."""
    since = as_of.replace(year=as_of.year - 1) if not (as_of.month == 2 and as_of.day == 29) else as_of.replace(year=as_of.year - 1, day=28)
    return (fact.where((F.col("pricing_bucket") == "Compute") & (F.col("product_code") == "AmazonEC2")
                       & (F.col("date") >= since.isoformat()))
            .select("date",
                    F.concat(F.coalesce(F.col("compute_processor_line"), F.lit("Unknown")), F.lit(": "),
                             F.coalesce(F.col("compute_instance_type_family"), F.lit("??"))).alias("vendor_family"),
                    "compute_os", "compute_software", "compute_instance_type_family", "pricing_regime",
                    F.coalesce(F.col("compute_processor_vendor"), F.lit("Unknown")).alias("compute_processor_vendor"),
                    "usage", "cost", (F.col("usage") * F.col("compute_processor_vcpu")).alias("_cpu"),
                    F.try_divide(F.col("cost"), F.col("usage") * F.col("compute_processor_vcpu")).alias("_r")))


def cpu_ratecard(fact: DataFrame, as_of: dt.date, approx_accuracy: int | None = None, sort: bool = False) -> DataFrame:
    """Per-vCPU-hour rates of EC2 compute over the last year, with percentiles of the unit rate.

    Percentiles are exact at every size, with linear interpolation: rates are first counted
    per group and value (partial sums before the shuffle), then a running count over the
    sorted values, which spills, picks the ranks. ``approx_accuracy`` asks for
    ``percentile_approx``, a bounded sketch, instead.
    """
    rows = ratecard_rows(fact, as_of)
    levels = list(PERCENTILES)
    if approx_accuracy is not None:
        g = rows.groupBy(*RATECARD_KEYS).agg(
            dsum("usage").alias("instance_hours"), dsum("cost").alias("cost"), dsum("_cpu").alias("cpu_hours"),
            F.percentile_approx("_r", levels, approx_accuracy).alias("_pct"))
        pct = [F.col("_pct")[i].cast("double") for i in range(len(levels))]
    else:
        values = rows.groupBy(*RATECARD_KEYS, "_r").agg(xsum("usage").alias("usage"), xsum("cost").alias("cost"),
                                                        xsum("_cpu").alias("_cpu"), F.count("_r").alias("_c"))
        group = Window.partitionBy(*RATECARD_KEYS)
        upto = group.orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = values.withColumns({"_upto": F.sum("_c").over(upto), "_n": F.sum("_c").over(group)})

        def at(rank):       # the value that holds a rank, counted from 0
            return F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank), F.col("_r")))

        picks = []
        for i, p in enumerate(levels):
            place = (F.col("_n") - 1) * F.lit(p)
            picks += [at(F.floor(place)).alias(f"_lo{i}"), at(F.ceil(place)).alias(f"_hi{i}")]
        g = ranked.groupBy(*RATECARD_KEYS).agg(
            dsum("usage").alias("instance_hours"), dsum("cost").alias("cost"), dsum("_cpu").alias("cpu_hours"),
            F.max("_n").alias("_n"), *picks)
        pct = []
        for i, p in enumerate(levels):
            place, lo, hi = (F.col("_n") - 1) * F.lit(p), F.col(f"_lo{i}"), F.col(f"_hi{i}")
            pct.append(F.when(lo == hi, lo).otherwise((F.ceil(place) - place) * lo + (place - F.floor(place)) * hi))
    rate = F.try_divide(F.col("cost"), F.col("cpu_hours"))
    out = g.select(
        *RATECARD_KEYS, "instance_hours", "cost", "cpu_hours",
        rate.alias("rate"), (rate * 100).alias("rate_cents"),
        *[(x * 100).alias(f"rate_cents_p{int(p * 100)}") for x, p in zip(pct, PERCENTILES)],
    )
    return out.orderBy(F.col("date").desc()) if sort else out


# ---------------------------------------------------------------- buying efficiency

def months_back_text(as_of: dt.date, months: int) -> str:
    y, m = as_of.year, as_of.month - months
    while m <= 0:
        m += 12
        y -= 1
    return f"{y:04d}-{m:02d}"


def buying_efficiency(fact: DataFrame, options, as_of: dt.date, sort: bool = False) -> DataFrame:
    """On-demand spend of the last three months on things that can be bought cheaper.

    ``options`` is keyed (product, bucket); a ``Dim`` is broadcast by its checked size. A list-typed
    ``buy_options`` is shown joined by ``, ``.
    """
    opts = small_side(options)
    if isinstance(opts.schema["buy_options"].dataType, T.ArrayType):
        opts = opts.withColumn("buy_options", F.array_join("buy_options", ", "))
    # date text compared with month text: everything from the first day of that month on
    rows = fact.where((F.col("date") >= months_back_text(as_of, 3)) & (F.col("pricing_regime") == "OnDemand"))
    out = (rows.join(opts, ["product_code", "pricing_bucket"])
           .groupBy("date_month", "product_code", "pricing_regime", "pricing_bucket", "pricing_unit", "buy_options")
           .agg(dsum("cost").alias("_cost"))
           # the warehouse rounds double -> int, Spark truncates: round first (half-even, as rint)
           .select("date_month", "product_code", "pricing_regime", "pricing_bucket", "pricing_unit", "buy_options",
                   F.rint("_cost").cast("int").alias("cost")))
    return out.orderBy(F.col("cost").desc()) if sort else out


# ---------------------------------------------------------------- week-over-week movers

MOVER_DIMS = ["product_code", "operation", "pricing_bucket"]
EPSILON = 0.00001


#: Days back in which the latest date is looked for, days of late data before the pivot, and days compared.
PIVOT_DAYS, LATE_DAYS, COMPARED_DAYS = 10, 3, 91


def _grid(fact: DataFrame, as_of: dt.date, dims: list[str]) -> DataFrame:
    """Sums for each date and ``dims``, over all days that any pivot can compare."""
    since = (as_of - dt.timedelta(days=PIVOT_DAYS + LATE_DAYS + COMPARED_DAYS)).isoformat()
    return fact.where(F.col("date") >= since).groupBy("date", *dims).agg(
        dsum("cost").alias("cost"), dsum("usage").alias("usage"))


def _pivot(grid: DataFrame, as_of: dt.date) -> DataFrame:
    """One row, one column: latest date with data in the last 10 days, minus 3 days (late data).

    A maximum over the grid's whole rows, with the ten days inside it: neither a pruned column nor
    a pushed filter makes this grid unlike the one that is compared, so both share one shuffle.
    """
    recent = F.when(F.col("date") >= (as_of - dt.timedelta(days=PIVOT_DAYS)).isoformat(), F.col("date"))
    latest = F.max(F.struct(recent.alias("day"), *[c for c in grid.columns if c != "date"]))
    return grid.agg(F.date_sub(F.to_date(latest["day"]), LATE_DAYS).alias("pivot"))


def wow_cost_movers(fact: DataFrame, as_of: dt.date, fixed: bool = False, dims: list[str] | None = None,
                    sort: bool = False) -> DataFrame:
    """Average daily cost of the current week against 3/6/9/12 weeks back.

    ``fixed=False`` reproduces the published arithmetic: days after the pivot count in week
    0 (integer division truncates toward zero) and averages include every week row of
    the group as zero. ``fixed=True`` stops at the pivot and averages only the weeks in
    range, with the epsilon for empty ranges.
    """
    dims = dims or MOVER_DIMS
    grid = _grid(fact, as_of, dims)
    # the pivot is a scalar subquery: computed once, inlined as a value (no join at all)
    x = grid.withColumn("pivot", _pivot(grid, as_of).scalar())
    seen = F.col("date") >= F.date_sub("pivot", COMPARED_DAYS).cast("string")
    if fixed:
        seen = seen & (F.col("date") <= F.col("pivot").cast("string"))
    # a sum is never null here; naming it keeps the filter above the grid that both readers share
    x = x.where(F.when(F.col("cost").isNotNull(), seen).otherwise(False))
    x = x.withColumn("weeks_back", F.expr("datediff(pivot, to_date(date)) div 7"))
    per_week = x.groupBy(F.col("pivot").cast("string").alias("current_week"), "weeks_back", *dims).agg(
        (dsum("cost") / 7).alias("avg_cost_daily"))
    wb = F.col("weeks_back")
    other = F.lit(None).cast("double") if fixed else F.lit(0.0)

    def wavg(cond):
        x = F.when(cond, F.col("avg_cost_daily")).otherwise(other)
        return F.try_divide(dsum(x), F.count(x).cast("double"))

    cons = per_week.groupBy("current_week", *dims).agg(
        wavg(wb == 0).alias("current_avg_cost"),
        wavg(wb.between(1, 3)).alias("avg_last_3"),
        wavg(wb.between(1, 6)).alias("avg_last_6"),
        wavg(wb.between(1, 9)).alias("avg_last_9"),
        wavg(wb.between(1, 12)).alias("avg_last_12"),
    )
    avgs = ["current_avg_cost", "avg_last_3", "avg_last_6", "avg_last_9", "avg_last_12"]
    cons = cons.select("current_week", *dims, *[F.coalesce(F.col(a), F.lit(EPSILON)).alias(a) for a in avgs])
    cur = F.col("current_avg_cost")
    cols = [F.abs(cur - F.col("avg_last_3")).alias("delta_3_abs"), "current_week", *dims,
            cur.alias("current_avg_cost"), (cur * F.lit(DAYS_PER_MONTH)).alias("current_cost_mrr")]
    for n in (3, 6, 9, 12):
        a = F.col(f"avg_last_{n}")
        cols += [(cur - a).alias(f"delta_{n}"), a.alias(f"avg_last_{n}"),
                 F.try_divide(cur - a, a).alias(f"delta_{n}_percent")]
    out = cons.select(*cols)
    return out.orderBy(F.col("delta_3_abs").desc()) if sort else out
