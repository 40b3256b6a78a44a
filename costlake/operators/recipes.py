"""Analysis recipes (G1-G17): the cost questions asked of the facts.

Every recipe first aggregates to a small grain (day x bucket, month x service, ...) with
map-side partial aggregation, then does its window, join or top-k on that small result.
Windows are partitioned by a dimension and ordered by day, so a partition holds at most
one row per day of its key however large the raw data is.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from costlake.functions.cleaning import iso_date, iso_month, nonblank
from costlake.functions.measures import davg, dsum, exact, xsum
from costlake.sources.dims import small_side


def _days_before(as_of: dt.date, days: int) -> str:
    return (as_of - dt.timedelta(days=days)).isoformat()


# ---------------------------------------------------------------- G1

def bucket_spend(fact: DataFrame, as_of: dt.date, bucket: str = "Compute", days: int = 35) -> DataFrame:
    return (fact.where((F.col("date") >= _days_before(as_of, days)) & (F.col("pricing_bucket") == bucket))
            .groupBy("date", "product_code").agg(dsum("cost").alias("cost")))


# ---------------------------------------------------------------- G2-G4

def _storage_deltas(fact: DataFrame, as_of: dt.date, days: int = 95) -> DataFrame:
    daily = (fact.where((F.col("date") >= _days_before(as_of, days)) & (F.col("pricing_bucket") == "Storage")
                        & (F.col("product_code") == "AmazonS3"))
             .groupBy("date", F.col("resource_name").alias("s3_bucket"))
             .agg(dsum("storage_total_tb").alias("tb"), dsum("cost").alias("cost")))
    w = Window.partitionBy("s3_bucket").orderBy("date")
    prev_date = F.lag("date").over(w)
    prev_tb = F.lag("tb").over(w)
    return (daily.select("date", "s3_bucket", "tb", "cost", prev_date.alias("prev_date"), prev_tb.alias("prev_tb"))
            # a delta exists only against the calendar day before (the self-join's condition)
            .where(F.datediff(F.to_date("date"), F.to_date("prev_date")) == 1)
            .select("date", "s3_bucket", "tb", "cost", (F.col("tb") - F.col("prev_tb")).alias("delta_tb"),
                    F.try_divide(F.col("tb") - F.col("prev_tb"), F.col("prev_tb")).alias("percent_delta")))


def _storage_summary(deltas: DataFrame) -> DataFrame:
    g = deltas.groupBy("s3_bucket").agg(
        davg("delta_tb").alias("avg_delta"),
        davg("percent_delta").alias("avg_percent"),
        F.max_by("tb", "date").alias("total_tb"),
        F.max_by("cost", "date").alias("cost"),
        # rounded far below any size: a merged moment's last bits depend on the task order
        F.round(F.stddev_samp("delta_tb"), 12).alias("stddev_delta"),
        F.percentile("delta_tb", 0.5).alias("median_delta"),
    )
    return g.select("s3_bucket", "avg_delta", "avg_percent", "total_tb", "cost", "stddev_delta", "median_delta")


def storage_growth(fact: DataFrame, as_of: dt.date, top: int = 50) -> DataFrame:
    """Buckets with the largest persistent growth (top-k is the feature)."""
    s = _storage_summary(_storage_deltas(fact, as_of))
    return s.orderBy(F.col("avg_delta").desc(), F.col("s3_bucket").asc()).limit(top)


def storage_idle(fact: DataFrame, as_of: dt.date, max_growth: float = 0.0) -> DataFrame:
    """The flipped question: buckets not growing, largest cost first."""
    s = _storage_summary(_storage_deltas(fact, as_of))
    return s.where(F.col("avg_delta") <= max_growth).orderBy(F.col("cost").desc(), F.col("s3_bucket").asc())


# ---------------------------------------------------------------- G5-G7 tag mapping

def env_mapping(fact: DataFrame, env_map, tag: str = "tag_env") -> DataFrame:
    """Tag frequency with the curated clean value (``Unknown`` when unmapped)."""
    freq = fact.groupBy(F.col(tag)).agg(F.count(F.lit(1)).alias("row_count"), dsum("cost").alias("cost"))
    m = small_side(env_map).select(F.col("tag_env").alias("_raw"), F.col("environment"))
    return (freq.join(m, freq[tag] == F.col("_raw"), "left")
            .select(F.col(tag), F.coalesce(F.col("environment"), F.lit("Unknown")).alias("environment"),
                    "row_count", "cost"))


def system_mapping(fact: DataFrame, system_map) -> DataFrame:
    """Synthetic ``system`` tag: the mapped system, else the service itself."""
    per = fact.groupBy("date_month", "tag_service").agg(dsum("cost").alias("cost"))
    m = small_side(system_map).select(F.col("tag_service").alias("_svc"), "tag_system")
    return (per.join(m, per["tag_service"] == F.col("_svc"), "left")
            .select("date_month", F.col("tag_service").alias("service"),
                    F.coalesce(F.col("tag_system"), F.col("tag_service")).alias("system"), "cost"))


#: Rules for service tags: the lowest number that applies wins. ``owner``: 'null', 'set' or 'any'; a null bound is open.
RULE_SCHEMA = "number long, service string, owner string, from_date string, to_date string, new_service string"


def rule_bins(rules: DataFrame, since: str, until: str) -> DataFrame:
    """Rules by the months they touch within ``since`` .. ``until``: (bin, service, owner, number, new_service, from_date, to_date).

    Of the rules that cover all of a month for the same service and owner condition only the
    lowest can win, so the others are dropped there; a bin's size does not grow with them.
    """
    lo = F.greatest(F.coalesce("from_date", F.lit(since)), F.lit(since))
    hi = F.least(F.coalesce("to_date", F.lit(until)), F.lit(until))
    clipped = rules.select("number", "service", "owner", "new_service", lo.alias("from_date"), hi.alias("to_date")).where("from_date <= to_date")
    first = F.explode(F.sequence(F.trunc(F.to_date("from_date"), "MM"), F.to_date("to_date"), F.expr("INTERVAL 1 MONTH"))).alias("first")
    bins = clipped.select("*", first).withColumn("bin", iso_month(F.col("first")))
    whole = (F.col("from_date") <= F.greatest(F.col("first").cast("string"), F.lit(since))) & (
        F.col("to_date") >= F.least(F.last_day("first").cast("string"), F.lit(until)))
    bins = bins.withColumn("part", F.when(~whole, F.struct("number", "new_service", "from_date", "to_date")))
    kept = F.min_by(F.struct("number", "new_service", "from_date", "to_date"), F.struct("number", "new_service"))
    return bins.groupBy("bin", "service", "owner", "part").agg(kept.alias("r")).select("bin", "service", "owner", "r.*")


def tag_patch(fact: DataFrame, rules: DataFrame, since: str, until: str) -> DataFrame:
    """Cost by day and service, the service renamed by date-bounded rules (RULE_SCHEMA).

    An interval join: the fact is first summed by day, service and whether it has an owner; rules
    are expanded to the months they touch and meet it by (service, month), so the join is an
    equi-join, and the lowest rule number that applies names the service. Days outside
    ``since`` .. ``until`` keep their service.
    """
    keys = fact.groupBy("date", "tag_service", F.col("tag_owner").isNull().alias("no_owner")).agg(
        xsum("cost").alias("cost"), F.count(F.lit(1)).alias("row_count")).withColumn("month", F.substring("date", 1, 7))
    bins = rule_bins(rules, since, until)
    applies = ((F.col("tag_service") == F.col("service")) & (F.col("month") == F.col("bin")) & F.col("date").between(F.col("from_date"), F.col("to_date"))
               & ((F.col("owner") == "any") | (F.col("owner") == F.when(F.col("no_owner"), "null").otherwise("set"))))
    named = (keys.join(bins, applies, "left").groupBy("date", "tag_service", "no_owner", "cost", "row_count")
             .agg(F.min_by("new_service", F.struct("number", "new_service")).alias("new_service")))
    return (named.groupBy("date", F.coalesce("new_service", "tag_service").alias("tag_service"))
            .agg(F.sum("cost").cast("double").alias("cost"), F.sum("row_count").alias("row_count")))


def rules_from_orders(orders: DataFrame) -> DataFrame:
    """Test rules, one an order: its customer's service is renamed for some weeks from the order's day on (a few rules never end)."""
    k, service = F.col("o_orderkey"), F.concat(F.lit("svc"), (F.col("o_custkey") % 10).cast("string"))
    day = F.to_date("o_orderdate")
    return orders.select(
        k.cast("long").alias("number"), service.alias("service"), F.element_at(F.array(F.lit("null"), F.lit("set"), F.lit("any")), (k % 3 + 1).cast("int")).alias("owner"),
        day.cast("string").alias("from_date"), F.when(k % 9973 != 0, F.date_add(day, (k % 45).cast("int")).cast("string")).alias("to_date"),
        F.concat(service, F.lit("-v"), (k % 7).cast("string")).alias("new_service"))


# ---------------------------------------------------------------- G8-G10

def invoice_summary(bill: DataFrame) -> DataFrame:
    return bill.groupBy("date_month", "invoice_id", "product_code", "bill_line").agg(
        dsum("unblended_cost").alias("cash_cost"),
        dsum("net_unblended_cost").alias("cash_cost_with_discounts"),
        dsum("accrual_cost").alias("accrual_cost"))


def tag_coverage(fact: DataFrame, tag: str = "tag_env") -> DataFrame:
    """Share of cost carrying a non-blank tag, per month and account."""
    g = fact.groupBy("date_month", "account_id").agg(
        dsum(F.when(nonblank(F.col(tag)).isNotNull(), F.col("cost")).otherwise(F.lit(0.0))).alias("tagged_cost"),
        dsum("cost").alias("total_cost"))
    return g.withColumn("coverage", F.try_divide(F.col("tagged_cost"), F.col("total_cost")))


def work_log_from_orders(orders: DataFrame) -> DataFrame:
    """A transaction log per (date, service): each order is one transaction of a service."""
    return (orders.groupBy(iso_date(F.col("o_orderdate")).alias("date"),
                           F.concat(F.lit("svc"), (F.col("o_custkey") % 10).cast("string")).alias("service"))
            .agg(F.count(F.lit(1)).alias("transactions")))


def unit_cost(fact: DataFrame, work_log: DataFrame) -> DataFrame:
    """Cost per transaction: daily service cost beside the work log; cost without transactions stays, with a null ratio."""
    cost = fact.groupBy("date", F.col("tag_service").alias("service")).agg(dsum("cost").alias("cost"))
    return (cost.join(work_log, ["date", "service"], "left")
            .select("date", "service", "cost", "transactions",
                    F.try_divide(F.col("cost"), F.col("transactions").cast("double")).alias("cost_per_transaction")))


# ---------------------------------------------------------------- G11, G13 (hourly grain)

def _compute_hours(hours: DataFrame, since: str | None) -> DataFrame:
    rows = hours.where(F.col("pricing_bucket") == "Compute")
    return rows if since is None else rows.where(F.col("date") >= since)


def hourly_usage(hours: DataFrame, since: str | None = None) -> DataFrame:
    """Instance-hours and vCPU-hours of compute per hour and product, from stage 01 by hours or the hour fact (days ``since`` or later, if given)."""
    return (_compute_hours(hours, since)
            .groupBy("hour", "product_code")
            .agg(dsum("usage").alias("instance_hours"),
                 dsum(F.col("usage") * F.col("compute_processor_vcpu")).alias("cpu_hours"),
                 dsum("cost").alias("cost")))


def hour_spine(spark: SparkSession, since: str | Column, until: dt.date) -> DataFrame:
    """(date, hour) of every hour of the days ``since`` .. ``until``: 24 rows a day, made by Spark."""
    first = F.lit(since).cast("date")
    days = F.explode(F.when(first <= F.lit(until), F.sequence(first, F.lit(until)))).alias("day")
    return (spark.range(1).select(days).select(F.col("day").cast("string").alias("date"), F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
            .select("date", F.concat("date", F.lit(" "), F.lpad(F.col("h").cast("string"), 2, "0")).alias("hour")))


def base_load(hours: DataFrame, as_of: dt.date, since: str | None = None) -> DataFrame:
    """Savings-plan base load: per month, the mean over days of the cheapest compute hour, from stage 01 by hours or the hour fact.

    Every hour from ``since`` (else the first month that has any) to ``as_of`` counts, by a
    calendar spine: an hour without compute rows costs 0. Months without any are left out.
    """
    hourly = _compute_hours(hours, since).groupBy("date", "hour").agg(dsum("cost").alias("cost"))
    if since is None:
        since = F.trunc(hourly.where(F.col("date").isNotNull()).select(F.min(F.struct("date", "cost")).getField("date")).scalar().cast("date"), "MM")
    filled = hour_spine(hours.sparkSession, since, as_of).join(hourly, ["date", "hour"], "left")
    cost = F.coalesce("cost", F.lit(0.0))
    daily = filled.groupBy("date").agg(F.min(cost).alias("low_hour"), F.max(cost).alias("peak_hour"), F.count("cost").alias("busy"))
    return (daily.groupBy(F.substring("date", 1, 7).alias("date_month"))
            .agg(davg("low_hour").alias("base_load_hourly_cost"), davg("peak_hour").alias("avg_peak_hourly_cost"),
                 F.count(F.lit(1)).alias("days"), F.sum("busy").alias("busy"))
            .where("busy > 0").drop("busy"))


# ---------------------------------------------------------------- G12, G14

def cost_ma7(fact: DataFrame) -> DataFrame:
    """7-calendar-day moving average of daily cost per pricing bucket (missing days are 0)."""
    daily = fact.groupBy("pricing_bucket", "date").agg(dsum("cost").alias("cost"))
    day_no = F.datediff(F.to_date("date"), F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("pricing_bucket").orderBy(day_no).rangeBetween(-6, 0)
    return daily.select("pricing_bucket", "date", "cost", (F.sum(exact("cost")).over(w).cast("double") / 7).alias("cost_ma7"))


def growth_alerts(fact: DataFrame, as_of: dt.date, window_days: int = 14, inflection: float = 0.5) -> DataFrame:
    """Storage growth detectors per storage class: rate inflects up, or growth stops.

    Mean day-over-day TB delta of the last ``window_days`` against the window before it.
    """
    since = _days_before(as_of, 2 * window_days)
    mid = _days_before(as_of, window_days)
    daily = (fact.where((F.col("pricing_bucket") == "Storage") & (F.col("date") > since))
             .groupBy(F.coalesce(F.col("storage_class"), F.lit("(none)")).alias("storage_class"), "date")
             .agg(dsum("storage_total_tb").alias("tb")))
    w = Window.partitionBy("storage_class").orderBy("date")
    d = (daily.select("storage_class", "date", "tb", F.lag("date").over(w).alias("pd"), F.lag("tb").over(w).alias("ptb"))
         .where(F.datediff(F.to_date("date"), F.to_date("pd")) == 1)
         .select("storage_class", "date", (F.col("tb") - F.col("ptb")).alias("delta_tb")))
    g = d.groupBy("storage_class").agg(
        davg(F.when(F.col("date") > mid, F.col("delta_tb"))).alias("recent_delta"),
        davg(F.when(F.col("date") <= mid, F.col("delta_tb"))).alias("prior_delta"))
    r, p = F.col("recent_delta"), F.col("prior_delta")
    alert = (F.when((p > 0) & (r <= 0), F.lit("growth_stopped"))
             .when((r > 0) & (p > 0) & (r > p * (1 + inflection)), F.lit("inflection_up"))
             .when((r > 0) & (p <= 0), F.lit("growth_started")))
    return g.select("storage_class", "recent_delta", "prior_delta", alert.alias("alert"))


# ---------------------------------------------------------------- G15, G16 projections

def _month_add(col, n: int):
    return iso_month(F.add_months(F.to_date(F.concat(col, F.lit("-01"))), n))


def driver_units_from_orders(orders: DataFrame) -> DataFrame:
    """Monthly driver units from the order log: orders, and distinct customers."""
    m = iso_month(F.col("o_orderdate")).alias("date_month")
    return (orders.groupBy(m).agg(F.count(F.lit(1)).cast("double").alias("orders"),
                                  F.countDistinct("o_custkey").cast("double").alias("customers"))
            .select("date_month", F.stack(F.lit(2), F.lit("orders"), "orders", F.lit("customers"), "customers")
                    .alias("driver", "units")))


def driver_projection(fact: DataFrame, driver_map, units: DataFrame, as_of: dt.date,
                      history_months: int = 6, horizon: int = 6) -> DataFrame:
    """Cost per driver unit over the last months x forecast units of the coming months.

    The forecast of month m is the units of month m-12 (seasonal naive), read from the
    same unit log.
    """
    first_hist = F.lit(as_of.strftime("%Y-%m"))
    cost = (fact.join(small_side(driver_map), "tag_service")
            .groupBy("driver", "date_month").agg(dsum("cost").alias("cost")))
    hist = (cost.join(units, ["driver", "date_month"])
            .where((F.col("date_month") < first_hist) & (F.col("date_month") >= _month_add(first_hist, -history_months)))
            .groupBy("driver").agg(F.try_divide(dsum("cost"), dsum("units")).alias("cost_per_unit")))
    months = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("k")
    fut = (hist.select("driver", "cost_per_unit", months)
           .select("driver", "cost_per_unit", _month_add(first_hist, 0).alias("base"), "k")
           .select("driver", "cost_per_unit", iso_month(F.add_months(F.to_date(F.concat("base", F.lit("-01"))), F.col("k") - 1)).alias("date_month"),
                   iso_month(F.add_months(F.to_date(F.concat("base", F.lit("-01"))), F.col("k") - 13)).alias("src_month")))
    u = units.select("driver", F.col("date_month").alias("src_month"), F.col("units").alias("forecast_units"))
    return (fut.join(u, ["driver", "src_month"], "left")
            .select("driver", "date_month", "forecast_units", "cost_per_unit",
                    (F.col("cost_per_unit") * F.col("forecast_units")).alias("projected_cost")))


def _compound(growth, n):
    """(1 + growth)^n as n ordered multiplications (reproducible, unlike a library pow); 1 for n = 0."""
    return F.when(n == 0, F.lit(1.0)).otherwise(
        F.aggregate(F.sequence(F.lit(1), n), F.lit(1.0), lambda acc, _: acc * (F.lit(1.0) + growth)))


def growth_projection(fact: DataFrame, as_of: dt.date, lookback: int = 6, horizon: int = 12) -> DataFrame:
    """Compounding projection per pricing bucket, plus a back-test one year earlier.

    Growth g is the mean monthly growth over ``lookback`` months before the base month;
    cost(base + n) = cost(base) * (1 + g)^n for n = 0 .. horizon-1. The back-test starts ``horizon`` months earlier
    and carries the actual cost of each projected month. The months of a bucket travel as
    one small map, so the fact is read once. A bucket without an anchor month stays, with
    null growth and null projections.
    """
    monthly = fact.groupBy("pricing_bucket", "date_month").agg(dsum("cost").alias("cost"))
    months = monthly.groupBy("pricing_bucket").agg(
        F.map_from_entries(F.collect_list(F.struct("date_month", "cost"))).alias("by_month"))
    base = (as_of.replace(day=1) - dt.timedelta(days=1)).strftime("%Y-%m")     # last complete month
    kinds = [("forecast", 0), ("backtest", -horizon)]

    def at(month_shift):
        return F.try_element_at("by_month", _month_add(F.lit(base), month_shift))

    starts = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), _month_add(F.lit(base), shift).alias("base_month"),
                 at(shift).alias("base_cost"), at(shift - lookback).alias("old_cost"))
        for kind, shift in kinds])).alias("s")
    g = (months.select("pricing_bucket", "by_month", starts)
         .select("pricing_bucket", "by_month", "s.*")
         .select("kind", "pricing_bucket", "by_month", "base_month", "base_cost",
                 (F.try_divide(F.col("base_cost") - F.col("old_cost"), F.col("old_cost")) / lookback).alias("growth")))
    # n = 0 .. horizon-1: the base month itself, then the months after it
    proj = (g.select("*", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("n"))
            .select("kind", "pricing_bucket", "by_month", "base_month", "growth", "n",
                    iso_month(F.add_months(F.to_date(F.concat("base_month", F.lit("-01"))), F.col("n"))).alias("date_month"),
                    (F.col("base_cost") * _compound(F.col("growth"), F.col("n"))).alias("projected_cost")))
    return proj.withColumn("actual_cost", F.try_element_at("by_month", F.col("date_month"))).drop("by_month")


# ---------------------------------------------------------------- G17

def reconcile(cur: DataFrame, bill: DataFrame, since_month: str, tolerance: float = 0.01) -> DataFrame:
    """Tie the bill to all raw lines per month: totals, difference, and what C1 dropped, in lines and dollars.

    ``source_total`` sums every raw line; the difference and the tolerance are against it, so
    dollars that the cleaning drops show. One aggregate over the raw lines gives it all.
    """
    lt = F.col("line_item_line_item_type")
    rate = F.col("pricing_public_on_demand_rate")
    free = (lt == "Usage") & (rate == "0.0000000000")
    billable = ~free                         # null (Usage with a null rate) is dropped too
    src = (cur.groupBy(iso_month(F.col("line_item_usage_start_date")).alias("date_month"))
           .agg(F.sum(F.when(billable, F.col("line_item_unblended_cost"))).cast("double").alias("source_unblended"),
                F.sum("line_item_unblended_cost").cast("double").alias("source_total"),
                F.sum(F.when(free, F.col("line_item_unblended_cost"))).cast("double").alias("dropped_free_cost"),
                F.sum(F.when((lt == "Usage") & rate.isNull(), F.col("line_item_unblended_cost"))).cast("double").alias("dropped_null_rate_cost"),
                F.count(F.when(billable, F.lit(1))).alias("source_lines"),
                F.count(F.when(free, F.lit(1))).alias("dropped_free_lines"),
                F.count(F.when((lt == "Usage") & rate.isNull(), F.lit(1))).alias("dropped_null_rate_lines")))
    b = bill.groupBy("date_month").agg(dsum("unblended_cost").alias("bill_unblended"))
    j = src.join(b, "date_month", "full_outer").where(F.col("date_month") >= since_month)
    diff = F.coalesce(F.col("bill_unblended"), F.lit(0.0)) - F.coalesce(F.col("source_total"), F.lit(0.0))
    pct = F.try_divide(F.abs(diff), F.abs(F.col("source_total")))
    return j.select("date_month", "source_total", "source_unblended", "bill_unblended", "dropped_free_cost",
                    "dropped_null_rate_cost", diff.alias("diff"), pct.alias("pct_diff"),
                    (F.coalesce(pct, F.lit(1.0)) <= tolerance).alias("within_tolerance"),
                    "source_lines", "dropped_free_lines", "dropped_null_rate_lines")


def reconcile_daily(cur: DataFrame, fact: DataFrame, since: str, tolerance: float = 0.01) -> DataFrame:
    """Tie the daily fact to the raw lines per day, in unblended dollars.

    The fact holds usage lines with positive usage and cost; ``other_cost`` is what the day's
    raw lines of other types cost (fees, tax, credits), ``diff`` the fact less the raw usage
    lines, dropped ones included.
    """
    lt = F.col("line_item_line_item_type")
    used = lt.isin("SavingsPlanCoveredUsage", "DiscountedUsage", "Usage")
    cost = F.col("line_item_unblended_cost")
    src = (cur.groupBy(iso_date(F.col("line_item_usage_start_date")).alias("date"))
           .agg(F.sum(F.when(used, cost)).cast("double").alias("source_usage_cost"),
                F.sum(F.when(~used, cost)).cast("double").alias("other_cost"),
                F.count(F.when(used, F.lit(1))).alias("source_usage_lines")))
    kept = fact.groupBy("date").agg(dsum("unblended_cost").alias("fact_unblended"), F.sum("record_cnt").alias("fact_lines"))
    j = src.join(kept, "date", "full_outer").where(F.col("date") >= since)
    diff = F.coalesce(F.col("fact_unblended"), F.lit(0.0)) - F.coalesce(F.col("source_usage_cost"), F.lit(0.0))
    pct = F.try_divide(F.abs(diff), F.abs(F.col("source_usage_cost")))
    return j.select("date", "source_usage_cost", "other_cost", "fact_unblended", diff.alias("diff"),
                    (F.coalesce(pct, F.lit(1.0)) <= tolerance).alias("within_tolerance"), "source_usage_lines", "fact_lines")


def reconcile_invoices(bill: DataFrame, invoices: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Tie the bill to the invoices by invoice and product, in cash (unblended) dollars.

    A full outer join of the two sums; ``status`` says what a row is: ``ok`` and ``off`` by the
    tolerance against the invoice, ``missing_invoice`` (billed, no invoice has it),
    ``missing_bill`` (invoiced, the bill lacks it), ``open`` (billed, not invoiced yet: no
    invoice number). Several lines of an invoice for one product are summed.
    """
    billed = bill.groupBy("invoice_id", "product_code").agg(dsum("unblended_cost").alias("bill_amount"))
    sent = invoices.groupBy(F.col("invoice_id").alias("_i"), F.col("product_code").alias("_p")).agg(dsum("amount").alias("invoice_amount"))
    same = F.col("invoice_id").eqNullSafe(F.col("_i")) & F.col("product_code").eqNullSafe(F.col("_p"))
    j = billed.join(sent, same, "full_outer")
    b, i = F.col("bill_amount"), F.col("invoice_amount")
    diff = F.coalesce(b, F.lit(0.0)) - F.coalesce(i, F.lit(0.0))
    pct = F.try_divide(F.abs(diff), F.abs(i))
    status = (F.when(i.isNull() & F.col("invoice_id").isNull(), "open").when(i.isNull(), "missing_invoice").when(b.isNull(), "missing_bill")
              .when((diff == 0) | (F.coalesce(pct, F.lit(1.0)) <= tolerance), "ok").otherwise("off"))
    return j.select(F.coalesce("invoice_id", "_i").alias("invoice_id"), F.coalesce("product_code", "_p").alias("product_code"),
                    i, b, diff.alias("diff"), pct.alias("pct_diff"), status.alias("status"))


def invoices_from_bill(bill: DataFrame) -> DataFrame:
    """Test invoices: the bill's sums, of which some are missing, 5 % or half a per cent off, or have a product that was never billed (by the first hex digit of an md5)."""
    sums = bill.where(F.col("invoice_id").isNotNull()).groupBy("invoice_id", "product_code").agg(dsum("unblended_cost").alias("amount"))
    mark = F.substring(F.md5(F.concat("invoice_id", F.coalesce("product_code", F.lit("")))), 1, 1)
    factor = F.when(mark == "1", 1.05).when(mark == "2", 1.005).otherwise(1.0)
    own = F.struct(F.col("product_code"), (F.col("amount") * factor).alias("amount"))
    extra = F.struct(F.concat(F.lit("unbilled-"), F.col("product_code")).alias("product_code"), (F.col("amount") / 2).alias("amount"))
    lines = F.when(mark == "0", F.array()).when(mark == "3", F.array(own, extra)).otherwise(F.array(own))
    return sums.select("invoice_id", F.explode(lines).alias("x")).select("invoice_id", "x.*")
