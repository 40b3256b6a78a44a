"""Fact tables (L1-L5): the daily accrual fact and the monthly cash bill.

Dates are ISO text, so windows are plain string comparisons on the partition column of
the written table (``date`` / ``date_month``) and prune whole directories on read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlake.functions.measures import xsum

USAGE_LINE_TYPES = ("SavingsPlanCoveredUsage", "DiscountedUsage", "Usage")
RESTATE_DAYS = 65
#: Days that the hour fact goes back, to the first day of the month it then is in.
HOUR_DAYS = 400

BILL_DIMS = [
    "date_month", "line_item_type", "bill_line", "account_id", "account_name", "billing_entity", "legal_entity",
    "invoice_id", "product_name", "product_code", "location", "product_description", "pricing_bucket",
    "pricing_unit", "pricing_regime",
]
CHARGE_TYPES = ("Usage", "SavingsPlanCoveredUsage", "SavingsPlanRecurringFee", "SavingsPlanUpfrontFee", "RIFee",
                "Refund", "DiscountedUsage", "Fee")


def years_back(as_of: dt.date, years: int) -> dt.date:
    try:
        return as_of.replace(year=as_of.year - years)
    except ValueError:          # 29 February
        return as_of.replace(year=as_of.year - years, day=28)


def full_load_start(as_of: dt.date) -> str:
    return years_back(as_of, 2).isoformat()


def restate_start(as_of: dt.date, days: int = RESTATE_DAYS) -> str:
    return (as_of - dt.timedelta(days=days)).isoformat()


def usage_fact(stage01: DataFrame, since: str) -> DataFrame:
    """L1/L2: billed usage rows with positive usage and accrual cost, dated ``since`` or later."""
    return stage01.where(
        (F.col("date") >= since)
        & F.col("line_item_type").isin(*USAGE_LINE_TYPES)
        & (F.col("usage") > 0)
        & (F.col("cost") > 0)
    )


def usage_daily(stage01: DataFrame, as_of: dt.date) -> DataFrame:
    return usage_fact(stage01, full_load_start(as_of))


def usage_incremental(stage01: DataFrame, as_of: dt.date, days: int = RESTATE_DAYS) -> DataFrame:
    return usage_fact(stage01, restate_start(as_of, days))


def hour_start(as_of: dt.date, days: int = HOUR_DAYS) -> str:
    """First day of the hour fact's window: a whole month's first."""
    return (as_of - dt.timedelta(days=days)).replace(day=1).isoformat()


def usage_hourly(stage01_hours: DataFrame, since: str) -> DataFrame:
    """The hour fact: usage lines by hour, dated ``since`` or later.

    Lines of usage or cost 0 and below stay: the daily fact's rule is on a day's sums.
    """
    return stage01_hours.where((F.col("date") >= since) & F.col("line_item_type").isin(*USAGE_LINE_TYPES))


def bill(stage01: DataFrame, since_month: str) -> DataFrame:
    """Monthly bill over all line types, months ``since_month`` or later.

    Money is summed exactly; partial aggregation combines map-side, so a hot group never
    travels whole to one task.
    """
    lt = F.col("line_item_type")
    bill_line = (F.when(lt.isin(*CHARGE_TYPES), F.lit("Charges"))
                 .when(lt == "SavingsPlanNegation", F.lit("Savings Plan"))
                 .when(lt == "Credit", F.lit("Credits"))
                 .otherwise(lt))
    rows = stage01.where(F.col("date_month") >= since_month).select(
        F.col("date_month"), lt.alias("line_item_type"), bill_line.alias("bill_line"), F.col("account_id"),
        F.concat(F.col("account_name"), F.lit(" ("), F.col("account_id"), F.lit(")")).alias("account_name"),
        F.col("billing_entity"), F.col("legal_entity"), F.col("invoice_id"),
        F.col("bill_product_name").alias("product_name"), F.col("bill_product_code").alias("product_code"),
        F.col("location"), F.col("product_description"),
        # the source product code, not the bill's (non-charge lines have no unit, hence no bucket)
        F.when(F.col("pricing_bucket") == "Unknown", F.col("product_code")).otherwise(F.col("pricing_bucket")).alias("pricing_bucket"),
        F.col("pricing_unit"), F.col("pricing_regime"),
        F.col("date"), F.col("cost"), F.col("usage"), F.col("unblended_cost"), F.col("net_unblended_cost"),
        F.col("cost_without_edp"), F.col("public_cost"),
    )
    measures = ["cost", "usage", "unblended_cost", "net_unblended_cost", "cost_without_edp", "public_cost"]
    # One hash aggregate, one shuffle. date_month is a key, so the distinct days of a group
    # are the bits of one integer.
    day = F.dayofmonth(F.to_date("date"))
    monthly = rows.groupBy(*BILL_DIMS).agg(
        *[xsum(m).alias(m) for m in measures],
        F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), day))).cast("int").alias("days_in_month"),
    )
    d = lambda m: F.col(m).cast("double")
    return monthly.select(*BILL_DIMS, d("cost").alias("accrual_cost"), d("usage").alias("usage"),
                          d("unblended_cost").alias("unblended_cost"), d("cost_without_edp").alias("cost_without_edp"),
                          "days_in_month", d("public_cost").alias("public_cost"),
                          (F.col("public_cost") - F.col("unblended_cost")).cast("double").alias("total_savings"),
                          d("net_unblended_cost").alias("net_unblended_cost"))


def bill_full(stage01: DataFrame, as_of: dt.date) -> DataFrame:
    return bill(stage01, years_back(as_of, 2).strftime("%Y-%m"))


def bill_restate_month(as_of: dt.date, days: int = RESTATE_DAYS) -> str:
    return (as_of - dt.timedelta(days=days)).strftime("%Y-%m")


def bill_incremental(stage01: DataFrame, as_of: dt.date, days: int = RESTATE_DAYS) -> DataFrame:
    return bill(stage01, bill_restate_month(as_of, days))
