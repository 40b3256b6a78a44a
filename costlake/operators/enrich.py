"""Stage 01: join the dimensions and derive measures (E1-E13). No aggregation.

Four left equi-joins against small dimensions, each broadcast behind the row count checked
at load, so stage 01 adds no shuffle to stage 00. The whole stage is ONE ``select``:
several outputs reuse a source name (``cost``, ``product_family``, ``compute_os``) and
every expression must read the *source* column (``rate`` uses the unsmoothed cost).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlake.functions import cleaning as fx
from costlake.sources.dims import Dim, Dims, spec_attributes

DAYS_PER_MONTH = 30.4375   # 365.25 / 12
DATA_TRANSFER_PRODUCTS = ("AWSELB", "AmazonEC2", "AmazonApiGateway", "AmazonECR")

STAGE01_COLUMNS = [
    "year", "month", "date_month", "day_of_week", "etl_version", "account_id", "account_name",
    "account_display_name", "billing_entity", "legal_entity", "invoice_id", "resource_name", "line_item_type",
    "usage_type", "usage_type_prefix", "region_code", "location", "operation", "currency_code", "pricing_bucket",
    "product_code", "product_name", "bill_product_code", "bill_product_name", "product_family", "product_group",
    "product_servicecode", "pricing_unit", "pricing_regime", "product_description", "savings_plan_arn",
    "reserved_instance_arn", "compute_instance_spec", "compute_instance_type", "compute_instance_family",
    "compute_instance_type_family", "compute_availability_zone", "compute_capacity_status", "compute_class",
    "compute_processor_name", "compute_processor_vendor", "compute_processor_line", "compute_processor_vcpu",
    "compute_storage", "compute_os", "compute_software", "storage_class", "storage_volume_type",
    "storage_volume_api", "storage_user_volume", "days_in_month",
]
STAGE01_MEASURES = [
    "record_cnt", "usage", "cost", "cost_mrr", "unblended_cost", "cost_without_edp", "edp_discount",
    "total_discount", "private_rate_discount", "public_cost", "rate", "public_rate", "storage_total_gb",
    "storage_total_tb",
]


@functools.lru_cache(maxsize=64)
def _stage01_columns(tags: tuple[str, ...]) -> tuple[Column, ...]:
    """The single select of stage 01 over the joined frame (unresolved, reusable)."""
    s = lambda n: F.col(f"a.{n}")  # noqa: E731  source column of stage 00
    bucket = F.col("c_bucket")
    product_name = F.coalesce(F.col("e_name"), s("product_name"))
    moved = s("product_code").isin(*DATA_TRANSFER_PRODUCTS) & (
        (s("product_family") == "Data Transfer")
        | ((s("line_item_type") == "EdpDiscount") & s("usage_type").like("%DataTransfer-%-Bytes%"))
    )
    os_fixed = F.when((bucket == "Compute") & fx.is_blank(s("compute_os")), F.lit("Linux")).otherwise(s("compute_os"))
    gb_month = s("pricing_unit") == "GB-Month"
    smoothed = F.when(gb_month, s("cost") / F.lit(DAYS_PER_MONTH) * s("days_in_month")).otherwise(s("cost"))

    derived = {
        "account_name": F.coalesce(F.col("b_name"), F.lit("Unknown")),
        "account_display_name": F.concat(F.coalesce(F.col("b_nick"), F.lit("Unknown")), F.lit(" ("), s("account_id"), F.lit(")")),
        "usage_type_prefix": fx.usage_type_prefix(s("usage_type")),
        "pricing_bucket": F.coalesce(bucket, F.lit("Unknown")),
        "product_name": product_name,
        "bill_product_code": F.when(moved, F.lit("AWSDataTransfer")).otherwise(s("product_code")),
        "bill_product_name": F.when(moved, F.lit("AWS Data Transfer")).otherwise(product_name),
        "product_family": F.when(fx.is_blank(s("product_family")), F.coalesce(bucket, F.lit("Unknown"))).otherwise(s("product_family")),
        "compute_class": F.col("d_class"),
        "compute_processor_name": F.col("d_pname"),
        "compute_processor_vendor": F.col("d_vendor"),
        "compute_processor_line": F.col("d_line"),
        "compute_processor_vcpu": F.col("d_vcpu"),
        "compute_os": os_fixed,
        "compute_software": F.when(s("compute_software").isin("NA", "") | s("compute_software").isNull(), os_fixed)
                             .otherwise(F.concat(os_fixed, F.lit(": "), s("compute_software"))),
        "cost": smoothed,
        "cost_mrr": smoothed * F.lit(DAYS_PER_MONTH),
        "private_rate_discount": s("private_rate_discount").cast("double"),
        "rate": F.try_divide(s("cost"), s("usage") + F.lit(1.0)),
        "public_rate": F.try_divide(s("public_cost"), s("usage") + F.lit(1.0)),
        "storage_total_gb": F.when(gb_month, s("usage") * s("days_in_month")).otherwise(F.lit(0.0)),
        "storage_total_tb": F.when(gb_month, s("usage") * s("days_in_month") / F.lit(1024.0)).otherwise(F.lit(0.0)),
    }
    cols = [derived[n].alias(n) if n in derived else s(n).alias(n) for n in STAGE01_COLUMNS]
    cols.append(s("date_week").alias("date_week"))
    cols += [s(t).alias(t) for t in tags]
    cols += [derived[n].alias(n) if n in derived else s(n).alias(n) for n in STAGE01_MEASURES]
    cols.append(s("net_unblended_cost").alias("net_unblended_cost"))
    cols.append(s("date").alias("date"))
    return tuple(cols)


def enrich(stage00: DataFrame, dims: Dims, tags: list[str] | tuple[str, ...] = ()) -> DataFrame:
    a = stage00.alias("a")
    b = dims.accounts.joinable().select(F.col("account_id").alias("b_id"), F.col("account_name").alias("b_name"),
                                        F.col("account_nick").alias("b_nick"))
    cb = dims.buckets.joinable().select(F.col("pricing_unit").alias("c_unit"), F.col("pricing_bucket").alias("c_bucket"))
    attrs = dims.spec_attrs or Dim(spec_attributes(dims.specs.df), dims.specs.rows)
    d = attrs.joinable().select(F.col("instance_spec").alias("d_spec"), F.col("compute_class").alias("d_class"),
                    F.col("processor_name").alias("d_pname"), F.col("processor_vendor").alias("d_vendor"),
                    F.col("processor_line").alias("d_line"), F.col("processor_vcpu").alias("d_vcpu"))
    e = dims.products.joinable().select(F.col("product_code").alias("e_code"), F.col("product_name").alias("e_name"))

    x = (a.join(b, F.col("a.account_id") == F.col("b_id"), "left")
          .join(cb, F.col("a.pricing_unit") == F.col("c_unit"), "left")
          .join(d, F.col("a.compute_instance_spec") == F.col("d_spec"), "left")
          .join(e, F.col("a.product_code") == F.col("e_code"), "left"))

    return x.select(*_stage01_columns(tuple(tags)))

