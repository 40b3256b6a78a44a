"""Stage 01 golden values (FIXTURES.md section 2) on edited copies of a real stage-00 row."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators.enrich import enrich
from costlake.plans.pipeline import fixture_pipeline


@pytest.fixture(scope="module")
def base(spark):
    p = fixture_pipeline(spark, SF_SMALL)
    return p, p.stage00().where(F.col("pricing_unit") == "GB-Month").limit(1).cache()


def enriched(p, row_df, **values):
    df = row_df
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v).cast(dict(row_df.dtypes)[k]))
    return enrich(df, p.dims).collect()[0]


def test_storage_smoothing(base):
    p, row = base
    r = enriched(p, row, cost=30.4375, days_in_month=28, usage=10.0)
    assert r.cost == 28.0 and r.cost_mrr == 852.25
    assert r.rate == 30.4375 / 11.0            # the rate uses the raw, unsmoothed cost
    assert r.storage_total_gb == 280.0 and r.storage_total_tb == 280.0 / 1024


def test_compute_software_labels(base):
    p, row = base
    compute = dict(pricing_unit="Hour", compute_os=None)
    assert enriched(p, row, compute_software="SQL Std", **compute).compute_software == "Linux: SQL Std"
    assert enriched(p, row, compute_software="NA", **compute).compute_software == "Linux"
    assert enriched(p, row, compute_software=None, pricing_unit="GB-Month", compute_os=None).compute_os is None


def test_account_names(base):
    p, row = base
    known = enriched(p, row, account_id="100000000001")
    assert (known.account_name, known.account_display_name) == ("Example Corp", "Staging (100000000001)")
    unknown = enriched(p, row, account_id="999")
    assert (unknown.account_name, unknown.account_display_name) == ("Unknown", "Unknown (999)")


def test_bill_product_moves_for_data_transfer_discount(base):
    p, row = base
    r = enriched(p, row, product_code="AmazonEC2", line_item_type="EdpDiscount",
                 usage_type="DataTransfer-Out-Bytes", product_family=None)
    assert (r.bill_product_code, r.bill_product_name) == ("AWSDataTransfer", "AWS Data Transfer")
    r = enriched(p, row, product_code="AmazonS3", line_item_type="EdpDiscount",
                 usage_type="DataTransfer-Out-Bytes", product_family=None)
    assert r.bill_product_code == "AmazonS3"


def test_spec_join_replaces_processor_fields(base):
    p, row = base
    r = enriched(p, row, compute_instance_spec="r5.large", compute_processor_name="something else")
    assert (r.compute_class, r.compute_processor_name, r.compute_processor_vcpu) == ("r5", "Intel Xeon Platinum 8175", 2)
    r = enriched(p, row, compute_instance_spec="no.such.type", compute_processor_name="kept?")
    assert r.compute_processor_name is None           # strictly replaced, no fallback
