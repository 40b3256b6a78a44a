"""One row per arm of the ordered pricing-unit rules, plus order checks."""

import pytest

from costlake.functions import cleaning as fx
from costlake.functions import units
from pyspark.sql import functions as F

COLS = ["unit", "product", "family", "grp", "op", "ltype", "gdesc", "rtype"]


def unit_of(spark, **kw):
    row = tuple(kw.get(c) for c in COLS)
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in COLS))
    e = fx.pricing_unit(*[F.col(c) for c in COLS])
    return df.select(e.alias("v")).collect()[0].v


ARMS = [
    (dict(unit="Hrs", gdesc="Billed by the month", rtype="Software"), "Software-Month"),
    (dict(unit="Hrs", gdesc="Billed by the month", rtype="Hardware"), "Hardware-Month"),
    (dict(unit="Months", op="GetLicense"), "Software-Month"),
    (dict(unit="User", family="User Pool MAU"), "User-Month"),
    (dict(unit="GB", product="AmazonCloudWatch"), "GB-Processed"),
    (dict(unit="Lambda-GB-Second"), "GB-Second"),
    (dict(unit="Fargate-GB-Hours"), "GB-Hour"),
    (dict(unit="Terabytes"), "GB-Processed"),
    (dict(unit="GB", product="AmazonS3", family="Data Transfer"), "GB-IO"),
    (dict(unit="GB", product="AmazonEC2", family="NAT Gateway"), "GB-Network"),
    (dict(unit="GigaBytes"), "GB-Network"),
    (dict(unit="Month", grp="User"), "User-Month"),
    (dict(unit="Faces-Mo"), "Face-Month"),
    (dict(unit="Tag-Mo"), "Tag-Month"),
    (dict(unit="Mo", product="AmazonRoute53"), "DNS-Month"),
    (dict(unit="Security Checks"), "SecurityCheck-Month"),
    (dict(unit="vCPU-Months"), "CPU-Month"),
    (dict(unit="User-Mo"), "User-Month"),
    (dict(unit="Objects", product="AmazonS3"), "Object-Month"),
    (dict(unit="Dollar", ltype="Fee", product="AWSSupportBusiness"), "Support-Month"),
    (dict(unit="GB-month"), "GB-Month"),
    (dict(unit="ShardHour"), "Hour"),
    (dict(unit="Dashboards", op="DashboardHour"), "Hour"),
    (dict(unit="Seconds"), "Hour"),
    (dict(unit="API Requests"), "Request"),
    (dict(unit="USE1-AmazonApiGateway-Request"), "Request"),
    (dict(unit="USW2-Foo"), "Foo"),
    (dict(unit="EU-Bar"), "Bar"),
    (dict(unit="Keys"), "Keys"),
    (dict(unit=None), None),
]


@pytest.mark.parametrize("kw, expected", ARMS)
def test_arm(spark, kw, expected):
    assert unit_of(spark, **kw) == expected


def test_order_io_before_network(spark):
    # S3 data transfer matches both the IO and the network arm; the earlier arm wins
    assert unit_of(spark, unit="GB", product="AmazonS3", family="Data Transfer") == "GB-IO"


def test_order_ingest_before_io(spark):
    assert unit_of(spark, unit="GB", product="AmazonDynamoDB", family="Data Transfer") == "GB-Processed"


def test_fee_needs_support_product(spark):
    assert unit_of(spark, unit="Dollar", ltype="Fee", product="AmazonEC2") == "Dollar"


def lines_of(spark, kws):
    return spark.createDataFrame([tuple(kw.get(c) for c in COLS) for kw in kws], ", ".join(f"{units.FIELDS[f]} string" for f in FIELD_OF.values()))


FIELD_OF = {"unit": "unit", "product": "product", "family": "family", "grp": "group", "op": "operation", "ltype": "line_type", "gdesc": "group_description", "rtype": "resource_type"}


def test_rule_table_names_units_as_the_expression_does(spark):
    """Every arm, and every pair of arms put together, by the dictionary and by the compiled rules."""
    kws = [kw for kw, _ in ARMS] + [{**a, **b} for a, _ in ARMS for b, _ in ARMS]
    lines = lines_of(spark, kws)
    rules = spark.createDataFrame(units.rule_rows(), units.RULE_SCHEMA)
    named = units.look_up(lines, units.dictionary(lines, rules))
    case = units.case_of({f: F.col(c) for f, c in units.FIELDS.items()})
    assert named.count() == len(kws)
    assert named.where(~F.col("clean_unit").eqNullSafe(case)).count() == 0
    plan = units.dictionary(lines, rules)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_site_s_own_rules(spark):
    lines = lines_of(spark, [dict(unit="Hrs", product="X"), dict(unit="Hrs", product="Y"), dict(unit="Widget-Request"), dict(unit="US-Foo"), dict(unit=None, family="F"), dict(unit="")])
    own = {f: None for f in [*units.FIELDS, *units.LIKE]}
    row = lambda n, result, **kw: (n, result, *{**own, **kw}.values())
    rules = spark.createDataFrame([row(5, "H", unit="Hrs"), row(2, "XH", unit="Hrs", product="X"), row(9, "R", unit_like="%Request"), row(1, "fam", family="F"), row(2, "XI", unit="Hrs", product="X")], units.RULE_SCHEMA)
    got = {(r["pricing_unit"], r["line_item_product_code"]): r["clean_unit"] for r in units.dictionary(lines, rules).collect()}
    assert got == {("Hrs", "X"): "XH", ("Hrs", "Y"): "H", ("Widget-Request", None): "R", ("US-Foo", None): "Foo", (None, None): "fam", ("", None): ""}
    assert units.dictionary(lines.limit(0), rules).count() == 0
    assert {r["clean_unit"] for r in units.dictionary(lines, rules.limit(0)).collect()} == {"Hrs", "Widget-Request", "Foo", None, ""}
