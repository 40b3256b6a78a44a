"""Week-over-week movers: the flat dollar a day (FIXTURES.md section 2), and arms that the adapter's lines do not reach."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from costlake.functions import cleaning as fx
from costlake.operators import facts, views

AS_OF = dt.date(2001, 11, 4)
PIVOT = dt.date(2001, 11, 1)


def flat(spark, last):
    days = [(PIVOT - dt.timedelta(days=91 - i)).isoformat() for i in range(91 + last + 1)]
    return spark.createDataFrame([(d, "AmazonEC2", "Run", "Compute", 1.0, 1.0, 2.0) for d in days], "date string, product_code string, operation string, pricing_bucket string, cost double, cost_mrr double, usage double")


def test_flat_dollar(spark):
    r = views.wow_cost_movers(flat(spark, 3), AS_OF).collect()
    assert len(r) == 1 and r[0]["current_week"] == "2001-11-01"
    r = r[0]
    # week 0 holds ten days (the pivot, six before, three after); 14 week rows share every average
    assert abs(r["current_avg_cost"] - 10 / 7 / 14) < 1e-9 and round(r["current_avg_cost"], 5) == 0.10204
    assert round(r["avg_last_3"], 5) == 0.21429 and round(r["delta_3_percent"], 3) == -0.524
    assert abs(r["delta_3_abs"] - abs(r["delta_3"])) < 1e-9 and abs(r["current_cost_mrr"] - r["current_avg_cost"] * 30.4375) < 1e-9
    for n in (6, 9, 12):
        assert abs(r[f"avg_last_{n}"] - n / 14) < 1e-9 and abs(r[f"delta_{n}_percent"] - (r["current_avg_cost"] / (n / 14) - 1)) < 1e-9


def test_flat_dollar_fixed(spark):
    r = views.wow_cost_movers(flat(spark, 3), AS_OF, fixed=True).first()
    assert r["current_avg_cost"] == 1.0 and r["avg_last_12"] == 1.0 and r["delta_3_percent"] == 0.0


def test_group_without_current_week_and_no_recent_data(spark):
    old = flat(spark, 3).where(F.col("date") <= "2001-09-01").withColumn("operation", F.lit("Old"))
    got = {r["operation"]: r for r in views.wow_cost_movers(flat(spark, 3).unionByName(old), AS_OF, fixed=True).collect()}
    assert got["Old"]["current_avg_cost"] == views.EPSILON and got["Old"]["avg_last_3"] == views.EPSILON and got["Old"]["avg_last_12"] == pytest.approx(1, rel=0.3)
    assert views.wow_cost_movers(flat(spark, 3).where(F.col("date") < "2001-10-20"), AS_OF).count() == 0


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in cols))
    return df.select(expr.cast("string").alias("v")).first().v


@pytest.mark.parametrize("values, expected", [(("b", "d", "g", "l"), "b"), (("", "d", "g", "l"), "d"), ((None, " ", "g", "l"), "g"), ((None, "", " ", "l"), "l"), ((None, "", None, ""), None)])
def test_description_arms(spark, values, expected):
    expr = fx.first_nonblank(*[F.col(c) for c in "bdgl"])
    assert one(spark, expr, **dict(zip("bdgl", values))) == expected


@pytest.mark.parametrize("family, bundle, expected", [("Compute Optimized", "X", "compute optimized"), ("", "Power Bundle", "power bundle"), (None, "Power", "power"), (" ", "", None), (None, None, None)])
def test_instance_family_arms(spark, family, bundle, expected):
    assert one(spark, fx.instance_family(F.col("f"), F.col("b")), f=family, b=bundle) == expected


@pytest.mark.parametrize("product, line, expected", [("us-east-1a", "us-east-1b", "us-east-1a"), ("NA", "us-east-1b", "us-east-1b"), ("", "us-east-1b", "us-east-1b"), (None, "", "")])
def test_availability_zone_arms(spark, product, line, expected):
    assert one(spark, fx.availability_zone(F.col("p"), F.col("l")), p=product, l=line) == expected


@pytest.mark.parametrize("kind, accrued, without", [("Usage", 5, 6), ("DiscountedUsage", 2, 20), ("SavingsPlanCoveredUsage", 3, 30), ("Tax", 0, 0), (None, 0, 0)])
def test_cost_arms(spark, kind, accrued, without):
    m = lambda c: F.col(c).cast(fx.MONEY)
    cols = {"t": kind, "n": "5", "e": "1", "rn": "2", "sn": "3", "r": "20", "s": "30"}
    assert float(one(spark, fx.accrual_cost(F.col("t"), m("n"), m("rn"), m("sn")), **cols)) == accrued
    assert float(one(spark, fx.cost_without_edp(F.col("t"), m("n"), m("e"), m("r"), m("s")), **cols)) == without


def test_cost_without_edp_is_null_with_a_null_discount(spark):
    m = lambda c: F.col(c).cast(fx.MONEY)
    assert one(spark, fx.cost_without_edp(F.col("t"), m("n"), m("e"), m("n"), m("n")), t="Usage", n="5", e=None) is None


def bill_of(spark, rows):
    cols = "date_month string, bill_line string, pricing_bucket string, billing_entity string, line_item_type string, product_code string, product_description string, accrual_cost double, unblended_cost double, cost_without_edp double, public_cost double"
    return spark.createDataFrame([("2001-10", line, "Compute", "AWS", kind, product, "d", *money) for line, kind, product, *money in rows], cols)


def test_iceberg_arms(spark):
    bill = bill_of(spark, [
        ("Charges", "Usage", "AmazonEC2", 70.0, 1.0, 0.0, 0.0), ("PrivateRateDiscount", "PrivateRateDiscount", "AmazonEC2", 0.0, -10.0, 0.0, 0.0),
        ("EdpDiscount", "EdpDiscount", "AmazonEC2", 0.0, -5.0, 0.0, 0.0), ("Credits", "Credit", "AmazonS3", 0.0, -2.0, 0.0, 0.0),
        ("Tax", "Tax", "AmazonEC2", 0.0, 3.0, 0.0, 0.0), ("Charges", "Fee", "AWSSupportEnterprise", 9.0, 9.0, 0.0, 0.0),
        ("Charges", "DiscountedUsage", "AmazonRDS", 27.0, 0.0, 30.0, 50.0), ("RiVolumeDiscount", "RiVolumeDiscount", "AmazonRDS", 0.0, -4.0, 0.0, 0.0)])
    got = {(r["iceberg_bill_line"], r["product_code"]): (r["iceberg_type"], r["iceberg_cost"], r["percent_of_type"], r["percent_of_total"]) for r in views.discount_iceberg(bill).collect()}
    above, below = 70.0 + 3.0 + 27.0, 10.0 + 5.0 + 2.0 + 24.0
    want = {("Net Charges", "AmazonEC2"): 70.0, ("PrivateRateDiscount", "AmazonEC2"): -10.0, ("EdpDiscount", "AmazonEC2"): -5.0, ("Credits", "AmazonS3"): -2.0,
            ("Tax", "AmazonEC2"): 3.0, ("Net Charges", "AmazonRDS"): 27.0, ("Reserved Instances", "AmazonRDS"): -24.0}
    assert {k: v[1] for k, v in got.items()} == want               # a fee is no usage: no iceberg cost, no row
    for k, (kind, cost, of_type, of_all) in got.items():
        assert kind == ("Discounts" if cost < 0 else "Net Charges")
        assert of_type == pytest.approx(cost / (-below if cost < 0 else above)) and of_all == pytest.approx(abs(cost) / (above + below))


@pytest.mark.parametrize("kind, line", [("Refund", "Charges"), ("SavingsPlanRecurringFee", "Charges"), ("SavingsPlanUpfrontFee", "Charges"), ("SavingsPlanNegation", "Savings Plan"), ("Credit", "Credits"), ("Tax", "Tax")])
def test_bill_lines(spark, kind, line):
    from conftest import SF_SMALL
    from costlake.plans.pipeline import fixture_pipeline

    s01 = fixture_pipeline(spark, SF_SMALL).stage01().limit(1).withColumns({"line_item_type": F.lit(kind), "date": F.lit("2001-10-03"), "date_month": F.lit("2001-10")})
    assert [r["bill_line"] for r in facts.bill(s01, "2001-01").collect()] == [line]
