"""Bill against invoices: every side's leftovers are shown."""

from costlake.operators import recipes


def test_statuses(spark):
    bill = spark.createDataFrame([
        ("I1", "ec2", 60.0), ("I1", "ec2", 40.0), ("I1", "s3", 10.0), ("I2", "ec2", 5.0), (None, "ec2", 3.0), ("I2", "zero", 0.0), ("I3", None, 7.0), ("I4", "credit", -100.0)],
        "invoice_id string, product_code string, unblended_cost double")
    invoices = spark.createDataFrame([
        ("I1", "ec2", 99.5), ("I1", "s3", 8.0), ("I1", "s3", 1.0), ("I2", "support", 20.0), ("I2", "zero", 0.0), ("I3", None, 7.0), ("I4", "credit", -100.5), ("I9", "ec2", 1.0)],
        "invoice_id string, product_code string, amount double")
    got = {(r["invoice_id"], r["product_code"]): (r["status"], r["diff"]) for r in recipes.reconcile_invoices(bill, invoices).collect()}
    assert got == {("I1", "ec2"): ("ok", 0.5), ("I1", "s3"): ("off", 1.0), ("I2", "ec2"): ("missing_invoice", 5.0), (None, "ec2"): ("open", 3.0),
                   ("I2", "support"): ("missing_bill", -20.0), ("I2", "zero"): ("ok", 0.0), ("I3", None): ("ok", 0.0), ("I4", "credit"): ("ok", 0.5), ("I9", "ec2"): ("missing_bill", -1.0)}


def test_empty_sides(spark):
    bill = spark.createDataFrame([("I1", "ec2", 2.0)], "invoice_id string, product_code string, unblended_cost double")
    none = spark.createDataFrame([], "invoice_id string, product_code string, amount decimal(24,10)")
    assert [r["status"] for r in recipes.reconcile_invoices(bill, none).collect()] == ["missing_invoice"]
    assert recipes.reconcile_invoices(bill.limit(0), none).count() == 0
