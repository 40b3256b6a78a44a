"""Golden scalars (FIXTURES.md section 2): each cleaning expression on one-row inputs."""

import pytest
from pyspark.sql import functions as F

from costlake.functions import cleaning as fx


def one(spark, expr, **cols):
    names = list(cols)
    df = spark.createDataFrame([tuple(cols[n] for n in names)], ", ".join(f"{n} string" for n in names))
    return df.select(expr.alias("v")).collect()[0].v


@pytest.mark.parametrize("rid, expected", [
    (None, ""), ("", ""), ("i-0abc1234def", ""), ("arn:aws:ec2:us-west-2:123:instance/i-0abc1234", ""),
    ("arn:aws:rds:us-west-2:1234567890:subservice/foo/bar/baz", "subservice/foo/bar/baz"),
    ("arn:aws:logs:us-east-1:1234567890:log-group:/aws/eks/foobar/cluster", "log-group:/aws/eks/foobar/cluster"),
    ("arn:aws:rds:us-west-2:1234567890:db:foo-bar-baz", "db:foo-bar-baz"),
    ("arn:aws:ecr:us-east-1:1234567890:repository/foo/bar", "repository/foo/bar"),
    ("arn:aws:ecr:us-east-1:1234567890:repository/foo", ""),
    ("arn:aws:ecs:us-east-1:123:cluster/web-1", "cluster/web-1"),
    ("my-bucket", "my-bucket"),
    ("arn:aws:kms:us-east-1:123:key/550e8400-e29b-41d4-a716-446655440000", "key/<UUID>"),
])
def test_resource_name(spark, rid, expected):
    assert one(spark, fx.resource_name(F.col("r")), r=rid) == expected


def test_resource_name_tag_fallback(spark):
    expr = fx.resource_name(F.col("r"), [F.col("t1"), F.col("t2")])
    assert one(spark, expr, r="i-0abc1234def", t1=" ", t2="web-cluster") == "web-cluster"


@pytest.mark.parametrize("raw, expected", [
    ("BoxUsage:c5.xlarge", "c5.xlarge"), ("USW2-SpotUsage:m5.large", "m5.large"), ("EBSOptimized:m4.large", "m4.large"),
    ("USE1-DataTransfer-OUT-Bytes-Internet", "OUT-Bytes-Internet"), ("USE1-DataTransfer-Out-Bytes", "DataTransfer-Out-Bytes"),
    ("USE1-USW2-AWS-In-Bytes", "AWS-In-Bytes"), ("EU-TimedStorage-ByteHrs", "TimedStorage-ByteHrs"),
    ("EUC1-TimedStorage-ByteHrs", "TimedStorage-ByteHrs"), ("us-east-1-KinesisShardHour", "KinesisShardHour"),
    ("USW2-UnusedBox:c5.large", "UnusedBox:c5.large"), ("TimedStorage-ZIA-SmObjects", "TimedStorage-ZIA-SmObjects"),
])
def test_usage_type(spark, raw, expected):
    assert one(spark, fx.usage_type(F.col("u")), u=raw) == expected


@pytest.mark.parametrize("raw, expected", [
    ("CreateCacheCluster:0000:SV000", "CreateCacheCluster"), ("RunInstances:0002", "RunInstances"),
    ("CreateDBInstance:0014:SV001", "CreateDBInstance"), ("LoadBalancing:Application", "LoadBalancing:Application"),
])
def test_operation(spark, raw, expected):
    assert one(spark, fx.operation(F.col("o")), o=raw) == expected


@pytest.mark.parametrize("raw, expected", [
    ("ml.c5.xlarge-Training", "c5.xlarge"), ("cache.m6g.large", "m6g.large"), ("g5.xlarge.search", "g5.xlarge"),
    ("db.r5.large", "r5.large"), ("R5.Large.Search", "r5.large.search"), ("r5.large.elasticsearch", "r5.large.elasticsearch"),
])
def test_instance_spec(spark, raw, expected):
    assert one(spark, fx.instance_spec(F.col("t")), t=raw) == expected


@pytest.mark.parametrize("itype, expected", [("c5.xlarge", "c5"), ("db.r5.large", "db"), ("cache.m6g.large", "cache")])
def test_instance_type_family(spark, itype, expected):
    assert one(spark, fx.instance_type_family(F.col("f"), F.col("t")), f=None, t=itype) == expected


@pytest.mark.parametrize("cleaned, expected", [("UnusedBox:c5.large", "UnusedBox"), ("c5.xlarge", None)])
def test_usage_type_prefix(spark, cleaned, expected):
    assert one(spark, fx.usage_type_prefix(F.col("u")), u=cleaned) == expected


def test_calendar(spark):
    assert one(spark, fx.week_text(F.col("d")), d="2022-01-01") == "2021-12-27"
    assert one(spark, fx.day_of_week(F.col("d")), d="2022-04-18") == "1 (Mon)"
    assert one(spark, fx.day_of_week(F.col("d")), d="2022-04-17") == "0 (Sun)"
    assert one(spark, fx.days_in_month(F.col("y"), F.col("m")), y="2000", m="2") == 29
    assert one(spark, fx.days_in_month(F.col("y"), F.col("m")), y="1900", m="2") == 28
    assert one(spark, fx.days_in_month(F.col("y"), F.col("m")), y="2023", m="4") == 30


@pytest.mark.parametrize("unit, divisor", [("Seconds", 3600.0), ("minutes", 60.0), ("Terabytes", 0.0009765625), ("Hrs", 1.0)])
def test_usage_divisor(spark, unit, divisor):
    assert one(spark, fx.usage_divisor(F.col("u")), u=unit) == divisor


@pytest.mark.parametrize("term, ltype, private, expected", [
    ("OnDemand", "Usage", "0.5", "PrivateRate"), ("OnDemand", "Usage", None, "OnDemand"),
    ("Reserved", "DiscountedUsage", "0", "Reserved"), ("Spot", "Usage", "0", "Spot"),
    ("", "SavingsPlanCoveredUsage", "0", "SavingsPlan"), ("Reserved", "RIFee", "0", "Unknown"),
])
def test_pricing_regime(spark, term, ltype, private, expected):
    expr = fx.pricing_regime(F.col("t"), F.col("l"), F.col("p").cast("decimal(24,10)"))
    assert one(spark, expr, t=term, l=ltype, p=private) == expected


@pytest.mark.parametrize("klass, ut, expected", [
    (None, "TimedStorage-ZIA-SmObjects", "Infrequent Access (Small Objects)"),
    ("Standard", "TimedStorage-ZIA-SmObjects", "Standard"),
    ("X", "TimedStorage-INT-IA-ByteHrs", "Intelligent (Infrequent Access)"),
    ("X", "TimedStorage-INT-AIA-ByteHrs", "Intelligent (Archive Instant Access)"),
    ("X", "TimedStorage-INT-FA-ByteHrs", "Intellegent (Frequent Access)"),
    ("Glacier", "TimedStorage-GlacierByteHrs", "Glacier"),
])
def test_storage_class(spark, klass, ut, expected):
    assert one(spark, fx.storage_class(F.col("c"), F.col("u")), c=klass, u=ut) == expected


@pytest.mark.parametrize("name, vendor, line", [
    ("Intel Xeon Platinum 8124M", "Intel", "Intel Xeon"), ("AWS Graviton2 Processor", "AWS", "AWS Graviton2"),
    ("Variable", "Unknown", "Unknown"), ("", None, None), (None, None, None),
])
def test_processor(spark, name, vendor, line):
    assert one(spark, fx.processor_vendor(F.col("p")), p=name) == vendor
    assert one(spark, fx.processor_line(F.col("p")), p=name) == line
