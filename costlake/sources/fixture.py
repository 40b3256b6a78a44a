"""Test adapter: derive raw cost-and-usage (CUR) lines from the TPC-H ``lineitem`` table.

The test tables hold no billing data, so every lineitem row becomes one CUR line. A
template id ``tid = (l_orderkey*7 + l_linenumber + l_suppkey) % 32`` picks the kind of
line (product, unit, line type, ...); the money columns come from price, quantity and
discount. The 32 templates are a fixed 32-row table joined by broadcast, so the work of
the adapter is one narrow pass over lineitem and grows with it.

Money follows the CUR contract: ``decimal(24,10)``. Every constant is a narrow decimal
and each column is cast to the wide type only after its last multiplication, so no
product passes 38 digits (Spark would silently cut the scale).
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.sources.local import local_table

MONEY = "decimal(24,10)"
AS_OF = dt.date(2001, 11, 4)   # last day with lineitem data
N_TEMPLATES = 32

TEMPLATE_COLUMNS = [
    "tid", "line_type", "product_code", "pricing_unit", "usage_type", "operation",
    "product_name", "product_family", "product_group", "servicecode",
    "instance_type", "instance_family", "instance_type_family", "processor",
    "os", "software", "storage_class", "region", "location", "pricing_term",
    "r_prefix", "r_mod", "r_suffix", "description", "unit_factor",
]

_EC2 = "Amazon Elastic Compute Cloud"
_USE1 = ("us-east-1", "US East (N. Virginia)")
_USW2 = ("us-west-2", "US West (Oregon)")
_EUC1 = ("eu-central-1", "EU (Frankfurt)")
_INST = "i-0abc12"   # + a number: always 6+ hex digits, so it reads as an instance id

# fmt: off
TEMPLATES = [
    # tid type  product  unit  usage_type  operation  name  family  group  servicecode
    # itype  ifamily  itype_family  processor  os  software  storage_class  region  location  term
    # r_prefix  r_mod  r_suffix  description  unit_factor
    (0, "Usage", "AmazonEC2", "Hrs", "BoxUsage:c5.xlarge", "RunInstances:0002", _EC2, "Compute Instance", None, "AmazonEC2",
     "c5.xlarge", "Compute optimized", "c5", "Intel Xeon Platinum 8124M", "Linux", "NA", None, *_USE1, "OnDemand",
     _INST, 997, "", "c5.xlarge Linux on demand", 1),
    (1, "Usage", "AmazonEC2", "Hours", "USW2-SpotUsage:m5.large", "RunInstances:SV001", _EC2, "Compute Instance", None, "AmazonEC2",
     "m5.large", "General purpose", "m5", "Intel Xeon Platinum 8175", "Linux", "NA", None, *_USW2, "Spot",
     "arn:aws:ec2:us-west-2:123456789012:instance/i-0def34", 997, "", "m5.large spot", 1),
    (2, "DiscountedUsage", "AmazonEC2", "Hrs", "BoxUsage:r6g.large", "RunInstances", _EC2, "Compute Instance", None, "AmazonEC2",
     "r6g.large", "Memory optimized", None, "AWS Graviton2 Processor", "Linux", "SQL Std", None, *_USE1, "Reserved",
     _INST, 997, "", "r6g.large reserved", 1),
    (3, "SavingsPlanCoveredUsage", "AmazonEC2", "Hrs", "BoxUsage:m6g.large", "RunInstances:0002", _EC2, "Compute Instance", None, "AmazonEC2",
     "m6g.large", "General purpose", "m6g", "AWS Graviton2 Processor", "", None, None, *_USE1, "OnDemand",
     "vol-0def45", 997, "", "m6g.large savings plan", 1),
    (4, "DiscountedUsage", "AmazonRDS", "Hrs", "InstanceUsage:db.r5.large", "CreateDBInstance:0014:SV001", "Amazon RDS Service", "Database Instance", None, "AmazonRDS",
     "db.r5.large", "Memory optimized", None, "Intel Xeon Platinum 8175", None, None, None, *_USE1, "Reserved",
     "arn:aws:rds:us-east-1:123456789012:db:orders-db-", 3, "", "db.r5.large reserved", 1),
    (5, "Usage", "AmazonES", "Hrs", "ESInstance:r5.search", "ESDomain", "Amazon Elasticsearch Service", "Elastic Search Instance", None, "AmazonES",
     "r5.large.search", "Memory optimized", None, "Intel Xeon Platinum 8175", None, None, None, *_USE1, "OnDemand",
     "arn:aws:es:us-east-1:123456789012:domain/search-", 2, "", "r5.large.search on demand", 1),
    (6, "Usage", "AmazonSageMaker", "second", "ml.c5.xlarge-Training", "Training", "Amazon SageMaker", "ML Instance", None, "AmazonSageMaker",
     "ml.c5.xlarge-Training", "Compute optimized", None, "Intel Xeon Platinum 8124M", None, None, None, *_USE1, "OnDemand",
     "arn:aws:sagemaker:us-east-1:123456789012:training-job/550e8400-e29b-41d4-a716-44665544000", 10, "", "training seconds", 3600),
    (7, "Usage", "AmazonEC2", "Hrs", "BoxUsage:c5.large", "RunInstances:0002", _EC2, "Compute Instance", None, "AmazonEC2",
     "c5.large", "Compute optimized", "c5", "Intel Xeon Platinum 8124M", "Windows", "SQL Ent", None, *_USE1, "OnDemand",
     _INST, 997, "", "c5.large private rate", 1),
    (8, "Usage", "AmazonEC2", "minutes", "EBSOptimized:m4.large", "RunInstances:0002", _EC2, "Compute Instance", None, "AmazonEC2",
     "m4.large", "General purpose", "m4", "Intel Xeon E5-2676 v3 (Haswell)", "Linux", "NA", None, *_USW2, "",
     _INST, 997, "", "m4.large minutes", 60),
    (9, "Usage", "AmazonS3", "GB-Mo", "EU-TimedStorage-ByteHrs", "PutObject", "Amazon Simple Storage Service", "Storage", None, "AmazonS3",
     None, None, None, None, None, None, "General Purpose", *_EUC1, "OnDemand",
     "my-bucket-", 4, "", "standard storage", 1),
    (10, "Usage", "AmazonS3", "GB-Mo", "TimedStorage-ZIA-SmObjects", "PutObject", "Amazon Simple Storage Service", "Storage", None, "AmazonS3",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "archive-bucket", None, "", "small objects", 1),
    (11, "Usage", "AmazonS3", "GB-Mo", "TimedStorage-INT-FA-ByteHrs", "PutObject", "Amazon Simple Storage Service", "Storage", None, "AmazonS3",
     None, None, None, None, None, None, "Intelligent-Tiering", *_USE1, "OnDemand",
     "logs-bucket", None, "", "intelligent tiering", 1),
    (12, "Usage", "AmazonS3", "GB", "USE1-DataTransfer-Out-Bytes", "GetObject", "Amazon Simple Storage Service", "Data Transfer", None, "AmazonS3",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "my-bucket-", 4, "", "s3 transfer out", 1),
    (13, "Usage", "AmazonEC2", "GB", "USE1-USW2-AWS-In-Bytes", "InterZone-In", _EC2, "Data Transfer", None, "AmazonEC2",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:ecs:us-east-1:123456789012:cluster/web-", 2, "", "inter region in", 1),
    (14, "EdpDiscount", "AmazonEC2", None, "USE1-DataTransfer-Out-Bytes", None, _EC2, None, None, None,
     None, None, None, None, None, None, None, *_USE1, None,
     "", None, "", "edp discount", 1),
    (15, "Usage", "AmazonAthena", "Terabytes", "DataScannedInTB", "RunQuery", "Amazon Athena", "Athena Queries", None, "AmazonAthena",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:athena:us-east-1:123456789012:workgroup/primary", None, "", "scanned terabytes", 1),
    (16, "Usage", "AWSLambda", "Lambda-GB-Second", "Lambda-GB-Second", "Invoke", "AWS Lambda", "Serverless", None, "AWSLambda",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:lambda:us-east-1:123456789012:function:handler-", 5, "", "lambda compute", 1),
    (17, "Usage", "AmazonCloudWatch", "GB", "USE1-DataProcessing-Bytes", "PutLogEvents", "AmazonCloudWatch", "Data Payload", None, "AmazonCloudWatch",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:logs:us-east-1:123456789012:log-group:/aws/eks/cluster-", 3, "/cluster", "log ingest", 1),
    (18, "Usage", "AmazonDynamoDB", "WriteRequestUnits", "USW2-WriteRequestUnits", "PayPerRequestThroughput", "Amazon DynamoDB", "Amazon DynamoDB PayPerRequest Throughput", None, "AmazonDynamoDB",
     None, None, None, None, None, None, None, *_USW2, "OnDemand",
     "arn:aws:dynamodb:us-west-2:123456789012:table/orders-", 3, "", "write request units", 1),
    (19, "Usage", "AmazonApiGateway", "USE2-AmazonApiGatewayRequest", "USE2-ApiGatewayRequest", "ApiGatewayRequest", "Amazon API Gateway", "API Calls", None, "AmazonApiGateway",
     None, None, None, None, None, None, None, "us-east-2", "US East (Ohio)", "OnDemand",
     "arn:aws:apigateway:us-east-2::/restapis/abc", 3, "", "api requests", 1),
    (20, "Usage", "AmazonECR", "GB-Mo", "USE1-TimedStorage-ByteHrs", "PutImage", "Amazon EC2 Container Registry (ECR)", "Storage", None, "AmazonECR",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:ecr:us-east-1:123456789012:repository/team/app-", 3, "", "image storage", 1),
    (21, "Usage", "AmazonCognito", "User", "USE1-CognitoUserPoolsMAU", "CognitoUserPoolMAU", "Amazon Cognito", "User Pool MAU", "User", "AmazonCognito",
     None, None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:cognito-idp:us-east-1:123456789012:userpool/us-east-1_AbCdEf", None, "", "monthly active users", 1),
    (22, "Fee", "AWSSupportEnterprise", "Dollar", "Dollar", "", "AWS Support (Enterprise)", None, None, "AWSSupportEnterprise",
     None, None, None, None, None, None, None, None, None, "OnDemand",
     "", None, "", "support fee", 1),
    (23, "Tax", "AmazonEC2", None, None, None, _EC2, None, None, None,
     None, None, None, None, None, None, None, None, None, None,
     None, None, "", "tax", 1),
    (24, "Credit", "AmazonS3", None, None, None, "Amazon Simple Storage Service", None, None, None,
     None, None, None, None, None, None, None, None, None, None,
     None, None, "", "promotional credit", 1),
    (25, "SavingsPlanNegation", "ComputeSavingsPlans", None, None, None, "Savings Plans for AWS Compute usage", None, None, None,
     None, None, None, None, None, None, None, None, None, None,
     "arn:aws:savingsplans::123456789012:savingsplan/550e8400-e29b-41d4-a716-44665544000", 10, "", "savings plan negation", 1),
    (26, "RIFee", "AmazonRDS", "Hrs", "InstanceUsage:db.r5.large", "CreateDBInstance:0014", "Amazon RDS Service", "Database Instance", None, "AmazonRDS",
     None, None, None, None, None, None, None, *_USE1, "Reserved",
     "arn:aws:rds:us-east-1:123456789012:ri:reserved-db-", 2, "", "reserved instance fee", 1),
    (27, "RiVolumeDiscount", "AmazonEC2", None, None, None, _EC2, None, None, None,
     None, None, None, None, None, None, None, None, None, None,
     "", None, "", "volume discount", 1),
    (28, "Usage", "AmazonEC2", "Hrs", "BoxUsage:t3.nano", "RunInstances", _EC2, "Compute Instance", None, "AmazonEC2",
     "t3.nano", "General purpose", "t3", "Intel Skylake E5 2686 v5", "Linux", "NA", None, *_USE1, "OnDemand",
     _INST, 997, "", "free tier", 1),
    (29, "Usage", "AmazonEC2", "Hrs", "BoxUsage:t3.nano", "RunInstances", _EC2, "Compute Instance", None, "AmazonEC2",
     "t3.nano", "General purpose", "t3", "Intel Skylake E5 2686 v5", "Linux", "NA", None, *_USE1, "OnDemand",
     _INST, 997, "", "no public rate", 1),
    (30, "Usage", "NewService", "Widgets", "XX-Foo", "Frobnicate", "New Service", "", None, "NewService",
     None, None, None, None, None, None, None, *_USE1, "",
     "widget-", 7, "", "", 1),
    (31, "Usage", "abc123appid", "Hrs", "SoftwareUsage:m5.large", "Subscription", "Example Marketplace App", "Software", None, "abc123appid",
     "m5.large", None, None, None, None, None, None, *_USE1, "OnDemand",
     "arn:aws:elasticloadbalancing:us-east-1:123456789012:loadbalancer/app/web-", 2, "/0123abcd", "marketplace app", 1),
]
# fmt: on

TEMPLATE_SCHEMA = T.StructType(
    [T.StructField("tid", T.IntegerType(), False)]
    + [T.StructField(c, T.StringType()) for c in TEMPLATE_COLUMNS[1:20]]
    + [T.StructField("r_prefix", T.StringType()), T.StructField("r_mod", T.IntegerType()),
       T.StructField("r_suffix", T.StringType()), T.StructField("description", T.StringType()),
       T.StructField("unit_factor", T.IntegerType())]
)

# environment tag values by l_partkey % 8 (the last is null)
ENV_TAGS = ["prod", "production", "prd", "oldprod", "dev", "devel", "", None]


_TEMPLATE_CACHE: dict[int, tuple[SparkSession, DataFrame]] = {}


def templates(spark: SparkSession) -> DataFrame:
    assert len(TEMPLATES) == N_TEMPLATES
    hit = _TEMPLATE_CACHE.get(id(spark))
    if hit is None or hit[0] is not spark:
        hit = (spark, local_table(spark, TEMPLATES, TEMPLATE_SCHEMA))
        _TEMPLATE_CACHE[id(spark)] = hit
    return hit[1]


def _dec(value: str, ty: str) -> Column:
    return F.lit(value).cast(ty)


#: Lines of a part, about: what one task cleans and folds without spilling.
PART_ROWS = 250_000


def cur_from_lineitem(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF, partitions: int | None = None) -> DataFrame:
    """Raw CUR lines, one per lineitem row.

    The test file has one row group, so one task would read all of it. A caller that wants the
    lines in parts, as a drop of many files has them, gives ``partitions``: the eight narrow
    columns are then dealt out by the lines' own numbers before they become CUR lines, in that
    many parts or as many more as keep a part at PART_ROWS lines (counted from the file's footers).
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if partitions is not None:
        partitions = max(partitions, -(-li.count() // PART_ROWS))
    return cur_from_lineitem_df(spark, li, as_of, partitions)


def cur_from_lineitem_df(spark: SparkSession, li: DataFrame, as_of: dt.date = AS_OF, partitions: int | None = None) -> DataFrame:
    li = li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                   "l_discount", "l_shipdate")
    if partitions is not None:
        li = li.repartition(partitions, "l_orderkey", "l_linenumber")
    li = li.withColumn(
        "tid", ((F.col("l_orderkey") * 7 + F.col("l_linenumber") + F.col("l_suppkey")) % N_TEMPLATES).cast("int")
    )
    t = F.broadcast(templates(spark))          # 32 rows, fixed
    x = li.join(t, "tid")

    return x.select(*_cur_columns(as_of))


@functools.lru_cache(maxsize=8)
def _cur_columns(as_of: dt.date) -> tuple[Column, ...]:
    """The CUR projection of the adapter (unresolved, reusable across queries)."""
    line_type = F.col("line_type")
    ship = F.col("l_shipdate")
    month_text = F.substring(F.to_date(ship).cast("string"), 1, 7)

    price = F.col("l_extendedprice").cast("decimal(12,2)")
    keep = (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")).cast("decimal(4,2)")
    public = (price * _dec("0.001", "decimal(4,3)")).cast(MONEY)
    unblended_pos = (price * _dec("0.001", "decimal(4,3)") * keep).cast(MONEY)
    negative = line_type.isin("Credit", "EdpDiscount", "SavingsPlanNegation")
    unblended = F.when(negative, -unblended_pos).otherwise(unblended_pos).cast(MONEY)
    is_usage = line_type == "Usage"
    zero = F.lit(0).cast(MONEY)
    edp = (F.when(F.col("tid") == 30, F.lit(None).cast(MONEY))
           .when(is_usage, (unblended * _dec("0.09", "decimal(4,2)")).cast(MONEY))
           .otherwise(zero))
    net_unblended = F.when(is_usage, (unblended * _dec("0.91", "decimal(4,2)")).cast(MONEY)).otherwise(unblended)
    ri = line_type == "DiscountedUsage"
    sp = line_type == "SavingsPlanCoveredUsage"
    private = (F.when(F.col("tid") == 7, (public * _dec("0.05", "decimal(4,2)")).cast(MONEY))
               .when(F.col("tid") == 8, F.lit(None).cast(MONEY))
               .otherwise(zero))
    has_instance = F.col("instance_type").isNotNull()
    resource = F.when(F.col("r_mod").isNull(), F.col("r_prefix")).otherwise(
        F.concat(F.col("r_prefix"), (F.col("l_partkey") % F.col("r_mod")).cast("string"), F.col("r_suffix"))
    )
    acct_n = F.col("l_suppkey") % 7

    return (
        F.year(ship).cast("string").alias("year"),
        F.month(ship).cast("string").alias("month"),
        F.expr("timestampadd(HOUR, CAST(l_orderkey % 24 AS INT), l_shipdate)").alias("line_item_usage_start_date"),
        (F.lit(100000000000) + acct_n).cast("string").alias("line_item_usage_account_id"),
        F.when(F.col("tid") == 31, "AWS Marketplace").otherwise("AWS").alias("bill_billing_entity"),
        F.when(F.col("tid") == 31, "Example Seller LLC").otherwise("Amazon Web Services, Inc.").alias("line_item_legal_entity"),
        F.when(month_text == as_of.strftime("%Y-%m"), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("INV-"), month_text)).alias("bill_invoice_id"),
        resource.alias("line_item_resource_id"),
        line_type.alias("line_item_line_item_type"),
        F.col("usage_type").alias("line_item_usage_type"),
        F.col("operation").alias("line_item_operation"),
        F.lit("USD").alias("line_item_currency_code"),
        F.col("product_code").alias("line_item_product_code"),
        F.concat(F.lit("desc "), F.col("description")).alias("line_item_line_item_description"),
        F.when(has_instance, F.concat(F.col("region"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("l_orderkey") % 3 + 1).cast("int"))))
         .otherwise(F.lit("")).alias("line_item_availability_zone"),
        F.col("region").alias("product_region"),
        F.col("location").alias("product_location"),
        F.col("product_name").alias("product_product_name"),
        F.col("product_family").alias("product_product_family"),
        F.col("product_group").alias("product_group"),
        F.col("servicecode").alias("product_servicecode"),
        F.lit(None).cast("string").alias("product_group_description"),
        F.lit(None).cast("string").alias("product_resource_type"),
        F.lit(None).cast("string").alias("product_bundle_description"),
        F.when(F.col("tid") % 2 == 0, F.col("description")).otherwise(F.lit("")).alias("product_description"),
        F.col("instance_type").alias("product_instance_type"),
        F.col("instance_family").alias("product_instance_family"),
        F.lit(None).cast("string").alias("product_bundle"),
        F.col("instance_type_family").alias("product_instance_type_family"),
        F.when(has_instance, F.lit("NA")).otherwise(F.lit(None).cast("string")).alias("product_availability_zone"),
        F.when(has_instance, F.lit("Used")).otherwise(F.lit(None).cast("string")).alias("product_capacitystatus"),
        F.col("processor").alias("product_physical_processor"),
        F.when(has_instance, F.lit("EBS only")).otherwise(F.lit(None).cast("string")).alias("product_storage"),
        F.col("os").alias("product_operating_system"),
        F.col("software").alias("product_pre_installed_sw"),
        F.col("storage_class").alias("product_storage_class"),
        F.lit(None).cast("string").alias("product_volume_type"),
        F.lit(None).cast("string").alias("product_volume_api_name"),
        F.lit(None).cast("string").alias("product_uservolume"),
        F.col("pricing_unit").alias("pricing_unit"),
        F.col("pricing_term").alias("pricing_term"),
        F.when(line_type.isin("SavingsPlanCoveredUsage", "SavingsPlanNegation"),
               F.concat(F.lit("arn:aws:savingsplans::123456789012:savingsplan/sp-"), (F.col("l_suppkey") % 2).cast("string")))
         .otherwise(F.lit("")).alias("savings_plan_savings_plan_a_r_n"),
        F.when(F.col("pricing_term") == "Reserved",
               F.concat(F.lit("arn:aws:ec2:us-east-1:123456789012:reserved-instances/ri-"), (F.col("l_suppkey") % 2).cast("string")))
         .otherwise(F.lit("")).alias("reservation_reservation_a_r_n"),
        F.when(F.col("tid") == 28, F.lit("0.0000000000")).when(F.col("tid") == 29, F.lit(None).cast("string"))
         .otherwise(F.lit("0.1000000000")).alias("pricing_public_on_demand_rate"),
        (F.col("l_quantity").cast("decimal(18,2)") * F.col("unit_factor").cast("decimal(4,0)")).cast(MONEY).alias("line_item_usage_amount"),
        net_unblended.alias("line_item_net_unblended_cost"),
        F.when(ri, (public * _dec("0.546", "decimal(4,3)")).cast(MONEY)).otherwise(zero).alias("reservation_net_effective_cost"),
        F.when(sp, (public * _dec("0.637", "decimal(4,3)")).cast(MONEY)).otherwise(zero).alias("savings_plan_net_savings_plan_effective_cost"),
        edp.alias("discount_edp_discount"),
        F.when(ri, (public * _dec("0.60", "decimal(4,2)")).cast(MONEY)).otherwise(zero).alias("reservation_effective_cost"),
        F.when(sp, (public * _dec("0.70", "decimal(4,2)")).cast(MONEY)).otherwise(zero).alias("savings_plan_savings_plan_effective_cost"),
        unblended.alias("line_item_unblended_cost"),
        private.alias("discount_private_rate_discount"),
        (edp + private).cast(MONEY).alias("discount_total_discount"),
        public.alias("pricing_public_on_demand_cost"),
        F.element_at(F.array(*[F.lit(v) for v in ENV_TAGS]), (F.col("l_partkey") % 8 + 1).cast("int")).alias("resource_tags_user_env"),
        F.concat(F.lit("svc"), (F.col("l_partkey") % 10).cast("string")).alias("resource_tags_user_service"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("team-"), (F.col("l_suppkey") % 3).cast("string"))).alias("resource_tags_user_owner"),
        )


#: Days before as_of that the restatement fixture edits: dearer lines, a day that vanishes, lines that arrive late.
DEARER_DAYS, VANISHED_DAY, LATE_DAY, EDITED_SERVICE = (10, 80), 20, 40, "svc3"


def edited_cur(cur: DataFrame, as_of: dt.date = AS_OF) -> DataFrame:
    """The raw lines as a later drop has them: one service dearer on two days, a day gone, that service's lines of another day twice."""
    day = F.to_date("line_item_usage_start_date")
    on = lambda n: day == F.lit(as_of - dt.timedelta(days=n))
    ours = F.col("resource_tags_user_service") == EDITED_SERVICE
    dearer = ours & (on(DEARER_DAYS[0]) | on(DEARER_DAYS[1]))
    cost = lambda c: F.when(dearer, F.col(c) * 2).otherwise(F.col(c)).cast(MONEY)
    costs = ("line_item_unblended_cost", "line_item_net_unblended_cost")
    late = cur.where(ours & on(LATE_DAY)).withColumn("line_item_resource_id", F.lit("late-line"))
    return cur.where(~on(VANISHED_DAY)).withColumns({c: cost(c) for c in costs}).unionByName(late)
