"""Dimension inputs (S4): accounts, pricing buckets, products, instance specs, buying options.

Dimensions are inputs. ``load_dims(spark, path)`` reads ``<name>.csv`` or ``<name>.parquet``
files under ``path`` by column name; without a path it builds the seeds below, which are for
tests (the pipeline, the command line and the stream ask for their dimensions). Every
dimension is checked for a unique key before use (a repeated key would multiply cost in a
left join), and its row count is kept so joins broadcast only a side of known size.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.sources.local import local_table

# a dimension is broadcast below this size (rows counted at load, CELL_BYTES for each value);
# a larger one joins as Spark decides
BROADCAST_BYTES, CELL_BYTES = 64 << 20, 64

_S = T.StringType()
SCHEMAS = {
    "dim_account_names": T.StructType([T.StructField(c, _S) for c in
                                       ("account_name", "account_nick", "account_id", "account_owner")]),
    "dim_pricing_buckets": T.StructType([T.StructField(c, _S) for c in ("pricing_unit", "pricing_bucket")]),
    "dim_aws_products": T.StructType([T.StructField(c, _S) for c in ("product_code", "product_name")]),
    "dim_instance_specs": T.StructType([T.StructField(c, _S) for c in (
        "instance_name", "instance_type", "instance_memory", "vcpu", "gpu", "processor_name",
        "instance_storage", "network_performance", "instance_io", "product_code", "instance_spec",
        "processor_vendor", "processor_line", "compute_class")]),
    "buying_options": T.StructType([T.StructField(c, _S) for c in ("product_code", "pricing_bucket", "buy_options")]),
}
KEYS = {
    "dim_account_names": ["account_id"],
    "dim_pricing_buckets": ["pricing_unit"],
    "dim_aws_products": ["product_code"],
    "dim_instance_specs": ["instance_type"],
    "buying_options": ["product_code", "pricing_bucket"],
}

# Our own test accounts: ids 100000000000-4 (ids 5 and 6 of the fixture stay unnamed).
ACCOUNTS = [
    ("Example Corp", "Production", "100000000000", "sre@example.com"),
    ("Example Corp", "Staging", "100000000001", "sre@example.com"),
    ("Example Corp", "Data", "100000000002", "data@example.com"),
    ("Example Labs", "Research", "100000000003", "lab@example.com"),
    ("Example Labs", "Sandbox", "100000000004", "lab@example.com"),
]

# Pricing unit -> pricing bucket, as published with the original SQL.
PRICING_BUCKETS = [
    ("CPU-Month", "Monthly"), ("DNS-Month", "Monthly"), ("Face-Month", "Monthly"),
    ("Hardware-Month", "Monthly"), ("Object-Month", "Monthly"), ("SecurityCheck-Month", "Monthly"),
    ("Software-Month", "Monthly"), ("Support-Month", "Monthly"), ("Tag-Month", "Monthly"),
    ("User-Month", "Monthly"),
    ("GB-Hour", "Storage"), ("GB-Month", "Storage"), ("Obj-Month", "Storage"), ("UsageRecord-month", "Storage"),
    ("Alarms", "Request"), ("ConfigRuleEvaluations", "Request"), ("ConfigurationItemRecorded", "Request"),
    ("Count", "Request"), ("Events", "Request"), ("HostedZone", "Request"), ("Keys", "Request"),
    ("Message", "Request"), ("Messages", "Request"), ("Metric Datapoints", "Request"), ("Metrics", "Request"),
    ("Notifications", "Request"), ("PutRequest", "Request"), ("Request", "Request"), ("Secrets", "Request"),
    ("State Transitions", "Request"), ("URL", "Request"),
    ("Hour", "Compute"),
    ("GB-Network", "Network"),
    ("GB-IO", "IO"), ("GiBps-mo", "IO"), ("IOPS-Mo", "IO"), ("IOs", "IO"), ("ReadCapacityUnit-Hrs", "IO"),
    ("ReadRequestUnits", "IO"), ("WriteCapacityUnit-Hrs", "IO"), ("WriteRequestUnits", "IO"),
    ("GB-Processed", "Processing"), ("GB-Second", "Processing"),
]

# Product code -> product name, as published with the original SQL.
PRODUCTS = [
    ("AmazonCloudFront", "Amazon CloudFront"), ("AWSDataTransfer", "AWS Data Transfer"),
    ("AmazonECRPublic", "Amazon Elastic Container Registry Public"), ("AmazonSES", "Amazon Simple Email Service"),
    ("AWSBackup", "AWS Backup"), ("AmazonRDS", "Amazon Relational Database Service"),
    ("AmazonSageMaker", "Amazon SageMaker"), ("AWSGlue", "AWS Glue"), ("AmazonCloudWatch", "AmazonCloudWatch"),
    ("awskms", "AWS Key Management Service"), ("AmazonEC2", "Amazon Elastic Compute Cloud"),
    ("AmazonApiGateway", "Amazon API Gateway"), ("AmazonRoute53", "Amazon Route 53"),
    ("AmazonSNS", "Amazon Simple Notification Service"), ("AWSQueueService", "Amazon Simple Queue Service"),
    ("AWSSecretsManager", "AWS Secrets Manager"), ("AmazonECR", "Amazon EC2 Container Registry (ECR)"),
    ("AWSSecurityHub", "AWS Security Hub"), ("AmazonDocDB", "Amazon DocumentDB (with MongoDB compatibility)"),
    ("AWSCloudTrail", "AWS CloudTrail"), ("AmazonVPC", "Amazon Virtual Private Cloud"),
    ("AmazonS3", "Amazon Simple Storage Service"), ("awswaf", "AWS WAF"), ("AmazonGuardDuty", "Amazon GuardDuty"),
    ("AmazonSimpleDB", "Amazon SimpleDB"), ("AmazonECS", "Amazon Elastic Container Service"),
    ("AmazonLightsail", "Amazon Lightsail"), ("AmazonQuickSight", "Amazon QuickSight"),
    ("AWSELB", "Elastic Load Balancing"), ("AmazonES", "Amazon OpenSearch Service"),
    ("AmazonDynamoDB", "Amazon DynamoDB"), ("CodeBuild", "CodeBuild"), ("AWSEvents", "CloudWatch Events"),
    ("AWSLambda", "AWS Lambda"), ("AmazonInspectorV2", "Amazon Inspector"),
    ("AmazonMCS", "Amazon Keyspaces (for Apache Cassandra)"), ("AmazonElastiCache", "Amazon ElastiCache"),
    ("AWSTransfer", "AWS Transfer Family"), ("AmazonQLDB", "Amazon Quantum Ledger Database"),
    ("AWSCostExplorer", "AWS Cost Explorer"), ("AWSAmplify", "AWS Amplify"),
    ("AmazonEFS", "Amazon Elastic File System"), ("AWSConfig", "AWS Config"),
    ("AmazonKinesisFirehose", "Amazon Kinesis Firehose"), ("AWSXRay", "AWS X-Ray"),
    ("AmazonStates", "AWS Step Functions"), ("AmazonKinesis", "Amazon Kinesis"),
    ("AWSCodePipeline", "AWS CodePipeline"), ("AWSGlobalAccelerator", "AWS Global Accelerator"),
    ("AWSCodeArtifact", "AWS CodeArtifact"), ("AmazonPinpoint", "Amazon Pinpoint"),
    ("AmazonWorkMail", "AmazonWorkMail"), ("AmazonEKS", "Amazon Elastic Container Service for Kubernetes"),
    ("AWSCodeCommit", "AWS CodeCommit"), ("AWSSystemsManager", "AWS Systems Manager"),
    ("AWSDatabaseMigrationSvc", "AWS Database Migration Service"), ("AmazonAthena", "Amazon Athena"),
    ("AmazonCognito", "Amazon Cognito"), ("AWSElementalMediaStore", "AWS Elemental MediaStore"),
    ("AWSServiceCatalog", "AWS Service Catalog"), ("AWSElementalMediaConvert", "AWS Elemental MediaConvert"),
    ("AmazonIVS", "Amazon Interactive Video Service"), ("ElasticMapReduce", "Amazon Elastic MapReduce"),
    ("AmazonKinesisAnalytics", "Amazon Kinesis Analytics"), ("AmazonRegistrar", "Amazon Registrar"),
    ("AmazonRedshift", "Amazon Redshift"), ("AppFlow", "Amazon AppFlow"), ("AmazonTimestream", "Amazon Timestream"),
    ("AmazonChimeFeatures", "Amazon Chime Features"), ("AmazonChime", "Amazon Chime"),
    ("ComputeSavingsPlans", "Savings Plans for AWS Compute usage"), ("AWSShield", "AWS Shield"),
    ("AmazonMQ", "Amazon MQ"), ("AWSAppSync", "AWS AppSync"), ("AmazonLocationService", "Amazon Location Service"),
    ("AmazonFSx", "Amazon FSx"), ("AWSDirectoryService", "AWS Directory Service"),
    ("AmazonPrometheus", "Amazon Managed Service for Prometheus"), ("AmazonWorkSpaces", "Amazon WorkSpaces"),
    ("AmazonMSK", "Amazon Managed Streaming for Apache Kafka"), ("AmazonRekognition", "Amazon Rekognition"),
    ("comprehend", "Amazon Comprehend"), ("AmazonCloudSearch", "Amazon CloudSearch"),
    ("AmazonKendra", "Amazon Kendra"), ("AmazonSumerian", "Amazon Sumerian"), ("AmazonWorkDocs", "Amazon WorkDocs"),
    ("ContactCenterTelecomm", "Contact Center Telecommunications (service sold by AMCS, LLC) "),
    ("AmazonMWAA", "Amazon Managed Workflows for Apache Airflow"),
]

# A seed of the machine-spec dimension, the rows for the instance types our
# fixture uses (the full list is loaded from a file in production, see load_dims).
INSTANCE_SPECS = [
    ("T3 Nano", "t3.nano", "0.5 GiB", "2", "0", "Intel Skylake E5 2686 v5", "EBS only", "Up to 5 Gigabit", "", "AmazonEC2", "t3.nano", "Intel", "Intel Skylake", "t3"),
    ("T1 Micro", "t1.micro", "0.613 GiB", "1", "0", "Variable", "EBS only", "Very Low", "", "AmazonEC2", "t1.micro", "", "", "t1"),
    ("M6G Large", "m6g.large", "8.0 GiB", "2", "0", "AWS Graviton2 Processor", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "m6g.large", "AWS", "AWS Graviton2", "m6"),
    ("C5 High-CPU Large", "c5.large", "4.0 GiB", "2", "0", "Intel Xeon Platinum 8124M", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "c5.large", "Intel", "Intel Xeon", "c5"),
    ("M5 General Purpose Large", "m5.large", "8.0 GiB", "2", "0", "Intel Xeon Platinum 8175", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "m5.large", "Intel", "Intel Xeon", "m5"),
    ("M4 General Purpose Large", "m4.large", "8.0 GiB", "2", "0", "Intel Xeon E5-2676 v3 (Haswell)", "EBS only", "Moderate", "", "AmazonEC2", "m4.large", "Intel", "Intel Xeon", "m4"),
    ("R6G Large", "r6g.large", "16.0 GiB", "2", "0", "AWS Graviton2 Processor", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "r6g.large", "AWS", "AWS Graviton2", "r6"),
    ("R5 Large", "r5.large", "16.0 GiB", "2", "0", "Intel Xeon Platinum 8175", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "r5.large", "Intel", "Intel Xeon", "r5"),
    ("C5 High-CPU Extra Large", "c5.xlarge", "8.0 GiB", "4", "0", "Intel Xeon Platinum 8124M", "EBS only", "Up to 10 Gigabit", "", "AmazonEC2", "c5.xlarge", "Intel", "Intel Xeon", "c5"),
    ("R5 Large", "db.r5.large", "16.0 GiB", "2", "0", "Intel Xeon Platinum 8175", "0 GiB (EBS only)", "Up to 10 Gigabit", "", "AmazonRDS", "r5.large", "Intel", "Intel Xeon", "r5"),
    ("R5 Memory Optimized Large", "r5.large.search", "16.0 GiB", "2", "0", "Intel Xeon Platinum 8175", "EBS Only", "Up to 10 Gigabit", "", "AmazonES", "r5.large", "Intel", "Intel Xeon", "r5"),
]

# Which purchase options exist per (product, bucket), as published.
BUYING_OPTIONS = [
    ("AmazonEC2", "Compute", "Reserved, SavingsPlan, Spot, ProvisionedIO"),
    ("AmazonRDS", "Compute", "Reserved"),
    ("AmazonES", "Compute", "Reserved"),
    ("AmazonElastiCache", "Compute", "Reserved"),
    ("AWSLambda", "Compute", "SavingsPlan"),
    ("AWSFargate", "Compute", "SavingsPlan"),
    ("AmazonRedshift", "Compute", "Reserved"),
    ("AmazonSageMaker", "Compute", "SavingsPlan"),
    ("AmazonDynamoDB", "IO", "ProvisionedIO"),
]

SEEDS = {
    "dim_account_names": ACCOUNTS,
    "dim_pricing_buckets": PRICING_BUCKETS,
    "dim_aws_products": PRODUCTS,
    "dim_instance_specs": INSTANCE_SPECS,
    "buying_options": BUYING_OPTIONS,
}


class DuplicateKeyError(ValueError):
    pass


@dataclass
class Dim:
    df: DataFrame
    rows: int

    def joinable(self) -> DataFrame:
        """The frame to join: broadcast when its size, from the checked row count, allows it."""
        size = self.rows * len(self.df.columns) * CELL_BYTES
        return F.broadcast(self.df) if size <= BROADCAST_BYTES else self.df


def small_side(table) -> DataFrame:
    """Join side for a lookup table: a ``Dim`` is broadcast when its checked row count allows;
    a plain DataFrame (size unknown here) joins normally and AQE broadcasts it at run time
    only if its measured size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``."""
    return table.joinable() if isinstance(table, Dim) else table


@dataclass
class Dims:
    accounts: Dim
    buckets: Dim
    products: Dim
    specs: Dim
    buying: Dim
    extra: dict = field(default_factory=dict)
    spec_attrs: Dim | None = None      # one row per instance_spec (E3), set by load_dims


def assert_unique(df: DataFrame, key: list[str], name: str) -> None:
    """Raise if ``key`` repeats. Runs as a Spark aggregate, returns at most one row."""
    dup = df.groupBy(*key).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"{name}: key {key} repeats, e.g. {dup[0].asDict()}")


def _seed(spark: SparkSession, name: str) -> Dim:
    rows = SEEDS[name]
    key_idx = [SCHEMAS[name].names.index(k) for k in KEYS[name]]
    keys = [tuple(r[i] for i in key_idx) for r in rows]
    if len(set(keys)) != len(keys):
        raise DuplicateKeyError(f"{name}: seed key repeats")
    return Dim(local_table(spark, rows, SCHEMAS[name]), len(rows))


def load_table(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """``base``.parquet or ``base``.csv (with a header), columns by name, on any file system that Spark reads."""
    try:
        df = spark.read.parquet(base + ".parquet")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.read.option("header", "true").csv(base + ".csv")
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} are missing in {base}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def load_dim(spark: SparkSession, name: str, path: str | None = None) -> Dim:
    if path is None:
        return _seed(spark, name)
    df = load_table(spark, f"{path.rstrip('/')}/{name}", SCHEMAS[name])
    assert_unique(df, KEYS[name], name)
    return Dim(df, df.count())


_SEED_CACHE: dict[int, tuple[SparkSession, "Dims"]] = {}


def load_dims(spark: SparkSession, path: str | None = None) -> Dims:
    if path is None:
        hit = _SEED_CACHE.get(id(spark))
        if hit is not None and hit[0] is spark:
            return hit[1]
    dims = Dims(
        accounts=load_dim(spark, "dim_account_names", path),
        buckets=load_dim(spark, "dim_pricing_buckets", path),
        products=load_dim(spark, "dim_aws_products", path),
        specs=load_dim(spark, "dim_instance_specs", path),
        buying=load_dim(spark, "buying_options", path),
    )
    # types that share a spec must agree on its attributes, else the spec join fans out
    if path is None:
        attrs = sorted({(r[10], r[13], r[5], r[11], r[12], r[3]) for r in INSTANCE_SPECS})
        if len({a[0] for a in attrs}) != len(attrs):
            raise DuplicateKeyError("dim_instance_specs: a spec has conflicting attributes")
        rows = [(spec, klass, pname, vendor, line, int(vcpu) if str(vcpu).isdigit() else None)
                for spec, klass, pname, vendor, line, vcpu in attrs]
        dims.spec_attrs = Dim(local_table(spark, rows, SPEC_ATTR_SCHEMA), len(rows))
        _SEED_CACHE[id(spark)] = (spark, dims)
    else:
        attrs = spec_attributes(dims.specs.df)
        assert_unique(attrs, ["instance_spec"], "dim_instance_specs (by spec)")
        dims.spec_attrs = Dim(attrs, dims.specs.rows)
    return dims


SPEC_ATTR_SCHEMA = T.StructType(
    [T.StructField(c, _S) for c in ("instance_spec", "compute_class", "processor_name", "processor_vendor",
                                    "processor_line")]
    + [T.StructField("processor_vcpu", T.IntegerType())])


def spec_attributes(specs: DataFrame) -> DataFrame:
    """One row per ``instance_spec`` (types sharing a spec share its attributes)."""
    return specs.select(
        "instance_spec", "compute_class", "processor_name", "processor_vendor", "processor_line",
        F.expr("try_cast(vcpu AS INT)").alias("processor_vcpu"),
    ).distinct()
