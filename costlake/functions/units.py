"""Normalised pricing units from an ordered table of rules; the lowest numbered rule that applies names the unit.

``case_of`` compiles the built-in rules into one expression. ``dictionary`` applies a rule table
that a site keeps itself: the distinct combinations of the fields that rules look at (a few
thousand, whatever the number of lines) meet the rules by an equi-join on each rule's anchor,
and the lines look their combination up.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a rule may look at, and the raw column it is.
FIELDS = {"unit": "pricing_unit", "product": "line_item_product_code", "family": "product_product_family", "group": "product_group",
          "operation": "line_item_operation", "line_type": "line_item_line_item_type", "group_description": "product_group_description",
          "resource_type": "product_resource_type"}
LIKE = ("unit_like", "product_like")
#: A rule table: null fields are not looked at; a rule names its unit, its family or its group description, or has a ``unit_like``.
RULE_SCHEMA = "number int, result string, " + ", ".join(f"{f} string" for f in [*FIELDS, *LIKE])

# Unit spellings and product lists.
MONTH_WORDS = ("Month", "Months", "month", "months", "Mo")
INGEST_PRODUCTS = ("AWSCloudTrail", "AmazonCloudWatch", "AmazonKinesisFirehose", "AmazonSNS", "AmazonGuardDuty",
                   "AmazonKinesis", "AmazonTimestream", "AWSShield", "AmazonECRPublic", "AmazonDynamoDB", "AWSMarketplace")
GB_SECOND_UNITS = ("Lambda-GB-Second", "Lambda-GB-Second-ARM", "GB-Seconds")
GB_HOUR_UNITS = ("Fargate-GB-Hours", "GB-Hours", "ECS-EC2-GB-Hours")
NETWORK_FAMILIES = ("Data Transfer", "Load Balancer", "VpcEndpoint", "Lightsail Networking", "Sending Attachments", "NAT Gateway")
DOLLAR_UNITS = ("dollar", "Dollar", "dollars", "Dollars")
GB_MONTH_UNITS = ("GB-Mo", "GB-month", "GB-mo", "GB-Month")
HOUR_UNITS = ("Hrs", "hrs", "Hours", "hours", "hour", "Hour", "StreamHr", "KPU-Hour", "ACU-Hr", "vCPU-Hours", "LCU-Hrs",
              "IdleLCU-Hr", "DPU-Hour", "Instance-hrs", "Hourly", "hourly", "ShardHour", "ConsumerShardHour",
              "Accelerator-Hours", "NatGateway-Hours", "Rule-Hour")
MINUTE_UNITS = ("minute", "minutes", "Minute", "Minutes")
SECOND_UNITS = ("second", "seconds", "Second", "Seconds")
REQUEST_UNITS = ("API Requests", "Requests", "Queries", "FunctionExecutions")
REGION_PREFIX = "(US|ZA|SA|EU|AP|JP|CA|ME|IN|AU|NA)[EWNSC]?[0-9]?-.+"
REGION_PREFIX_TAIL = "(?:US|ZA|SA|EU|AP|JP|CA|ME|IN|AU|NA)[EWNSC]?[0-9]?-(.+)"
# The rules, most specific first; the order is the meaning.
RULES = [
    ("Software-Month", {"group_description": "Billed by the month", "resource_type": "Software"}),
    ("Hardware-Month", {"group_description": "Billed by the month", "resource_type": "Hardware"}),
    ("Software-Month", {"unit": MONTH_WORDS, "operation": ("GetLicense", "Subscription")}),
    ("User-Month", {"family": "User Pool MAU"}),
    ("GB-Processed", {"unit": "GB", "product": INGEST_PRODUCTS}),
    ("GB-Second", {"unit": GB_SECOND_UNITS}),
    ("GB-Hour", {"unit": GB_HOUR_UNITS}),
    ("GB-Processed", {"unit": "Terabytes"}),
    ("GB-IO", {"unit": "GB", "product": ("AmazonS3", "AmazonEFS")}),
    ("GB-Network", {"unit": "GB", "family": NETWORK_FAMILIES}),
    ("GB-Network", {"unit": "GigaBytes"}),
    ("User-Month", {"unit": "Month", "group": "User"}),
    ("Face-Month", {"unit": "Faces-Mo"}),
    ("Tag-Month", {"unit": "Tag-Mo"}),
    ("DNS-Month", {"unit": "Mo", "product": "AmazonRoute53"}),
    ("SecurityCheck-Month", {"unit": "Security Checks"}),
    ("CPU-Month", {"unit": "vCPU-Months"}),
    ("User-Month", {"unit": ("User", "User-Mo")}),
    ("Object-Month", {"unit": "Objects", "product": "AmazonS3"}),
    ("Support-Month", {"line_type": "Fee", "unit": DOLLAR_UNITS, "product_like": "%Support%"}),
    ("GB-Month", {"unit": GB_MONTH_UNITS}),
    ("Hour", {"unit": HOUR_UNITS}),
    ("Hour", {"unit": "Dashboards", "operation": "DashboardHour"}),
    ("Hour", {"unit": (*MINUTE_UNITS, *SECOND_UNITS)}),
    ("Request", {"unit": REQUEST_UNITS}),
    ("Request", {"unit_like": "%Request"}),
]


def _named_otherwise(unit: Column) -> Column:
    """A unit without a rule: what follows its region prefix, or itself."""
    return F.when(unit.rlike(REGION_PREFIX), F.nullif(F.regexp_extract(unit, REGION_PREFIX_TAIL, 1), F.lit(""))).otherwise(unit)


def case_of(fields: dict[str, Column]) -> Column:
    """The built-in rules as one expression over the fields."""
    def wanted(name: str, value) -> Column:
        if name in LIKE:
            return fields[name.removesuffix("_like")].like(value)
        return fields[name].isin(*value) if isinstance(value, tuple) else fields[name] == value

    out = F
    for result, wants in RULES:
        cond = F.lit(True)
        for i, (name, value) in enumerate(wants.items()):
            cond = wanted(name, value) if i == 0 else cond & wanted(name, value)
        out = out.when(cond, result)
    return out.otherwise(_named_otherwise(fields["unit"]))


def rule_rows() -> list[tuple]:
    """The built-in rules as rows of RULE_SCHEMA, one for each combination that a rule lists."""
    rows = []
    for number, (result, wants) in enumerate(RULES):
        choices = [v if isinstance(v := wants.get(f), tuple) else (v,) for f in [*FIELDS, *LIKE]]
        rows += [(number, result, *combo) for combo in itertools.product(*choices)]
    return rows


def dictionary(lines: DataFrame, rules: DataFrame) -> DataFrame:
    """The raw columns of FIELDS and ``clean_unit``: every combination that ``lines`` have, named by ``rules``.

    A rule's anchor is its unit, else its family, else its group description, else nothing; a
    combination offers all of them, so the two sides meet by equality and what else the rule asks
    is checked on the few that meet.
    """
    combos = lines.select(*[F.col(src).alias(f) for f, src in FIELDS.items()]).distinct()
    kinds = ("unit", "family", "group_description")
    offers = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in kinds], F.struct(F.lit("any").alias("kind"), F.lit("").alias("value")))
    r = rules.select(*[F.col(c).alias(f"r_{c}") for c in ("number", "result", *FIELDS, *LIKE)])
    kind, value = F.lit("any"), F.lit("")
    for k in reversed(kinds):
        kind, value = F.when(F.col(f"r_{k}").isNotNull(), k).otherwise(kind), F.coalesce(f"r_{k}", value)
    r = r.withColumns({"r_kind": kind, "r_value": value})
    meets = (F.col("offer.kind") == F.col("r_kind")) & (F.col("offer.value") == F.col("r_value"))
    for f in FIELDS:
        meets = meets & (F.col(f"r_{f}").isNull() | (F.col(f"r_{f}") == F.col(f)))
    for f in LIKE:
        meets = meets & (F.col(f"r_{f}").isNull() | F.like(F.col(f.removesuffix("_like")), F.col(f"r_{f}")))
    rank = F.when(F.col("r_number").isNotNull(), F.struct("r_number", "r_result"))       # an offer that no rule takes ranks nowhere
    found = (combos.withColumn("offer", F.explode(offers)).join(r, meets, "left").groupBy(*FIELDS)
             .agg(F.min_by("r_result", rank).alias("result")))
    return found.select(*[F.col(f).alias(src) for f, src in FIELDS.items()], F.coalesce("result", _named_otherwise(F.col("unit"))).alias("clean_unit"))


def look_up(lines: DataFrame, units: DataFrame) -> DataFrame:
    """``lines`` with ``clean_unit``; null fields meet null fields."""
    held = units.select("clean_unit", *[F.col(src).alias(f"u_{f}") for f, src in FIELDS.items()])
    same = F.lit(True)
    for i, (f, src) in enumerate(FIELDS.items()):
        one = F.col(src).eqNullSafe(F.col(f"u_{f}"))
        same = one if i == 0 else same & one
    return lines.join(held, same, "left").drop(*[f"u_{f}" for f in FIELDS])
