"""Column expressions of stage 00 (C2-C18). All built-in, so they stay inside codegen.

Conventions kept from the original SQL:
* a regex extract that finds nothing is null (Spark returns ``''``, hence ``extract``);
* ``if(x not in ('', ' '), x)`` is null for null ``x`` as well as for blanks (``nonblank``);
* every CASE is an ordered ``when`` chain: the first matching arm wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlake.functions import units


def c(name: str) -> Column:
    return F.col(name)


def extract(s: Column, pattern: str, group: int = 1) -> Column:
    """Regex extract with null (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(s, pattern, group), F.lit(""))


def nonblank(s: Column) -> Column:
    return F.when(~s.isin("", " "), s)


def is_blank(s: Column) -> Column:
    return (s == "") | s.isNull()


# ---------------------------------------------------------------- calendar

# Calendar text is built from dates with plain arithmetic, never through a formatter: a
# formatter converts through the session time zone and moves wall-clock times that fall
# in a daylight-saving gap.

def iso_date(d: Column) -> Column:
    """``yyyy-MM-dd`` of a date (or of the wall-clock day of a timestamp)."""
    return F.to_date(d).cast("string")


def iso_month(d: Column) -> Column:
    return F.substring(iso_date(d), 1, 7)


def date_text(ts: Column) -> Column:
    return iso_date(ts)


def hour_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH`` of the wall-clock hour."""
    return F.concat(iso_date(ts), F.lit(" "), F.lpad(F.hour(ts).cast("string"), 2, "0"))


def week_text(date_txt: Column) -> Column:
    """Monday of the ISO week, as text."""
    d = F.to_date(date_txt)
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7).cast("string")


def month_text(date_txt: Column) -> Column:
    return F.substring(date_txt, 1, 7)


def day_of_week(date_txt: Column) -> Column:
    """``1 (Mon)``: Sunday is 0."""
    d = F.to_date(date_txt)
    names = F.array(*[F.lit(n) for n in ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")])
    return F.concat((F.dayofweek(d) - 1).cast("string"), F.lit(" ("), F.element_at(names, F.dayofweek(d)), F.lit(")"))


def days_in_month(year: Column, month: Column) -> Column:
    """Calendar length of the partition month (Gregorian rule, D7)."""
    first = F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
    return F.dayofmonth(F.last_day(first))


# ---------------------------------------------------------------- resource_name (C4)

INSTANCE_OR_VOLUME = r"(i-[0-9a-f]{6,}|vol-[0-9a-f]{6,})|:instance/i-[0-9a-f]{6,}"
# Sub-services whose ``kind/name`` is the useful part of an ARN.
COLON_SLASH_KINDS = (
    "awskms|cluster|crawler|directory|distribution|fargate|file-system|function|hostedzone|"
    "log-group|natgateway|storage-lens|table|task|userpool|workgroup|workspace"
)
UUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_SEG = r"[a-zA-Z0-9_\-]+"


def resource_name(rid: Column, tag_fallbacks: Sequence[Column] = ()) -> Column:
    """Readable resource: kind/name from ARNs, instances folded into a tag (or ''), UUIDs masked."""
    folded = F.coalesce(*[nonblank(t) for t in tag_fallbacks], F.lit(None).cast("string"))
    # each guard is a literal its arm's regex needs anyway: it only skips hopeless regex runs
    colon = rid.contains(":")
    picked = (
        F.when(is_blank(rid), F.lit(""))
        .when((rid.contains("i-") | rid.contains("vol-")) & rid.rlike(INSTANCE_OR_VOLUME), folded)
        .when(colon & rid.rlike(f":(?:{COLON_SLASH_KINDS})/"), extract(rid, f":({_SEG}:?/{_SEG})"))
        .when(colon & rid.rlike(":(?:loadbalancer|repository)/"), extract(rid, f":({_SEG}/{_SEG}/{_SEG})"))
        .when(rid.startswith("arn:") & rid.rlike(f"^arn:{_SEG}:{_SEG}:{_SEG}:[0-9]+:.+$"),
              extract(rid, f"^arn:{_SEG}:{_SEG}:{_SEG}:[0-9]+:(.+)$"))
        .otherwise(rid)
    )
    return F.coalesce(F.regexp_replace(picked, UUID, "<UUID>"), F.lit(""))


# ---------------------------------------------------------------- usage_type (C5), operation

# What the patterns of usage types, operations and instance types must match.

def usage_type(raw: Column) -> Column:
    return F.coalesce(
        extract(raw, r"^.*(?:SpotUsage:|InstanceUsage:|BoxUsage:|EBSOptimized:)(.+)"),
        extract(raw, r"((IN|OUT)-Bytes-(Internet|AWS))$"),
        extract(raw, r"^[A-Z]{2,}[0-9]?-[A-Z0-9]{2,}[0-9]?-(.+(In|Out)-Bytes)"),
        extract(raw, r"^[A-Z]{3,}[0-9]-(.+)"),
        extract(raw, r"^(US|ZA|SA|EU|AP|JP|CA|ME|IN|AU|NA)-(.+)", 2),
        extract(raw, r"^(us|za|sa|eu|ap|jp|ca|me|in|au|na)-(east|west|central|north|south|northeast|northwest|southeast|southwest)-[0-9]-(.+)", 3),
        raw,
    )


def usage_type_prefix(cleaned: Column) -> Column:
    return extract(cleaned, r"^([^:]+):")


def operation(raw: Column) -> Column:
    return F.coalesce(extract(raw, r"^([^:]+):(SV)?[0-9]+(:(SV)?[0-9]+)?$"), raw)


# ---------------------------------------------------------------- pricing unit (C8) and usage scale

def pricing_unit(unit: Column, product_code: Column, family: Column, group: Column, operation_raw: Column,
                 line_type: Column, group_description: Column, resource_type: Column) -> Column:
    """Normalised pricing unit, by the built-in rules of ``units``."""
    return units.case_of({"unit": unit, "product": product_code, "family": family, "group": group, "operation": operation_raw,
                          "line_type": line_type, "group_description": group_description, "resource_type": resource_type})


def usage_divisor(unit_orig: Column) -> Column:
    """Rescale seconds and minutes to hours, terabytes to gigabytes."""
    return (
        F.when(unit_orig.isin(*units.SECOND_UNITS), F.lit(3600.0))
        .when(unit_orig.isin(*units.MINUTE_UNITS), F.lit(60.0))
        .when(unit_orig == "Terabytes", F.lit(0.0009765625))
        .otherwise(F.lit(1.0))
    )


# ---------------------------------------------------------------- regime, description

def pricing_regime(term: Column, line_type: Column, private_rate_discount: Column) -> Column:
    on_demand = term.isin("OnDemand", "")
    return (
        F.when((term == "Reserved") & (line_type == "DiscountedUsage"), "Reserved")
        .when((term == "Spot") & (line_type == "Usage"), "Spot")
        .when(on_demand & (private_rate_discount != 0), "PrivateRate")
        .when(on_demand & (line_type == "Usage"), "OnDemand")
        .when(on_demand & (line_type == "SavingsPlanCoveredUsage"), "SavingsPlan")
        .otherwise("Unknown")
    )


def first_nonblank(*cols: Column) -> Column:
    return F.coalesce(*[nonblank(x) for x in cols])


# ---------------------------------------------------------------- compute

# Fixed value: what is cut from an instance type.
SPEC_NOISE = r"ml\.|\.search|db\.|cache\.|-Hosting|-Training|-TrainDebugFreeTier|-TrainDebug|-Notebook"


def instance_spec(itype: Column) -> Column:
    return F.lower(F.regexp_replace(itype, SPEC_NOISE, ""))


def instance_family(family: Column, bundle: Column) -> Column:
    return F.coalesce(F.when(~family.isin("", " "), F.lower(family)), F.when(~bundle.isin("", " "), F.lower(bundle)))


def instance_type_family(type_family: Column, itype: Column) -> Column:
    return F.when(is_blank(type_family), extract(F.lower(itype), "([a-z0-9]+)")).otherwise(F.lower(type_family))


def availability_zone(product_az: Column, line_az: Column) -> Column:
    return F.when(product_az.isNotNull() & ~product_az.isin("", "NA"), product_az).otherwise(line_az)


def processor_vendor(name: Column) -> Column:
    return F.when(name.isNotNull() & (name != ""), F.coalesce(extract(name, "(Intel|AMD|AWS)"), F.lit("Unknown")))


def processor_line(name: Column) -> Column:
    return F.when(name.isNotNull() & (name != ""), F.coalesce(extract(name, "((?:Intel|AMD|AWS) [^ ]+)"), F.lit("Unknown")))


# ---------------------------------------------------------------- storage

def storage_class(product_class: Column, usage_type_raw: Column) -> Column:
    return (
        F.when(product_class.isNull() & (usage_type_raw == "TimedStorage-ZIA-SmObjects"), "Infrequent Access (Small Objects)")
        .when(usage_type_raw == "TimedStorage-INT-IA-ByteHrs", "Intelligent (Infrequent Access)")
        .when(usage_type_raw == "TimedStorage-INT-AIA-ByteHrs", "Intelligent (Archive Instant Access)")
        .when(usage_type_raw == "TimedStorage-INT-FA-ByteHrs", "Intellegent (Frequent Access)")
        .otherwise(product_class)
    )


# ---------------------------------------------------------------- accrual cost

MONEY = "decimal(24,10)"


def accrual_cost(line_type: Column, net_unblended: Column, ri_net: Column, sp_net: Column) -> Column:
    return (F.when(line_type == "Usage", net_unblended)
            .when(line_type == "DiscountedUsage", ri_net)
            .when(line_type == "SavingsPlanCoveredUsage", sp_net)
            .otherwise(F.lit(0).cast(MONEY)))


def cost_without_edp(line_type: Column, net_unblended: Column, edp: Column, ri_eff: Column, sp_eff: Column) -> Column:
    return (F.when(line_type == "Usage", net_unblended + edp)
            .when(line_type == "DiscountedUsage", ri_eff)
            .when(line_type == "SavingsPlanCoveredUsage", sp_eff)
            .otherwise(F.lit(0).cast(MONEY)))
