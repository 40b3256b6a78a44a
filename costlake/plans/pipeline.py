"""Wiring of the stages: raw CUR -> stage 00 -> stage 01 -> facts.

Each function returns a lazy DataFrame; nothing is collected. ``Pipeline`` keeps the
parameters that the SQL original took from ``current_date`` (``as_of``) explicit, so runs
are repeatable.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.operators import facts
from costlake.operators.clean import clean, rollup
from costlake.operators.enrich import enrich
from costlake.sources.contract import month_start, months_back, restatement_months, usage_months
from costlake.sources.dims import Dim, Dims, load_dims
from costlake.sources.fixture import AS_OF, cur_from_lineitem

# the fixture's tag columns, as a user would name their own
FIXTURE_TAGS = {"tag_env": "resource_tags_user_env", "tag_service": "resource_tags_user_service",
                "tag_owner": "resource_tags_user_owner"}


@dataclass
class Pipeline:
    spark: SparkSession
    cur: DataFrame
    as_of: dt.date                           # the day the run stands on (the SQL's current_date)
    dims: Dims | None = None
    tags: Mapping[str, str] = field(default_factory=dict)
    grain: str = "day"
    buckets: tuple[str, ...] = ()
    resource_tags: tuple[str, ...] = ()      # tag columns naming an instance's group (C4)
    unit_rules: DataFrame | None = None      # a site's own table of pricing-unit rules (C8)

    def __post_init__(self):
        if self.dims is None:
            raise ValueError("dims is required: load_dims(spark, path), or load_dims(spark) for the test seeds")

    def stage00(self) -> DataFrame:
        units = None
        if self.buckets:
            # only lines whose unit maps to the wanted buckets, dropped per line before the shuffle
            # a subset of the bucket dimension: bounded by its checked row count
            units = Dim(self.dims.buckets.df.where(F.col("pricing_bucket").isin(*self.buckets)).select("pricing_unit"),
                        self.dims.buckets.rows)
        return clean(self.cur, self.tags, resource_tag_fallbacks=self.resource_tags, grain=self.grain,
                     keep_units=units, unit_rules=self.unit_rules)

    def only(self, *buckets: str) -> "Pipeline":
        """The same pipeline restricted to lines of the given pricing buckets."""
        return replace(self, buckets=tuple(buckets))

    def over(self, cur: DataFrame) -> "Pipeline":
        """The same pipeline over other raw lines."""
        return replace(self, cur=cur)

    def stage01(self) -> DataFrame:
        carry = list(self.tags) + (["hour"] if self.grain == "hour" else [])
        return enrich(self.stage00(), self.dims, carry)

    def usage_daily(self) -> DataFrame:
        return facts.usage_daily(self.stage01(), self.as_of)

    def usage_hourly(self) -> DataFrame:
        """The hour fact (of a pipeline of grain hour)."""
        return facts.usage_hourly(self.stage01(), facts.hour_start(self.as_of))

    def usage_from_hours(self) -> DataFrame:
        """The daily fact of the hour fact's window, summed from hours (of a pipeline of grain hour)."""
        days = enrich(rollup(self.stage00(), list(self.tags)), self.dims, list(self.tags))
        return facts.usage_fact(days, facts.hour_start(self.as_of))

    def usage_incremental(self) -> DataFrame:
        return facts.usage_incremental(self.stage01(), self.as_of)

    def bill(self) -> DataFrame:
        return facts.bill_full(self.stage01(), self.as_of)

    def bill_incremental(self) -> DataFrame:
        return facts.bill_incremental(self.stage01(), self.as_of)


def fixture_pipeline(spark: SparkSession, sf_dir: str, tags: Mapping[str, str] | None = None,
                     as_of: dt.date = AS_OF, grain: str = "day", partitions: int | None = None) -> Pipeline:
    """Pipeline over the lineitem-derived CUR of a test-data folder, read in ``partitions`` parts if given."""
    return Pipeline(spark, cur_from_lineitem(spark, sf_dir, as_of, partitions), as_of, load_dims(spark), tags=dict(tags or {}), grain=grain)


#: Months before the month of as_of that a full build covers: two years.
FULL_MONTHS = 24


# ---------------------------------------------------------------- builds (the published run order)

def build_steps(as_of: dt.date, months_per_step: int = 1) -> list[tuple[dt.date, dt.date]]:
    """First day of the first and of the last usage month of each step of a full build."""
    months = [month_start(as_of, k) for k in range(FULL_MONTHS, -1, -1)]
    return [(months[i], months[min(i + months_per_step, len(months)) - 1]) for i in range(0, len(months), months_per_step)]


def build_full(p: Pipeline, usage_path: str, bill_path: str, months_per_step: int = 1) -> dict:
    """Full build (S5), some usage months at a time: stage 01 of a step once (materialised), both facts from it.

    A step's facts go to version folders and into the build's ledger; when all steps are
    there, each table is published in one commit, so readers keep the old table until then. A
    build that died is started again with the same arguments: it repeats no step of its ledger.
    """
    from costlake.plans.sinks import materialized
    from costlake.plans.versions import Ledger, VersionedTable

    usage, bill = VersionedTable(p.spark, usage_path, "date"), VersionedTable(p.spark, bill_path, "date_month")
    made_of = repr((sorted(p.tags.items()), p.grain, p.buckets, p.resource_tags, months_per_step, bill_path))
    ledger = Ledger(p.spark, f"{usage.path}/build", f"{p.as_of}-{zlib.crc32(made_of.encode()):08x}")
    done, repeated = ledger.done(), []
    steps = build_steps(p.as_of, months_per_step)
    for first, last in steps:
        name = f"{first:%Y-%m}_{last:%Y-%m}"
        if name in done:
            repeated.append(name)
            continue
        window = p.over(usage_months(p.cur, first, last, final=(first, last) == steps[-1]))
        with materialized(window.stage01(), f"stage01-{name}") as s01:
            daily, monthly = facts.usage_daily(s01, p.as_of), facts.bill_full(s01, p.as_of)
            done[name] = {"usage": usage.write_version(daily), "bill": bill.write_version(monthly)}
        ledger.record(name, done[name])
    empty = p.over(p.cur.limit(0)).stage01()          # for the schema alone
    daily, monthly = facts.usage_daily(empty, p.as_of), facts.bill_full(empty, p.as_of)
    for table, rows, part in ((usage, daily, "usage"), (bill, monthly, "bill")):
        table.commit(table.schema_of(rows), {v: e for step in done.values() for v, e in step[part].items()}, table.head())
    ledger.close()
    return {"steps": [f"{a:%Y-%m}_{b:%Y-%m}" for a, b in steps], "found_done": repeated}


def build_incremental(p: Pipeline, usage_path: str, bill_path: str, days: int = facts.RESTATE_DAYS) -> dict:
    """Daily increment (S6, S7): restate the trailing window of both facts.

    Only the CUR months the window touches are read (partition filter on year/month); the
    bill restates whole months from the month of ``as_of - days``, and of those only the ones
    that differ are written.
    """
    from costlake.plans.sinks import materialized, restate

    window = p.over(months_back(p.cur, p.as_of, restatement_months(p.as_of, days)))
    with materialized(window.stage01(), "stage01-window") as s01:
        daily = restate(facts.usage_incremental(s01, p.as_of, days), usage_path, "date", facts.restate_start(p.as_of, days))
        month = facts.bill_restate_month(p.as_of, days)
        monthly = restate(facts.bill(s01, month), bill_path, "date_month", month, changed_only=True)
    return {"dropped_days": daily["dropped"], "dropped_months": monthly["dropped"], "written_months": monthly["written"],
            "kept_months": monthly["kept"]}


def build_hourly(p: Pipeline, hourly_path: str, usage_path: str | None = None, days: int = facts.HOUR_DAYS) -> dict:
    """The hour fact (G11, G13): restate its last ``days`` days, whole months, and forget days older than its window.

    With ``usage_path`` the same days of the daily fact are summed from the hours (two-level
    roll-up): the raw lines are read once for both.
    """
    from costlake.plans.sinks import materialized, restate
    from costlake.plans.versions import VersionedTable

    since, floor = facts.hour_start(p.as_of, days), facts.hour_start(p.as_of)
    months = restatement_months(p.as_of, (p.as_of - dt.date.fromisoformat(since)).days)
    hours = replace(p, grain="hour").over(months_back(p.cur, p.as_of, months))
    with materialized(hours.stage00(), "stage00-hours") as h00:
        rows = facts.usage_hourly(enrich(h00, p.dims, [*p.tags, "hour"]), since)
        out = {"hours": VersionedTable(p.spark, hourly_path, "date").replace(rows, since, floor=floor)}
        if usage_path is not None:
            out["days"] = restate(facts.usage_fact(enrich(rollup(h00, list(p.tags)), p.dims, list(p.tags)), since), usage_path, "date", since)
    return out
