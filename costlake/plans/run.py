"""Command-line driver: the published run order as one call.

    python -m costlake.plans.run full        --cur PATH --usage PATH --bill PATH --dims PATH [--as-of DATE]
    python -m costlake.plans.run incremental --cur PATH --usage PATH --bill PATH --dims PATH [--days 65] ...
    python -m costlake.plans.run hours       --cur PATH --hours PATH --dims PATH [--usage PATH] ...
    python -m costlake.plans.run view NAME   --usage PATH --bill PATH --out PATH [--hours PATH] [--inputs PATH] ...
    python -m costlake.plans.run vacuum      --usage PATH --bill PATH

``full`` truncates and loads both facts month by month (and resumes if it died), ``incremental``
restates the trailing window (the daily job), ``hours`` the hour fact (and the daily fact from
it, if named), ``view`` writes one analysis view read from the fact tables, ``vacuum`` removes
versions that no recent pointer names. The session comes from ``spark-submit``;
``spark.checkpoint.dir`` must name a shared folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from costlake.functions import units
from costlake.operators import facts, recipes, views
from costlake.plans.pipeline import Pipeline, build_full, build_hourly, build_incremental
from costlake.plans.sinks import read_table
from costlake.plans.versions import VersionedTable
from costlake.sources.contract import conform
from costlake.sources.dims import load_dim, load_dims, load_table

#: Views by name: what each is made from (``usage``, ``bill``, ``hours``, ``cur``, or a named input), and how.
VIEWS = {
    "discount_iceberg": lambda x, d: views.discount_iceberg(x("bill")),
    "cpu_ratecard": lambda x, d: views.cpu_ratecard(x("usage"), d),
    "cpu_ratecard_approx": lambda x, d: views.cpu_ratecard(x("usage"), d, approx_accuracy=10_000),
    "buying_efficiency": lambda x, d: views.buying_efficiency(x("usage"), x("buying_options"), d),
    "wow_cost_movers": lambda x, d: views.wow_cost_movers(x("usage"), d, dims=x("movers_dims")),
    "wow_cost_movers_fixed": lambda x, d: views.wow_cost_movers(x("usage"), d, fixed=True, dims=x("movers_dims")),
    "bucket_spend": lambda x, d: recipes.bucket_spend(x("usage"), d),
    "storage_growth": lambda x, d: recipes.storage_growth(x("usage"), d),
    "storage_idle": lambda x, d: recipes.storage_idle(x("usage"), d),
    "env_mapping": lambda x, d: recipes.env_mapping(x("usage"), x("env_map")),
    "system_mapping": lambda x, d: recipes.system_mapping(x("usage"), x("system_map")),
    "tag_patch": lambda x, d: recipes.tag_patch(x("usage"), x("tag_rules"), facts.full_load_start(d), d.isoformat()),
    "invoice_summary": lambda x, d: recipes.invoice_summary(x("bill")),
    "tag_coverage": lambda x, d: recipes.tag_coverage(x("usage")),
    "unit_cost": lambda x, d: recipes.unit_cost(x("usage"), x("work_log")),
    "hourly_usage": lambda x, d: recipes.hourly_usage(x("hours"), facts.hour_start(d)),
    "cost_ma7": lambda x, d: recipes.cost_ma7(x("usage")),
    "base_load": lambda x, d: recipes.base_load(x("hours"), d, facts.hour_start(d)),
    "growth_alerts": lambda x, d: recipes.growth_alerts(x("usage"), d),
    "driver_projection": lambda x, d: recipes.driver_projection(x("usage"), x("driver_map"), x("driver_units"), d),
    "growth_projection": lambda x, d: recipes.growth_projection(x("usage"), d),
    "reconcile": lambda x, d: recipes.reconcile(conform(x("cur")), x("bill"), facts.years_back(d, 2).strftime("%Y-%m")),
    "reconcile_daily": lambda x, d: recipes.reconcile_daily(conform(x("cur")), x("usage"), facts.full_load_start(d)),
    "reconcile_invoices": lambda x, d: recipes.reconcile_invoices(x("bill"), x("invoices")),
}

#: Named inputs and their columns; each is a Parquet or CSV file (with a header) of that name under ``--inputs``.
INPUTS = {
    "env_map": "tag_env string, environment string",
    "system_map": "tag_service string, tag_system string",
    "driver_map": "tag_service string, driver string",
    "driver_units": "driver string, date_month string, units double",
    "work_log": "date string, service string, transactions long",
    "tag_rules": recipes.RULE_SCHEMA,
    "invoices": "invoice_id string, product_code string, amount decimal(24,10)",
}


def source(spark: SparkSession, args: argparse.Namespace):
    """name -> table, opened when a view asks for it."""
    def get(name: str):
        if name == "movers_dims":
            return args.movers_dims.split(",") if args.movers_dims else None
        if name == "buying_options":
            return load_dim(spark, name, needed(args.dims, "--dims"))
        if name == "cur":
            return spark.read.parquet(needed(args.cur, "--cur"))
        if name in INPUTS:
            return load_table(spark, f"{needed(args.inputs, '--inputs').rstrip('/')}/{name}", T.StructType.fromDDL(INPUTS[name]))
        return read_table(spark, needed(getattr(args, name), f"--{name}"))

    def needed(value: str | None, option: str) -> str:
        if not value:
            raise SystemExit(f"{option} is required for view {args.name}")
        return value

    return get


def parse(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="costlake.plans.run")
    ap.add_argument("mode", choices=["full", "incremental", "hours", "view", "vacuum"])
    ap.add_argument("name", nargs="?", help="view name (mode view)")
    ap.add_argument("--cur", help="raw CUR folder (Parquet, partitioned by year/month)")
    ap.add_argument("--usage", help="daily fact folder")
    ap.add_argument("--bill", help="monthly bill folder")
    ap.add_argument("--hours", help="hour fact folder")
    ap.add_argument("--inputs", help="folder with a view's own inputs, a Parquet or CSV file each: " + ", ".join(INPUTS))
    ap.add_argument("--movers-dims", help="comma-separated site dimensions of the cost movers")
    ap.add_argument("--months-per-step", type=int, default=1, help="usage months of one step (mode full)")
    ap.add_argument("--dims", help="folder with dimension CSV/Parquet files (loads and buying_efficiency)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.datetime.now(dt.timezone.utc).date())
    ap.add_argument("--days", type=int, default=65, help="restated window (mode incremental)")
    ap.add_argument("--tag", action="append", default=[], metavar="OUT=COLUMN", help="extra tag dimension")
    ap.add_argument("--unit-rules", help="a site's own pricing-unit rules: a Parquet or CSV file, without its ending")
    ap.add_argument("--out", help="output folder (mode view)")
    return ap.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    args = parse(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    if args.mode == "view":
        if args.name not in VIEWS or not args.out:
            raise SystemExit(f"view needs one of {sorted(VIEWS)} and --out")
        VIEWS[args.name](source(spark, args), args.as_of).write.mode("overwrite").parquet(args.out)
        return {"mode": "view", "name": args.name, "out": args.out}
    facts_of = {"usage": (args.usage, "date"), "bill": (args.bill, "date_month"), "hours": (args.hours, "date")}
    if args.mode == "vacuum":
        return {"mode": "vacuum", **{k: VersionedTable(spark, path, col).vacuum() for k, (path, col) in facts_of.items() if path}}
    for option in ("cur", "dims", *(["hours"] if args.mode == "hours" else ["usage", "bill"])):
        if not getattr(args, option):
            raise SystemExit(f"--{option} is required for mode {args.mode}")
    tags = dict(t.split("=", 1) for t in args.tag)
    p = Pipeline(spark, spark.read.parquet(args.cur), args.as_of, load_dims(spark, args.dims), tags,
                 unit_rules=load_table(spark, args.unit_rules, T.StructType.fromDDL(units.RULE_SCHEMA)) if args.unit_rules else None)
    if args.mode == "full":
        return {"mode": "full", "as_of": args.as_of.isoformat(), **build_full(p, args.usage, args.bill, args.months_per_step)}
    if args.mode == "hours":
        return {"mode": "hours", "as_of": args.as_of.isoformat(), **build_hourly(p, args.hours, args.usage)}
    out = build_incremental(p, args.usage, args.bill, args.days)
    return {"mode": "incremental", "as_of": args.as_of.isoformat(), **out}


if __name__ == "__main__":
    print(json.dumps(main()))
