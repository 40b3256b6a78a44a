"""Versioned tables: whole tables whenever a load dies, files kept where nothing changed, builds that resume."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from costlake.operators import facts
from costlake.plans import versions
from costlake.plans.pipeline import build_full, build_incremental, build_steps, fixture_pipeline
from costlake.plans.sinks import partitions, read_table, restate
from costlake.plans.versions import ConcurrentCommit, Files, Ledger, VersionedTable
from costlake.sources.fixture import AS_OF, edited_cur


class Died(Exception):
    pass


def frame(spark, days, value):
    return spark.createDataFrame([(i, float(value), d) for d in days for i in range(3)], "i int, x double, date string")


def content(df):
    return sorted(tuple(r) for r in df.select("date", "i", "x").collect())


OLD, NEW = ["2001-10-01", "2001-10-02", "2001-10-03"], ["2001-10-02", "2001-10-04"]


def die_in_write(m):
    """All files of the new version are there, the pointer is not."""
    whole = VersionedTable.write_version
    m.setattr(VersionedTable, "write_version", lambda self, rows: (whole(self, rows), (_ for _ in ()).throw(Died()))[0])


def die_before_rename(m):
    """The pointer's text is written under its hidden name."""
    def put(self, name, text):
        self.write(f"pointer/.{name.rpartition('/')[2]}-half", text[: len(text) // 2])
        raise Died
    m.setattr(Files, "put", put)


def die_after_commit(m):
    whole = VersionedTable.commit

    def commit(self, *a, **kw):
        whole(self, *a, **kw)
        raise Died
    m.setattr(VersionedTable, "commit", commit)


@pytest.mark.parametrize("die, published", [(die_in_write, False), (die_before_rename, False), (die_after_commit, True)])
def test_a_load_that_dies_leaves_a_whole_table(spark, tmp_path, die, published):
    path = str(tmp_path / "t")
    table = VersionedTable(spark, path, "date")
    table.replace(frame(spark, OLD, 1))
    before = content(read_table(spark, path))
    after = sorted(content(frame(spark, OLD[:1], 1)) + content(frame(spark, NEW, 2)))
    reader = table.read()                               # opened before the load
    with pytest.MonkeyPatch.context() as m:
        die(m)
        with pytest.raises(Died):
            restate(frame(spark, NEW, 2), path, "date", "2001-10-02")
    assert content(read_table(spark, path)) == (after if published else before)
    out = restate(frame(spark, NEW, 2), path, "date", "2001-10-02")   # run again
    assert content(read_table(spark, path)) == after and partitions(spark, path, "date") == ["2001-10-01", *NEW]
    assert out["written"] == NEW and out["dropped"] == ([] if published else ["2001-10-03"])
    assert content(reader) == before                    # its files are still there
    table.vacuum(keep=1)
    assert content(read_table(spark, path)) == after
    held = {e["version"] for e in table.head().partitions.values()}
    assert {n.split("=")[1] for n in os.listdir(f"{path}/data") if n.startswith("version=")} == held


def test_partition_filters_prune_folders(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "date")
    table.replace(frame(spark, OLD, 1))
    df = table.read().where(F.col("date") >= "2001-10-03")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in p and df.count() == 3 and dict(df.dtypes)["date"] == "string"


def test_two_loads_at_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "date")
    table.replace(frame(spark, OLD, 1))
    base, schema = table.head(), table.schema_of(frame(spark, [], 0))
    table.replace(frame(spark, NEW, 2))
    with pytest.raises(ConcurrentCommit):
        table.commit(schema, {}, base)
    assert content(table.read()) == content(frame(spark, NEW, 2))


def test_empty_and_plain_tables(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), "date")
    with pytest.raises(FileNotFoundError):
        table.read()
    table.replace(frame(spark, [], 0))
    assert table.read().count() == 0 and table.read().columns == ["i", "x", "date"]
    table.replace(frame(spark, OLD, 1))
    table.replace(frame(spark, [], 0), since="2001-10-02")
    assert table.values() == OLD[:1]
    plain = str(tmp_path / "plain")
    frame(spark, OLD, 1).write.partitionBy("date").parquet(plain)
    with pytest.raises(ValueError, match="plain partitions"):
        restate(frame(spark, NEW, 2), plain, "date", "2001-10-02")
    assert len(content(read_table(spark, plain))) == 9


def test_unchanged_months_keep_their_files(spark, tmp_path):
    p, path = fixture_pipeline(spark, SF_SMALL), str(tmp_path / "bill")
    table = VersionedTable(spark, path, "date_month")
    table.replace(p.bill())
    files = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/data/version=*/*/*.parquet")}
    before, first = files(), table.head()
    same = restate(p.bill_incremental(), path, "date_month", facts.bill_restate_month(AS_OF), changed_only=True)
    assert same["kept"] == ["2001-08", "2001-09", "2001-10", "2001-11"] and not same["written"] and not same["dropped"]
    assert files() == before and table.head().partitions == first.partitions
    one = p.over(p.cur.withColumn("line_item_unblended_cost", F.when(F.to_date("line_item_usage_start_date").between("2001-09-03", "2001-09-04"), F.col("line_item_unblended_cost") + 1)
                                  .otherwise(F.col("line_item_unblended_cost")).cast("decimal(24,10)")))
    out = restate(one.bill_incremental(), path, "date_month", facts.bill_restate_month(AS_OF), changed_only=True)
    assert out["written"] == ["2001-09"] and out["kept"] == ["2001-08", "2001-10", "2001-11"]
    assert {f: t for f, t in files().items() if f in before} == before
    now = table.head().partitions
    assert [m for m in now if now[m] != first.partitions[m]] == ["2001-09"]
    rows = lambda df: sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    assert rows(read_table(spark, path).where("date_month >= '2001-08'")) == rows(one.bill_incremental())


def test_fingerprints_see_any_change_but_order(spark):
    table = VersionedTable(spark, "/nowhere", "date")
    base = frame(spark, OLD[:1], 1)
    at = lambda df: table.fingerprints(df)
    assert at(base) == at(base.orderBy(F.desc("i"))) == at(base.repartition(3).select("x", "date", "i"))
    for other in (base.union(base.limit(1)), base.where("i > 0"), base.withColumn("x", F.when(F.col("i") == 1, 1.0000000001).otherwise(F.col("x"))),
                  base.withColumn("x", F.when(F.col("i") == 1, None).otherwise(F.col("x")))):
        assert at(other) != at(base)


def test_a_full_build_resumes(spark, tmp_path):
    p = fixture_pipeline(spark, SF_SMALL)
    usage, bill = str(tmp_path / "usage"), str(tmp_path / "bill")
    steps = [f"{a:%Y-%m}_{b:%Y-%m}" for a, b in build_steps(AS_OF, 9)]
    assert steps == ["1999-11_2000-07", "2000-08_2001-04", "2001-05_2001-11"]
    built = []
    whole = facts.bill_full

    def bill_full(s01, as_of):
        built.append(1)
        if len(built) == 2:
            raise Died
        return whole(s01, as_of)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(facts, "bill_full", bill_full)
        with pytest.raises(Died):
            build_full(p, usage, bill, 9)
        assert not VersionedTable.exists(spark, usage) and not VersionedTable.exists(spark, bill)
        out = build_full(p, usage, bill, 9)             # the same build again
        assert out["steps"] == steps and out["found_done"] == steps[:1]
    assert len(built) == 2 + 2 + 1                      # two steps left, and the schema of an empty one
    rows = lambda df: sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())
    assert rows(read_table(spark, usage)) == rows(p.usage_daily()) and rows(read_table(spark, bill)) == rows(p.bill())
    assert not Ledger(spark, f"{usage}/build", "").files.names("") or not os.listdir(f"{usage}/build")
    # a second full build truncates: the table is what its own lines give
    one = p.over(p.cur.where(F.to_date("line_item_usage_start_date") == F.lit("2001-10-08").cast("date")))
    build_full(one, usage, bill, 25)
    assert partitions(spark, usage, "date") == ["2001-10-08"] and partitions(spark, bill, "date_month") == ["2001-10"]


def test_daily_increment_reports_months(spark, tmp_path):
    p = fixture_pipeline(spark, SF_SMALL)
    usage, bill = str(tmp_path / "usage"), str(tmp_path / "bill")
    build_full(p, usage, bill, 25)
    out = build_incremental(p.over(edited_cur(p.cur)), usage, bill)
    assert out["dropped_days"] == ["2001-10-15"] and out["dropped_months"] == []
    assert set(out["written_months"]) <= {"2001-08", "2001-09", "2001-10"} and "2001-11" in out["kept_months"]
    assert versions.VersionedTable(spark, usage, "date").head().number == 2
