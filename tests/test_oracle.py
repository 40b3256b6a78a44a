"""Every registered query against its DuckDB oracle on the smallest test folder."""

import math

import duckdb
import pytest

from conftest import SF_SMALL
from __spark_entry__ import oracle_sql, queries

TABLES = ["lineitem", "orders", "documents", "embeddings"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(v):
    if v is None:
        return None
    try:
        import pandas as pd
        if v is pd.NA or v is pd.NaT:
            return None
    except ImportError:
        pass
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T", " ")
    return v


def table(df):
    cols = sorted(df.columns)
    return sorted((tuple(canon(x) for x in r) for r in df[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert table(got) == table(want)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["hourly_usage", "clean_lineitems", "discount_iceberg", "source_date_slice"])
def test_session_time_zone_does_not_matter(spark, con, name):
    """Calendar text is zone-free: a zone with daylight saving gives the same rows."""
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = queries()[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert table(got) == table(con.execute(oracle_sql()[name]).df())
