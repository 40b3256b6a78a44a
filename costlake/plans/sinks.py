"""Fact sinks (S5-S7): full reload and restatement of a trailing window, as commits of a versioned table.

Tables are versioned (``versions.py``): data goes to a new version folder, then one pointer
names the folder of every partition. A partition that the source no longer has is not named
any more. Writes use the ``rebalance`` hint: AQE splits a skewed partition value (one huge day)
over several tasks and merges small ones, so files stay sized whatever the skew.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlake.plans.versions import Files, VersionedTable


def full_load(df: DataFrame, path: str, partition_col: str, since: str | None = None) -> None:
    """Truncate and load (optionally only values ``>= since``), in one commit."""
    if since is not None:
        df = df.where(F.col(partition_col) >= since)
    VersionedTable(df.sparkSession, path, partition_col).replace(df)


def partitions(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Partition values of the table, from its pointer (no job)."""
    return VersionedTable(spark, path, partition_col).values()


def restate(df: DataFrame, path: str, partition_col: str, since: str, changed_only: bool = False) -> dict[str, list[str]]:
    """Replace every partition ``>= since`` with the window of ``df``, written once and published in one step.

    With ``changed_only`` partitions whose fingerprint is the same keep their files. Returns the
    values written, kept and dropped.
    """
    return VersionedTable(df.sparkSession, path, partition_col).replace(df, since, changed_only)


@contextlib.contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` written under the shared ``spark.checkpoint.dir`` and read back; deleted at the end, also after a failure.

    Cuts the lineage (an executor lost later does not recompute the cleaning) and lets
    both facts be loaded from one computation of stage 01.
    """
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for intermediate tables")
    out = f"{base.rstrip('/')}/costlake/{name}-{uuid.uuid4().hex}"
    try:
        df.write.mode("overwrite").parquet(out)
        yield spark.read.parquet(out)
    finally:
        Files(spark, out).remove("")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a table written here: by its pointer, or a plain Parquet folder (a view's output).

    Partition values stay ISO text: Spark would otherwise infer ``date=2001-05-27`` as a
    DateType column, and the views compare dates as text, as the facts define them.
    """
    if VersionedTable.exists(spark, path):
        return VersionedTable(spark, path, "").read()
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        return spark.read.parquet(path)      # the file index (and partition types) is built here
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
