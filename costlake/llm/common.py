"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), whatever other columns the table has; a null text stays null."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def task_count(spark: SparkSession) -> int:
    """Shuffle partitions of the session; groups dealt out by number are a multiple of it."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the folder the cluster names. Only a session whose driver and tasks are one process (tests) gets one of its own; executors could not see it elsewhere."""
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir is not set; name a folder that the driver and all executors share")
            import tempfile

            folder = tempfile.mkdtemp(prefix="costlake-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read again; the shuffle files of the write are removed when it ends, not when the driver collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return df.sparkSession.read.parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, element by element (uint64, wraps)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
