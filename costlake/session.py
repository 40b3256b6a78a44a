"""Session helpers.

The library never builds its own session inside operators; callers pass one in.
``local_session`` is for tests, the bench and the smoke entry only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC so date text derived from timestamps is stable;
# AQE so shuffle partition counts follow the data instead of a fixed guess.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot compiles no method over 8 KB. The per-line loop of stage 00 would be one of 15 KB: a stage
    # over the limit is generated as many small methods instead, which the JIT compiles like others.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "costlake") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # no per-call call-site capture while building large expression trees (static conf)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("COSTLAKE_DRIVER_MEMORY", "8g"))
    )
    # local runs only: a cluster names its shared folder in spark.checkpoint.dir itself, and a folder named stays
    running = SparkSession.getActiveSession()
    named = running.conf.get("spark.checkpoint.dir", None) if running else os.environ.get("COSTLAKE_CHECKPOINT_DIR")
    builder = builder.config("spark.checkpoint.dir", named or tempfile.mkdtemp(prefix="costlake-ckpt-"))
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def use_jit_limit(spark: SparkSession) -> None:
    """Give a session that has Spark's own code size limit the one of JOB_CONF, at run time; any other limit is the caller's choice and stays.

    With Spark's default the line loop of stage 00 is one method that HotSpot never compiles.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(name) == "65535":
        spark.conf.set(name, JOB_CONF[name])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is left alone; ``local_session``
    sets a scratch folder for tests.
    """
    current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for lineage cuts")
    spark.sparkContext.setCheckpointDir(current)
    return current
