"""Run the daily restatement whenever new CUR files land (Structured Streaming trigger).

The billing feed is not an append-only log: lines change weeks later, so the answer to late
data is to restate a trailing window (S6, S7), not a watermark. This module only turns
"new files arrived in the CUR folder" into a restatement run: a file-source stream over
the CUR drop folder, and ``foreachBatch`` that restates both facts from the CUR table
(partition-pruned to the months the window touches). The stream's checkpoint records
which files were seen, so a restarted driver neither misses nor repeats a delivery.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from costlake.plans.pipeline import Pipeline, build_incremental
from costlake.sources.dims import Dims


def _utc_today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def start_restatement_stream(spark: SparkSession, cur_path: str, cur_schema: StructType, usage_path: str,
                             bill_path: str, checkpoint: str, dims: Dims, as_of: Callable[[], dt.date] = _utc_today,
                             tags: Mapping[str, str] | None = None,
                             available_now: bool = True, interval: str = "1 hour") -> StreamingQuery:
    """Start the stream. ``available_now`` processes what has landed and stops (a daily job);
    otherwise it polls every ``interval``. ``cur_schema`` includes the ``year``/``month``
    partition columns of the drop folder."""
    drops = spark.readStream.schema(cur_schema).parquet(cur_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        cur = spark.read.schema(cur_schema).parquet(cur_path)
        build_incremental(Pipeline(spark, cur, as_of(), dims, dict(tags or {})), usage_path, bill_path)

    writer = drops.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
