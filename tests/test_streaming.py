"""The restatement stream: files landing in the CUR folder restate both facts once."""

from conftest import SF_SMALL
from costlake.plans.sinks import partitions
from costlake.sources.dims import load_dims
from costlake.sources.fixture import AS_OF, cur_from_lineitem
from costlake.streaming.restate import start_restatement_stream


def test_stream_restates_on_new_files(spark, tmp_path):
    cur_path = str(tmp_path / "cur")
    cur = cur_from_lineitem(spark, SF_SMALL)
    cur.write.partitionBy("year", "month").parquet(cur_path)
    schema = spark.read.parquet(cur_path).schema
    usage, bill = str(tmp_path / "usage"), str(tmp_path / "bill")
    q = start_restatement_stream(spark, cur_path, schema, usage, bill, str(tmp_path / "ckpt"), load_dims(spark), as_of=lambda: AS_OF)
    q.awaitTermination(300)
    days = partitions(spark, usage, "date")
    months = partitions(spark, bill, "date_month")
    assert days and min(days) >= "2001-08-31" and max(days) <= "2001-11-04"
    assert months == ["2001-08", "2001-09", "2001-10", "2001-11"]
    # nothing new: a second run finds no files and leaves the tables alone
    q2 = start_restatement_stream(spark, cur_path, schema, usage, bill, str(tmp_path / "ckpt"), load_dims(spark), as_of=lambda: AS_OF)
    q2.awaitTermination(300)
    assert partitions(spark, usage, "date") == days
