"""Small fixed tables as local relations.

``spark.createDataFrame(list)`` ships the rows as an RDD, and broadcasting it runs a job.
A ``VALUES`` table is a local relation: built with one call, broadcast straight from the
driver, no job. Meant for tables of a few hundred rows (seeds, templates, curated maps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MAX_ROWS = 10_000


def _lit(v, ty: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {ty.simpleString()})"
    if isinstance(ty, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(ty, T.BooleanType):
        return "TRUE" if v else "FALSE"
    return f"CAST({v!r} AS {ty.simpleString()})"


def local_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    if len(rows) > MAX_ROWS:
        raise ValueError(f"local_table is for small fixed tables, got {len(rows)} rows")
    fields = schema.fields
    values = ", ".join("(" + ", ".join(_lit(v, f.dataType) for v, f in zip(r, fields)) + ")" for r in rows)
    names = ", ".join(f"`{f.name}`" for f in fields)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")
