"""DataFrames from a handful of driver rows (a ledger row, a manifest)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_ARROW = {
    T.IntegerType(): pa.int32(),
    T.LongType(): pa.int64(),
    T.DoubleType(): pa.float64(),
    T.StringType(): pa.string(),
    T.TimestampNTZType(): pa.timestamp("us"),
}


def small_frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """Handed over as one Arrow table, which starts no Python workers; one partition."""
    table = pa.Table.from_pylist(rows, schema=pa.schema([(f.name, _ARROW[f.dataType]) for f in schema.fields]))
    return spark.createDataFrame(table, schema).coalesce(1)
