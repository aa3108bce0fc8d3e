"""Source type names, their warehouse types and the Spark types we store.

Which source type becomes which warehouse type is control data: a CSV with a
column per dialect, read by ``read_mapping``. No such table is built in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.names import col

MAPPING_SCHEMA = "dialect string, source_type string, warehouse_type string, row_no long"

# Spark storage type of each warehouse type. 'json' and 'time' are pseudo types
# of ``typed_projection``. A bare decimal is (10,0) in Spark and would cut
# fractions, so precision is always written out.
SPARK_TYPES = {
    "number": "bigint",
    "decimal": "decimal(38,18)",
    "float": "double",
    "varchar": "string",
    "binary": "binary",
    "object": "json",
    "timestamp_ntz": "timestamp_ntz",
    "timestamp_tz": "timestamp",
    "date": "date",
    "time": "time",
    "geometry": "string",
    "boolean": "boolean",
}


def read_mapping(spark: SparkSession, path: str, warehouse_column: str) -> DataFrame:
    """Mapping rows from a CSV file with one column per dialect and one for the warehouse type.

    ``row_no`` ascends from the top of the file, which must be one: of several there
    is no first. Empty cells are no mapping.
    """
    lines = spark.read.option("header", True).csv(path)
    if len(lines.inputFiles()) > 1:
        raise ValueError(f"a mapping is one file, {path} has several")
    lines = lines.withColumn("__row", F.monotonically_increasing_id())
    dialects = [c for c in lines.columns if c not in (warehouse_column, "__row")]
    cells = F.explode(
        F.array(*[F.struct(F.lit(d).alias("dialect"), col(d).alias("source_type")) for d in dialects])
    ).alias("cell")
    rows = lines.select(cells, col(warehouse_column).alias("warehouse_type"), col("__row").alias("row_no"))
    return rows.select("cell.*", "warehouse_type", "row_no").where("source_type is not null")


def storage_type(warehouse_type: str, precision: int | None = None, scale: int | None = None) -> str:
    """Spark type, or pseudo type, of a warehouse type; decimals keep the precision their source declares."""
    if warehouse_type == "decimal" and precision and precision <= 38:
        return f"decimal({precision},{scale or 0})"
    if warehouse_type not in SPARK_TYPES:
        raise ValueError(f"unknown warehouse type {warehouse_type!r}")
    return SPARK_TYPES[warehouse_type]


def stored_as(dtype: str) -> str:
    """The type of a target column for a storage type."""
    return {"json": "variant", "time": "string"}.get(dtype, dtype)
