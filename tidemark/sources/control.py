"""Control files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import CONTROL_SCHEMA, LoadSpec


def read_control(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTROL_SCHEMA).option("header", True).option("escape", '"').csv(path)


def load_specs(control: DataFrame) -> list[LoadSpec]:
    """Control rows as specs: one short row per object to load."""
    return [LoadSpec.from_control(row.asDict()) for row in control.orderBy("CONTROL_ID").collect()]
