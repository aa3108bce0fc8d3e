"""Counts and extremes of staged Parquet from the footers of its files.

Spark's second Parquet reader answers MAX, MIN and COUNT without a filter from
what each file's footer says of its row groups; no row is decoded. It keeps such
statistics of numbers but not of timestamps, so times are staged once more as
microseconds.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.comparison import any_null
from tidemark.functions.timestamps import wall_micros
from tidemark.names import col

#: staged columns, named as no source column is likely to be
AT, KEYLESS = "tidemark_at", "tidemark_keyless"
MEASURES = f"{AT} long, {KEYLESS} int"
#: stands for no time: footers say nothing of a column of nulls
NEVER = -(1 << 63)


def footer_aggregate(spark: SparkSession, path: str, schema: str, *aggregates: Column) -> DataFrame:
    """Aggregates without groups or filters over all files below a path; ``schema`` has the first columns of the files."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    return reader.read.schema(schema).parquet(path).agg(*aggregates)


def with_measures(df: DataFrame, times: list[str] | tuple[str, ...], keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Puts each row's newest time as microseconds, and 1 where its key holds a null, before its columns.

    The reader finds a column's statistics by its place, so those it is asked for come first.
    """
    stamps = [col(t).cast("timestamp_ntz") for t in times]
    newest = F.greatest(*stamps) if len(stamps) > 1 else stamps[0] if stamps else F.lit(None).cast("timestamp_ntz")
    keyless = any_null([col(k) for k in keys]).cast("int") if keys else F.lit(0)
    micros = F.coalesce(wall_micros(newest), F.lit(NEVER))
    return df.select(micros.alias(AT), keyless.alias(KEYLESS), *[col(c) for c in df.columns])


def measured(spark: SparkSession, path: str) -> tuple[datetime | None, int, bool]:
    """Newest time of a staged batch, its rows, and whether some have a null in their key."""
    newest, rows, keyless = footer_aggregate(
        spark, path, MEASURES, F.max(AT), F.coalesce(F.count(F.lit(1)), F.lit(0)), F.max(KEYLESS)
    ).first()
    at = None if newest in (None, NEVER) else datetime(1970, 1, 1) + timedelta(microseconds=newest)
    return at, rows or 0, bool(keyless)
