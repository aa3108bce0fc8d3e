"""High-water marks and counts of a batch: one partial aggregate, one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.documents import with_document_times
from tidemark.names import SENTINEL_MARK, col, ntz


def greatest_time(times: list[Column]) -> Column:
    """Greatest of all times; always without a time zone, as the driver would shift others."""
    latest = [F.max(time.cast("timestamp_ntz")) for time in times]
    if not latest:
        return F.lit(None).cast("timestamp_ntz")
    return F.greatest(*latest) if len(latest) > 1 else latest[0]


def high_water_mark(df: DataFrame, inserted: str, updated: str | None = None) -> DataFrame:
    """Greatest insert or update time; null for an empty batch."""
    names = [name for name in dict.fromkeys((inserted, updated)) if name]
    return df.agg(greatest_time([col(name) for name in names]).alias("max_timestamp"))


def document_high_water_mark(df: DataFrame, doc: str, inserted: str | None, updated: str | None = None) -> DataFrame:
    """The same by fields of the documents; null if they have no times."""
    fields = [field for field in dict.fromkeys((inserted, updated)) if field]
    times = {f"__time_{at}": field for at, field in enumerate(fields)}
    return with_document_times(df, doc, times).agg(greatest_time([col(t) for t in times]).alias("max_timestamp"))


def incremental_mark(df: DataFrame, inserted: str) -> DataFrame:
    """Greatest insert time alone, or the sentinel mark for an empty batch."""
    return df.agg(F.coalesce(greatest_time([col(inserted)]), ntz(SENTINEL_MARK)).alias("max_timestamp"))


def batch_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), (F.count(F.lit(1)) == 0).alias("is_empty"))
