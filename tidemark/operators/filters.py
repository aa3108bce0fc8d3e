"""Predicates of the incremental and audit reads.

They are plain column comparisons, so Catalyst hands them to the JDBC or
Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame

from tidemark.functions.documents import with_document_times
from tidemark.names import INSERTED_AT, UPDATED_AT, col, ntz


def changed_since(df: DataFrame, mark: str | Column, inserted: str, updated: str | None) -> DataFrame:
    """Rows inserted or updated strictly after the mark; null times never qualify."""
    mark = ntz(mark)
    if updated is None or updated == inserted:
        return df.filter(col(inserted) > mark)
    return df.filter((col(inserted) > mark) | (col(updated) > mark))


def inserted_since(df: DataFrame, mark: str | Column, inserted: str) -> DataFrame:
    """The deleted-rows feed carries one time column only."""
    return df.filter(col(inserted) > ntz(mark))


def documents_changed_since(
    df: DataFrame, mark: str | Column, doc: str, inserted: str | None, updated: str | None = None
) -> DataFrame:
    """As ``changed_since`` by fields of the documents; either may be missing, without both all stay."""
    fields = [f for f in dict.fromkeys((inserted, updated)) if f]
    times = {f"__changed_{at}": field for at, field in enumerate(fields)}
    return any_later(with_document_times(df, doc, times), mark, list(times)).drop(*times)


def any_later(df: DataFrame, mark: str | Column, times: list[str]) -> DataFrame:
    """Rows with a time after the mark in one of the columns; without columns all stay."""
    later = [col(t) > ntz(mark) for t in times]
    return df.filter(reduce(lambda a, b: a | b, later)) if later else df


def audited_since(df: DataFrame, since: str | Column, action: str) -> DataFrame:
    """Target rows inserted ('insert') or updated ('update') at or after ``since``."""
    stamp = {"insert": INSERTED_AT, "update": UPDATED_AT}[action]
    return df.filter(col(stamp) >= ntz(since))
