"""Latest row per key.

The rank filter plans as a window group limit on both sides of the shuffle:
each map task sends at most one row per key, so a key that holds a third of
all rows still moves only as many rows as there are map tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.comparison import comparable
from tidemark.functions.documents import document_text, with_document_times
from tidemark.functions.timestamps import effective_timestamp
from tidemark.names import col

_RANK = "__rank"


def latest_per_key(
    df: DataFrame,
    keys: list[str] | tuple[str, ...],
    inserted: str | None,
    updated: str | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """One row per key: greatest ``coalesce(updated, inserted)``, nulls last.

    Without an insert time only the tiebreak decides.

    Ties fall to ``tiebreak`` (ascending), by default all remaining columns, so
    the choice is the same on every run and on every task retry. Rows with null
    keys form one group per null pattern.
    """
    order = []
    if inserted:
        newest = effective_timestamp(col(updated), col(inserted)) if updated else col(inserted)
        order.append(newest.desc_nulls_last())
    types = {f.name: f.dataType for f in df.schema.fields}
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys]
    order += [comparable(col(c), types[c]).asc_nulls_last() for c in tiebreak]
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*(order or [col(k) for k in keys]))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def typed_documents(
    df: DataFrame, doc: str, keys: dict[str, str], inserted: str | None, updated: str | None
) -> tuple[DataFrame, list[str]]:
    """Documents with their key fields as text columns and their times as ``__ins`` and ``__upd``.

    ``keys`` gives the column for each field. Returns the names of the time
    columns too; a field that serves as both times is one.
    """
    fields = {"__ins": inserted, "__upd": updated if updated != inserted else None}
    times = {name: field for name, field in fields.items() if field}
    texts = {name: document_text(col(doc), field) for field, name in keys.items()}
    return with_document_times(df.withColumns(texts), doc, times), list(times)


def latest_document_per_key(
    df: DataFrame,
    doc: str,
    key: str,
    inserted: str | None,
    updated: str | None = None,
    tiebreak: list[str] | None = None,
    key_as: str = "doc_key",
) -> DataFrame:
    """Latest document per key field; adds the key as the text column ``key_as``.

    A variant cannot be ordered or hashed, so key and times are extracted first.
    Times compare as timestamps; either may be missing. Remaining ties fall to
    the document text.
    """
    typed, times = typed_documents(df, doc, {key: key_as}, inserted, updated)
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c != doc] + [doc]
    return latest_per_key(typed, [key_as], *newest_first(times), tiebreak).drop(*times)


def newest_first(times: list[str]) -> tuple[str | None, str | None]:
    """Insert and update column of ``latest_per_key`` for the times there are."""
    return (times[0], times[1] if len(times) > 1 else None) if times else (None, None)
