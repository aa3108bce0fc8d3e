"""Reading fields out of VARIANT documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timestamps import parse_export_time, utc_wall
from tidemark.names import col


# How exports write object ids, and dates as text or as milliseconds.
_OBJECT_ID = r'^\{"\$oid":"([^"]*)"\}$'
_DATE_TEXT = r'^\{"\$date":"([^"]*)"\}$'
_DATE_MILLIS = r'^\{"\$date":(?:\{"\$numberLong":")?(-?\d+)"?\}?\}$'
_MILLIS = "ms "


def _path(field: str) -> str:
    mark = '"' if "'" in field else "'"
    return f"$[{mark}{field}{mark}]"


def _text(doc: Column, field: str) -> Column:
    return F.try_variant_get(doc, _path(field), "string")


def document_text(doc: Column, field: str) -> Column:
    """Field as text; an absent field gives null, an exported object id its digits."""
    return F.regexp_replace(_text(doc, field), _OBJECT_ID, "$1")


def document_time_text(doc: Column, field: str) -> Column:
    """Field as the text that ``parse_document_time`` reads."""
    return F.regexp_replace(F.regexp_replace(_text(doc, field), _DATE_TEXT, "$1"), _DATE_MILLIS, f"{_MILLIS}$1")


def parse_document_time(text: Column, strict: bool = True) -> Column:
    """Text in one of the known layouts, or an exported date: ISO text or milliseconds since 1970, in UTC."""
    millis = F.substring(text, len(_MILLIS) + 1, 20).try_cast("long")
    return F.when(F.startswith(text, F.lit(_MILLIS)), utc_wall(F.timestamp_millis(millis))).otherwise(
        parse_export_time(text, strict)
    )


def document_timestamp(doc: Column, field: str, strict: bool = True) -> Column:
    """Field as timestamp, see ``parse_document_time``."""
    return parse_document_time(document_time_text(doc, field), strict)


def with_document_times(df: DataFrame, doc: str, fields: dict[str, str]) -> DataFrame:
    """Adds the time of a field of each document, by name of its column.

    A document is read and its text parsed once. A filter on a projected time
    would be merged into the projection, and do both again at each mention, so
    the times come from a generator, which filters stay above.
    """
    if not fields:
        return df
    texts = {f"{name}__text": document_time_text(col(doc), field) for name, field in fields.items()}
    parsed = df.withColumns(texts).withColumns({f"{name}__time": parse_document_time(col(f"{name}__text")) for name in fields})
    given = F.array(F.struct(*[col(f"{name}__time").alias(name) for name in fields]))
    return parsed.select(*[col(c) for c in df.columns], F.inline(given))
