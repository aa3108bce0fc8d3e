"""Column selection, typing and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import TIME_TEXT, time_of_day, timestamp_text
from tidemark.names import INSERTED_AT, UPDATED_AT, col, ntz, split_names


def project_columns(df: DataFrame, columns: str | list[str] | tuple[str, ...] | None) -> DataFrame:
    """'*' or None keeps every column; a comma list or a sequence keeps those named."""
    if columns is None or columns == "*":
        return df
    names = split_names(columns) if isinstance(columns, str) else columns
    return df.select(*[col(n) for n in names])


def project_keys(df: DataFrame, keys: str | list[str] | tuple[str, ...]) -> DataFrame:
    names = split_names(keys) if isinstance(keys, str) else keys
    return df.select(*[col(n) for n in names])


def _json(column: Column, dtype: T.DataType, lenient: bool) -> Column:
    """JSON text as the object it spells; a value that is one already stays as it is."""
    if isinstance(dtype, T.VariantType):
        return column
    if isinstance(dtype, T.StringType):
        return F.try_parse_json(column) if lenient else F.parse_json(column)
    return F.to_variant_object(column) if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)) else column.cast("variant")


def _time(column: Column, dtype: T.DataType, lenient: bool) -> Column:
    """Time of day of a timestamp, or of text with a time alone or behind a date."""
    if isinstance(dtype, T.StringType):
        column = F.when(column.rlike(TIME_TEXT), F.concat(F.lit("1970-01-01 "), column)).otherwise(column)
    return time_of_day(column.try_cast("timestamp_ntz") if lenient else column.cast("timestamp_ntz"))


#: pseudo type of a column of Spark's own TIME type, which ``spark.sql.timeType.enabled`` makes available
NATIVE_TIME = "time(6)"


def _typed(source: Column, given: T.DataType, dtype: str, lenient: bool) -> Column:
    if dtype in ("time", NATIVE_TIME):
        text = _time(source, given, lenient)
        return text if dtype == "time" else text.cast(NATIVE_TIME)
    if dtype in ("json", "variant"):
        return _json(source, given, lenient)
    return source.try_cast(dtype) if lenient else source.cast(dtype)


def typed_projection(df: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Cast each listed column to its type and keep its name.

    A value that does not fit raises under ANSI mode; ``lenient`` makes it null.
    The pseudo type 'time' gives the time of day as text, 'time(6)' as Spark's own
    type, and 'json' (or 'variant') parses JSON text into an object.
    """
    given = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(*[_typed(col(name), given[name.lower()], dtype, lenient).alias(name) for name, dtype in types.items()])


REASONS = "tidemark_reasons"


def rejecting_projection(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The typed columns, null where a value does not fit, and why in ``REASONS``.

    That is an array of (column, text, type), one for each value that is there but
    is none of its type; it is empty for a good row.
    """
    given = {f.name.lower(): f.dataType for f in df.schema.fields}
    typed = {name: _typed(col(name), given[name.lower()], dtype, True) for name, dtype in types.items()}
    reasons = []
    for name, value in typed.items():
        nested = isinstance(given[name.lower()], (T.VariantType, T.StructType, T.ArrayType, T.MapType))
        text = F.to_json(F.struct(col(name))) if nested else col(name).cast("string")
        reason = F.struct(F.lit(name).alias("column"), text.alias("text"), F.lit(types[name]).alias("type"))
        reasons.append(F.when(col(name).isNotNull() & value.isNull(), reason))
    found = F.filter(F.array(*reasons), lambda reason: reason.isNotNull())
    return df.select(*[value.alias(name) for name, value in typed.items()], found.alias(REASONS))


def timestamps_as_text(df: DataFrame) -> DataFrame:
    """Every timestamp column as text with six fraction digits."""
    stamps = (T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            timestamp_text(col(f.name)).alias(f.name) if isinstance(f.dataType, stamps) else col(f.name)
            for f in df.schema.fields
        ]
    )


def with_audit_columns(df: DataFrame, run_ts: str | Column) -> DataFrame:
    """Rows that are new as of ``run_ts``."""
    return df.withColumns({INSERTED_AT: ntz(run_ts), UPDATED_AT: F.lit(None).cast("timestamp_ntz")})
