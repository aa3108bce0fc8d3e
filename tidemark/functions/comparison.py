"""Row comparison and fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import col


def _holds(dtype: T.DataType, kinds: tuple[type, ...]) -> bool:
    if isinstance(dtype, kinds):
        return True
    if isinstance(dtype, T.ArrayType):
        return _holds(dtype.elementType, kinds)
    if isinstance(dtype, T.MapType):
        return _holds(dtype.keyType, kinds) or _holds(dtype.valueType, kinds)
    if isinstance(dtype, T.StructType):
        return any(_holds(f.dataType, kinds) for f in dtype.fields)
    return False


def comparable(column: Column, dtype: T.DataType) -> Column:
    """A form of the column that Spark can compare, order and hash.

    Variants and maps can do none of these; their JSON text can (variant JSON
    has sorted keys, map entries are sorted here).
    """
    if isinstance(dtype, T.MapType) and not _holds(dtype.valueType, (T.MapType, T.VariantType)):
        return F.array_sort(F.map_entries(column))
    if _holds(dtype, (T.VariantType, T.MapType)):
        return F.to_json(column)
    return column


def any_null(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns])


def rows_differ(pairs: list[tuple[Column, Column, T.DataType]]) -> Column:
    """Null-safe inequality of two rows, column by column.

    A hash of all columns would miss a value moving between two null columns.
    """
    unequal = [~comparable(a, t).eqNullSafe(comparable(b, t)) for a, b, t in pairs]
    return reduce(lambda a, b: a | b, unequal) if unequal else F.lit(False)


def _canonical_text(column: Column, dtype: T.DataType) -> Column:
    if _holds(dtype, (T.MapType, T.VariantType, T.StructType, T.ArrayType)):
        return F.to_json(F.struct(comparable(column, dtype).alias("v")))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # 0.0 equals -0.0 but prints differently
        column = F.when(column == 0, F.lit(0).cast(dtype)).otherwise(column)
    if isinstance(dtype, T.BinaryType):
        return F.hex(column)
    return column.cast("string")


def row_fingerprint(df: DataFrame, columns: list[str] | None = None, legacy: bool = False) -> Column:
    """SHA-256 of a row.

    ``legacy`` joins the values with '_' and skips nulls, so ('a', null, 'b')
    equals ('a', 'b', null). The default writes each value with its length, and
    nulls as a mark of their own, so different rows give different texts.
    """
    names = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    if legacy:
        return F.sha2(F.concat_ws("_", *[col(n).cast("string") for n in names]), 256)
    parts = []
    for name in names:
        text = _canonical_text(col(name), types[name])
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    return F.sha2(F.concat_ws("|", *parts), 256)
