"""Types of text columns, found in the pass that stages them.

Each column keeps the narrowest type that all its values can be cast to. What a
column can be is an aggregate over its values, and Spark gathers such aggregates
while it writes, so a file is opened once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import col

#: from narrow to wide; what fits none is text
LATTICE = ("int", "bigint", "double", "date", "timestamp_ntz", "boolean")
# a fraction, an exponent or a time of day is not what these casts may drop
_SHAPES = {
    "int": r"^\s*[+-]?\d+\s*$",
    "bigint": r"^\s*[+-]?\d+\s*$",
    "double": r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$",
    "date": r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$",
    "timestamp_ntz": r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?\s*$",
    "boolean": r"^\s*(?i:true|false)\s*$",
}


def fits(text: Column, dtype: str) -> Column:
    return text.isNull() | (text.rlike(_SHAPES[dtype]) & text.try_cast(dtype).isNotNull())


def _fitting(names: list[str]) -> list[Column]:
    found = [F.count(F.lit(1)).alias("rows")]
    for at, name in enumerate(names):
        found.append(F.count(col(name)).alias(f"c{at}"))
        found += [F.coalesce(F.bool_and(fits(col(name), dtype)), F.lit(True)).alias(f"c{at}_{dtype}") for dtype in LATTICE]
    return found


def _types(names: list[str], found: dict) -> dict[str, str]:
    """The first type of the lattice that fits; a column without values is text."""
    return {
        name: next((dtype for dtype in LATTICE if found[f"c{at}"] and found[f"c{at}_{dtype}"]), "string")
        for at, name in enumerate(names)
    }


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, every column as text; only the header is read here."""
    return spark.read.option("header", True).csv(path)


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def as_types(text: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns as the types that were found for them; other columns stay."""
    read = {name: F.trim(col(name)).cast(dtype) for name, dtype in types.items() if dtype != "string"}
    return text.select(*[read.get(name, col(name)).alias(name) for name in text.columns])


def stage_inferred(text: DataFrame, path: str) -> tuple[DataFrame, dict[str, str]]:
    """Write rows as Parquet and find the types of their text columns in the same pass; the typed rows, and the types."""
    names, seen = _texts(text), Observation()
    text.observe(seen, *_fitting(names)).write.mode("overwrite").parquet(path)
    types = _types(names, seen.get)
    return as_types(text.sparkSession.read.schema(text.schema).parquet(path), types), types


def infer_types(text: DataFrame) -> dict[str, str]:
    """The same for text columns that are staged already: one aggregate."""
    names = _texts(text)
    return _types(names, text.agg(*_fitting(names)).first().asDict())
