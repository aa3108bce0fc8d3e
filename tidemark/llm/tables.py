"""Intermediate tables, row identity and input columns of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.names import whole_key
from tidemark.shared import fresh_dir

ID, TEXT, TEXT_HASH, REST = "_id", "_text", "_text_hash", "_rest"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: an executor lost later costs no recomputation, and what
    reads the table several times computes it once.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text, hash of the text and a struct of all other columns.

    Id and hash together name a row, also where ids repeat or are null; rows
    equal in both are equal in text. The other columns travel in one struct, so
    no name of theirs can clash with one of an operator's own; its first field is
    there so that it is never empty.
    """
    others = [quoted(name) for name in docs.columns if name not in (id_col, text_col)]
    filler = "_" * (1 + max(map(len, docs.columns)))
    return docs.select(
        quoted(id_col).alias(ID),
        F.xxhash64(quoted(text_col)).alias(TEXT_HASH),
        quoted(text_col).alias(TEXT),
        F.struct(F.lit(True).alias(filler), *others).alias(REST),
    )


def row_key(at: Column, dtype: str) -> list[Column]:
    """An id as two columns without nulls, ``k1`` and ``k2``: joins and grouping on them share one exchange."""
    absent = F.lit("") if dtype == "string" else F.lit(0).cast(dtype)
    return [F.coalesce(at, absent).alias("k1"), at.isNull().alias("k2")]


def spread_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows whose keys may be hot with rows that have each key once.

    ``right`` mostly comes out of an aggregate on the keys. The keys are compared
    as one struct, so that both sides are shuffled for this join and Spark can
    split a hot key's partition; null keys equal each other.
    """
    on = whole_key(keys, "l") == whole_key(keys, "r")
    others = [F.col("r." + "`" + name + "`") for name in right.columns if name not in keys]
    return left.alias("l").join(right.alias("r"), on).select("l.*", *others)


def same_row(left: DataFrame, right: DataFrame) -> Column:
    return left[ID].eqNullSafe(right[ID]) & (left[TEXT_HASH] == right[TEXT_HASH])


def other_columns(df: DataFrame, taken: set[str]) -> list[Column]:
    """The columns in the struct that no result column replaces; names that differ in case only are the same."""
    used = {name.lower() for name in taken}
    _, *names = (f.name for f in df.schema[REST].dataType.fields)
    return [F.col(REST)[name].alias(name) for name in names if name.lower() not in used]
