"""New or changed rows of an object that has no modified-date column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.comparison import row_fingerprint
from tidemark.names import col

_HASH = "__fingerprint"


def _fingerprint(df: DataFrame, names: list[str], legacy: bool) -> Column:
    """32 bytes, never null: a null check would make the scan compute it twice."""
    return F.coalesce(F.unhex(row_fingerprint(df, names, legacy)), F.lit(b"")).alias(_HASH)


def new_rows(
    current: DataFrame, snapshot: DataFrame, legacy: bool = False, copies_per_task: int = 100_000
) -> DataFrame:
    """Rows of ``current`` that the snapshot does not hold; copies are all kept.

    Copies of a row are counted before the shuffle, so a row repeated through a
    third of the table costs one row per map task. What is new is then spread
    over tasks in portions of ``copies_per_task`` and unfolded there. Both sides
    are grouped by fingerprint, so the join adds no shuffle of its own.

    Legacy fingerprints can be equal for different rows, which must not be
    folded into one: they are joined as they are.
    """
    names = current.columns
    known = snapshot.select(_fingerprint(snapshot, names, legacy)).distinct()
    hashed = current.select(
        _fingerprint(current, names, legacy),
        F.struct(*[col(c) for c in names]).alias("row"),
    )
    if legacy:
        return hashed.join(known, _HASH, "left_anti").select("row.*")
    folded = hashed.groupBy(_HASH).agg(F.any_value("row").alias("row"), F.count(F.lit(1)).alias("n"))
    fresh = folded.join(known, _HASH, "left_anti")
    starts = F.sequence(F.lit(0).cast("long"), col("n") - 1, F.lit(copies_per_task).cast("long"))
    portions = fresh.select("row", "n", F.explode(starts).alias("start")).hint("rebalance")
    here = F.least(col("n") - col("start"), F.lit(copies_per_task)).cast("int")
    return portions.select(F.explode(F.array_repeat("row", here)).alias("row")).select("row.*")
