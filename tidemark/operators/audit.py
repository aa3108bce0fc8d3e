"""Keys a run inserted or updated, as rows instead of text in the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.names import INSERTED_AT, UPDATED_AT, col, ntz
from tidemark.operators.filters import audited_since


def audit_keys(
    target: DataFrame, keys: list[str] | tuple[str, ...], since: str | Column, action: str, run_id: int
) -> DataFrame:
    """Keys with the given action at or after ``since``; no rows if there are none."""
    rows = audited_since(target, since, action)
    return rows.select(
        F.lit(run_id).cast("long").alias("edw_run_id"), F.lit(action).alias("edw_action"), *[col(k) for k in keys]
    )


def audit_of_run(target: DataFrame, keys: list[str] | tuple[str, ...], run_ts: str | Column, run_id: int) -> DataFrame:
    """Keys that the run with exactly this stamp inserted or updated, in one pass; no row is both."""
    inserted, updated = (col(name).eqNullSafe(ntz(run_ts)) for name in (INSERTED_AT, UPDATED_AT))
    action = F.when(inserted, "insert").otherwise("update").alias("edw_action")
    names = [col(k) for k in keys]
    return target.filter(inserted | updated).select(F.lit(run_id).cast("long").alias("edw_run_id"), action, *names)
