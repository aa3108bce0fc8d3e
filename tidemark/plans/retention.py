"""Removal of what no reader needs any more.

A lake keeps the newest committed runs of each target. Stages of older runs go,
and so do versions that no kept run shows. A run that is being written is newer
than all committed ones and is left alone. Audit rows stay: they are the record of
what each run did.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.names import col
from tidemark.operators.ledger import succeeded
from tidemark.plans import folders
from tidemark.plans.loads import Lake
from tidemark.sources.staging import run_path
from tidemark.spec import LoadSpec

STAGES = ("batch", "snapshot", "deleted", "deleted_new", "rejects", "typed")


def _runs(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the ``run_id=<number>`` folders."""
    parts = (name.partition("=") for name in folders.names(spark, folder))
    return sorted(int(number) for label, _, number in parts if label == "run_id" and number.isdigit())


def retire_stage(spark: SparkSession, stage: str, newest: int, keep: int) -> list[int]:
    """Remove all staged runs up to ``newest`` but the last ``keep`` of them; their ids."""
    gone = [run for run in _runs(spark, stage) if run <= newest - keep]
    for run in gone:
        folders.remove(spark, run_path(stage, run))
    return gone


def retire(lake: Lake, spec: LoadSpec, keep: int = 2) -> dict[str, list[int]]:
    """Keep the newest ``keep`` committed runs of an object; the ids removed, by kind of folder."""
    if keep < 1:
        raise ValueError("the committed run must stay")
    done = lake.ledger.rows().filter(succeeded() & (col("target_table_name") == spec.target.upper()))
    kept = [row["run_id"] for row in done.select("run_id").orderBy(F.desc("run_id")).limit(keep).collect()]
    if not kept:
        return {}
    table, oldest = lake.table(spec), min(kept)
    held = {table.version(run).run_id for run in kept}
    found = {kind: retire_stage(lake.spark, lake.stage(spec, kind), oldest - 1, 0) for kind in STAGES}
    found["tables"] = [run for run in _runs(lake.spark, table.root) if run < oldest and run not in held]
    for run in found["tables"]:
        table.drop(run)
    return {kind: runs for kind, runs in found.items() if runs}
