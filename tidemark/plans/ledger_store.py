"""The run ledger on storage: append-only Parquet, one writer per ledger."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import overlap_start
from tidemark.names import FAILED, SENTINEL_MARK, SUCCESS, col
from tidemark.operators.ledger import IDENTITY, LEDGER_SCHEMA, has_mark, next_run_id, succeeded
from tidemark.plans.small import small_frame


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def local_clock(zone: str):
    """A clock for ``Lake`` that gives the wall clock of a time zone."""
    return lambda: datetime.now(ZoneInfo(zone)).replace(tzinfo=None)


def sentinel() -> datetime:
    return datetime.fromisoformat(SENTINEL_MARK)


@dataclass(frozen=True)
class LoadState:
    """Id of the next run, newest committed run of the target and its stamp, stored mark, start of the next read."""

    run_id: int
    committed: int | None
    stamp: datetime | None
    mark: datetime | None
    read_from: datetime | None


@dataclass(frozen=True)
class LedgerStore:
    spark: SparkSession
    path: str

    def create(self) -> None:
        """Make the ledger if there is none yet."""
        small_frame(self.spark, [], LEDGER_SCHEMA).write.mode("ignore").parquet(self.path)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)

    def next_run_id(self) -> int:
        return next_run_id(self.rows()).first()["run_id"]

    def states(self, wanted: list[tuple[tuple[str, str, str], str]], minutes: int) -> list[LoadState]:
        """What loads must know before they start, for each identity and target, in one read of the ledger.

        One row for each object of the ledger reaches the driver. Run ids are given
        out in the order asked for. Any successful run with a mark counts: one that
        only updated or deleted rows has read up to its mark as well.
        """
        run, marked = col("run_id"), has_mark()
        mark = F.max_by("max_timestamp", F.when(marked, run))
        held = (
            self.rows()
            .groupBy(*IDENTITY, "target_table_name")
            .agg(
                F.max(run).alias("run_id"),
                F.max(F.when(succeeded(), run)).alias("committed"),
                F.max(F.when(succeeded(), col("run_start"))).alias("stamp"),
                F.max(F.when(marked, run)).alias("marked"),
                F.when(F.bool_or(marked), mark).alias("mark"),
                F.when(F.bool_or(marked), overlap_start(mark, minutes)).alias("read_from"),
            )
            .collect()
        )
        first = max((row["run_id"] for row in held), default=0) + 1
        found = []
        for at, (identity, target) in enumerate(wanted):
            written = [r for r in held if r["target_table_name"] == target.upper() and r["committed"] is not None]
            read = [r for r in held if tuple(r[n] for n in IDENTITY) == identity and r["marked"] is not None]
            last = max(read, key=lambda r: r["marked"], default=None)
            found.append(
                LoadState(
                    run_id=first + at,
                    committed=max((r["committed"] for r in written), default=None),
                    stamp=max((r["stamp"] for r in written), default=None),
                    mark=last and last["mark"],
                    read_from=last and last["read_from"],
                )
            )
        return found

    def state(self, identity: tuple[str, str, str], target: str, minutes: int) -> LoadState:
        return self.states([(identity, target)], minutes)[0]

    def append(self, rows: list[dict]) -> None:
        """Add the rows of runs, as one file; refused if another writer has taken an id meanwhile."""
        first = min(row["run_id"] for row in rows)
        if self.next_run_id() > first:
            raise RuntimeError(f"run {first} is already in the ledger: a lake has one writer at a time")
        small_frame(self.spark, rows, LEDGER_SCHEMA).write.mode("append").parquet(self.path)

    def committed_run(self, target: str) -> int | None:
        """Newest successful run of a target: the version readers see."""
        done = self.rows().filter(succeeded() & (col("target_table_name") == target.upper()))
        return done.agg(F.max("run_id").alias("run_id")).first()["run_id"]


def ledger_row(spec, run_id: int, started: datetime, finished: datetime, **outcome) -> dict:
    """A ledger row; the caller's clock gives both times and the creation time."""
    database, schema, name = spec.identity
    row = {
        "run_id": run_id,
        "run_start": started,
        "run_end": finished,
        "duration_in_sec": (finished - started).total_seconds(),
        "source_database_name": database,
        "source_schema_name": schema,
        "source_object_name": name,
        "target_table_name": spec.target.upper(),
        "status": SUCCESS,
        "error_message": "-",
        "rows_inserted": 0,
        "rows_updated": 0,
        "rows_deleted": 0,
        "max_timestamp": sentinel(),
        "created_timestamp": finished,
    }
    row.update(outcome)
    return row


def failed_row(
    spec, run_id: int, started: datetime, finished: datetime, error: BaseException, step: str
) -> dict:
    """A failed run: zero counts and the sentinel mark, so no later read starts from it."""
    reason = f"{step}: {type(error).__name__}: {error}"
    return ledger_row(spec, run_id, started, finished, status=FAILED, error_message=reason)
