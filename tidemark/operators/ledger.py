"""The run ledger: one row per load of one object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import overlap_start
from tidemark.names import FAILED, SENTINEL_MARK, SUCCESS, col, ntz

# Ledger columns in order.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("run_start", T.TimestampNTZType()),
        T.StructField("run_end", T.TimestampNTZType()),
        T.StructField("duration_in_sec", T.DoubleType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("source_database_name", T.StringType()),
        T.StructField("source_schema_name", T.StringType()),
        T.StructField("source_object_name", T.StringType()),
        T.StructField("target_database_name", T.StringType()),
        T.StructField("target_schema_name", T.StringType()),
        T.StructField("target_table_name", T.StringType()),
        T.StructField("triggered_by", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("rows_inserted_ids", T.StringType()),
        T.StructField("rows_inserted", T.LongType()),
        T.StructField("rows_updated_ids", T.StringType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_deleted", T.LongType()),
        T.StructField("max_timestamp", T.TimestampNTZType()),
        T.StructField("created_timestamp", T.TimestampNTZType()),
        T.StructField("created_by", T.StringType()),
    ]
)

IDENTITY = ["source_database_name", "source_schema_name", "source_object_name"]


def succeeded() -> Column:
    return F.upper(col("status")) == SUCCESS


def has_mark() -> Column:
    """A successful run with a real mark, whether it inserted rows or only updated and deleted some."""
    return succeeded() & (col("max_timestamp") != ntz(SENTINEL_MARK))


def is_valid_mark() -> Column:
    """The narrower rule of the look-up operators: the run must have inserted rows."""
    return succeeded() & (col("max_timestamp") != ntz(SENTINEL_MARK)) & (col("rows_inserted") != 0)


def object_runs(ledger: DataFrame, identity: tuple[str, str, str]) -> DataFrame:
    for name, value in zip(IDENTITY, identity):
        ledger = ledger.filter(col(name) == value)
    return ledger


def valid_marks(ledger: DataFrame) -> DataFrame:
    """Successful runs that inserted rows and carry a real mark."""
    return ledger.filter(is_valid_mark())


def _latest_mark(minutes: int) -> Column:
    return overlap_start(F.max_by("max_timestamp", "run_id"), minutes).alias("read_from")


def watermark_lookup(ledger: DataFrame, identity: tuple[str, str, str], minutes: int = 10) -> DataFrame:
    """Where the next incremental read of one object starts; null without a valid run."""
    return valid_marks(object_runs(ledger, identity)).agg(_latest_mark(minutes))


def watermark_per_object(ledger: DataFrame, minutes: int = 10) -> DataFrame:
    """The same for every object of the ledger in one aggregate."""
    return valid_marks(ledger).groupBy(*IDENTITY).agg(_latest_mark(minutes))


def last_success_time(ledger: DataFrame, identity: tuple[str, str, str] | None = None) -> DataFrame:
    """Creation time of the latest successful run, for one object or for each."""
    good = ledger.filter(succeeded())
    latest = F.max_by("created_timestamp", "run_id").alias("last_success")
    if identity is None:
        return good.groupBy(*IDENTITY).agg(latest)
    return object_runs(good, identity).agg(latest)


def next_run_id(ledger: DataFrame) -> DataFrame:
    return ledger.agg((F.coalesce(F.max("run_id"), F.lit(0)) + 1).alias("run_id"))


def failure_summary(ledger: DataFrame, job: list[str], block: int = 65536) -> DataFrame:
    """Failed objects and reasons of each job, numbered from 1 in run order.

    Numbering counts per block of run ids first and offsets each block by the
    count before it, so no task sorts more than ``block`` rows of one job.
    """
    failed = ledger.filter(F.upper(col("status")) == FAILED).select(
        *job, "run_id", "source_object_name", "error_message"
    )
    in_blocks = failed.withColumn("__block", col("run_id") - F.pmod(col("run_id"), F.lit(block)))
    sizes = in_blocks.groupBy(*job, "__block").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy(*job).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*job, "__block", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*job, "__block").orderBy("run_id")
    return (
        in_blocks.withColumn("__at", F.row_number().over(inside))
        .join(offsets, [*job, "__block"])
        .select(
            *job,
            (col("__before") + col("__at")).alias("failure_no"),
            "run_id",
            "source_object_name",
            "error_message",
        )
    )
