"""Staged batches: one ``run_id=`` partition per run.

The current batch is a partition filter and older partitions are the archive,
so nothing is moved, and a failed run can be written again in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import col


def run_path(stage: str, run_id: int) -> str:
    return f"{stage}/run_id={run_id}"


def stage_batch(df: DataFrame, stage: str, run_id: int) -> DataFrame:
    """Write the batch once and read it back.

    Later steps read these files, so the source is read once per run and lost
    executors recompute from storage rather than from a source that moved on.
    """
    path = run_path(stage, run_id)
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_document_chunks(df: DataFrame, path: str, per_file: int) -> None:
    """JSON lines, at most ``per_file`` documents in each file."""
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def write_full_chunks(df: DataFrame, path: str, per_file: int, numbered: str) -> None:
    """JSON lines, exactly ``per_file`` documents in each file but one, which has the rest.

    Rows are numbered without bringing them together: they are written to
    ``numbered`` with their place in their task, tasks are counted, and the counts
    before each task, one row a task, give its first number.
    """
    place, chunk = "__place", "__chunk"
    df.withColumn(place, F.monotonically_increasing_id()).write.mode("overwrite").parquet(numbered)
    placed = df.sparkSession.read.parquet(numbered).withColumn("__task", F.shiftright(col(place), 33))
    order = Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("__task").agg(F.count(F.lit(1)).alias("__rows")).select(
        "__task", F.coalesce(F.sum("__rows").over(order), F.lit(0)).alias("__before")
    )
    number = col("__before") + col(place).bitwiseAND(F.lit((1 << 33) - 1))
    chunked = placed.join(before, "__task").withColumn(chunk, F.floor(number / F.lit(per_file)))
    # a task writes its chunks one after another; the one that is not full is the last of its task
    dealt = chunked.repartition(chunk).sortWithinPartitions(chunk).drop("__task", "__before", place, chunk)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def stage_parted(df: DataFrame, reasons: str, stage: str, run_id: int) -> tuple[DataFrame, DataFrame]:
    """Rows without and with ``reasons`` (an array), written in one pass to two folders of the batch."""
    path, flag = run_path(stage, run_id), "tidemark_rejected"
    df.withColumn(flag, F.size(col(reasons)) > 0).write.mode("overwrite").partitionBy(flag).parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(flag, T.BooleanType())])
    staged = df.sparkSession.read.schema(schema).parquet(path)
    return staged.filter(~col(flag)).drop(reasons, flag), staged.filter(col(flag)).drop(flag)


def read_staged(spark: SparkSession, stage: str, schema=None) -> DataFrame:
    """Every staged run; ``run_id`` is a partition column."""
    if schema is not None:
        return spark.read.schema(schema).parquet(stage)
    return spark.read.option("mergeSchema", True).parquet(stage)


def read_matching(spark: SparkSession, root: str, pattern: str, schema) -> DataFrame:
    """Staged Parquet files below ``root`` whose whole path matches a regular expression.

    The path is a constant of each file, so files that do not match are dropped
    before any is opened.
    """
    everything = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)
    return everything.filter(F.col("_metadata.file_path").rlike(f"^(?:{pattern})$"))


def current_batch(staged: DataFrame, run_id: int | Column | None = None) -> DataFrame:
    """Rows of one run, by default of the newest; the scan opens only that partition's files.

    Give the id where it is known, as a load knows it from its ledger: to find
    the newest, a scalar subquery looks at the partition of every staged file.
    """
    if run_id is None:
        run_id = staged.agg(F.max("run_id")).scalar()
    return staged.filter(col("run_id") == run_id)
