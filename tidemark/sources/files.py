"""File sources: manifests, choice of a file by object name, tabular scans.

An "object" in file storage is a file, or a folder of part files written by a
distributed job; its key is the path below the root, without part file names.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.names import col
from tidemark.sources.inference import as_types, infer_types, read_text

# Part files of one data set: 'part-00000-...'.
_PART_FILE = r"/part-[^/]*$"


def _since(reader: DataFrameReader, mark: datetime) -> DataFrameReader:
    """Files that changed after a moment, in whole seconds of UTC, as Spark lists them: others never become part of a scan."""
    return reader.option("modifiedAfter", mark.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")


def file_manifest(spark: SparkSession, root: str, suffix: str, after: datetime | None = None) -> DataFrame:
    """Path, time and size of every file below ``root`` with the suffix; after a moment in UTC, only of files changed since.

    File contents are not selected, so none are opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    found = (_since(reader, after) if after else reader).load(root).select("path", "modificationTime", "length")
    return found.filter(_changed_after(col("modificationTime"), after)) if after else found


def _changed_after(modified: Column, mark: datetime) -> Column:
    """The part of a second that the listing does not look at."""
    return F.unix_micros(modified) > (mark - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def archived_until(archive: DataFrame) -> datetime | None:
    """When the newest file of a manifest changed, in UTC; nothing for an empty one."""
    micros = archive.agg(F.max(F.unix_micros("modificationTime"))).first()[0]
    return None if micros is None else datetime(1970, 1, 1) + timedelta(microseconds=micros)


def read_since(spark: SparkSession, path: str, kind: str, schema: str | T.StructType, mark: datetime | None) -> DataFrame:
    """Rows of the files below a path that changed after the mark (a moment in UTC, such as ``archived_until``)."""
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    reader = reader.schema(schema).option("recursiveFileLookup", True)
    if mark is None:
        return reader.format(kind).load(path)
    return _since(reader, mark).format(kind).load(path).filter(_changed_after(F.col("_metadata.file_modification_time"), mark))


def relative_key(path: Column, root: str) -> Column:
    """Path below ``root``, cut at its start alone; part files count as the folder that holds them.

    A root without a scheme also stands for the paths of the default store.
    """
    scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", root)
    clean = re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*:)?/*", "", root).rstrip("/")
    cut = r"^[A-Za-z][A-Za-z0-9+.-]*:/*" if scheme else r"^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?/*"
    whole = F.regexp_replace(path, cut, "")
    inside = F.startswith(whole, F.lit(f"{clean}/")) if clean else F.lit(False)
    below = F.when(inside, F.substring(whole, F.lit(len(clean) + 2), F.length(whole))).otherwise(whole)
    return F.regexp_replace(below, _PART_FILE, "")


def names_object(key: Column, name: str) -> Column:
    """Key equals the name, or holds it after '/' or '_'; case does not matter."""
    low, wanted = F.lower(key), name.lower()
    return (low == wanted) | F.contains(low, F.lit("/" + wanted)) | F.contains(low, F.lit("_" + wanted))


def latest_per_file_key(manifest: DataFrame, root: str) -> DataFrame:
    """Latest modification per relative key."""
    return (
        manifest.groupBy(relative_key(col("path"), root).alias("file_key"))
        .agg(F.max("modificationTime").alias("modified"), F.sum("length").alias("bytes"))
    )


def select_object(manifest: DataFrame, root: str, name: str) -> DataFrame:
    """The one object that answers to the name: newest first, then by key."""
    return (
        latest_per_file_key(manifest, root)
        .filter(names_object(F.concat(F.lit("/"), col("file_key")), name))
        .orderBy(F.col("modified").desc(), F.col("file_key"))
        .limit(1)
    )


def newer_than_archive(source: DataFrame, source_root: str, archive: DataFrame, archive_root: str) -> DataFrame:
    """Source objects that are not in the archive, or are newer there."""
    left = latest_per_file_key(source, source_root).alias("s")
    right = latest_per_file_key(archive, archive_root).alias("a")
    return (
        left.join(right, F.col("s.file_key") == F.col("a.file_key"), "left")
        .filter(F.col("a.modified").isNull() | (F.col("s.modified") > F.col("a.modified")))
        .select("s.file_key", "s.modified", "s.bytes")
    )


def read_tabular(spark: SparkSession, path: str, kind: str, schema: str | None = None) -> DataFrame:
    """CSV with a header row, Parquet, or JSON lines.

    Without a schema CSV types are found by an aggregate over the data; where it is
    staged anyway, ``inference.stage_inferred`` finds them on the way.
    """
    if kind == "csv" and schema is None:
        text = read_text(spark, path)
        return as_types(text, infer_types(text))
    reader = spark.read.option("header", True) if kind == "csv" else spark.read
    return (reader.schema(schema) if schema else reader).format(kind).load(path)


def read_object(
    spark: SparkSession,
    root: str,
    name: str,
    kind: str,
    schema: str | None = None,
    suffix: str | None = None,
    as_text: bool = False,
) -> DataFrame:
    """Rows of the object chosen by name; ``as_text`` leaves the columns of a CSV file as text."""
    manifest = file_manifest(spark, root, suffix or f".{kind}")
    chosen = select_object(manifest, root, name).first()
    if chosen is None:
        raise FileNotFoundError(f"no {kind} object named {name!r} below {root}")
    path = f"{root.rstrip('/')}/{chosen['file_key']}"
    return read_text(spark, path) if as_text else read_tabular(spark, path, kind, schema)
