"""Folders on the lake's storage: listing, removal, markers."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def names(spark: SparkSession, folder: str) -> list[str]:
    """What lies directly below a folder; nothing if it is not there."""
    store, path = _store(spark, folder)
    return [status.getPath().getName() for status in store.listStatus(path)] if store.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    store, path = _store(spark, folder)
    store.delete(path, True)


def mark(spark: SparkSession, file: str) -> None:
    """An empty file, whose name is all it says."""
    store, path = _store(spark, file)
    store.create(path, True).close()


def total_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder, without opening any."""
    store, path = _store(spark, folder)
    return store.getContentSummary(path).getLength()


def put_text(spark: SparkSession, file: str, text: str) -> None:
    """A small file from the driver, such as a control file."""
    store, path = _store(spark, file)
    out = store.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()
