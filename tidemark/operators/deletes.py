"""Deletes driven by a feed of deleted keys.

Keys are compared column by column: joined into one text, (1, 23) and (12, 3)
would be equal. Feed keys are made distinct before the shuffle, so a key that
fills the feed costs one row per map task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from tidemark.functions.comparison import any_null
from tidemark.names import col, quoted, whole_key


def _feed_keys(deleted: DataFrame, keys) -> DataFrame:
    names = [quoted(k) for k in keys]
    return deleted.select(*names).filter(~any_null([col(k) for k in keys])).distinct()


def _join(target: DataFrame, deleted: DataFrame, keys, unique: bool, how: str) -> DataFrame:
    feed = _feed_keys(deleted, keys).alias("d")
    target = target.alias("t")
    if unique:
        on = reduce(lambda a, b: a & b, [col(k, "t") == col(k, "d") for k in keys])
    else:
        on = whole_key(keys, "t") == whole_key(keys, "d")
    return target.join(feed, on, how)


def delete_by_key(
    target: DataFrame, deleted: DataFrame, keys: list[str] | tuple[str, ...], target_unique: bool = False
) -> DataFrame:
    """Target rows whose key is not in the feed; null keys always stay.

    With ``target_unique`` the keys join as they are, and rows with null keys
    bypass the join, where they would all go to one task.
    """
    if not target_unique:
        return _join(target, deleted, keys, False, "left_anti")
    no_key = any_null([col(k) for k in keys])
    return keyed_remaining(target.filter(~no_key), deleted, keys).unionByName(target.filter(no_key))


def keyed_remaining(target: DataFrame, deleted: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """The same for a target with unique keys and no null in them: one join, which does not move a bucketed target."""
    return _join(target, deleted, keys, True, "left_anti")


def deleted_rows(
    target: DataFrame, deleted: DataFrame, keys: list[str] | tuple[str, ...], target_unique: bool = False
) -> DataFrame:
    """Target rows the feed removes."""
    target = target.filter(~any_null([col(k) for k in keys]))
    return _join(target, deleted, keys, target_unique, "left_semi")
