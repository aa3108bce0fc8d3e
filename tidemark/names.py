"""Column names and markers shared by every module."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audit columns of a target table, the mark logged for a run that
# moved nothing, and the status words of the run ledger.
INSERTED_AT = "edw_inserted_timestamp"
UPDATED_AT = "edw_updated_timestamp"
AUDIT_COLUMNS = (INSERTED_AT, UPDATED_AT)
SENTINEL_MARK = "9999-12-31 23:59:59.999"
SUCCESS = "SUCCESS"
FAILED = "FAILED"


def quoted(name: str, alias: str | None = None) -> str:
    """Column reference safe for names with spaces, dots or back-ticks."""
    safe = "`" + name.replace("`", "``") + "`"
    return f"{alias}.{safe}" if alias else safe


def col(name: str, alias: str | None = None) -> Column:
    return F.col(quoted(name, alias))


def whole_key(keys: list[str] | tuple[str, ...], alias: str | None = None) -> Column:
    """All key columns as one struct, for joins whose left side may have a hot key.

    Adaptive execution splits a hot partition only where both join inputs come
    straight from a shuffle made for that join. A side that was just grouped on
    the key columns would otherwise be joined without a shuffle of its own; the
    struct is a different partitioning key, so it gets one. Structs of nulls are
    equal: one side must hold no null keys.
    """
    return F.struct(*[col(k, alias).alias(f"k{at}") for at, k in enumerate(keys)])


def ntz(value: str | datetime | Column) -> Column:
    """Timestamp without time zone from a literal, whatever the session zone is."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def split_names(text: str) -> list[str]:
    """Comma-separated names of a control row, trimmed."""
    return [part.strip() for part in text.split(",") if part.strip()]
