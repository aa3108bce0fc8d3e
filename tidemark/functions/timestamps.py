"""Timestamp expressions.

All of them work on TIMESTAMP_NTZ, or turn a TIMESTAMP into its wall clock in
UTC first, and none depends on the session time zone:
functions that go through TIMESTAMP (date_format, date_trunc, to_timestamp,
timestamp_diff) would shift wall-clock values inside a daylight-saving gap of that zone.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.names import col

# The two accepted text layouts (with and without a fraction) as
# one pattern, and the text that stands for a missing timestamp.
TEXT_LAYOUTS = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}(\.\d{1,6})?$"
MISSING_TEXT = "NaT"

# A time of day alone, and the ISO layouts that exports of documents use.
TIME_TEXT = r"^\d{1,2}:\d{2}(:\d{2}(\.\d{1,6})?)?$"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?$"


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """Text to timestamp; null and 'NaT' give null.

    Other text outside the two layouts, or naming no real instant, raises when
    strict and gives null otherwise.
    """
    missing = text.isNull() | (text == MISSING_TEXT)
    parsed = F.when(text.rlike(TEXT_LAYOUTS), text.try_cast("timestamp_ntz"))
    if not strict:
        return F.when(missing, F.lit(None).cast("timestamp_ntz")).otherwise(parsed)
    message = F.concat(F.lit("text is not a known timestamp layout: "), text)
    return (
        F.when(missing, F.lit(None).cast("timestamp_ntz"))
        .when(parsed.isNotNull(), parsed)
        .otherwise(F.raise_error(message).cast("timestamp_ntz"))
    )


def utc_wall(instant: Column) -> Column:
    """The wall clock in UTC of a TIMESTAMP, whatever the session zone is."""
    micros = F.unix_micros(instant)
    seconds = F.pmod(micros, F.lit(60_000_000)).cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(18,6)")
    minutes = F.floor(micros / F.lit(60_000_000).cast("decimal(18,0)")).cast("long")
    days = F.floor(minutes / F.lit(1440).cast("decimal(18,0)")).cast("int")
    since = F.make_dt_interval(days, F.lit(0), F.pmod(minutes, F.lit(1440)).cast("int"), seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def wall_clock(df: DataFrame, names: list[str | None]) -> DataFrame:
    """The named columns without a time zone: instants as their wall clock in UTC.

    A mark taken from such a column is a plain number of the clock, which no
    session's or driver's time zone shifts.
    """
    wanted = {name.lower() for name in names if name}
    instants = [f.name for f in df.schema.fields if f.name.lower() in wanted and isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: utc_wall(col(name)) for name in instants}) if instants else df


def parse_export_time(text: Column, strict: bool = True) -> Column:
    """A time as document exports write it: the known layouts, or ISO; with an offset, as UTC.

    Null and 'NaT' give null; other text raises when strict and gives null otherwise.
    """
    offset = text.rlike(r"[+-]\d{2}:?\d{2}$")
    iso = F.when(offset, utc_wall(text.try_cast("timestamp"))).otherwise(
        F.replace(F.rtrim(text, F.lit("Z")), F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")
    )
    parsed = [
        F.when(text.rlike(TEXT_LAYOUTS), text.try_cast("timestamp_ntz")),
        F.when(text.rlike(ISO_TEXT), iso),
    ]
    if strict:
        message = F.concat(F.lit("text is not a known timestamp layout: "), text)
        parsed.append(F.raise_error(message).cast("timestamp_ntz"))
    return F.when(text.isNotNull() & (text != MISSING_TEXT), F.coalesce(*parsed))


def timestamp_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss.ffffff', always six fraction digits."""
    return _six_digits(ts.cast("timestamp_ntz").cast("string"))


def _six_digits(text: Column) -> Column:
    fraction = F.when(F.contains(text, F.lit(".")), F.substring_index(text, ".", -1)).otherwise(F.lit(""))
    return F.concat(F.substring_index(text, ".", 1), F.lit("."), F.rpad(fraction, 6, "0"))


def time_of_day(ts: Column) -> Column:
    """'HH:mm:ss.ffffff' as text; the TIME type is off by default in Spark 4.1."""
    return F.substring_index(timestamp_text(ts), " ", -1)


def file_stamp(ts: Column) -> Column:
    """'yyyy-MM-dd_HH-mm-ss', as it stands in names of files."""
    seconds = F.substring_index(timestamp_text(ts), ".", 1)
    return F.translate(seconds, " :", "_-")


@contextmanager
def native_time(spark: SparkSession):
    """Spark's own TIME type for what is planned inside; it is off by default in Spark 4.1."""
    name = "spark.sql.timeType.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def time_text(at: Column) -> Column:
    """A value of the TIME type as 'HH:mm:ss.ffffff'."""
    return _six_digits(at.cast("string"))


def effective_timestamp(updated: Column, inserted: Column) -> Column:
    return F.coalesce(updated, inserted)


def local_run_time(utc: Column, zone: str) -> Column:
    """Wall clock of ``zone`` for a UTC wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz"))


def wall_micros(ts: Column) -> Column:
    """Microseconds from 1970 on the wall clock, as a long.

    Put together from the date and the parts of the day: timestamp_diff and
    unix_micros go through the session time zone.
    """
    stamp = ts.cast("timestamp_ntz")
    days = F.datediff(stamp.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(stamp)) * 60 + F.minute(stamp)
    seconds = F.date_part(F.lit("SECOND"), stamp)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def seconds_between(start: Column, end: Column) -> Column:
    return (wall_micros(end) - wall_micros(start)) / F.lit(1_000_000.0)


def overlap_start(mark: Column, minutes: int = 10) -> Column:
    """Stored mark less the re-read overlap, cut to milliseconds."""
    moved = mark.cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(minutes))
    return F.substring(moved.cast("string"), 1, 23).cast("timestamp_ntz")
