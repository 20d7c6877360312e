"""Expressions on instants, retention periods and time-prefixed ids.

Instants are UTC and kept as ``timestamp_ntz``, so no result depends on the
time zone of the session.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"
PERIOD_UNITS = ("day", "month", "year")


def as_utc(instant: str | datetime) -> datetime:
    """A given instant as a zone-less UTC datetime; without a zone it is read as UTC."""
    if isinstance(instant, str):
        instant = datetime.fromisoformat(instant)
    if instant.tzinfo is not None:
        instant = instant.astimezone(timezone.utc).replace(tzinfo=None)
    return instant


def instant_literal(instant: str | datetime) -> Column:
    return F.lit(as_utc(instant).isoformat(sep=" ")).cast("timestamp_ntz")


def instant_as(instant: Column, time_type: T.DataType) -> Column:
    """A UTC instant in the type of the column it is compared with."""
    if isinstance(time_type, T.TimestampType):
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), instant).cast("timestamp")
    return instant


def parse_instant(text: Column) -> Column:
    """ISO text to a UTC instant; text without a zone is read as UTC, text that is no time gives NULL."""
    zoned = F.when(text.rlike(r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?)$"), text).otherwise(F.concat(text, F.lit("Z")))
    wall_time = F.try_to_timestamp(zoned).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall_time)


def with_instant(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with a column of ISO text turned into UTC instants; blank or unreadable text becomes NULL.

    Columns of a time type stay as they are.
    """
    if not isinstance(rows.schema[column].dataType, T.StringType):
        return rows
    return rows.withColumn(column, parse_instant(F.trim(column)))


def period_unit(unit: Column) -> Column:
    return F.lower(F.trim(unit))


def shift_back(instant: Column, count: Column, unit: Column) -> Column:
    """``instant`` minus a period.

    Days are exact spans of 24 hours. Months and years move the calendar and keep
    the time of day; a day that the target month lacks becomes its last day.
    """
    unit = period_unit(unit)
    count = count.cast("int")
    return (
        F.when(unit == "day", instant - F.make_dt_interval(count))
        .when(unit == "month", instant - F.make_ym_interval(F.lit(0), count))
        .when(unit == "year", instant - F.make_ym_interval(count, F.lit(0)))
    )


def shift_back_to_midnight(instant: Column, count: Column, unit: Column) -> Column:
    """As ``shift_back``, but month and year periods end at midnight of the day reached."""
    midnight = instant.cast("date").cast("timestamp_ntz")
    start = F.when(period_unit(unit) == "day", instant).otherwise(midnight)
    return shift_back(start, count, unit)


def epoch_seconds_instant(seconds: Column) -> Column:
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def epoch_millis_text(millis: Column) -> Column:
    """Epoch milliseconds, as number or numeric text, to ``yyyy-MM-dd HH:mm:ss`` in UTC.

    NULL for text that is not a number.
    """
    seconds = F.floor(millis.try_cast("decimal(18,3)") / 1000)
    return epoch_seconds_instant(seconds).cast("string")


def object_id_seconds(object_id: Column) -> Column:
    """The epoch seconds in the first four bytes of a 24-digit hexadecimal id."""
    return F.conv(F.substring(object_id, 1, 8), 16, 10).cast("long")


def object_id_month(object_id: Column) -> Column:
    return F.substring(epoch_seconds_instant(object_id_seconds(object_id)).cast("string"), 1, 7)


def object_id_floor(instant: str | datetime) -> str:
    """The smallest id that carries the given second."""
    seconds = int(as_utc(instant).replace(tzinfo=timezone.utc).timestamp())
    return f"{seconds:08x}" + "0" * 16
