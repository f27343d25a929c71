"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_HOUR = 3_600_000_000
_UTC = ("UTC", "Etc/UTC", "Z", "GMT")


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 for a timestamp column.

    Spark counts microseconds of a column without time zone by way of the session time
    zone, which is right in UTC only; elsewhere the fields are read one by one.
    """
    ts = F.col(name)
    utc = df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC
    if utc or isinstance(df.schema[name].dataType, T.TimestampType):
        return F.unix_micros(ts.cast("timestamp"))
    ts = ts.cast("timestamp_ntz")
    minutes = F.unix_date(F.to_date(ts)).cast("bigint") * 1440 + F.hour(ts) * 60 + F.minute(ts)
    fraction = (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return minutes * 60_000_000 + fraction


def hhmm_to_timestamp(day: str | Column, hhmm: str | Column) -> Column:
    """Day plus an HHMM number such as 5, 930 or 2400; the last is the next midnight.

    Numbers that are no clock time give null.
    """
    number = _column(hhmm).try_cast("int")
    hours, minutes = (number / 100).cast("int"), number % 100
    valid = number.between(0, 2400) & (minutes < 60)
    start = _column(day).cast("timestamp_ntz")
    return F.when(valid, F.timestamp_add("MINUTE", hours * 60 + minutes, start))


def shift_zone(ts: str | Column, zone: str | Column, to_utc: bool = True) -> Column:
    """Wall clock in ``zone`` to UTC, or back; a null zone gives null."""
    ts, zone, utc = _column(ts).cast("timestamp_ntz"), _column(zone), F.lit("UTC")
    return F.convert_timezone(zone, utc, ts) if to_utc else F.convert_timezone(utc, zone, ts)


def hours_between(df: DataFrame, later: str, earlier: str) -> Column:
    """Hours from ``earlier`` to ``later`` with microsecond precision."""
    return (epoch_micros(df, later) - epoch_micros(df, earlier)) / F.lit(float(MICROS_PER_HOUR))


def with_time_parts(df: DataFrame, ts: str, hour: str = "hour", minute: str = "minute") -> DataFrame:
    return df.withColumns({hour: F.hour(ts), minute: F.minute(ts)})


def time_levels(ts: str | Column) -> list[Column]:
    """Month and day of a timestamp: the coarse levels used for running totals over time."""
    day = F.to_date(_column(ts))
    return [F.trunc(day, "month"), day]
