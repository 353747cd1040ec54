"""Date/time column functions (F1-F9, P14) — all JVM-side expressions.

Timestamps are ``TIMESTAMP_NTZ`` with the session time zone pinned to UTC. ``date_trunc`` returns a
session-zone timestamp, so results are cast back to NTZ to keep schemas aligned with SQL engines that
only have naive timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_hour(c) -> Column:
    """truncate to the hour, NTZ in and out."""
    return F.date_trunc("hour", col(c)).cast("timestamp_ntz")


def floor_day(c) -> Column:
    return F.to_date(col(c))


def floor_month(c) -> Column:
    """first day of the month as a DATE."""
    return F.trunc(col(c), "MM")


def floor_week(c) -> Column:
    """Monday of the ISO week as a DATE."""
    return F.trunc(col(c), "week")


def add_hours(c, n) -> Column:
    """``ts + n hours`` for a literal or column ``n``; keeps NTZ."""
    n = F.lit(n) if isinstance(n, int) else col(n)
    return col(c) + F.make_dt_interval(hours=n.cast("int"))


def hour_index(c) -> Column:
    """Whole hours since 1970-01-01 00:00 (session zone UTC): a dense integer time axis."""
    return F.floor(F.unix_micros(col(c).cast("timestamp")) / F.lit(3_600_000_000)).cast("long")


def from_hour_index(c) -> Column:
    return F.timestamp_micros(col(c) * F.lit(3_600_000_000)).cast("timestamp_ntz")


def ts_diff(unit: str, start, end) -> Column:
    """``timestampdiff(unit, start, end)``: whole units from start to end (truncating)."""
    return F.timestamp_diff(unit, col(start), col(end))


def hours_between(later, earlier) -> Column:
    """whole-hour difference."""
    return ts_diff("HOUR", earlier, later)


def weekday_mon0(c) -> Column:
    """Monday = 0 ... Sunday = 6 (pandas ``dayofweek``)."""
    return F.weekday(col(c))


def is_weekend(c) -> Column:
    """weekday in (5, 6) as 0/1 int."""
    return weekday_mon0(c).isin(5, 6).cast("int")


def is_night(c) -> Column:
    """hour >= 23 or hour <= 6 as 0/1 int."""
    h = F.hour(col(c))
    return ((h >= 23) | (h <= 6)).cast("int")


def parse_ts(c, fmt: str | None = None) -> Column:
    """coercing timestamp parse — unparsable input becomes NULL (ANSI stays on)."""
    s = col(c).cast("string")
    return (F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)).cast("timestamp_ntz")


def utc_to_local(c, tz: str = "Europe/Kyiv") -> Column:
    """UTC wall clock -> local naive wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(c).cast("timestamp_ntz"))


def date_and_time(date_c, time_c) -> Column:
    """``YYYY-MM-DD`` + ``HH:MM:SS`` strings -> timestamp."""
    return parse_ts(F.concat_ws(" ", col(date_c), col(time_c)))


def last_completed_hour(now_c) -> Column:
    """F8: floor(now) - 1h.  ``now`` is always a parameter, never ``current_timestamp()``."""
    return add_hours(floor_hour(now_c), -1)


def spring_forward_hour(year_c) -> Column:
    """The local hour that does not exist — 03:00 on the last Sunday of March."""
    mar31 = F.make_date(col(year_c), F.lit(3), F.lit(31))
    last_sunday = F.date_sub(mar31, F.pmod(F.weekday(mar31) + 1, F.lit(7)))
    return F.make_timestamp_ntz(F.year(last_sunday), F.lit(3), F.dayofmonth(last_sunday), F.lit(3), F.lit(0), F.lit(0))


def drop_spring_forward_hours(df: DataFrame, ts_col: str) -> DataFrame:
    """Remove rows that fall on the non-existent DST hour of their year."""
    return df.filter(F.col(ts_col) != spring_forward_hour(F.year(F.col(ts_col))))


def hour_grid(spark: SparkSession, lo_hi: DataFrame, lo: str = "lo", hi: str = "hi",
              name: str = "hour", rows_per_partition: int = 100_000) -> DataFrame:
    """every hour between the (one-row) bounds, generated distributed.

    ``lo_hi`` is a one-row scalar aggregate. The hour count is read from it (a scalar, not data) so
    ``spark.range`` can spread the calendar over partitions instead of exploding it in one task.
    """
    row = lo_hi.select(hour_index(F.col(lo)).alias("a"), hour_index(F.col(hi)).alias("b")).first()
    if row is None or row["a"] is None:
        return spark.createDataFrame([], f"{name} timestamp_ntz")
    n = int(row["b"]) - int(row["a"]) + 1
    parts = max(1, min(4096, n // rows_per_partition + 1))
    return spark.range(0, n, 1, parts).select(from_hour_index(F.col("id") + F.lit(int(row["a"]))).alias(name))
