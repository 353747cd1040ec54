"""Interval events against the hour grid.

Minutes and flags come from a sweep line: an interval is a few signed marks at hour borders, whatever its length.
Marks are summed per (keys, hour) before they move, and a running sum per key (at most a row per hour of the calendar,
however many intervals overlap) says how many intervals cover an hour.  :func:`expand_minutes` keeps the long form, a row
per interval and hour, for those who want the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import add_hours, floor_hour


def close_open_intervals(iv: DataFrame, end: str = "end", cutoff=None) -> DataFrame:
    """Open intervals (missing end, or a year-0001 placeholder) close at ``cutoff``."""
    if cutoff is None:
        return iv
    e = F.col(end)
    is_open = e.isNull() | (F.year(e) <= 1)
    return iv.withColumn(end, F.when(is_open, F.lit(cutoff).cast("timestamp_ntz")).otherwise(e))


def covered_hours(iv: DataFrame, start: str = "start", end: str = "end", hour: str = "hour") -> DataFrame:
    """Every hour bucket from floor(start) to floor(end) (both included), one row per bucket."""
    return iv.withColumn(hour, F.explode(F.sequence(floor_hour(start), floor_hour(end), F.expr("INTERVAL 1 HOUR"))))


def overlap_micros(start: str = "start", end: str = "end", hour: str = "hour"):
    """microseconds of [start, end) inside [hour, hour + 1h) (negative when disjoint)."""
    lo = F.greatest(F.col(start), F.col(hour))
    hi = F.least(F.col(end), add_hours(hour, 1))
    return F.timestamp_diff("MICROSECOND", lo, hi)


def expand_minutes(iv: DataFrame, start: str = "start", end: str = "end", hour: str = "hour") -> DataFrame:
    """Interval -> (hour, overlap); zero-overlap hours dropped.

    Overlap is kept as integer microseconds (exact sums in any order) plus minutes for display.
    """
    x = covered_hours(iv, start, end, hour).withColumn("overlap_us", overlap_micros(start, end, hour))
    return x.filter(F.col("overlap_us") > 0).withColumn("minutes", F.col("overlap_us") / F.lit(60_000_000.0))


def hourly_minutes(expanded: DataFrame, keys: list[str], hour: str = "hour", cap_minutes: int = 60) -> DataFrame:
    """A2: sum of overlap minutes per (keys, hour) clipped to [0, cap], with an active flag."""
    cap = F.lit(cap_minutes * 60_000_000).cast("long")
    us = F.least(F.greatest(F.sum("overlap_us"), F.lit(0).cast("long")), cap)
    return expanded.groupBy(*keys, hour).agg((us / F.lit(60_000_000.0)).alias("minutes_in_hour"),
                                              F.max(F.lit(1)).alias("active"))


def swept_minutes(iv: DataFrame, keys: list[str], start: str = "start", end: str = "end", hour: str = "hour",
                  cap_minutes: int = 60) -> DataFrame:
    """The result of ``hourly_minutes(expand_minutes(iv), keys)`` by sweep line.

    The hours that an interval covers whole are a +1 and a -1 mark, the parts at its two ends are exact microseconds.
    Intervals without a positive length, or with a null end, count for nothing.
    """
    whole = 3_600_000_000
    first, last = floor_hour(start), floor_hour(end)
    none, after = F.lit(0).cast("long"), add_hours(first, 1)
    mark = lambda h, d, us: F.struct(h.alias("h"), F.lit(d).cast("long").alias("d"), us.cast("long").alias("us"))
    micros = lambda a, b: F.timestamp_diff("MICROSECOND", a, b)
    marks = (F.when(first == last, F.array(mark(first, 0, micros(F.col(start), F.col(end)))))
             .otherwise(F.array(mark(first, 0, micros(F.col(start), after)), mark(after, 1, none),
                                mark(last, -1, micros(last, F.col(end))))))
    m = iv.filter(F.col(end) > F.col(start)).select(*keys, F.explode(marks).alias("_m"))
    m = m.groupBy(*keys, F.col("_m.h").alias("_h")).agg(F.sum("_m.d").alias("_d"), F.sum("_m.us").alias("_us"))
    line = Window.partitionBy(*keys).orderBy("_h")
    m = m.withColumn("_level", F.sum("_d").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.lead("_h").over(line))
    # the level holds until the next mark: hours in between are made here, behind all exchanges
    hours = F.when(F.col("_level") > 0, F.sequence(F.col("_h"), add_hours("_next", -1), F.expr("INTERVAL 1 HOUR"))).otherwise(F.array("_h"))
    x = m.withColumn(hour, F.explode(hours))
    us = F.col("_level") * whole + F.when(F.col(hour) == F.col("_h"), F.col("_us")).otherwise(none)
    x = x.select(*keys, hour, F.least(us, F.lit(cap_minutes * 60_000_000).cast("long")).alias("_us")).filter("_us > 0")
    return x.select(*keys, hour, (F.col("_us") / F.lit(60_000_000.0)).alias("minutes_in_hour"), F.lit(1).alias("active"))


def overlap_flags(iv: DataFrame, grid: DataFrame, keys: list[str], start: str = "start", end: str = "end",
                  hour: str = "hour") -> DataFrame:
    """Flag every grid cell overlapped by some interval: start < hour+1h AND end > hour.

    Zero-length intervals inside an hour are counted (the predicate form, not the minutes form).  Grid rows and marks meet in
    one running sum per key: no join, and no row per covered hour.
    """
    first = floor_hour(start)
    until = add_hours(floor_hour(F.col(end) - F.expr("INTERVAL 1 MICROSECOND")), 1)  # the first hour that starts at the end or later
    mark = lambda h, d: F.struct(h.alias("h"), F.lit(d).cast("long").alias("d"))
    known = iv.filter(until > first)
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    marks = known.select(*keys, F.explode(F.array(mark(first, 1), mark(until, -1))).alias("_m"))
    marks = marks.groupBy(*keys, F.col("_m.h").alias(hour)).agg(F.sum("_m.d").alias("_d"))
    cells = grid.withColumn("_d", F.lit(0).cast("long")).withColumn("_cell", F.lit(True))
    both = cells.unionByName(marks, allowMissingColumns=True)
    level = F.sum("_d").over(Window.partitionBy(*keys).orderBy(hour))  # by range: marks of the cell's own hour are in it
    return both.withColumn("active", (level > 0).cast("int")).filter("_cell").drop("_d", "_cell")
