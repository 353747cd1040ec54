"""As-of joins.

Spark has no native as-of join.  The Spark-first form is a union of both sides ordered by time
(right rows before left rows at equal time) with a forward fill of the right side's payload —
``prefix_scan(kind='last')`` — keeping only the left rows.  Partitioned by the ``by`` keys, and
with ``bucket_rows`` by (keys, time bucket) with a per-bucket carry, so a hot key or an unkeyed
(global) as-of still spreads across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.windows import prefix_scan

SIDE = "_side"


def asof_join(left: DataFrame, right: DataFrame, t: str, payload: list[str], by: list[str] | None = None,
              right_t: str | None = None, bucket_rows: int | None = None, t_out: str = "asof_t") -> DataFrame:
    """For each left row, the latest right row with right_t <= left t (within ``by``).

    ``t`` must be an integer, date or timestamp column present on the left; ``right_t`` names the right
    side's time column (default: ``t``).  ``bucket_rows`` is in the units of the numeric time axis
    (days for dates, microseconds for timestamps).  Output: left columns + payload + ``t_out`` (the matched
    right time, null when nothing precedes).
    """
    by = list(by or [])
    right_t = right_t or t
    key = "_k" if not by else by
    lcols = left.columns
    L = left.withColumn(SIDE, F.lit(1))
    R = right.select(*by, F.col(right_t).alias(t), *payload).withColumn(SIDE, F.lit(0))
    if not by:
        L, R = L.withColumn("_k", F.lit(0)), R.withColumn("_k", F.lit(0))
    R = R.withColumn(t_out, F.col(t))
    for c in lcols:
        if c not in R.columns:
            R = R.withColumn(c, F.lit(None).cast(dict(left.dtypes)[c]))
    for c in payload + [t_out]:
        L = L.withColumn(c, F.lit(None).cast(dict(R.dtypes)[c]))
    u = L.unionByName(R.select(*L.columns))
    tnum = "_tn"
    u = u.withColumn(tnum, F.unix_micros(F.col(t).cast("timestamp")) if dict(u.dtypes)[t].startswith("timestamp")
                     else (F.unix_date(F.col(t)) if dict(u.dtypes)[t] == "date" else F.col(t)))
    # one struct keeps payload columns of the same right row together
    specs = {"_f": ("last", F.when(F.col(SIDE) == 0, F.struct(*[F.col(c) for c in payload + [t_out]])))}
    scanned = prefix_scan(u, specs, key, tnum, inclusive=True,
                          bucket_rows=bucket_rows, order=[SIDE])
    out = scanned.filter(F.col(SIDE) == 1).select(*lcols, *[F.col(f"_f.{c}").alias(c) for c in payload + [t_out]])
    return out


def decay_factor(gap_hours: Column, half_life_hours: float = 6.0) -> Column:
    """0.5 ** (gap / half-life); gaps <= 0 give 1."""
    return F.when(gap_hours <= 0, F.lit(1.0)).otherwise(F.pow(F.lit(0.5), gap_hours / F.lit(half_life_hours)))


def priority_union(primary: DataFrame, override: DataFrame, keys: list[str]) -> DataFrame:
    """Union two sources on the same key; the ``override`` side wins (one row per key)."""
    cols = primary.columns
    u = primary.select(*cols).withColumn("_prio", F.lit(0)).unionByName(
        override.select(*cols).withColumn("_prio", F.lit(1)))
    rest = [c for c in cols if c not in keys]
    best = u.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), F.col("_prio")).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
