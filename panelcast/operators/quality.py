"""Data-quality audits (Q1-Q3, Q7, Q8) — each is one aggregate query returning a small report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_preservation(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Q1: a left join keeps the left row count iff the right side is unique on the key."""
    n_left = left.agg(F.count(F.lit(1)).alias("n_left"))
    dup = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).agg(F.count_if(F.col("_c") > 1).alias("right_dup_keys"))
    n_out = left.join(right, keys, "left").agg(F.count(F.lit(1)).alias("n_out"))
    out = n_left.crossJoin(n_out).crossJoin(dup)
    return out.withColumn("preserved", F.col("n_left") == F.col("n_out"))


def incomplete_hours(df: DataFrame, hour: str, entity: str, expected: int) -> DataFrame:
    """Q2: hours whose distinct entity count differs from ``expected``."""
    c = df.groupBy(hour).agg(F.countDistinct(entity).alias("n_entities"))
    return c.filter(F.col("n_entities") != expected)


def health_report(df: DataFrame, hour: str, entity: str, expected: int, days: int = 60) -> DataFrame:
    """Q3: recent-window health in one pass over the per-key counts."""
    mx = df.agg(F.max(hour).alias("_mx"))
    recent = df.crossJoin(F.broadcast(mx)).filter(F.col(hour) > F.col("_mx") - F.make_dt_interval(days=F.lit(days)))
    per_key = recent.groupBy(hour, entity).agg(F.count(F.lit(1)).alias("_c"))
    per_hour = per_key.groupBy(hour).agg(F.count(F.lit(1)).alias("_e"), F.count_if(F.col("_c") > 1).alias("_d"))
    return per_hour.agg(F.max(hour).alias("max_hour"), F.count(F.lit(1)).alias("distinct_hours"),
                        F.sum("_d").alias("duplicate_keys"),
                        F.count_if(F.col("_e") != expected).alias("incomplete_hours")).crossJoin(
        recent.agg(F.count(F.lit(1)).alias("rows")))
