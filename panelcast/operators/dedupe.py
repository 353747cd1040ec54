"""Set operations and de-duplication.

Keep-first / keep-last are written as grouped ``max_by``/``min_by`` over a version ordering (sort aggregates, as the
buffers hold structs) with map-side partial combine, so a hot key is pre-reduced before the shuffle
(a ``row_number`` window would sort every copy of a hot key inside one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: list[str], version: Column | str) -> DataFrame:
    """One row per key, the one with the greatest version (ties: greatest full row)."""
    v = F.col(version) if isinstance(version, str) else version
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]),
                                          F.struct(v, *[F.col(c) for c in rest])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def keep_first(df: DataFrame, keys: list[str], version: Column | str) -> DataFrame:
    """U2 ``drop_duplicates(subset)`` first-wins, with a deterministic order."""
    v = F.col(version) if isinstance(version, str) else version
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]),
                                          F.struct(v, *[F.col(c) for c in rest])).alias("_r"))
    return best.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """U4: existing + new with new winning on the key (idempotent: upsert(upsert(a,b),b) == upsert(a,b))."""
    cols = existing.columns
    u = existing.select(*cols).withColumn("_v", F.lit(0)).unionByName(new.select(*cols).withColumn("_v", F.lit(1)))
    return keep_last(u, keys, "_v").drop("_v")


def replace_slice(base: DataFrame, patch: DataFrame, predicate: Column) -> DataFrame:
    """Delete rows matching ``predicate``, append the patch."""
    return base.filter(~F.coalesce(predicate, F.lit(False))).unionByName(patch.select(*base.columns))


def append_only_new(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Append incoming rows whose key is not present yet (anti join, then union)."""
    fresh = incoming.join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def key_differences(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys only in a, only in b (side column), via one full outer join."""
    ka = a.select(*keys).distinct().withColumn("_a", F.lit(True))
    kb = b.select(*keys).distinct().withColumn("_b", F.lit(True))
    j = ka.join(kb, keys, "full_outer")
    return j.filter(F.col("_a").isNull() | F.col("_b").isNull()).select(
        *keys, F.when(F.col("_b").isNull(), F.lit("only_left")).otherwise(F.lit("only_right")).alias("side"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """U8: keys occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
