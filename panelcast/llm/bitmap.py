"""A broadcast bitmap of fixed size: positions in [0, bits), packed into 64-bit words.

It holds at most ``bits / 64`` rows of 16 bytes, so it is safe to broadcast whatever the input's size.  Used as a
filter before a shuffle: a position that isn't set rules a row out, a set one says "maybe".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def position(key: Column, bits: int) -> Column:
    return F.pmod(key, F.lit(bits))


def pack(positions: DataFrame, column: str) -> DataFrame:
    """``word, hits``: the set positions of ``column`` (long)."""
    return (positions.groupBy(F.shiftright(column, 6).alias("word"))
            .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({column} & 63 as int))")).alias("hits")))


def with_hit(df: DataFrame, words: DataFrame, at: Column, out: str) -> DataFrame:
    """``df`` plus the boolean ``out``: whether the position ``at`` is set."""
    side = F.broadcast(words.select(F.col("word").alias("_word"), F.col("hits").alias("_hits")))
    hit = F.call_function("shiftright", F.col("_hits"), F.pmod(F.col("_at"), F.lit(64)).cast("int")).bitwiseAND(F.lit(1))
    x = df.withColumn("_at", at)
    x = x.join(side, F.shiftright("_at", 6) == F.col("_word"), "left")
    return x.withColumn(out, F.coalesce(hit, F.lit(0)) == 1).drop("_at", "_word", "_hits")
