"""Time-ordered splits (W15, W16) and class weights (M2) without a global single-task sort.

The global row position (order by time, then entity) is the distributed prefix sum (DR6) of a
unit weight over the range-partitioned (time, entity) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.ranking import prefix_sum


def global_position(df: DataFrame, time_col: str, tie: str, out: str = "pos") -> DataFrame:
    """0-based position of each row in the (time_col, tie) order; (time_col, tie) must be unique.

    Range partitioning on both columns splits even a single hot time key across tasks.
    """
    return prefix_sum(df, [time_col, tie], None, out=out, inclusive=False)


def chronological_split(df: DataFrame, time_col: str, tie: str, train: float = 0.70, valid: float = 0.85) -> DataFrame:
    """First floor(n*train) rows train, up to floor(n*valid) valid, rest test."""
    x = global_position(df, time_col, tie)
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    x = x.crossJoin(F.broadcast(n))
    split = (F.when(F.col("pos") < F.floor(F.col("_n") * train), F.lit("train"))
              .when(F.col("pos") < F.floor(F.col("_n") * valid), F.lit("valid")).otherwise(F.lit("test")))
    return x.withColumn("split", split).drop("_n")


def expanding_folds(positioned: DataFrame, n_train: str = "_ntr", n_splits: int = 3) -> DataFrame:
    """TimeSeriesSplit(n_splits) fold id per training row: test size = n // (n_splits + 1);
    fold f tests rows [n - (n_splits - f) * size, + size) and trains on everything before."""
    size = F.floor(F.col(n_train) / (n_splits + 1))
    first_test = F.col(n_train) - size * n_splits
    fold = F.when(F.col("pos") >= first_test, F.floor((F.col("pos") - first_test) / size)).cast("int")
    return positioned.withColumn("test_fold", fold).withColumn("fold_size", size.cast("long"))


def class_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """M2: balanced weight n / (k * n_c) per class and scale_pos_weight = neg / pos."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = c.agg(F.sum("n_c").alias("_n"), F.count(F.lit(1)).alias("_k"),
                F.sum(F.when(F.col(label) == 0, F.col("n_c"))).alias("_neg"),
                F.sum(F.when(F.col(label) == 1, F.col("n_c"))).alias("_pos"))
    return c.crossJoin(tot).select(label, "n_c", (F.col("_n") / (F.col("_k") * F.col("n_c"))).alias("weight"),
                                   F.try_divide(F.col("_neg").cast("double"), F.col("_pos")).alias("scale_pos_weight"))
