"""Skew properties: one entity / key holding a third of all rows must not land in a single task,
and the distributed forms must equal the plain ones."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelcast.operators import dedupe as U
from panelcast.operators import windows as W
from panelcast.operators.ranking import PID, prefix_sum


def skewed_panel(spark, n_hot=3000, n_cold=20, per_cold=300):
    rng = np.random.default_rng(3)
    rows = [(0, t, int(rng.random() < 0.2), float(rng.normal())) for t in range(n_hot)]
    for e in range(1, n_cold + 1):
        rows += [(e, t, int(rng.random() < 0.2), float(rng.normal())) for t in range(per_cold)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["entity_id", "t", "y", "x"]))


def test_bucketed_windows_split_hot_entity_and_match(spark):
    df = skewed_panel(spark)

    def feats(w):
        return [W.lag_fill("y", 12, w).alias("lag"), W.rolling_sum_prev("y", 24, w).alias("roll"),
                W.rolling_zscore("x", 24, w).alias("z")]

    plain = W.hours_since_last_event(W.apply_windowed(df, feats), "y", out="hs")
    bucketed = W.hours_since_last_event(W.apply_windowed(df, feats, lead_in=24, bucket_rows=200), "y", out="hs",
                                        bucket_rows=200)
    a = plain.toPandas().sort_values(["entity_id", "t"]).reset_index(drop=True)
    b = bucketed.toPandas().sort_values(["entity_id", "t"]).reset_index(drop=True)
    for c in ("lag", "roll", "z", "hs"):
        np.testing.assert_allclose(a[c].to_numpy(float), b[c].to_numpy(float), rtol=1e-9, atol=1e-9)
    # the hot entity (a third of all rows) is processed as many independent window partitions
    parts = W.with_lead_in(df.filter("entity_id = 0"), "t", 200, 24).select(W.B).distinct().count()
    assert parts >= 15


def test_prefix_sum_spreads_hot_key_over_ranges(spark):
    pdf = pd.DataFrame({"k": [0] * 6000 + list(range(1, 3001)), "o": list(range(6000)) + [0] * 3000})
    df = spark.createDataFrame(pdf)
    out = prefix_sum(df, ["o"], None, keys=["k"], out="cum", partitions=8)
    got = out.filter("k = 0").orderBy("o").select("cum").toPandas()["cum"].tolist()
    assert got == list(range(1, 6001))
    # range partitioning on (key, order) puts the hot key's rows in several partitions
    spread = (df.repartitionByRange(8, "k", "o").withColumn(PID, F.spark_partition_id())
                .filter("k = 0").select(PID).distinct().count())
    assert spread >= 3


def test_keep_last_with_hot_key_matches_bruteforce(spark):
    rng = np.random.default_rng(5)
    keys = np.concatenate([np.zeros(5000, dtype=int), rng.integers(1, 500, 10000)])
    pdf = pd.DataFrame({"k": keys, "v": rng.integers(0, 10**9, len(keys))})
    got = U.keep_last(spark.createDataFrame(pdf), ["k"], "v").toPandas().set_index("k")["v"].to_dict()
    assert got == pdf.groupby("k")["v"].max().to_dict()
