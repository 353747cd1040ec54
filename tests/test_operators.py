"""Unit tests of the operators against small hand-written fixtures (source-shaped cases)."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelcast.functions import calendar as C
from panelcast.functions import codes as K
from panelcast.ml import metrics as Mx
from panelcast.operators import asof as A
from panelcast.operators import dedupe as U
from panelcast.operators import intervals as I
from panelcast.operators.clean import SchemaDrift, align_to_schema
from panelcast.operators.ranking import exact_quantiles, prefix_sum


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_interval_minutes_clip_and_zero_length(spark):
    rows = [(1, 0, ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00")),   # ends exactly on the hour
            (2, 0, ts("2024-01-01 10:30:00"), ts("2024-01-01 10:30:00")),   # zero length
            (3, 0, ts("2024-01-01 10:15:00"), ts("2024-01-01 10:55:00")),   # overlaps #1: sum > 60 -> clip
            (4, 1, ts("2024-01-01 23:50:00"), ts("2024-01-02 00:20:00"))]   # spans midnight
    iv = spark.createDataFrame(rows, "id long, entity_id int, start timestamp_ntz, end timestamp_ntz")
    got = {(r.entity_id, r.hour): r.minutes_in_hour for r in I.hourly_minutes(I.expand_minutes(iv), ["entity_id"]).collect()}
    assert got == {(0, ts("2024-01-01 10:00:00")): 60.0, (1, ts("2024-01-01 23:00:00")): 10.0,
                   (1, ts("2024-01-02 00:00:00")): 20.0}
    grid = spark.createDataFrame([(0, ts("2024-01-01 10:00:00")), (0, ts("2024-01-01 11:00:00"))], "entity_id int, hour timestamp_ntz")
    flags = {r.hour: r.active for r in I.overlap_flags(iv, grid, ["entity_id"]).collect()}
    assert flags == {ts("2024-01-01 10:00:00"): 1, ts("2024-01-01 11:00:00"): 0}


def test_open_interval_closes_at_cutoff(spark):
    iv = spark.createDataFrame([(0, ts("2024-01-01 10:00:00"), None)], "entity_id int, start timestamp_ntz, end timestamp_ntz")
    x = I.close_open_intervals(iv, cutoff="2024-01-01 12:30:00").collect()[0]
    assert x.end == ts("2024-01-01 12:30:00")


def test_asof_join_on_or_before_and_priority_union(spark):
    left = spark.createDataFrame([(1, 5), (1, 10), (2, 3)], "k int, t long")
    right = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 4, "c")], "k int, t long, v string")
    got = {(r.k, r.t): r.v for r in A.asof_join(left, right, "t", ["v"], by=["k"], bucket_rows=4).collect()}
    assert got == {(1, 5): "a", (1, 10): "b", (2, 3): None}
    act = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double")
    fc = spark.createDataFrame([(2, 20.0), (3, 30.0)], "k int, v double")
    assert {r.k: r.v for r in A.priority_union(act, fc, ["k"]).collect()} == {1: 1.0, 2: 20.0, 3: 30.0}


def test_upsert_is_idempotent_and_new_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = U.upsert(old, new, ["k"])
    twice = U.upsert(once, new, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.k: r.v for r in once.collect()} == {1: "a", 2: "B", 3: "C"}


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "x": rng.integers(0, 40, 500).astype(float)})
    got = exact_quantiles(spark.createDataFrame(pdf), "x", [0.0, 0.25, 0.5, 0.8, 0.99, 1.0], keys=["g"]).toPandas()
    for r in got.itertuples():
        assert abs(r.q_value - pdf[pdf.g == r.g].x.quantile(r.q)) < 1e-9


def test_prefix_sum_global_order(spark):
    pdf = pd.DataFrame({"a": np.arange(1000)[::-1], "w": np.ones(1000, dtype=int)})
    got = prefix_sum(spark.createDataFrame(pdf), ["a"], F.col("w"), partitions=7).toPandas().sort_values("a")
    assert got["cum"].tolist() == list(range(1, 1001))


def test_auc_and_ap_match_definitions(spark):
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    s = [0.9, 0.8, 0.8, 0.6, 0.5, 0.5, 0.3, 0.1]
    df = spark.createDataFrame(list(zip(y, s)), "y int, score double")
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(Mx.roc_auc(df).first()[0] - auc) < 1e-12
    perfect = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2)], "y int, score double")
    assert abs(Mx.average_precision(perfect).first()[0] - 1.0) < 1e-12


def test_gate_rule(spark):
    df = spark.createDataFrame([(0.5, None, 0.1, None), (0.5, 0.4, 0.1, 0.9), (0.4, 0.4, 0.2, 0.3), (0.4, 0.4, 0.2, 0.1)],
                               "na double, oa double, nf double, of double")
    got = [r[0] for r in df.select(Mx.champion_gate(F.col("na"), F.col("oa"), F.col("nf"), F.col("of"))).collect()]
    assert got == [True, True, False, True]


def test_calendar_scalars(spark):
    df = spark.createDataFrame([(2024,), (2025,)], "y int")
    got = [r[0] for r in df.select(C.spring_forward_hour(F.col("y"))).collect()]
    assert got == [ts("2024-03-31 03:00:00"), ts("2025-03-30 03:00:00")]
    d = spark.createDataFrame([(ts("2024-01-06 10:00:00"),), (ts("2024-01-08 23:00:00"),)], "t timestamp_ntz")
    assert [tuple(r) for r in d.select(C.weekday_mon0("t"), C.is_weekend("t"), C.is_night("t")).collect()] == [(5, 1, 0), (0, 0, 1)]


def test_codes_and_bands(spark):
    df = spark.createDataFrame([("Light Snow, Rain",), ("Partially cloudy",), ("Fog",), ("Hot",)], "c string")
    assert [r[0] for r in df.select(K.classify_condition(F.col("c"))).collect()] == ["Snow", "Cloudy", "Fog", "Other"]
    p = spark.createDataFrame([(None,), (0.1,), (0.34,), (0.5,), (0.79,), (0.8,)], "p double")
    assert [r[0] for r in p.select(K.risk_band(F.col("p"))).collect()] == [
        "no_data", "very_low", "low", "elevated", "high", "very_high"]


def test_schema_alignment_strict(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, "x")], "a long, extra string")
    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])
    assert align_to_schema(df, target).collect()[0] == (1, 0.0)
    try:
        align_to_schema(df, target, strict_extra=True)
        raise AssertionError("expected drift")
    except SchemaDrift:
        pass
