"""pandas cross-checks of the per-entity time-series operators on hand-written panels (gaps, ties,
single-row entities, events in the first row), in plain and bucketed (lead-in) execution."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelcast.operators import windows as W


def panel_pdf():
    rng = np.random.default_rng(7)
    rows = []
    for e, n in ((0, 60), (1, 1), (2, 45), (3, 30)):
        for t in range(1000, 1000 + n):
            y = int(rng.random() < 0.3)
            if e == 2 and t == 1000:
                y = 1                      # event in the first row
            rows.append((e, t, y, float(rng.normal(10, 3)) if e != 3 else 0.0))
    return pd.DataFrame(rows, columns=["entity_id", "t", "y", "x"])


def reference(pdf):
    out = []
    for _, g in pdf.sort_values(["entity_id", "t"]).groupby("entity_id"):
        g = g.copy()
        g["lag_3"] = g["y"].shift(3).fillna(0)
        g["roll"] = g["y"].shift(1).rolling(24, min_periods=1).sum().fillna(0)
        s = g["y"].shift(1).fillna(0)
        g["hs"] = s.groupby(s.cumsum()).cumcount().astype(float)
        g["ewm"] = g["x"].shift(1).ewm(span=24).mean().fillna(0)
        g["ewm6"] = g["x"].ewm(span=6).mean().fillna(0)
        g["z"] = ((g["x"] - g["x"].rolling(24, min_periods=1).mean()) / (g["x"].rolling(24, min_periods=1).std() + 1e-9)).fillna(0)
        g["d3"] = g["x"].diff(3).fillna(0)
        out.append(g)
    return pd.concat(out)


@pytest.mark.parametrize("bucket", [None, 16, 500])
def test_window_features_match_pandas(spark, bucket):
    pdf = panel_pdf()
    df = spark.createDataFrame(pdf)
    lead = W.ewm_cutoff_rows(24)
    b = None if bucket is None else max(bucket, lead) if bucket == 500 else bucket

    def feats(w):
        cols = [W.lag_fill("y", 3, w).alias("lag_3"), W.rolling_sum_prev("y", 24, w).alias("roll"),
                W.rolling_zscore("x", 24, w).alias("z"), W.diff_fill("x", 3, w).alias("d3")]
        if b is None or b >= lead:
            cols += [W.ewm_mean("x", 24, w, shifted=True).alias("ewm"), W.ewm_mean("x", 6, w, shifted=False).alias("ewm6")]
        return cols

    got = W.apply_windowed(df, feats, lead_in=(lead if (b and b >= lead) else 24) if b else 0, bucket_rows=b)
    got = W.hours_since_last_event(got, "y", out="hs", bucket_rows=b).toPandas().sort_values(["entity_id", "t"])
    ref = reference(pdf).sort_values(["entity_id", "t"])
    assert len(got) == len(ref)
    for c in ["lag_3", "roll", "hs", "z", "d3"] + (["ewm", "ewm6"] if "ewm" in got.columns else []):
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), ref[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9,
                                   err_msg=c)


def test_prefix_scan_last_and_sum_bucketed(spark):
    pdf = pd.DataFrame({"k": [0] * 10 + [1] * 5, "t": list(range(10)) + list(range(5)),
                        "v": [None, 2.0, None, None, 5.0, None, 7.0, None, None, None, 1.0, None, 3.0, None, None]})
    df = spark.createDataFrame(pdf)
    got = W.prefix_scan(df, {"ff": ("last", F.col("v")), "s": ("sum", F.lit(1))}, "k", "t", inclusive=True,
                        bucket_rows=3).toPandas().sort_values(["k", "t"])
    exp_ff = pdf.groupby("k")["v"].ffill()
    np.testing.assert_allclose(got["ff"].fillna(-1).to_numpy(), exp_ff.fillna(-1).to_numpy())
    assert got["s"].tolist() == [i + 1 for i in range(10)] + [i + 1 for i in range(5)]


def test_linear_bucketed_ewm_matches_pandas(spark):
    pdf = panel_pdf()
    df = spark.createDataFrame(pdf)
    lead = max(W.ewm_cutoff_rows(24), W.ewm_cutoff_rows(6))
    bucket = min(2 * lead, W.ewm_max_bucket(6, lead))

    def feats(w):
        return [W.ewm_mean_bucketed("x", 24, w, "t", bucket, lead, shifted=True).alias("ewm"),
                W.ewm_mean_bucketed("x", 6, w, "t", bucket, lead, shifted=False).alias("ewm6")]

    got = W.apply_windowed(df, feats, lead_in=lead, bucket_rows=bucket).toPandas().sort_values(["entity_id", "t"])
    ref = reference(pdf).sort_values(["entity_id", "t"])
    for c in ("ewm", "ewm6"):
        np.testing.assert_allclose(got[c].to_numpy(dtype=float), ref[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9)
