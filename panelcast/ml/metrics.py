"""Exact evaluation metrics as DataFrame aggregates.

Curve metrics are computed over the table of *distinct scores* with positive/negative counts (a
partial-combined aggregate), then ranked with the distributed prefix sum — never a global sort of
all rows in one task.  ``BinaryClassificationEvaluator`` down-samples the curve and integrates PR
with the trapezoid rule, so it is not used here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.ranking import prefix_sum
from panelcast.session import materialize

# Fixed values of the product's model-selection rules
THRESHOLD_GRID = [0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]
GATE_EPS = 1e-6


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct score -> (pos, neg) counts, written once: curves and totals read the same table."""
    return materialize(df.groupBy(score).agg(F.sum(F.col(label).cast("long")).alias("pos"),
                                             F.sum((1 - F.col(label)).cast("long")).alias("neg")), "score-counts")


def roc_auc(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """Mann-Whitney AUC with ties counted one half (== sklearn ``roc_auc_score``)."""
    sc = score_counts(df, label, score)
    r = prefix_sum(sc, [score], F.col("neg"), out="neg_le")
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    part = r.agg(F.sum(F.col("pos") * (F.col("neg_le") - F.col("neg") + F.col("neg") * 0.5)).alias("_s"))
    return part.crossJoin(tot).select(F.try_divide(F.col("_s"), F.col("P") * F.col("N")).alias("roc_auc"))


def average_precision(df: DataFrame, label: str = "y", score: str = "score") -> DataFrame:
    """sum_i (R_i - R_{i-1}) P_i over distinct thresholds, descending (== sklearn)."""
    sc = score_counts(df, label, score).withColumn("_neg_score", -F.col(score))
    r = prefix_sum(sc, ["_neg_score"], {"tp": F.col("pos"), "fp": F.col("neg")})
    tot = sc.agg(F.sum("pos").alias("P"))
    x = r.crossJoin(F.broadcast(tot))
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    ap = F.sum(F.try_divide("pos", "P") * prec)        # R_i - R_{i-1} = pos_i / P; without positives 0
    return x.agg(F.coalesce(ap, F.lit(0.0)).alias("average_precision"))


def _prf(tp: Column, fp: Column, fn: Column):
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return p, r, f


def threshold_sweep(df: DataFrame, label: str = "y", score: str = "score", grid=THRESHOLD_GRID) -> DataFrame:
    """M9: precision / recall / F1 of ``score >= thr`` for every threshold in one aggregation pass;
    the best threshold is the first (lowest) reaching the maximum F1."""
    aggs = []
    for i, t in enumerate(grid):
        pred = F.col(score) >= F.lit(t)
        aggs += [F.count_if(pred & (F.col(label) == 1)).alias(f"tp{i}"), F.count_if(pred & (F.col(label) == 0)).alias(f"fp{i}"),
                 F.count_if(~pred & (F.col(label) == 1)).alias(f"fn{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                              F.col(f"fn{i}").alias("fn")) for i, t in enumerate(grid)])
    long = one.select(F.inline(rows))
    p, r, f = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    out = long.select("threshold", p.alias("precision"), r.alias("recall"), f.alias("f1"))
    best = out.agg(F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("_best"))
    return out.crossJoin(best).withColumn("is_best", F.col("threshold") == F.col("_best")).drop("_best")


def classification_report(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """Per-class precision/recall/F1/support, macro and weighted means, accuracy (zero_division=0)."""
    c = df.agg(F.count_if((F.col(pred) == 1) & (F.col(label) == 1)).alias("tp"),
               F.count_if((F.col(pred) == 1) & (F.col(label) == 0)).alias("fp"),
               F.count_if((F.col(pred) == 0) & (F.col(label) == 1)).alias("fn"),
               F.count_if((F.col(pred) == 0) & (F.col(label) == 0)).alias("tn"))
    p1, r1, f1 = _prf(F.col("tp"), F.col("fp"), F.col("fn"))
    p0, r0, f0 = _prf(F.col("tn"), F.col("fn"), F.col("fp"))
    s1 = F.col("tp") + F.col("fn")
    s0 = F.col("tn") + F.col("fp")
    n = s0 + s1
    acc = (F.col("tp") + F.col("tn")) / n
    def row(name, p, r, f, sup):
        return F.struct(F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        sup.cast("double").alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n),
        row("accuracy", acc, acc, acc, n),
        row("confusion tn/fp/fn/tp", F.col("tn").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double"),
            F.col("tp")))
    return c.select(F.inline(rows))


def regression_metrics(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """MAE, RMSE, R^2 of a prediction against the label ; of equal labels, R^2 is NaN if all are hit,
    else -inf (== the SQL, and sklearn's ``r2_score`` with ``force_finite=False``)."""
    err = F.col(pred).cast("double") - F.col(label).cast("double")
    m = df.agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"), F.sum(err * err).alias("_sse"),
               F.var_pop(F.col(label).cast("double")).alias("_var"), F.count(F.lit(1)).alias("_n"))
    equal = F.when(F.col("_sse") == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    r2 = F.when(F.col("_var") == 0, equal).otherwise(F.lit(1.0) - F.col("_sse") / (F.col("_var") * F.col("_n")))
    return m.select("mae", "rmse", r2.alias("r2"))


def champion_gate(new_ap: Column, old_ap: Column, new_f1: Column, old_f1: Column) -> Column:
    """Accept when PR-AUC improves by more than eps, or ties and F1 is not worse (both by the
    same tolerance); no champion -> accept."""
    return (F.when(old_ap.isNull(), F.lit(True))
             .when(new_ap > old_ap + F.lit(GATE_EPS), F.lit(True))
             .when((F.abs(new_ap - old_ap) <= F.lit(GATE_EPS)) & (new_f1 >= old_f1 - F.lit(GATE_EPS)), F.lit(True))
             .otherwise(F.lit(False)))
