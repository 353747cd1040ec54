"""Model queries (M1, M3-M8, M14, M15, M17, M18) on the leak-free model panel; rows-only checks
(model internals differ from the single-machine libraries; the metrics themselves are exact)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.ml import bundle as B
from panelcast.ml import models as Md
from panelcast.ml import split as Sp
from panelcast.operators import windows as W
from panelcast.operators.clean import align_features
from panelcast.operators.graph import lagged_global_total, lagged_neighbour_sum
from panelcast.plans import driver as D
from panelcast.plans.q_panel import FAMILY_SHIFTS, family_columns, lag_feature_block, wide_panel
from panelcast.plans.registry import query
from panelcast.session import materialize

# Columns never used as model inputs (target, keys, calendar strings, leak-prone totals)
DROP_COLS = ["y", "entity_id", "hour", "t", "alarms_in_last_24h", "neighbour_lag1", "total_lag1"]
# Search grid used by the registered queries: the product grid's shape at test-sized iteration counts
QUICK_GBT_GRID = [{"stepSize": 0.1, "maxIter": 15, "maxDepth": 4, "minInstancesPerNode": 50},
                  {"stepSize": 0.1, "maxIter": 15, "maxDepth": 5, "minInstancesPerNode": 100}]


def model_panel(spark, sf):
    """Leak-free model panel — lag block, neighbour/global totals and family-shifted sources."""
    p = D.hourly_panel(spark, sf)
    lags = lag_feature_block(p).select("entity_id", "hour", "t", "y", "lag_1", "lag_3", "lag_6", "lag_12",
                                       "alarms_in_last_24h", "hours_since_last", "is_weekend", "is_night")
    tot = lagged_neighbour_sum(lagged_global_total(p.select("entity_id", "hour", "y"), "y"), D.edges(spark), "y")
    wide = wide_panel(spark, sf)
    shifted = W.family_shift(wide, family_columns(wide.columns, FAMILY_SHIFTS), bucket_rows=D.bucket_rows(spark))
    src = shifted.select("entity_id", "hour", "hour_value_avg", F.col("hour_busy").cast("int").alias("hour_busy"),
                         "day_value_max", "msg_n_events", "rep_n_chars")
    return lags.join(tot.select("entity_id", "hour", "total_lag1", "neighbour_lag1"), ["entity_id", "hour"]).join(
        src, ["entity_id", "hour"])


def features_of(df):
    return [c for c in df.columns if c not in DROP_COLS and not c.startswith("_") and c not in ("pos", "split")]


def split_panel(spark, sf):
    mp = model_panel(spark, sf)
    # written once: fits, thresholds and scores pass over it many times
    return materialize(Sp.chronological_split(mp, "hour", "entity_id"), "split-panel")


@query("feature_label_split", covers="M1 P13")
def feature_label_split(spark, sf):
    x = split_panel(spark, sf)
    feats = features_of(x)
    a = Md.assemble(x, feats)
    return a.select("entity_id", "hour", "split", F.col("y").alias("label"),
                    Md.vector_to_array("features").alias("features"))


def _train_test(spark, sf):
    x = split_panel(spark, sf)
    return x.filter(F.col("split") == "train"), x.filter(F.col("split") == "test"), x


@query("logreg_fit_score", covers="M6 M15 M18")
def logreg_fit_score(spark, sf):
    tr, te, x = _train_test(spark, sf)
    feats = features_of(tr)
    trw = Md.with_balanced_weights(tr)
    n_w = trw.agg(F.sum("w")).first()[0]
    model = Md.logreg_pipeline(feats, n_w).fit(trw)
    valid = Md.proba(model.transform(x.filter(F.col("split") == "valid"))).select("y", "score")
    thr = Md.best_threshold(valid)  # never from the rows it is reported on
    scored = Md.proba(model.transform(te)).select("entity_id", "hour", "y", "score")
    return scored.select("entity_id", "hour", "y", F.round("score", 4).alias("proba"),
                         (F.col("score") >= thr).alias("alarm"))


def folded(train, n_splits=3):
    """Training rows with their expanding fold, written."""
    ntr = train.agg(F.count(F.lit(1)).alias("_ntr"))
    x = Sp.expanding_folds(train.crossJoin(F.broadcast(ntr)), "_ntr", n_splits)
    return x.withColumn("_first_test", F.col("_ntr") - F.col("fold_size") * n_splits)


@query("logreg_fold_scores", covers="M6 W16 M10 M11")
def logreg_fold_scores(spark, sf):
    """M6: the pipeline over three expanding folds, medians and scales from each fold's past; mean and deviation beside every fold."""
    tr, _, _ = _train_test(spark, sf)
    feats = features_of(tr)

    def fit(rows):
        w = Md.with_balanced_weights(rows)
        return Md.logreg_pipeline(feats, w.agg(F.sum("w")).first()[0]).fit(w)

    rows = Md.fold_scores(materialize(folded(tr), "folds"), fit)
    out = spark.createDataFrame([(r["fold"], r["n_train"], r["n_test"], r["roc_auc"], r["average_precision"]) for r in rows],
                                "fold int, n_train bigint, n_test bigint, roc_auc double, average_precision double")
    stats = [f(c).alias(f"{n}_{c}") for c in ("roc_auc", "average_precision") for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return out.crossJoin(out.agg(*stats))  # three rows and one


@query("logreg_coefficients", covers="M15")
def logreg_coefficients(spark, sf):
    tr, _, _ = _train_test(spark, sf)
    feats = features_of(tr)
    trw = Md.with_balanced_weights(tr)
    model = Md.logreg_pipeline(feats, trw.agg(F.sum("w")).first()[0]).fit(trw)
    coef = model.stages[-1].coefficients.toArray().tolist()
    rows = sorted(zip(feats, coef), key=lambda r: -abs(r[1]))
    tot = sum(abs(c) for _, c in rows) or 1.0
    return spark.createDataFrame([(f, float(c), abs(c) / tot * 100) for f, c in rows[:20]],
                                 "feature string, coefficient double, share_pct double")


@query("gbt_fit_score", covers="M3 M8 M9 M17")
def gbt_fit_score(spark, sf):
    x = split_panel(spark, sf)
    tr = x.filter(F.col("split") == "train")
    feats = features_of(x)
    tr = materialize(Md.assemble(folded(tr), feats), "gbt-folds")
    params, cv_ap, oof = Md.search_gbt(tr, QUICK_GBT_GRID)
    thr = Md.best_threshold(oof)
    final = Md.gbt(params).fit(Md.with_balanced_weights(tr))
    rows = []
    for name in ("valid", "test"):
        part = Md.assemble(x.filter(F.col("split") == name), feats)
        m = Md.evaluate(Md.proba(final.transform(part)).select("y", "score"), thr)
        rows.append((name, m["average_precision"], m["roc_auc"], m["f1"], thr, cv_ap,
                     Md.summary_record("gbt", m, {"params": params, "threshold": thr})))
    imp = final.featureImportances.toArray().tolist()
    top = sorted(zip(feats, imp), key=lambda r: -r[1])[:20]
    return spark.createDataFrame([r + (str(top),) for r in rows],
                                 "split string, average_precision double, roc_auc double, f1 double, threshold double, "
                                 "cv_average_precision double, summary string, top_importances string")


@query("rf_fit_score", covers="M5 M15")
def rf_fit_score(spark, sf):
    """M5: the product's three forests by mean ROC-AUC over expanding folds; the best is fitted on all training rows and tested."""
    tr, te, _ = _train_test(spark, sf)
    feats = features_of(tr)
    best, cv_auc, scores = Md.search_forest(materialize(Md.assemble(folded(tr), feats), "forest-folds"))
    model = Md.fit_forest(Md.assemble(tr, feats), **best)
    scored = materialize(Md.proba(model.transform(Md.assemble(te, feats))).select("y", "score"), "forest-scores")
    m = Md.evaluate(scored, 0.5)
    summary = Md.summary_record("forest", m, {"params": best, "folds": scores})
    imp = sorted(zip(feats, model.featureImportances.toArray().tolist()), key=lambda r: -r[1])
    return spark.createDataFrame([(f, float(v), m["average_precision"], m["roc_auc"], cv_auc, best["numTrees"], best["maxDepth"], summary) for f, v in imp],
                                 "feature string, importance double, test_average_precision double, test_roc_auc double, "
                                 "cv_roc_auc double, num_trees int, max_depth int, summary string")


@query("linreg_fit_score", covers="M7 M13")
def linreg_fit_score(spark, sf):
    from panelcast.ml import metrics as Mx
    tr, te, x = _train_test(spark, sf)
    feats = features_of(tr)
    model = Md.linreg().fit(Md.assemble(tr, feats).withColumn("y", F.col("y").cast("double")))
    score = lambda part: model.transform(Md.assemble(part, feats)).select("y", F.col("prediction").alias("score"))
    grid = [round(0.20 + 0.05 * i, 2) for i in range(11)]        # the linear model sweeps from 0.20
    sweep = Mx.threshold_sweep(score(x.filter(F.col("split") == "valid")), grid=grid)  # tuned on the validation rows
    thr = sweep.filter("is_best").first()["threshold"]
    reg = Mx.regression_metrics(score(te).withColumn("pred", (F.col("score") >= thr).cast("double")))
    return sweep.crossJoin(reg)


@query("permutation_importance", covers="M14")
def permutation_importance(spark, sf):
    tr, te, _ = _train_test(spark, sf)
    feats = features_of(tr)
    trw = Md.with_balanced_weights(tr)
    model = Md.logreg_pipeline(feats, trw.agg(F.sum("w")).first()[0]).fit(trw)
    # the product samples 20k rows; a seeded hash keeps it deterministic (the sample is the feature)
    sample = te.withColumn("row_id", F.xxhash64("entity_id", "hour")).orderBy(F.xxhash64("row_id", F.lit(42))).limit(20000)
    return Md.permutation_importance(model, sample.select("row_id", "y", *feats), feats, repeats=5)


def fit_bundle(x, rows=None) -> B.Bundle:
    """The balanced logistic pipeline on the training rows (or on ``rows``), its threshold from the validation rows."""
    tr = rows if rows is not None else x.filter(F.col("split") == "train")
    feats = features_of(x)
    flat = lambda df: align_features(df, feats, ["y"])
    trw = Md.with_balanced_weights(flat(tr))
    model = Md.logreg_pipeline(feats, trw.agg(F.sum("w")).first()[0]).fit(trw)
    thr = Md.best_threshold(Md.proba(model.transform(flat(x.filter(F.col("split") == "valid")))).select("y", "score"))
    return B.Bundle(model, thr, feats)


@query("retrain_summary", covers="M16 M17 M18 P13")
def retrain_summary(spark, sf):
    """The stored champion (fitted on the first half of the training rows) against a retrained challenger on the test
    rows; the gate decides whether the challenger is promoted.  The champion's folder stays as the backup.  The summary is
    written as one JSON record and returned.
    """
    from panelcast.ml import metrics as Mx
    from panelcast.session import scratch_path

    x = split_panel(spark, sf)
    te = x.filter(F.col("split") == "test")
    base = scratch_path(spark, f"production/{uuid.uuid4().hex[:12]}")
    train = x.filter(F.col("split") == "train")
    half = train.agg((F.max("pos") / 2).alias("p")).first().p
    B.promote(B.save_bundle(fit_bundle(x, train.filter(F.col("pos") < half)), f"{base}/v1", spark), base, spark)

    champion, challenger = B.current_bundle(base, spark), fit_bundle(x)
    metrics = {n: Md.evaluate(B.score(b, te, ["y"]), b.threshold) for n, b in (("old", champion), ("new", challenger))}
    old, new = metrics["old"], metrics["new"]
    ok = spark.range(1).select(Mx.champion_gate(F.lit(new["average_precision"]), F.lit(old["average_precision"]),
                                                F.lit(new["f1"]), F.lit(old["f1"])).alias("a")).first()["a"]
    B.save_bundle(challenger, f"{base}/v2", spark)
    if ok:
        B.promote(f"{base}/v2", base, spark)
    done = B.history(base, spark)
    rec = Md.summary_record("logreg", {f"new_{k}": v for k, v in new.items()},
                            {**{f"old_{k}": v for k, v in old.items()}, "threshold": challenger.threshold, "accepted": bool(ok),
                             "promoted": done[-1], "backups": done[:-1], "n_test": te.count(), "features": challenger.features})
    out = spark.createDataFrame([(rec, bool(ok), challenger.threshold, len(done))], "record string, accepted boolean, threshold double, promotions int")
    out.write.json(f"{base}/retrain_metrics")
    return out
