"""Model training, search and scoring on DataFrames.

Spark ML estimators replace the single-machine libraries: ``GBTClassifier`` (depth-wise boosting;
compare by metric, not by prediction), ``RandomForestClassifier``, an Imputer -> StandardScaler ->
``LogisticRegression`` pipeline and ``LinearRegression``.  Class balance is a ``weightCol`` from a
class-count join (M2).  Folds are the time-ordered expanding windows of ``ml.split`` (Spark's
``CrossValidator`` folds are random), and every fold is scored with the exact distributed metrics.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.ml import metrics as Mx
from panelcast.ml.split import class_weights
from panelcast.session import materialize

# The product's boosting grid (learning rate, iterations, leaves, min leaf, l2).  Spark's
# GBT has no leaf-count or l2 knob: leaves map to depth ceil(log2(leaves)), min leaf to minInstancesPerNode.
PRODUCT_GBT_GRID = [
    {"stepSize": 0.05, "maxIter": 300, "maxDepth": 5, "minInstancesPerNode": 50},
    {"stepSize": 0.05, "maxIter": 400, "maxDepth": 5, "minInstancesPerNode": 100},
    {"stepSize": 0.03, "maxIter": 500, "maxDepth": 6, "minInstancesPerNode": 50},
    {"stepSize": 0.03, "maxIter": 600, "maxDepth": 6, "minInstancesPerNode": 100},
]
LOGREG_C = 0.01
# The product's forest grid (trees, depth); min_samples_leaf is minInstancesPerNode
PRODUCT_FOREST_GRID = [{"numTrees": 50, "maxDepth": 8}, {"numTrees": 100, "maxDepth": 10}, {"numTrees": 200, "maxDepth": 10}]


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Numeric feature vector (booleans -> 0/1, NULL/NaN kept for the imputer)."""
    cast = df.select("*", *[F.col(c).cast("double").alias(f"__f_{c}") for c in features])
    va = VectorAssembler(inputCols=[f"__f_{c}" for c in features], outputCol=out, handleInvalid="keep")
    return va.transform(cast).drop(*[f"__f_{c}" for c in features])


def with_balanced_weights(df: DataFrame, label: str = "y", out: str = "w") -> DataFrame:
    """M2: n / (k * n_c) per row; the planner broadcasts the class table if it is small."""
    return df.join(class_weights(df, label).select(label, F.col("weight").alias(out)), label)


def proba(model_df: DataFrame, out: str = "score") -> DataFrame:
    """P(class 1) as a column."""
    return model_df.withColumn(out, vector_to_array("probability")[1])


def gbt(params: dict, label: str = "y", weight: str = "w") -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol=label, weightCol=weight, seed=42, **params)


def logreg_pipeline(features: list[str], n_weighted: float, label: str = "y", weight: str = "w") -> Pipeline:
    """M6: median imputation -> standardisation -> L2 logistic regression (C=0.01, balanced).

    sklearn minimises C * sum(w * loss) + 0.5 ||b||^2; Spark minimises mean(w * loss) + reg/2 ||b||^2,
    so regParam = 1 / (C * sum(w)).
    """
    imp = Imputer(inputCols=features, outputCols=[f"__i_{c}" for c in features], strategy="median")
    va = VectorAssembler(inputCols=[f"__i_{c}" for c in features], outputCol="raw", handleInvalid="keep")
    sc = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol=weight, maxIter=500,
                            regParam=1.0 / (LOGREG_C * n_weighted), elasticNetParam=0.0)
    return Pipeline(stages=[imp, va, sc, lr])


def fold_frames(positioned: DataFrame, fold: int, n_splits: int = 3):
    """Expanding-window fold: train = rows before the fold's test block, test = the block."""
    train = positioned.filter(F.col("pos") < F.col("_first_test") + F.col("fold_size") * fold)
    test = positioned.filter(F.col("test_fold") == fold)
    return train, test


def search_gbt(train: DataFrame, grid: list[dict], n_splits: int = 3):
    """M3/M8: grid x expanding folds, mean fold average precision, out-of-fold scores of the best.

    ``train`` carries ``pos``, ``test_fold``, ``fold_size``, ``_first_test`` (see ``ml.split``).
    Returns (best params, best mean AP, out-of-fold scored DataFrame).
    """
    best, best_score, best_oof = None, float("-inf"), None
    for params in grid:
        scores, oofs = [], []
        for f in range(n_splits):
            tr, te = fold_frames(train, f, n_splits)
            model = gbt(params).fit(with_balanced_weights(tr))
            scored = proba(model.transform(te)).select("y", "score")
            scores.append(Mx.average_precision(scored).first()[0])
            oofs.append(scored)
        mean = sum(scores) / len(scores)
        if mean > best_score:
            best, best_score = params, mean
            best_oof = oofs[0]
            for o in oofs[1:]:
                best_oof = best_oof.unionByName(o)
    return best, best_score, best_oof


def fold_scores(train: DataFrame, fit, n_splits: int = 3) -> list[dict]:
    """Per expanding fold: rows trained on and tested, ROC-AUC and average precision of ``fit(fold's training rows)`` on its test block.

    ``train`` carries ``pos``, ``test_fold``, ``fold_size``, ``_first_test``; whatever ``fit`` learns (medians, scales) comes from the fold's past.
    """
    out = []
    for f in range(n_splits):
        tr, te = fold_frames(train, f, n_splits)
        scored = materialize(proba(fit(tr).transform(te)).select("y", "score"), "fold-scores")  # two metrics read it
        out.append({"fold": f, "n_train": tr.count(), "n_test": scored.count(), "roc_auc": Mx.roc_auc(scored).first()[0],
                    "average_precision": Mx.average_precision(scored).first()[0]})
    return out


def search_forest(train: DataFrame, grid: list[dict] = PRODUCT_FOREST_GRID, n_splits: int = 3) -> tuple[dict, float, list[dict]]:
    """M5: (best point, its mean ROC-AUC over the expanding folds, all scores); the first of equal points stays.

    A test block of one class has no ROC-AUC and counts in no mean; if no block has one, the mean is None.
    """
    scores = []
    for params in grid:
        folds = fold_scores(train, lambda tr: fit_forest(tr, **params), n_splits)  # noqa: B023
        scores += [{**params, **f} for f in folds]

    def mean(p):
        known = [s["roc_auc"] for s in scores if all(s[k] == v for k, v in p.items()) and s["roc_auc"] is not None]
        return sum(known) / len(known) if known else None

    best = max(grid, key=lambda p: -1.0 if mean(p) is None else mean(p))
    return best, mean(best), scores


def best_threshold(scored: DataFrame) -> float:
    """M9 on out-of-fold scores: the lowest threshold with the maximum F1."""
    t = Mx.threshold_sweep(scored).filter("is_best").select("threshold").first()
    return float(t[0]) if t else 0.5


def evaluate(scored: DataFrame, threshold: float) -> dict:
    """AP, ROC-AUC and F1 at the threshold (exact, distributed)."""
    ap = Mx.average_precision(scored).first()[0]
    auc = Mx.roc_auc(scored).first()[0]
    rep = Mx.classification_report(scored.withColumn("pred", (F.col("score") >= threshold).cast("int")))
    f1 = rep.filter(F.col("label") == "1").select("f1").first()[0]
    return {"average_precision": ap, "roc_auc": auc, "f1": f1}


def permutation_importance(model, df: DataFrame, features: list[str], repeats: int = 5, seed: int = 42,
                           key: str = "row_id") -> DataFrame:
    """Drop in average precision when one feature is permuted, mean and std over repeats.

    A permutation pairs each row with the row of the same rank under a seeded hash order (two
    distributed rank columns and one equi-join per repeat), and all (feature, repeat) variants are
    scored in one transform and one grouped metric pass.
    """
    from panelcast.operators.ranking import prefix_sum

    base = Mx.average_precision(proba(model.transform(df)).select("y", "score")).first()[0]
    ranked = prefix_sum(df.select(key), [key], None, out="_r")
    perms = None
    for r in range(repeats):
        h = df.select(key, *features).withColumn("_h", F.xxhash64(F.col(key), F.lit(seed + r)))
        hr = prefix_sum(h, ["_h", key], None, out="_r").drop("_h", key)
        p = ranked.join(hr, "_r").drop("_r").withColumn("_repeat", F.lit(r))      # key -> permuted source values
        p = p.select(key, "_repeat", *[F.col(f).alias(f"_p_{f}") for f in features])
        perms = p if perms is None else perms.unionByName(p)
    # one join and one generator: each (row, repeat) is expanded over the features, and only the
    # variant's own feature takes the permuted value
    x = df.join(perms, key).withColumn("_feature", F.explode(F.array(*[F.lit(f) for f in features])))
    allv = x.select(key, "y", "_feature", "_repeat", *[
        F.when(F.col("_feature") == F.lit(f), F.col(f"_p_{f}")).otherwise(F.col(f)).alias(f) for f in features],
        *[c for c in df.columns if c not in features and c not in (key, "y")])
    scored = proba(model.transform(allv)).select("_feature", "_repeat", "y", "score")
    sc = scored.groupBy("_feature", "_repeat", "score").agg(
        F.sum(F.col("y").cast("long")).alias("pos"), F.sum((1 - F.col("y")).cast("long")).alias("neg"))
    sc = sc.withColumn("_neg_score", -F.col("score"))
    r2 = prefix_sum(sc, ["_neg_score"], {"tp": F.col("pos"), "fp": F.col("neg")}, keys=["_feature", "_repeat"])
    P = sc.groupBy("_feature", "_repeat").agg(F.sum("pos").alias("P"))
    ap = (r2.join(P, ["_feature", "_repeat"]).groupBy("_feature", "_repeat")
          .agg(F.coalesce(F.sum(F.try_divide("pos", "P") * F.col("tp") / (F.col("tp") + F.col("fp"))), F.lit(0.0)).alias("ap")))
    drop = ap.withColumn("drop", F.lit(base) - F.col("ap"))
    return drop.groupBy(F.col("_feature").alias("feature")).agg(F.avg("drop").alias("importance_mean"),
                                                                F.stddev_pop("drop").alias("importance_std"))


def summary_record(name: str, metrics: dict, extra: dict | None = None) -> str:
    """The retrain summary as one JSON document."""
    return json.dumps({"model": name, **metrics, **(extra or {})}, sort_keys=True, default=str)


def linreg(label: str = "y") -> LinearRegression:
    """M7: linear regression used as a score."""
    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.0)


def random_forest(label: str = "y", weight: str = "w", numTrees: int = 50, maxDepth: int = 8) -> RandomForestClassifier:
    """M5: class-weighted random forest."""
    return RandomForestClassifier(featuresCol="features", labelCol=label, weightCol=weight, numTrees=numTrees,
                                  maxDepth=maxDepth, minInstancesPerNode=5, seed=42)


def fit_forest(rows: DataFrame, label: str = "y", **params):
    """The forest fitted on class-weighted ``rows``; the label is marked as binary, so rows of class 0 alone give two probabilities too."""
    marked = rows.withMetadata(label, {"ml_attr": {"type": "binary", "name": label}})
    return random_forest(label, **params).fit(with_balanced_weights(marked, label))
