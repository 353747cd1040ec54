"""Model bundles (M16-M18, Q8): a fitted pipeline, its threshold and its feature order, saved, promoted and reloaded.

A bundle is a folder (``model`` and one JSON row ``meta``).  Promotion appends a pointer, so earlier bundles stay as
backups and a reader always finds a complete one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.ml import models as Md
from panelcast.operators.clean import align_features
from panelcast.session import path_exists

_POINTER = "n long, path string"


@dataclass
class Bundle:
    model: PipelineModel
    threshold: float
    features: list[str]


def save_bundle(bundle: Bundle, path: str, spark: SparkSession) -> str:
    bundle.model.write().save(f"{path}/model")
    meta = json.dumps({"threshold": bundle.threshold, "features": bundle.features})
    spark.createDataFrame([(meta,)], "value string").write.text(f"{path}/meta")
    return path


def load_bundle(path: str, spark: SparkSession) -> Bundle:
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    if not {"threshold", "features"} <= set(meta):
        raise ValueError(f"the bundle at {path} lacks its threshold or feature order")
    return Bundle(PipelineModel.load(f"{path}/model"), float(meta["threshold"]), list(meta["features"]))


def promote(path: str, base: str, spark: SparkSession) -> None:
    """Makes the bundle at ``path`` the current one of ``base``; the one before stays where it is."""
    pointers = f"{base}/_promoted"
    last = spark.read.schema(_POINTER).json(pointers).agg(F.max("n")).first()[0] if path_exists(spark, pointers) else None
    spark.createDataFrame([((last or 0) + 1, path)], _POINTER).write.mode("append").json(pointers)


def history(base: str, spark: SparkSession) -> list[str]:
    """Promoted bundles, the current one last (a row per promotion)."""
    if not path_exists(spark, f"{base}/_promoted"):
        return []
    return [r.path for r in spark.read.schema(_POINTER).json(f"{base}/_promoted").orderBy("n").collect()]


def current_bundle(base: str, spark: SparkSession) -> Bundle | None:
    found = history(base, spark)
    return load_bundle(found[-1], spark) if found else None


def score(bundle: Bundle, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, ``score`` and ``alarm``: features are aligned to the bundle's order (missing: 0) first."""
    scored = Md.proba(bundle.model.transform(align_features(df, bundle.features, keep)))
    return scored.select(*keep, "score", (F.col("score") >= bundle.threshold).alias("alarm"))
