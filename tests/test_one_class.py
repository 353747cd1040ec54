"""Tables whose target is one class only, and groups of equal values: every division by their spread or count of a class."""

import math

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelcast.ml import metrics as Mx
from panelcast.ml import models as Md
from panelcast.operators import aggregates as G


def test_kde_of_equal_values(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 5.0), (1, 5.0), (2, 7.0)], "y int, v double")
    got = {(r.y, r.point): r.density for r in G.kde_by_class(df, "v", "y", [0.0, 5.0]).collect()}
    assert len(got) == 6
    assert math.isnan(got[1, 0.0]) and math.isnan(got[1, 5.0])  # bandwidth 0
    assert got[2, 0.0] is None and got[2, 5.0] is None          # no deviation of one value
    h = math.sqrt(0.5) * 2 ** -0.2
    want = sum(math.exp(-0.5 * (v / h) ** 2) for v in (1, 2)) / (2 * h * math.sqrt(2 * math.pi))
    assert abs(got[0, 0.0] - want) < 1e-12


def test_regression_metrics_of_equal_labels(spark):
    made = lambda rows: Mx.regression_metrics(spark.createDataFrame(rows, "y int, pred double")).first()
    assert math.isnan(made([(1, 1.0), (1, 1.0)]).r2)
    missed = made([(1, 1.0), (1, 0.0)])
    assert missed.r2 == float("-inf") and missed.mae == 0.5
    assert abs(made([(1, 1.0), (0, 1.0)]).r2 + 1.0) < 1e-12


def test_average_precision_without_positives(spark):
    none = spark.createDataFrame([(0, 0.2), (0, 0.7)], "y int, score double")
    assert Mx.average_precision(none).first()[0] == 0.0


def folds(spark, label):
    """40 rows in three test blocks of 10."""
    rows = spark.range(40).select(F.col("id").alias("pos"), label(F.col("id")).cast("int").alias("y"),
                                  array_to_vector(F.array((F.col("id") % 7).cast("double"))).alias("features"))
    block = F.when(F.col("pos") >= 10, F.floor((F.col("pos") - 10) / 10)).cast("int")
    return rows.select("*", block.alias("test_fold"), F.lit(10).alias("fold_size"), F.lit(10).alias("_first_test"))


GRID = [{"numTrees": 2, "maxDepth": 2}, {"numTrees": 3, "maxDepth": 2}]


@pytest.mark.parametrize("value", [0, 1])
def test_forest_search_over_one_class(spark, value):
    best, mean, scores = Md.search_forest(folds(spark, lambda i: F.lit(value)), GRID)
    assert best == GRID[0] and mean is None
    assert len(scores) == 6 and all(s["roc_auc"] is None and s["n_test"] == 10 for s in scores)


def test_forest_search_leaves_blocks_of_one_class_out_of_the_mean(spark):
    best, mean, scores = Md.search_forest(folds(spark, lambda i: (i < 20) & (i % 2 == 0)), GRID[:1])  # the last two blocks are all 0
    assert [s["roc_auc"] is None for s in scores] == [False, True, True]
    assert mean == scores[0]["roc_auc"]
