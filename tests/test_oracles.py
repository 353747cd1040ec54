"""Every registered query with an oracle must match DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.helpers import assert_frames_match

ORACLES = E.oracle_sql()
LLM = {k for k in E.queries() if k == "pipeline" or k.startswith("op") and k[2:].split("_")[0].isdigit()}  # tested beside their operators
KEYS = sorted(k for k in E.queries() if k in ORACLES and k not in LLM)
#: What can't be said in SQL has fitted models inside: rows that must come out, and what must hold for them.
FITTED = {
    "feature_label_split": lambda p: len(p) == 24 * 720 and set(p["split"]) == {"train", "valid", "test"},
    "logreg_fit_score": lambda p: p["proba"].between(0, 1).all() and p["alarm"].any(),
    "logreg_coefficients": lambda p: abs(p["share_pct"].sum()) <= 100.01,
    "gbt_fit_score": lambda p: set(p["split"]) == {"valid", "test"} and p["roc_auc"].between(0, 1).all(),
    "logreg_fold_scores": lambda p: list(p.sort_values("fold")["n_train"].diff().dropna()) == list(p.sort_values("fold")["n_test"])[:2]
    and p["roc_auc"].between(0, 1).all() and abs(p["roc_auc"].mean() - p["mean_roc_auc"][0]) < 1e-9,
    "rf_fit_score": lambda p: abs(p["importance"].sum() - 1) < 1e-6 and p["summary"][0].count('"fold"') == 9 and p["cv_roc_auc"].between(0, 1).all(),
    "linreg_fit_score": lambda p: len(p) == 11 and p["is_best"].sum() == 1,
    "permutation_importance": lambda p: p["feature"].is_unique and (p["importance_std"] >= 0).all(),
    "retrain_summary": lambda p: len(p) == 1 and p["promotions"][0] == 1 + int(p["accepted"][0]),
    "forecast_json": lambda p: len(p) == 24 * 24 and p["proba"].between(0, 1).all(),
    "svd_topics": lambda p: p["doc_id"].nunique() == 200 and p["value"].notna().all(),
    "svd_variance": lambda p: (p.sort_values("component")["singular_value"].diff().dropna() <= 1e-9).all() and (p["ratio"] >= 0).all()
    and 0 < p["cumulative_ratio"].max() <= 1 + 1e-9,
    "chat_topics": lambda p: p["msg_id"].nunique() == 87 and p["value"].notna().all(),
    "svd_top_terms": lambda p: (p.groupby("topic").size() == 10).all(),
}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    got = E.queries()[key](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[key]).df()
    assert_frames_match(got, want, tol=1e-6)


def test_only_fitted_results_lack_sql():
    assert {k for k in E.queries() if k not in ORACLES} - LLM == set(FITTED)


@pytest.mark.parametrize("key", sorted(FITTED))
def test_fitted_result_holds(spark, key):
    assert FITTED[key](E.queries()[key](spark, SF_SMALL).toPandas())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "hours_since_last" in df.columns


@pytest.mark.parametrize("bucket", ["50", "2160"])
@pytest.mark.parametrize("key", ["panel_lag_features", "panel_velocity_zscore", "panel_leakfree_shift",
                                 "panel_clock_lag_features", "panel_ewm"])
def test_panel_queries_independent_of_bucket_size(spark, duck, key, bucket):
    from panelcast.plans.driver import BUCKET_CONF

    spark.conf.set(BUCKET_CONF, bucket)
    try:
        got = E.queries()[key](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.unset(BUCKET_CONF)
    assert_frames_match(got, duck.execute(ORACLES[key]).df(), tol=1e-6)
