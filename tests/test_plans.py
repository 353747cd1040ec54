"""Plan guards on headline queries: no Python UDFs, pruned scans, one pass over the events."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

HEADLINE = ["panel_lag_features", "panel_ewm", "panel_leakfree_shift", "panel_neighbour_totals", "asof_daily_report",
            "serve_peak_hour", "tfidf_weights", "five_number"]


def plan_of(spark, key):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else paths are cut short in the plan's text
    return E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", HEADLINE)
def test_no_python_in_headline_plans(spark, key):
    plan = plan_of(spark, key)
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("key", ["panel_lag_features", "panel_neighbour_totals", "panel_leakfree_shift", "asof_daily_report",
                                 "panel_ewm", "serve_peak_hour", "serve_region_stats"])
def test_events_are_scanned_once_for_the_cells(spark, key):
    """The cells table is written in one pass; the query itself reads that table, however many branches it has."""
    plan = plan_of(spark, key)
    assert plan.count("events.parquet") == 0 and "materialized/cells" in plan


@pytest.mark.parametrize("key", ["panel_leakfree_shift", "asof_daily_report", "panel_source_join"])
def test_report_features_do_not_read_texts(spark, key):
    plan = plan_of(spark, key)
    scans = [line for line in plan.splitlines() if "documents.parquet" in line]
    assert scans and all("text:string" not in line for line in scans)


def test_tail_filter_reaches_the_scan(spark):
    from panelcast.plans import driver as D
    from panelcast.sources.tables import read_tail

    plan = read_tail(D.events(spark, SF_SMALL), "ts", 48)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan
