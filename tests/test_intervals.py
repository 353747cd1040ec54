"""Minutes and flags by sweep line against the long form, over overlapping, nested, long and zero-length intervals."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import intervals as I

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "entity_id int, start timestamp_ntz, end timestamp_ntz"


@pytest.fixture(scope="module")
def rows():
    import random

    rng = random.Random(5)
    out = []
    for _ in range(300):
        a = T0 + dt.timedelta(microseconds=rng.choice([3_600_000_000, 60_000_000, 1]) * rng.randrange(60))
        out.append((rng.choice([1, 2, 2, 2, None]), a, a + rng.choice([0, 1, 59, 60, 61, 125, 600, 4000]) * rng.choice([dt.timedelta(minutes=1), dt.timedelta(seconds=1)])))
    return out + [(1, T0, T0), (3, T0 + dt.timedelta(minutes=5), T0 + dt.timedelta(minutes=5)), (1, T0, None)]


def test_minutes_equal_the_long_form(spark, rows):
    iv = spark.createDataFrame(rows, SCHEMA)
    want = I.hourly_minutes(I.expand_minutes(iv), ["entity_id"]).collect()
    got = I.swept_minutes(iv, ["entity_id"])
    assert got.columns == ["entity_id", "hour", "minutes_in_hour", "active"]
    assert len(want) > 60 and sorted(map(str, got.collect())) == sorted(map(str, want))


def test_flags_equal_the_predicate(spark, rows):
    iv = spark.createDataFrame(rows, SCHEMA)
    cells = [(e, T0 + dt.timedelta(hours=h), f"{e}-{h}") for e in (1, 2, 3, 4, None) for h in range(-3, 140)] * 2
    grid = spark.createDataFrame(cells, "entity_id int, hour timestamp_ntz, name string")
    got = I.overlap_flags(iv, grid, ["entity_id"])
    assert got.columns == ["entity_id", "hour", "name", "active"]
    hour = dt.timedelta(hours=1)
    want = [(e, h, n, int(any(e is not None and e == k and b is not None and a < h + hour and b > h for k, a, b in rows))) for e, h, n in cells]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def test_rows_that_move_grow_with_intervals_not_with_hours(spark):
    """A year-long interval is three marks, and the hours are made behind the last exchange."""
    iv = spark.range(200).select(F.lit(1).alias("entity_id"), F.lit(T0).cast("timestamp_ntz").alias("start"),
                                 (F.lit(T0).cast("timestamp_ntz") + F.expr("INTERVAL 365 DAYS")).alias("end"))
    out = I.swept_minutes(iv, ["entity_id"])
    assert out.count() == 365 * 24 and out.agg(F.min("minutes_in_hour"), F.max("minutes_in_hour")).first()[:] == (60.0, 60.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("sequence(") < plan.index("Exchange")  # the plan is printed from its last step on


def test_empty(spark):
    assert I.swept_minutes(spark.createDataFrame([], SCHEMA), ["entity_id"]).count() == 0
