"""Feature rows of the forecast hours against look-ups in plain dictionaries."""

import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import feature_rows as R

ORIGIN = 19_800 * 24 + 10
EDGES = [(0, 1), (1, 2), (2, 0), (0, 2), (3, 0)]


def feeds_of(spark, cells, topics, reports):
    c = spark.createDataFrame(cells, "entity_id int, t long, y int, n_events long, value_avg double, value_max double")
    e = spark.createDataFrame(EDGES, "src int, dst int")
    v = spark.createDataFrame(topics, "t long, vec array<double>")
    r = spark.createDataFrame(reports, "d int, n_chars long").select(F.date_from_unix_date("d").alias("day"), "n_chars")
    return R.tagged_feeds(c, e, v, r, ORIGIN)


def rows(spark, cells, topics=(), reports=(), entities=4):
    ents = spark.range(entities).select(F.col("id").cast("int").alias("entity_id"))
    out = R.feature_rows(feeds_of(spark, list(cells), list(topics), list(reports)), ents, ORIGIN).withColumn("t", F.unix_micros(F.col("hour").cast("timestamp")) / 3_600_000_000)
    return {(r.entity_id, int(r.t)): r for r in out.collect()}


def check(got, cells, topics, reports, entities=4):
    cells = {(e, t): r for r in cells for e, t in [r[:2]] if t < ORIGIN}
    topics = {t: v for t, v in topics if t < ORIGIN}
    reports = {d: n for d, n in reports if d * 24 < ORIGIN}
    assert set(got) == {(e, ORIGIN + k) for e in range(entities) for k in range(24)}
    last_any = max((t for _, t in cells), default=None)

    def intensity(t):
        have = [u for u in topics if u <= t - 1]
        return sum(map(abs, topics[max(have)])) * 0.5 ** ((t - 1 - max(have)) / 6) if have else 0.0

    for (e, t), r in got.items():
        y = lambda u, x=e: cells[x, u][2] if (x, u) in cells else 0
        assert [r.lag_1, r.lag_3, r.lag_6, r.lag_12] == [y(t - k) for k in (1, 3, 6, 12)]
        assert r.active_last_24h == sum(y(t - k) for k in range(1, 25))
        assert r.total_lag_1 == sum(y(t - 1, x) for x in range(entities)) and r.neighbours_lag_1 == sum(y(t - 1, d) for s, d in EDGES if s == e)
        mine = [u for x, u in cells if x == e]
        on = [u for u in mine if y(u)]
        assert r.hours_since_last == (t - 1 - max(on) if on else len(mine))
        last = cells[e, max(mine)] if mine else None
        for name, age, back, col in (("hour_value", r.hour_value_age, 1, 4), ("day_value", r.day_value_age, 24, 5)):
            src = cells.get((e, t - back)) or last
            assert r[name] == (src[col] if src else 0.0) and age == (t - back - src[1] if src else None)
        if (e, t - 1) in cells:
            want = cells[e, t - 1][3]
        else:
            want = last[3] * 0.5 ** ((t - 1 - last_any) / 6) if last and last[1] == last_any else 0.0
        assert r.signal == pytest.approx(want)
        day = (t - 24) // 24
        used = day if day in reports else max(reports, default=None)
        assert (r.report_chars, r.report_age_days) == ((reports[used], day - used) if used is not None else (0, None))
        assert r.topic_intensity == pytest.approx(intensity(t)) and r.topic_velocity_24h == pytest.approx(intensity(t) - intensity(t - 24))
        series = [intensity(u) for u in range(ORIGIN - R.LEAD, t + 1)]
        weights = [(5 / 7) ** (len(series) - 1 - i) for i in range(len(series))]
        assert r.topic_ema_6h == pytest.approx(sum(a * b for a, b in zip(series, weights)) / sum(weights))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_dictionaries(spark, seed):
    rng = random.Random(seed)
    cells = [(e, t, rng.randint(0, 1), rng.randint(1, 9), rng.random(), rng.random()) for e in range(3) for t in range(ORIGIN - 90, ORIGIN + 30) if rng.random() < 0.3]
    topics = [(t, [rng.uniform(-1, 1) for _ in range(3)]) for t in range(ORIGIN - 80, ORIGIN + 9) if rng.random() < 0.15]
    reports = [(d, rng.randint(1, 99)) for d in range(19_780, 19_803) if rng.random() < 0.4]
    check(rows(spark, cells, topics, reports), cells, topics, reports)


def test_old_history_only(spark):
    cells = [(0, ORIGIN - 5000, 1, 3, 1.5, 2.5), (1, ORIGIN - 900, 0, 2, 0.5, 0.75)]
    topics, reports = [(ORIGIN - 700, [1.0, -2.0])], [(19_000, 5)]
    check(rows(spark, cells, topics, reports), cells, topics, reports)


def test_nothing_landed(spark):
    got = rows(spark, [])
    check(got, [], [], [])
    assert all(r.signal_age is None and r.topic_age is None and r.topic_intensity == 0.0 for r in got.values())


def test_the_future_is_not_read(spark):
    rng = random.Random(5)
    past = [(e, t, rng.randint(0, 1), 1, rng.random(), 1.0) for e in range(3) for t in range(ORIGIN - 40, ORIGIN)]
    future = [(e, t, 1, 9, 9.0, 9.0) for e in range(3) for t in range(ORIGIN, ORIGIN + 24)]
    assert rows(spark, past) == rows(spark, past + future)
