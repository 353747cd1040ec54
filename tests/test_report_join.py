"""X11: hours joined to a versioned report table, fixed per batch."""

import datetime as dt

from panelcast.sources.versioned import VersionedTable
from panelcast.streaming import jobs as J

SCHEMA = "day date, doc_id long, week string"


def reports(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), i, "w") for d, i in rows], SCHEMA)


def hours(spark, *days):
    return spark.createDataFrame([(e, dt.datetime(2024, 1, d, 5)) for d in days for e in (1, 2)], "entity_id int, hour timestamp_ntz")


def rows(spark, ws, batch):
    out = spark.read.parquet(f"{ws}/out/batch_id={batch}")
    return sorted((r.hour.day, r.entity_id, r.doc_id, r.as_of_day and r.as_of_day.day) for r in out.collect())


def test_a_replay_after_a_new_report_gives_the_same_rows(spark, tmp_path):
    ws = str(tmp_path)
    table = VersionedTable(spark, f"{ws}/reports", "week")
    sink = J.join_as_of(spark, table, "day", ["doc_id"], ws)
    table.upsert(reports(spark, (2, 20), (4, 40)), ["day"])
    sink(hours(spark, 1, 2, 3, 5), 0)
    want = [(d, e, i, a) for d, i, a in ((1, None, None), (2, 20, 2), (3, 20, 2), (5, 40, 4)) for e in (1, 2)]
    assert rows(spark, ws, 0) == want
    table.upsert(reports(spark, (1, 10), (3, 30), (4, 41)), ["day"])
    sink(hours(spark, 1, 2, 3, 5), 0)  # replayed: still the first version
    assert rows(spark, ws, 0) == want
    sink(hours(spark, 1, 2, 3, 5), 1)
    assert rows(spark, ws, 1) == [(d, e, i, a) for d, i, a in ((1, 10, 1), (2, 20, 2), (3, 30, 3), (5, 41, 4)) for e in (1, 2)]


def test_before_the_first_report(spark, tmp_path):
    ws = str(tmp_path)
    table = VersionedTable(spark, f"{ws}/reports", "week")
    sink = J.join_as_of(spark, table, "day", ["doc_id"], ws)
    sink(hours(spark, 1), 0)
    assert spark.read.parquet(f"{ws}/out/batch_id=0").columns == ["entity_id", "hour"]
    table.upsert(reports(spark, (1, 10)), ["day"])
    sink(hours(spark, 1), 0)  # the pin says: no version
    assert spark.read.parquet(f"{ws}/out/batch_id=0").columns == ["entity_id", "hour"]
