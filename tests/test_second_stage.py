"""The second stage: holes are filled from the earliest one on, nothing before it changes, replays are no-ops."""

import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from panelcast.plans import q_stream as Q
from panelcast.session import scratch_path
from panelcast.sources.versioned import VersionedTable
from panelcast.streaming import jobs as J

T0 = datetime(2024, 1, 1)


def test_holes_and_replays(spark):
    ws = scratch_path(spark, f"second/{uuid.uuid4().hex}")
    rows = [(e, T0 + timedelta(hours=h), int(h % 5 == e), h + e / 10, h % 2 == 0, float(h), h % 7, h, h) for e in range(2) for h in range(120)]
    wide = spark.createDataFrame(rows, "entity_id int, hour timestamp_ntz, y int, hour_value_avg double, hour_busy boolean, day_value_max double, day_of_week int, "
                                 "msg_n_events long, rep_n_chars long").withColumn("t", F.unix_micros(F.col("hour").cast("timestamp")) / 3_600_000_000).withColumn("t", F.col("t").cast("long"))
    table = VersionedTable(spark, f"{ws}/final", "day")
    land, sink = J.batch_sink(f"{ws}/first"), Q.second_stage(spark, f"{ws}/first", table, 168)
    want = {(r.entity_id, r.hour): tuple(r) for r in Q._shifted(wide, 168).collect()}
    read = lambda n=None: {(r.entity_id, r.hour): tuple(r) for r in table.read(n).select(*Q.FINAL_COLS).collect()}
    upto = lambda h: {k: v for k, v in want.items() if k[1] < T0 + timedelta(hours=h)}

    land(wide.filter(F.col("hour") < F.lit(T0 + timedelta(hours=60)).cast("timestamp_ntz")), 0)
    sink(None, 0)
    assert read() == upto(60) and table.version() == 1
    sink(None, 0)                                                           # nothing is missing
    assert table.version() == 1
    # a hole on the second day, and a mark on a row before it that a full rebuild would wipe out
    marked = table.read().withColumn("y", F.when(F.col("hour") == F.lit(T0).cast("timestamp_ntz"), 9).otherwise(F.col("y")))
    table.replace(["2024-01-01", "2024-01-02"], marked.filter(F.col("day") < F.lit("2024-01-03").cast("date")).filter(F.hour("hour") != 20))
    land(wide.filter(F.col("hour") >= F.lit(T0 + timedelta(hours=60)).cast("timestamp_ntz")), 1)
    holed = read()
    sink(None, 0)                                                           # a replayed batch commits nothing
    assert read() == holed
    sink(None, 1)
    got = read()
    assert {k: v for k, v in got.items() if k[1] != T0} == {k: v for k, v in want.items() if k[1] != T0}
    assert all(v[2] == 9 for k, v in got.items() if k[1] == T0)
