"""Admission of late rows: limits to the hour, waiting rows, replays."""

import uuid
from datetime import datetime, timedelta

from panelcast.session import scratch_path
from panelcast.streaming import jobs as J

T0 = datetime(2024, 1, 1)


def batch(spark, *hours):
    """Rows (id, minute 30 of these hours after T0)."""
    rows = [(n, T0 + timedelta(hours=h, minutes=30), T0 + timedelta(hours=h)) for n, h in enumerate(hours)]
    return spark.createDataFrame(rows, "id long, ts timestamp_ntz, hour timestamp_ntz")


def at(rows):
    return sorted(int((r.hour - T0).total_seconds() // 3600) for r in rows.collect())


def log(spark, out):
    hour = lambda x: None if x is None else int((x - T0).total_seconds() // 3600)
    return [(r.batch, r.landed, r.refused, hour(r.first_refused), hour(r.last_refused), r.on_limit) for r in J.admission_log(spark, out).orderBy("batch").collect()]


def test_limits_waiting_rows_and_replays(spark):
    out = scratch_path(spark, f"admission/{uuid.uuid4().hex}")
    sink = J.admit(spark, out)
    sink(batch(spark, 0, 1, 5, 5), 0)                    # cutoff 4: hour 5 isn't complete
    assert at(J.verdicts(spark, out, "admitted")) == [0, 1] and at(J.verdicts(spark, out, "waiting")) == [5, 5]
    sink(batch(spark, 4, 5, 3, 8, 6), 1)                 # 4 is on the limit: refused; 5 is the first that may come
    want = [0, 1, 5, 5, 5, 6]
    assert at(J.verdicts(spark, out, "admitted")) == want and at(J.verdicts(spark, out, "refused")) == [3, 4]
    expected = [(0, 4, 0, None, None, 0), (1, 5, 2, 3, 4, 1)]
    assert log(spark, out) == expected
    sink(batch(spark, 4, 5, 3, 8, 6), 1)                 # the same batch again
    assert at(J.verdicts(spark, out, "admitted")) == want and log(spark, out) == expected
    sink(batch(spark, 2, 6, 7), 2)                       # nothing later than hour 8: the cutoff stays 7
    assert at(J.verdicts(spark, out, "admitted")) == want and at(J.verdicts(spark, out, "refused")) == [2, 3, 4, 6, 7]
    sink(batch(spark, 20), 3)
    assert at(J.verdicts(spark, out, "admitted")) == [*want, 8]
    assert sum(x[1] for x in log(spark, out)) == 13
