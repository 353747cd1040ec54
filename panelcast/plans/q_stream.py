"""Streaming queries (X1-X12): each runs a real Structured Streaming job over landed drops of the
tables and returns the final sink contents; the oracle is the batch SQL of the same result."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from panelcast.functions.calendar import floor_hour
from panelcast.operators.windows import family_shift
from panelcast.plans import driver as D
from panelcast.plans.q_events import UPSERT_CUT, UPSERT_NEW_FROM
from panelcast.plans.q_panel import WIDE_SQL, family_columns, lag_feature_block, wide_panel
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, PANEL, REPORTS, with_
from panelcast.session import materialize, path_exists
from panelcast.sources.tables import read_tail
from panelcast.sources.versioned import VersionedTable
from panelcast.streaming import jobs as J

def week_of(c):
    """Drop id: whole weeks since the start of the landed period (one cron tick per week)."""
    return F.floor(F.datediff(F.to_date(c), F.lit("2024-01-01").cast("date")) / 7).cast("int")
EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType())])


def _event_drops(spark, sf):
    ev = D.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return ev.withColumn("_chunk", week_of("ts"))


@query("stream_tumbling_counts", covers="X1 X2 X3 X4", sql=with_(EV, """
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS w FROM ev)""") + """
SELECT entity_id, hour, count(*) AS n, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_error
FROM ev, wm WHERE hour + INTERVAL 1 HOUR <= wm.w GROUP BY entity_id, hour""")
def stream_tumbling_counts(spark, sf):
    ws = J.new_workspace(spark, "tumbling")

    def build(s):
        # event time must be a session-zone TIMESTAMP (UTC here, so wall clock is unchanged)
        s = s.withColumn("entity_id", D.entity_of("user_id")).withColumn("ts", F.col("ts").cast("timestamp"))
        s = s.withWatermark("ts", "1 hour")
        g = s.groupBy(F.window("ts", "1 hour").alias("w"), "entity_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"))
        return g.select("entity_id", F.col("w.start").cast("timestamp_ntz").alias("hour"), "n", "n_error")

    J.run_drops(spark, _event_drops(spark, sf), "_chunk", EVENT_SCHEMA, build, J.batch_sink(f"{ws}/out"), ws)
    out = J.read_sink(spark, f"{ws}/out", T.StructType([
        T.StructField("entity_id", T.IntegerType()), T.StructField("hour", T.TimestampNTZType()),
        T.StructField("n", T.LongType()), T.StructField("n_error", T.LongType())]))
    return out.select("entity_id", "hour", "n", "n_error")


PANEL_SCHEMA = T.StructType([T.StructField("entity_id", T.IntegerType()), T.StructField("hour", T.TimestampNTZType()),
                             T.StructField("t", T.LongType()), T.StructField("y", T.IntegerType())])
HOURS_OUT = T.StructType([T.StructField("entity_id", T.IntegerType()), T.StructField("hour", T.TimestampNTZType()),
                          T.StructField("y", T.IntegerType()), T.StructField("hours_since_last", T.DoubleType())])


@query("stream_state_hours_since", covers="X5 W6", sql=with_(PANEL, """
f AS (SELECT entity_id, hour, y, COALESCE(lag(y, 1) OVER w, 0) AS s FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
g AS (SELECT *, sum(s) OVER (PARTITION BY entity_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp FROM f)""") + """
SELECT entity_id, hour, y, CAST(row_number() OVER (PARTITION BY entity_id, grp ORDER BY hour) - 1 AS DOUBLE) AS hours_since_last
FROM g""")
def stream_state_hours_since(spark, sf):
    ws = J.new_workspace(spark, "hours-since")
    p = D.hourly_panel(spark, sf).select("entity_id", "hour", "t", "y").withColumn(
        "_chunk", week_of("hour"))

    def build(s):
        return s.groupBy("entity_id").applyInPandasWithState(
            J.continue_hours_since, HOURS_OUT, J.HOURS_STATE, "append", GroupStateTimeout.NoTimeout)

    J.run_drops(spark, p, "_chunk", PANEL_SCHEMA, build, J.batch_sink(f"{ws}/out"), ws)
    return J.read_sink(spark, f"{ws}/out", HOURS_OUT).select("entity_id", "hour", "y", "hours_since_last")


@query("stream_upsert", covers="X8 U4", sql=with_(EV) + """
SELECT entity_id, hour, count(*) AS n_events, round(sum(value), 6) AS value_sum FROM ev GROUP BY entity_id, hour""")
def stream_upsert(spark, sf):
    ws = J.new_workspace(spark, "upsert")
    table = VersionedTable(spark, f"{ws}/table", "day")

    def upsert_batch(batch, batch_id):
        cells = (batch.withColumn("entity_id", D.entity_of("user_id")).withColumn("hour", floor_hour("ts"))
                 .groupBy("entity_id", "hour").agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
                 .withColumn("day", F.to_date("hour")))
        table.upsert(cells, ["entity_id", "hour"], batch=batch_id)  # one commit a batch; a replayed batch changes nothing

    J.run_drops(spark, _event_drops(spark, sf), "_chunk", EVENT_SCHEMA, lambda s: s, upsert_batch, ws, redeliver=[0])
    return table.read().select("entity_id", "hour", "n_events", D.r6("value_sum").alias("value_sum"))


@query("stream_sliding_counts", covers="X12 X2 X3", sql=with_(EV, """
wm AS (SELECT max(ts) - INTERVAL 2 HOUR AS w FROM ev),
x AS (SELECT entity_id, event_type, value, hour + to_hours(CAST(k AS BIGINT)) AS until FROM ev, range(1, 25) r(k))""") + """
SELECT entity_id, until - INTERVAL 24 HOUR AS window_start, until AS window_end, count(*) AS n,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_error, round(max(value), 6) AS value_max
FROM x, wm WHERE until <= wm.w GROUP BY entity_id, until""")
def stream_sliding_counts(spark, sf):
    """24-hour windows that start every hour, by event time: a window is emitted once, when the watermark has passed its end, and its
    state is dropped then.  A row is in 24 windows; they are counted where the row is before any exchange."""
    ws = J.new_workspace(spark, "sliding")

    def build(s):
        s = s.withColumn("entity_id", D.entity_of("user_id")).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "2 hours")
        g = s.groupBy(F.window("ts", "24 hours", "1 hour").alias("w"), "entity_id").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"), F.max("value").alias("value_max"))
        return g.select("entity_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "n", "n_error", "value_max")

    J.run_drops(spark, _event_drops(spark, sf), "_chunk", EVENT_SCHEMA, build, J.batch_sink(f"{ws}/out"), ws)
    out = J.read_sink(spark, f"{ws}/out", T._parse_datatype_string(
        "entity_id int, window_start timestamp_ntz, window_end timestamp_ntz, n bigint, n_error bigint, value_max double"))
    return out.select("entity_id", "window_start", "window_end", "n", "n_error", D.r6("value_max").alias("value_max"))


def _late_drops(spark, sf):
    """Weekly drops out of order: every 20th event comes a week late, every 20th after it two weeks."""
    late = F.when(F.col("event_id") % 20 == 7, 1).when(F.col("event_id") % 20 == 8, 2).otherwise(0)
    ev = D.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return ev.withColumn("_chunk", week_of("ts") + late)


LATE_SQL = with_(EV, """
d AS (SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS INTEGER)
       + CASE WHEN event_id % 20 = 7 THEN 1 WHEN event_id % 20 = 8 THEN 2 ELSE 0 END AS drop_id FROM ev),
m AS (SELECT drop_id, date_trunc('hour', max(max(ts)) OVER (ORDER BY drop_id)) - INTERVAL 1 HOUR AS cutoff FROM d GROUP BY drop_id),
b AS (SELECT drop_id, cutoff, lag(cutoff) OVER (ORDER BY drop_id) AS last FROM m),
v AS (SELECT d.*, coalesce(d.hour <= b.last, false) AS refused, d.hour <= (SELECT max(cutoff) FROM m) AS complete FROM d JOIN b USING (drop_id))""")


def admitted_drops(spark, sf):
    """(ws of the run): every drop's rows with the verdict of :func:`panelcast.streaming.jobs.admit`."""
    ws = J.new_workspace(spark, "admission")
    drops = _late_drops(spark, sf).withColumn("entity_id", D.entity_of("user_id")).withColumn("hour", floor_hour("ts"))
    J.run_drops(spark, drops, "_chunk", drops.drop("_chunk").schema, lambda s: s, J.admit(spark, f"{ws}/admission"), ws)
    return f"{ws}/admission"


@query("stream_admitted_hours", covers="X3 X4", sql=LATE_SQL + """
SELECT entity_id, hour, count(*) AS n, CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS n_error
FROM v WHERE NOT refused AND complete GROUP BY entity_id, hour""")
def stream_admitted_hours(spark, sf):
    """Cells of the hours that were admitted: an hour comes in with one drop, whole, and never changes afterwards."""
    rows = J.verdicts(spark, admitted_drops(spark, sf), "admitted")
    return rows.groupBy("entity_id", "hour").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_error"))


@query("stream_refused_rows", covers="X4", sql=LATE_SQL + """
SELECT drop_id AS batch, count(*) AS landed, CAST(count(*) FILTER (WHERE refused) AS BIGINT) AS refused,
       min(hour) FILTER (WHERE refused) AS first_refused, max(hour) FILTER (WHERE refused) AS last_refused,
       CAST(count(*) FILTER (WHERE refused AND hour = (SELECT last FROM b WHERE b.drop_id = v.drop_id)) AS BIGINT) AS on_limit
FROM v GROUP BY drop_id""")
def stream_refused_rows(spark, sf):
    """Per batch: rows that landed and those refused, as observed while the batch was written."""
    return J.admission_log(spark, admitted_drops(spark, sf)).select("batch", "landed", "refused", "first_refused", "last_refused", "on_limit")


@query("versioned_upsert", covers="U4 U5 S14", sql=with_(EV, """
old AS (SELECT entity_id, hour, count(*) AS n, avg(value) AS v FROM ev WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2),
new AS (SELECT entity_id, hour, count(*) AS n, max(value) AS v FROM ev WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2),
v2 AS (SELECT * FROM new UNION ALL SELECT o.* FROM old o ANTI JOIN new n ON n.entity_id = o.entity_id AND n.hour = o.hour),
slice AS (SELECT entity_id, hour, count(*) AS n, min(value) AS v FROM ev WHERE CAST(hour AS DATE) = DATE '2024-01-04' GROUP BY 1, 2),
v3 AS (SELECT * FROM v2 WHERE CAST(hour AS DATE) NOT IN (DATE '2024-01-04', DATE '2024-01-05') UNION ALL SELECT * FROM slice)""") + """
SELECT 1 AS version, entity_id, hour, n, round(v, 6) AS v FROM old UNION ALL SELECT 2, entity_id, hour, n, round(v, 6) FROM v2
UNION ALL SELECT 3, entity_id, hour, n, round(v, 6) FROM v3""")
def versioned_upsert(spark, sf):
    """Three commits on a table partitioned by day: a load, an upsert, a replaced slice; every version stays readable."""
    ev = D.entity_events(spark, sf)
    cells = lambda x, agg: (x.groupBy("entity_id", "hour").agg(F.count(F.lit(1)).alias("n"), agg("value").alias("v"))
                            .withColumn("day", F.to_date("hour")))
    table = VersionedTable(spark, J.new_workspace(spark, "versioned"), "day")
    cut = lambda t: F.lit(t).cast("timestamp_ntz")
    table.upsert(cells(ev.filter(F.col("ts") < cut(UPSERT_CUT)), F.avg), ["entity_id", "hour"])
    table.upsert(cells(ev.filter(F.col("ts") >= cut(UPSERT_NEW_FROM)), F.max), ["entity_id", "hour"])
    table.replace(["2024-01-04", "2024-01-05"], cells(ev.filter(F.to_date("hour") == F.lit("2024-01-04").cast("date")), F.min))
    out = [table.read(n).select(F.lit(n).alias("version"), "entity_id", "hour", "n", D.r6("v").alias("v")) for n in (1, 2, 3)]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("stream_dedupe", covers="X10", sql="""
SELECT DISTINCT event_type, date_trunc('second', ts) AS ts_sec FROM events""")
def stream_dedupe(spark, sf):
    ws = J.new_workspace(spark, "dedupe")

    def build(s):
        k = s.withColumn("ts_sec", F.date_trunc("second", F.col("ts").cast("timestamp"))).withWatermark("ts_sec", "1 hour")
        d = k.dropDuplicatesWithinWatermark(["event_type", "ts_sec"])
        return d.select("event_type", F.col("ts_sec").cast("timestamp_ntz").alias("ts_sec"))

    J.run_drops(spark, _event_drops(spark, sf), "_chunk", EVENT_SCHEMA, build, J.batch_sink(f"{ws}/out"), ws,
                redeliver=[0])
    return J.read_sink(spark, f"{ws}/out", T.StructType([T.StructField("event_type", T.StringType()),
                                                         T.StructField("ts_sec", T.TimestampNTZType())]))


TAIL_HOURS = 720


@query("incremental_equals_batch", covers="X6 X12", sql=with_(PANEL, """
f AS (SELECT entity_id, hour, y, COALESCE(lag(y, 1) OVER w, 0) AS lag_1, COALESCE(lag(y, 3) OVER w, 0) AS lag_3,
        COALESCE(lag(y, 6) OVER w, 0) AS lag_6, COALESCE(lag(y, 12) OVER w, 0) AS lag_12,
        CAST(COALESCE(sum(y) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS alarms_in_last_24h,
        COALESCE(lag(y, 1) OVER w, 0) AS s FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
g AS (SELECT *, sum(s) OVER (PARTITION BY entity_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp FROM f)""") + """
SELECT entity_id, hour, y, lag_1, lag_3, lag_6, lag_12, alarms_in_last_24h,
       CAST(row_number() OVER (PARTITION BY entity_id, grp ORDER BY hour) - 1 AS DOUBLE) AS hours_since_last FROM g""")
def incremental_equals_batch(spark, sf):
    """Each drop is appended by recomputing features over (last 720 h of the table + new rows) and
    keeping only the new rows; hours-since continues exactly from the last stored row (X5 rule)."""
    ws = J.new_workspace(spark, "incremental")
    table = f"{ws}/table"
    p = D.hourly_panel(spark, sf).select("entity_id", "hour", "t", "y").withColumn(
        "_chunk", week_of("hour"))
    cols = ["entity_id", "hour", "y", "lag_1", "lag_3", "lag_6", "lag_12", "alarms_in_last_24h", "hours_since_last"]

    def build(s):
        return s

    def append_batch(batch, batch_id):
        new = batch.select("entity_id", "hour", "t", "y")
        existing = spark.read.parquet(table).filter(F.col("batch_id") < batch_id) if path_exists(spark, table) else None
        if existing is None or existing.isEmpty():
            feats = lag_feature_block(new, bucket_rows=None)
        else:
            latest = existing.agg(F.max("hour")).first()[0]
            tail = read_tail(existing, "hour", TAIL_HOURS, strict=True)  # a literal cut: old row groups are skipped
            last = tail.filter(F.col("hour") == F.lit(latest).cast("timestamp_ntz")).select(
                "entity_id", F.col("t").alias("_t0"), F.col("y").alias("_y0"), F.col("hours_since_last").alias("_h0"))
            combo = tail.select("entity_id", "hour", "t", "y").unionByName(new)
            feats = lag_feature_block(combo).drop("hours_since_last")
            feats = feats.join(new.select("entity_id", "t"), ["entity_id", "t"], "left_semi")
            # exact continuation of hours-since: events among the new rows, else the stored state
            from panelcast.operators.windows import prefix_scan
            ev = prefix_scan(feats, {"_ev": ("max", F.when(F.col("y") == 1, F.col("t")))}, "entity_id", "t",
                             bucket_rows=D.bucket_rows(spark))
            ev = ev.join(last, "entity_id", "left")
            hs = (F.when(F.col("_ev").isNotNull(), F.col("t") - F.col("_ev") - 1)
                  .when(F.col("_y0") == 1, F.col("t") - F.col("_t0") - 1)
                  .otherwise(F.col("_h0") + (F.col("t") - F.col("_t0"))))
            feats = ev.withColumn("hours_since_last", hs.cast("double"))
        feats.select(*cols, "t").write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")  # a replay writes itself again

    J.run_drops(spark, p, "_chunk", PANEL_SCHEMA, build, append_batch, ws)
    return spark.read.parquet(table).select(*cols)


FINAL_LEAD_HOURS = 72
COMPARE_DAYS = 90
FINAL_COLS = ["entity_id", "hour", "y", "hour_value_avg", "day_value_max", "msg_n_events", "rep_n_chars"]
FINAL_SQL = """SELECT entity_id, hour, y, round(COALESCE(lag(hour_value_avg, 1) OVER w, 0), 6) AS hour_value_avg,
  round(COALESCE(lag(day_value_max, 24) OVER w, 0), 6) AS day_value_max, COALESCE(lag(msg_n_events, 1) OVER w, 0) AS msg_n_events,
  COALESCE(lag(rep_n_chars, 24) OVER w, 0) AS rep_n_chars
FROM wide WINDOW w AS (PARTITION BY entity_id ORDER BY hour)"""


def _shifted(panel, bucket_rows):
    out = family_shift(panel, family_columns(panel.columns), bucket_rows=bucket_rows)
    return out.select(*[D.r6(c).alias(c) if c in ("hour_value_avg", "day_value_max") else F.col(c) for c in FINAL_COLS])


@query("rebuild_missing_final", covers="X7", sql=with_(PANEL, REPORTS, WIDE_SQL) + FINAL_SQL)
def rebuild_missing_final(spark, sf):
    """The second stage finds the earliest hour of the last 90 days that the final table lacks and rebuilds from
    there, with 72 hours of lead-in; what lies before stays as stored.  Here the stored table has a hole in its third
    week and ends a day early."""
    wide = materialize(wide_panel(spark, sf), "unshifted")
    keys = ["entity_id", "hour"]
    hole = (F.datediff("hour", F.lit("2024-01-01").cast("date")) == 16) & (F.hour("hour") == 5)
    late = F.to_date("hour") >= F.to_date(F.lit(wide.agg(F.max("hour")).first()[0]))
    final = materialize(_shifted(wide, D.bucket_rows(spark)).filter(~hole & ~late), "final")

    recent = read_tail(wide, "hour", 24 * COMPARE_DAYS).select(*keys)
    start = recent.join(final, keys, "left_anti").agg(F.min("hour")).first()[0]
    if start is None:
        return final
    lead = wide.filter(F.col("hour") >= F.lit(start - timedelta(hours=FINAL_LEAD_HOURS)).cast("timestamp_ntz"))
    from_start = F.lit(start).cast("timestamp_ntz")
    new = _shifted(lead, D.bucket_rows(spark)).filter(F.col("hour") >= from_start)
    return final.filter(F.col("hour") < from_start).unionByName(new)


def second_stage(spark, first: str, table: VersionedTable, bucket_rows: int):
    """Sink of the stream that reads the first stage's folder ``first``.  It looks for the earliest hour of the last 90 days that
    the final table lacks, reads the first stage from 72 hours before it, and commits the rebuilt hours under the batch's id:
    rows before that hour stay as they are, and a replayed batch changes nothing."""
    keys = ["entity_id", "hour"]

    def sink(batch, batch_id):
        wide = spark.read.parquet(first).drop("batch_id")
        recent = read_tail(wide, "hour", 24 * COMPARE_DAYS).select(*keys)
        stored = table.read().select(*keys) if table.version() else recent.limit(0)
        start = recent.join(stored, keys, "left_anti").agg(F.min("hour")).first()[0]
        if start is None:
            return
        lead = wide.filter(F.col("hour") >= F.lit(start - timedelta(hours=FINAL_LEAD_HOURS)).cast("timestamp_ntz"))
        new = _shifted(lead, bucket_rows).filter(F.col("hour") >= F.lit(start).cast("timestamp_ntz"))
        table.upsert(new.withColumn("day", F.to_date("hour")), keys, batch=batch_id)

    return sink


@query("stream_second_stage", covers="X7 U4", sql=with_(PANEL, REPORTS, WIDE_SQL) + FINAL_SQL)
def stream_second_stage(spark, sf):
    """Two chained streams: the first lands the unshifted panel drop by drop, the second reads its folder and keeps the final table.
    After the third drop some hours are taken out of the final table; the next tick puts them back."""
    ws = J.new_workspace(spark, "second-stage")
    wide = wide_panel(spark, sf).withColumn("_chunk", week_of("hour"))
    schema = wide.drop("_chunk").schema
    table = VersionedTable(spark, f"{ws}/final", "day")
    first, second = J.batch_sink(f"{ws}/first"), second_stage(spark, f"{ws}/first", table, D.bucket_rows(spark))
    for i, cid in enumerate(J.stage_drops(wide, "_chunk", f"{ws}/staged")):
        J.write_drop(f"{ws}/staged", "_chunk", cid, f"{ws}/landing/tick_{i:05d}", spark)
        J.tick(spark, f"{ws}/landing", schema, f"{ws}/checkpoint-first", lambda s: s, first)
        J.tick(spark, f"{ws}/first", schema, f"{ws}/checkpoint-second", lambda s: s, second)
        if i == 2:
            table.replace(["2024-01-17", "2024-01-18"], table.read().filter((F.col("day") == F.lit("2024-01-17").cast("date")) & (F.hour("hour") < 5)))
    return table.read().select(*FINAL_COLS)


REPORT_SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType())])
DAY_OUT = T.StructType([T.StructField("day", T.TimestampNTZType()), T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType())])


@query("stream_report_carry", covers="X11 W14", sql=with_(REPORTS, """
cal AS (SELECT DATE '2024-01-01' + CAST(range AS INTEGER) AS day FROM range(45))""") + """
SELECT CAST(c.day AS TIMESTAMP) AS day, COALESCE(r.doc_id, 0) AS doc_id, COALESCE(r.n_chars, 0) AS n_chars
FROM cal c LEFT JOIN LATERAL (SELECT * FROM reports r WHERE r.day <= c.day ORDER BY r.day DESC LIMIT 1) r ON true
WHERE c.day <= (SELECT max(day) FROM reports)""")
def stream_report_carry(spark, sf):
    """X11: each tick fills its own days; a day without a report keeps the latest one, across ticks too: the seed is the
    last stored row with a report.  A batch writes its own folder, so a replay changes nothing."""
    ws = J.new_workspace(spark, "report-carry")
    table = f"{ws}/table"
    reports = D.daily_reports(spark, sf).withColumn("_chunk", week_of("day"))

    def carry(batch, batch_id):
        stored = spark.read.parquet(table).filter((F.col("batch_id") < batch_id) & (F.col("doc_id") > 0)) if path_exists(spark, table) else None
        seed = stored.agg(F.max(F.struct("day", "doc_id", "n_chars")).alias("s")).select("s.*") if stored is not None else None
        done = spark.read.parquet(table).filter(F.col("batch_id") < batch_id).agg(F.max("day")).first()[0] if stored is not None else None
        first = done.date() + timedelta(days=1) if done is not None else date.fromisoformat(D.REPORT_EPOCH)
        last = batch.agg(F.max("day")).first()[0]
        days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
        rows = days.join(batch, "day", "left")
        if seed is not None:
            rows = rows.unionByName(seed.select(F.lit(first - timedelta(days=1)).alias("day"), "doc_id", "n_chars"))
        # the days of one tick and a seed row: one small ordered window
        w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
        filled = rows.select("day", *[F.coalesce(F.last(c, ignorenulls=True).over(w), F.lit(0)).cast("long").alias(c) for c in ("doc_id", "n_chars")])
        out = filled.filter(F.col("day") >= F.lit(first)).withColumn("day", F.col("day").cast("timestamp_ntz"))
        out.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    J.run_drops(spark, reports, "_chunk", REPORT_SCHEMA, lambda s: s, carry, ws)
    return J.read_sink(spark, table, DAY_OUT).select("day", "doc_id", "n_chars")


ASOF_OUT = "entity_id int, hour timestamp_ntz, doc_id bigint, n_chars bigint, as_of_day date"


@query("stream_report_join", covers="X11 J10 S14", sql=with_(PANEL, REPORTS, """
r AS (SELECT *, floor(date_diff('day', DATE '2024-01-01', day) / 7) + CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS landed FROM reports),
p AS (SELECT entity_id, hour, CAST(hour AS DATE) AS d, floor(date_diff('day', DATE '2024-01-01', CAST(hour AS DATE)) / 7) AS week FROM panel),
pick AS (SELECT q.d, max(r.day) AS day FROM (SELECT DISTINCT d, week FROM p) q JOIN r ON r.day <= q.d AND r.landed <= q.week GROUP BY q.d)""") + """
SELECT p.entity_id, p.hour, r.doc_id, r.n_chars, CAST(r.day AS TIMESTAMP) AS as_of_day
FROM p LEFT JOIN pick ON pick.d = p.d LEFT JOIN r ON r.day = pick.day""")
def stream_report_join(spark, sf):
    """X11 as a stream-static join: a stream of panel hours, joined to a versioned table of daily reports as it stood at the tick.
    Every third report lands a week late, so the hours of its own week carry an older one."""
    ws = J.new_workspace(spark, "report-join")
    reports = VersionedTable(spark, f"{ws}/reports", "week")
    landed = D.daily_reports(spark, sf).withColumn("week", week_of("day"))
    landed = materialize(landed.withColumn("_landed", F.col("week") + (F.col("doc_id") % 3 == 0).cast("int")), "reports-landed")
    panel = D.hourly_panel(spark, sf).select("entity_id", "hour").withColumn("_chunk", week_of("hour"))
    schema = panel.drop("_chunk").schema
    sink = J.join_as_of(spark, reports, "day", ["doc_id", "n_chars"], ws)
    for i, week in enumerate(J.stage_drops(panel, "_chunk", f"{ws}/staged")):
        reports.upsert(landed.filter(F.col("_landed") == week).drop("_landed"), ["day"], batch=week)
        J.write_drop(f"{ws}/staged", "_chunk", week, f"{ws}/landing/tick_{i:05d}", spark)
        J.tick(spark, f"{ws}/landing", schema, f"{ws}/checkpoint", lambda s: s, sink)
    out = spark.read.schema(ASOF_OUT).parquet(f"{ws}/out").drop("batch_id")
    return out.withColumn("as_of_day", F.col("as_of_day").cast("timestamp_ntz"))
