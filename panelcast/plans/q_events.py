"""Interval, as-of, fallback, anti-join and de-duplication queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.calendar import add_hours, hour_index
from panelcast.operators import asof as A
from panelcast.operators import dedupe as U
from panelcast.operators import intervals as I
from panelcast.operators.vectors import scale, vector_mean_by_key
from panelcast.plans import driver as D
from panelcast.plans.q_panel import CELLS_SQL, observed_cells
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, INTERVALS, IV, PANEL, REPORTS, TOPICS, with_


@query("interval_hour_minutes", covers="J9 A2 F10", sql=with_(INTERVALS, """
x AS (SELECT entity_id, start, "end", unnest(generate_series(date_trunc('hour', start), date_trunc('hour', "end"),
                                                    INTERVAL 1 HOUR)) AS hour FROM iv),
m AS (SELECT entity_id, hour,
        epoch_us(least("end", hour + INTERVAL 1 HOUR)) - epoch_us(greatest(start, hour)) AS us FROM x)""") + """
SELECT entity_id, hour, CAST(least(greatest(sum(us), 0), 3600000000) AS BIGINT) / 60000000.0 AS minutes_in_hour,
       max(1) AS active
FROM m WHERE us > 0 GROUP BY entity_id, hour""")
def interval_hour_minutes(spark, sf):
    iv = D.error_intervals(spark, sf)
    return I.swept_minutes(iv, ["entity_id"]).select("entity_id", "hour", "minutes_in_hour", "active")


@query("interval_overlap_flags", covers="J8", sql=with_(PANEL, IV) + """
SELECT p.entity_id, p.hour,
  CASE WHEN EXISTS (SELECT 1 FROM iv WHERE iv.entity_id = p.entity_id AND iv.start < p.hour + INTERVAL 1 HOUR
                    AND iv."end" > p.hour) THEN 1 ELSE 0 END AS active
FROM panel p""")
def interval_overlap_flags(spark, sf):
    grid = D.hourly_panel(spark, sf).select("entity_id", "hour")
    return I.overlap_flags(D.error_intervals(spark, sf), grid, ["entity_id"]).select("entity_id", "hour", "active")


@query("asof_daily_report", covers="J10 W14 X11", sql=with_(PANEL, REPORTS, """
cal AS (SELECT DISTINCT CAST(hour AS DATE) AS day FROM panel),
lo AS (SELECT min(day) - 120 AS d0 FROM cal)""") + """
SELECT CAST(c.day AS TIMESTAMP) AS day, CAST(r.day AS TIMESTAMP) AS report_day, COALESCE(r.doc_id, 0) AS doc_id, COALESCE(r.n_chars, 0) AS n_chars
FROM cal c LEFT JOIN LATERAL (
  SELECT * FROM reports r, lo WHERE r.day <= c.day AND r.day >= lo.d0 ORDER BY r.day DESC LIMIT 1) r ON true""")
def asof_daily_report(spark, sf):
    cal = D.hourly_panel(spark, sf).select(F.to_date("hour").alias("day")).distinct()
    lo = cal.agg(F.date_sub(F.min("day"), 120).alias("d0"))
    reps = (D.daily_reports(spark, sf).crossJoin(F.broadcast(lo)).filter(F.col("day") >= F.col("d0"))
            .select(F.col("day").alias("report_day"), "doc_id", "n_chars"))
    # un-keyed as-of: bucketed by 90 days so the forward fill never runs as one global window
    x = A.asof_join(cal, reps, "day", ["doc_id", "n_chars"], right_t="report_day", t_out="report_day", bucket_rows=90)
    return x.select(F.col("day").cast("timestamp_ntz").alias("day"), F.col("report_day").cast("timestamp_ntz").alias("report_day"),
                    F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
                    F.coalesce("n_chars", F.lit(0).cast("long")).alias("n_chars"))


TOPIC_HOURLY_SQL = """th_el AS (SELECT hour, i, avg(v) AS m FROM (
    SELECT hour, unnest(vec) AS v, unnest(range(len(vec))) AS i FROM topics) GROUP BY hour, i),
th AS (SELECT hour, sum(abs(m)) AS intensity FROM th_el GROUP BY hour)"""


def topic_hourly(spark, sf):
    """A3: mean topic vector per hour (partial-aggregated element-wise mean)."""
    return vector_mean_by_key(D.topic_vectors(spark, sf), ["hour"], "vec")


@query("asof_decay", covers="J11 A3", sql=with_(PANEL, TOPICS, TOPIC_HOURLY_SQL, """
hrs AS (SELECT DISTINCT hour FROM panel)""") + """
SELECT h.hour, date_diff('hour', m.hour, h.hour - INTERVAL 1 HOUR) AS gap_hours,
  round(COALESCE(m.intensity * CASE WHEN date_diff('hour', m.hour, h.hour - INTERVAL 1 HOUR) <= 0 THEN 1.0
        ELSE pow(0.5, date_diff('hour', m.hour, h.hour - INTERVAL 1 HOUR) / 6.0) END, 0), 6) AS intensity
FROM hrs h LEFT JOIN LATERAL (SELECT * FROM th WHERE th.hour <= h.hour - INTERVAL 1 HOUR ORDER BY th.hour DESC LIMIT 1) m
  ON true""")
def asof_decay(spark, sf):
    th = topic_hourly(spark, sf).select(F.col("hour").alias("topic_hour"),
                                        F.aggregate(F.transform("vec", lambda x: F.abs(x)), F.lit(0.0),
                                                    lambda a, x: a + x).alias("intensity"))
    hrs = D.hourly_panel(spark, sf).select("hour").distinct().withColumn("src", add_hours("hour", -1))
    # un-keyed as-of on microsecond time: one-week buckets with a cross-bucket carry
    x = A.asof_join(hrs, th.withColumn("src", F.col("topic_hour")), "src", ["intensity", "topic_hour"],
                    t_out="_m", bucket_rows=168 * 3_600_000_000)
    gap = F.timestamp_diff("HOUR", F.col("topic_hour"), F.col("src"))
    return x.select("hour", gap.alias("gap_hours"),
                    D.r6(F.coalesce(F.col("intensity") * A.decay_factor(gap), F.lit(0.0))).alias("intensity"))


@query("asof_decay_vector", covers="J11", sql=with_(PANEL, TOPICS, """th_el AS (SELECT hour, i, avg(v) AS m FROM (
    SELECT hour, unnest(vec) AS v, unnest(range(len(vec))) AS i FROM topics) GROUP BY hour, i),
th AS (SELECT hour, list(m ORDER BY i) AS vec FROM th_el GROUP BY hour),
hrs AS (SELECT DISTINCT hour FROM panel),
x AS (SELECT h.hour, m.vec, CASE WHEN date_diff('hour', m.hour, h.hour - INTERVAL 1 HOUR) <= 0 THEN 1.0
             ELSE pow(0.5, date_diff('hour', m.hour, h.hour - INTERVAL 1 HOUR) / 6.0) END AS f
      FROM hrs h JOIN LATERAL (SELECT * FROM th WHERE th.hour <= h.hour - INTERVAL 1 HOUR ORDER BY th.hour DESC LIMIT 1) m ON true)""") + """
SELECT hour, CAST(i AS INTEGER) AS topic, round(vec[i + 1] * f, 6) AS value FROM (SELECT hour, vec, f, unnest(range(len(vec))) AS i FROM x)""")
def asof_decay_vector(spark, sf):
    """J11 on the whole topic vector: the latest vector before each hour, scaled by the decay of its age."""
    th = topic_hourly(spark, sf).withColumnRenamed("hour", "topic_hour")
    hrs = D.hourly_panel(spark, sf).select("hour").distinct().withColumn("src", add_hours("hour", -1))
    x = A.asof_join(hrs, th.withColumn("src", F.col("topic_hour")), "src", ["vec", "topic_hour"],
                    t_out="_m", bucket_rows=168 * 3_600_000_000).filter(F.col("vec").isNotNull())
    gap = F.timestamp_diff("HOUR", F.col("topic_hour"), F.col("src"))
    scaled = x.select("hour", F.posexplode(scale("vec", A.decay_factor(gap))).alias("topic", "v"))
    return scaled.select("hour", "topic", D.r6("v").alias("value"))


@query("asof_decay_entity", covers="J12", sql=with_(EV, CELLS_SQL, """
L AS (SELECT max(hour) AS last_hour FROM cells),
tgt AS (SELECT e.entity_id, L.last_hour + to_hours(CAST(k AS BIGINT)) AS hour
        FROM range(24) e(entity_id), L, range(1, 25) r(k))""") + """
SELECT CAST(tgt.entity_id AS INTEGER) AS entity_id, tgt.hour,
  round(CASE WHEN x.n_events IS NOT NULL THEN x.n_events
       WHEN f.n_events IS NOT NULL THEN f.n_events * CASE WHEN date_diff('hour', L.last_hour, tgt.hour - INTERVAL 1 HOUR) <= 0
            THEN 1.0 ELSE pow(0.5, date_diff('hour', L.last_hour, tgt.hour - INTERVAL 1 HOUR) / 6.0) END
       ELSE 0 END, 6) AS signal
FROM tgt CROSS JOIN L
LEFT JOIN cells x ON x.entity_id = tgt.entity_id AND x.hour = tgt.hour - INTERVAL 1 HOUR
LEFT JOIN cells f ON f.entity_id = tgt.entity_id AND f.hour = L.last_hour""")
def asof_decay_entity(spark, sf):
    cells = observed_cells(spark, sf).select("entity_id", "hour", F.col("n_events").cast("double").alias("sig"))
    last = cells.agg(F.max("hour").alias("last_hour"))
    tgt = (D.entities(spark).crossJoin(F.broadcast(last))
           .select("entity_id", "last_hour", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("k"))
           .withColumn("hour", add_hours("last_hour", F.col("k"))))
    exact = cells.select("entity_id", F.col("hour").alias("src"), F.col("sig").alias("exact"))
    fb = cells.join(F.broadcast(last), cells.hour == last.last_hour).select("entity_id", F.col("sig").alias("fb"))
    x = (tgt.withColumn("src", add_hours("hour", -1))
            .join(exact, ["entity_id", "src"], "left").join(fb, ["entity_id"], "left"))
    gap = F.timestamp_diff("HOUR", F.col("last_hour"), F.col("src"))
    sig = F.coalesce(F.col("exact"), F.col("fb") * A.decay_factor(gap), F.lit(0.0))
    return x.select("entity_id", "hour", D.r6(sig).alias("signal"))


@query("fallback_chain_lookup", covers="J13 J19", sql=with_(EV, """
act AS (SELECT entity_id, hour, avg(value) AS v FROM ev WHERE event_type <> 'view' GROUP BY 1, 2),
fc AS (SELECT entity_id, hour, avg(value) AS v FROM ev WHERE event_type = 'view' GROUP BY 1, 2),
comb AS (SELECT entity_id, hour, v FROM fc UNION ALL
         SELECT a.entity_id, a.hour, a.v FROM act a ANTI JOIN fc f ON f.entity_id = a.entity_id AND f.hour = a.hour),
fb AS (SELECT entity_id, arg_max(v, hour) AS v FROM comb GROUP BY entity_id),
L AS (SELECT max(hour) AS last_hour FROM comb),
tgt AS (SELECT CAST(e.entity_id AS INTEGER) AS entity_id, L.last_hour + to_hours(CAST(k AS BIGINT)) AS hour
        FROM range(24) e(entity_id), L, range(1, 25) r(k))""") + """
SELECT t.entity_id, t.hour, round(COALESCE(h.v, fb.v, 0), 6) AS hour_val, round(COALESCE(d.v, fb.v, 0), 6) AS day_val
FROM tgt t LEFT JOIN comb h ON h.entity_id = t.entity_id AND h.hour = t.hour - INTERVAL 1 HOUR
LEFT JOIN comb d ON d.entity_id = t.entity_id AND d.hour = t.hour - INTERVAL 24 HOUR
LEFT JOIN fb ON fb.entity_id = t.entity_id""")
def fallback_chain_lookup(spark, sf):
    ev = D.entity_events(spark, sf)
    act = ev.filter(F.col("event_type") != "view").groupBy("entity_id", "hour").agg(F.avg("value").alias("v"))
    fc = ev.filter(F.col("event_type") == "view").groupBy("entity_id", "hour").agg(F.avg("value").alias("v"))
    comb = A.priority_union(act, fc, ["entity_id", "hour"])
    fb = comb.groupBy("entity_id").agg(F.max_by("v", "hour").alias("fb"))
    last = comb.agg(F.max("hour").alias("last_hour"))
    tgt = (D.entities(spark).crossJoin(F.broadcast(last))
           .select("entity_id", "last_hour", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("k"))
           .select("entity_id", add_hours("last_hour", F.col("k")).alias("hour")))
    h = comb.select("entity_id", add_hours("hour", 1).alias("hour"), F.col("v").alias("hv"))
    d = comb.select("entity_id", add_hours("hour", 24).alias("hour"), F.col("v").alias("dv"))
    x = tgt.join(h, ["entity_id", "hour"], "left").join(d, ["entity_id", "hour"], "left").join(fb, "entity_id", "left")
    return x.select("entity_id", "hour", D.r6(F.coalesce("hv", "fb", F.lit(0.0))).alias("hour_val"),
                    D.r6(F.coalesce("dv", "fb", F.lit(0.0))).alias("day_val"))


@query("anti_join_missing_hours", covers="J14 X9", sql=with_(PANEL, """
obs AS (SELECT DISTINCT entity_id, hour FROM ev)""") + """
SELECT p.entity_id, min(p.hour) AS earliest_missing, count(*) AS n_missing
FROM panel p ANTI JOIN obs o ON o.entity_id = p.entity_id AND o.hour = p.hour GROUP BY p.entity_id""")
def anti_join_missing_hours(spark, sf):
    grid = D.hourly_panel(spark, sf).select("entity_id", "hour")
    obs = D.entity_events(spark, sf).select("entity_id", "hour")
    miss = grid.join(obs, ["entity_id", "hour"], "left_anti")
    return miss.groupBy("entity_id").agg(F.min("hour").alias("earliest_missing"), F.count(F.lit(1)).alias("n_missing"))


@query("dedupe_keep_last", covers="U3", sql=with_(EV) + """
SELECT entity_id, hour, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, round(arg_max(value, (ts, event_id)), 6) AS value
FROM ev GROUP BY entity_id, hour""")
def dedupe_keep_last(spark, sf):
    ev = D.entity_events(spark, sf).select("entity_id", "hour", "event_id", "ts", "event_type", "value")
    k = U.keep_last(ev, ["entity_id", "hour"], F.struct("ts", "event_id"))
    return k.select("entity_id", "hour", "event_id", "ts", "event_type", D.r6("value").alias("value"))


UPSERT_CUT = "2024-01-20 00:00:00"
UPSERT_NEW_FROM = "2024-01-15 00:00:00"


@query("upsert_panel", covers="U4", sql=with_(EV, """
old AS (SELECT entity_id, hour, count(*) AS n, avg(value) AS v FROM ev WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2),
new AS (SELECT entity_id, hour, count(*) AS n, max(value) AS v FROM ev WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2)""") + """
SELECT entity_id, hour, n, round(v, 6) AS v, 'new' AS version FROM new
UNION ALL
SELECT o.entity_id, o.hour, o.n, round(o.v, 6), 'old' FROM old o ANTI JOIN new n ON n.entity_id = o.entity_id AND n.hour = o.hour""")
def upsert_panel(spark, sf):
    ev = D.entity_events(spark, sf)
    old = (ev.filter(F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp_ntz")).groupBy("entity_id", "hour")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("v")).withColumn("version", F.lit("old")))
    new = (ev.filter(F.col("ts") >= F.lit(UPSERT_NEW_FROM).cast("timestamp_ntz")).groupBy("entity_id", "hour")
             .agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("v")).withColumn("version", F.lit("new")))
    out = U.upsert(old, new, ["entity_id", "hour"])
    return out.select("entity_id", "hour", "n", D.r6("v").alias("v"), "version")


@query("replace_slice", covers="U5", sql=with_(EV, """
base AS (SELECT entity_id, hour, avg(value) AS v FROM ev GROUP BY 1, 2),
patch AS (SELECT entity_id, hour, max(value) AS v FROM ev WHERE entity_id = 3 GROUP BY 1, 2)""") + """
SELECT entity_id, hour, round(v, 6) AS v FROM base WHERE NOT (entity_id = 3)
UNION ALL SELECT entity_id, hour, round(v, 6) FROM patch""")
def replace_slice(spark, sf):
    ev = D.entity_events(spark, sf)
    base = ev.groupBy("entity_id", "hour").agg(F.avg("value").alias("v"))
    patch = ev.filter(F.col("entity_id") == 3).groupBy("entity_id", "hour").agg(F.max("value").alias("v"))
    out = U.replace_slice(base, patch, F.col("entity_id") == 3)
    return out.select("entity_id", "hour", D.r6("v").alias("v"))


@query("append_only_new", covers="U7", sql="""
SELECT event_id, ts, event_type FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
UNION ALL
SELECT n.event_id, n.ts, n.event_type FROM events n
WHERE n.ts >= TIMESTAMP '2024-01-15 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM events o WHERE o.ts < TIMESTAMP '2024-01-20 00:00:00' AND o.event_id = n.event_id)""")
def append_only_new(spark, sf):
    ev = D.events(spark, sf).select("event_id", "ts", "event_type")
    existing = ev.filter(F.col("ts") < F.lit(UPSERT_CUT).cast("timestamp_ntz"))
    incoming = ev.filter(F.col("ts") >= F.lit(UPSERT_NEW_FROM).cast("timestamp_ntz"))
    return U.append_only_new(existing, incoming, ["event_id"])


@query("key_set_difference", covers="U6 Q4", sql=with_(EV, """
a AS (SELECT DISTINCT entity_id, hour FROM ev WHERE event_type = 'error'),
b AS (SELECT DISTINCT entity_id, hour FROM ev WHERE event_type = 'purchase')""") + """
SELECT entity_id, hour, 'only_left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL
SELECT entity_id, hour, 'only_right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def key_set_difference(spark, sf):
    ev = D.entity_events(spark, sf)
    a = ev.filter(F.col("event_type") == "error")
    b = ev.filter(F.col("event_type") == "purchase")
    return U.key_differences(a, b, ["entity_id", "hour"])


@query("dup_audit", covers="U8", sql=with_(EV) + """
SELECT user_id, hour, count(*) AS n, count(DISTINCT event_type) AS n_types
FROM ev GROUP BY user_id, hour HAVING count(*) > 1""")
def dup_audit(spark, sf):
    ev = D.entity_events(spark, sf)
    return (ev.groupBy("user_id", "hour")
              .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_type").alias("n_types"))
              .filter(F.col("n") > 1))


@query("first_wins_subset", covers="U2", sql="""
SELECT user_id, event_type, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_wins_subset(spark, sf):
    """The first event of each (user, type) stays."""
    ev = D.events(spark, sf).select("user_id", "event_type", "event_id", "ts")
    return U.keep_first(ev, ["user_id", "event_type"], "ts")


@query("open_interval_flags", covers="J8", sql=with_(PANEL, IV, """
mx AS (SELECT max(hour) AS m FROM panel),
o AS (SELECT entity_id, start, CASE WHEN event_id % 2 = 0 AND start > mx.m - INTERVAL 24 HOUR THEN mx.m ELSE "end" END AS e FROM iv, mx)""") + """
SELECT p.entity_id, p.hour, CASE WHEN EXISTS (SELECT 1 FROM o WHERE o.entity_id = p.entity_id AND o.start < p.hour + INTERVAL 1 HOUR
  AND o.e > p.hour) THEN 1 ELSE 0 END AS active FROM panel p""")
def open_interval_flags(spark, sf):
    """J8 with intervals that haven't ended: half of the last day's alarms are still open (their end is missing, or in
    year 1) and close at the cutoff, the panel's last hour."""
    panel = D.hourly_panel(spark, sf).select("entity_id", "hour")
    cutoff = panel.agg(F.max("hour")).first()[0]
    still = (F.col("event_id") % 2 == 0) & (F.col("start") > F.lit(cutoff).cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS"))
    gone = F.when(F.col("event_id") % 4 == 0, F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    iv = D.error_intervals(spark, sf).withColumn("end", F.when(still, gone).otherwise(F.col("end")))
    return I.overlap_flags(I.close_open_intervals(iv, cutoff=cutoff), panel, ["entity_id"]).select("entity_id", "hour", "active")
