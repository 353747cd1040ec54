"""Feature rows of the forecast hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.calendar import hour_index
from panelcast.operators import feature_rows as R
from panelcast.plans import driver as D
from panelcast.plans.q_events import topic_hourly
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EDGES, EV, REPORTS, TOPICS, with_
from panelcast.session import materialize

ROUNDED = ("hour_value", "day_value", "signal", "topic_intensity", "topic_decay", "topic_std", "topic_top", "topic_entropy",
           "topic_velocity_3h", "topic_velocity_24h", "topic_ema_6h", "topic_zscore_24h")


def latest_hour(spark, sf) -> int | None:
    """Hour index of the latest event: one scalar."""
    return D.events(spark, sf).agg(F.max(hour_index("ts"))).first()[0]


def instant(hour: int):
    return F.timestamp_micros(F.lit(hour * 3_600_000_000)).cast("timestamp_ntz")


def rows_from(spark, sf, origin: int):
    """Feature rows of the 24 hours from hour index ``origin``; the literal cut reaches the scan of the events."""
    cells = D.hourly_cells(D.conformed(D.events(spark, sf).filter(F.col("ts") < instant(origin)))).withColumn("t", hour_index("hour"))
    topics = topic_hourly(spark, sf).select(hour_index("hour").alias("t"), "vec")
    feeds = materialize(R.tagged_feeds(cells, D.edges(spark), topics, D.daily_reports(spark, sf), origin), "feeds")
    x = R.feature_rows(feeds, D.entities(spark), origin)
    return x.withColumns({c: D.r6(c) for c in ROUNDED})


def _sql(shift: int) -> str:
    """The rows' SQL; the origin lies ``shift`` hours after the latest event's hour."""
    return with_(EV, EDGES, REPORTS, TOPICS, f"""
o AS (SELECT CAST(date_diff('hour', TIMESTAMP '1970-01-01', max(hour)) AS BIGINT) + {shift} AS o FROM ev),
c AS (SELECT entity_id, CAST(date_diff('hour', TIMESTAMP '1970-01-01', hour) AS BIGINT) AS t, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS y,
        count(*) AS n_events, avg(value) AS value_avg, max(value) AS value_max FROM ev GROUP BY 1, 2 HAVING t < (SELECT o FROM o)),
th_el AS (SELECT hour, i, avg(v) AS m FROM (SELECT hour, unnest(vec) AS v, unnest(range(len(vec))) AS i FROM topics) GROUP BY hour, i),
th AS (SELECT CAST(date_diff('hour', TIMESTAMP '1970-01-01', hour) AS BIGINT) AS t, sum(abs(m)) AS s, max(abs(m)) AS top, stddev_samp(abs(m)) AS std, list(abs(m)) AS l
  FROM th_el GROUP BY hour HAVING t < (SELECT o FROM o)),
the AS (SELECT t, s, top, std, CASE WHEN s > 0 THEN -list_sum(list_transform(l, lambda x: (x / s) * ln(x / s + 1e-9))) ELSE 0 END AS ent FROM th),
rep AS (SELECT CAST(date_diff('day', DATE '1970-01-01', day) AS BIGINT) AS d, n_chars FROM reports WHERE date_diff('day', DATE '1970-01-01', day) * 24 < (SELECT o FROM o)),
h AS (SELECT o + k AS t FROM o, range(-48, 24) r(k)),
ser AS (SELECT h.t, m.t AS mt, coalesce(m.s * f, 0) AS x, coalesce(m.std * f, 0) AS std, coalesce(m.top * f, 0) AS top, coalesce(m.ent, 0) AS ent, f
  FROM h LEFT JOIN LATERAL (SELECT the.*, pow(0.5, (h.t - 1 - the.t) / 6.0) AS f FROM the WHERE the.t <= h.t - 1 ORDER BY the.t DESC LIMIT 1) m ON true),
sw AS (SELECT *, coalesce(x - lag(x, 3) OVER w, 0) AS v3, coalesce(x - lag(x, 24) OVER w, 0) AS v24,
    coalesce((x - avg(x) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) / (stddev_samp(x) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) + 1e-9), 0) AS z,
    (SELECT sum(b.x * pow(5 / 7.0, ser.t - b.t)) / sum(pow(5 / 7.0, ser.t - b.t)) FROM ser b WHERE b.t <= ser.t) AS ema FROM ser WINDOW w AS (ORDER BY t)),
tgt AS (SELECT CAST(e.range AS INTEGER) AS entity_id, h.t, TIMESTAMP '1970-01-01' + to_hours(h.t) AS hour FROM range(24) e, h, o WHERE h.t >= o.o),
last AS (SELECT entity_id, max(t) AS t, max(t) FILTER (y = 1) AS on_t, count(*) AS n, arg_max(value_avg, t) AS value_avg, arg_max(value_max, t) AS value_max,
    arg_max(n_events, t) AS n_events FROM c GROUP BY entity_id),
g AS (SELECT max(t) AS t FROM c),
repl AS (SELECT * FROM rep ORDER BY d DESC LIMIT 1)""") + """
SELECT x.entity_id, x.hour, CAST(isodow(x.hour) - 1 AS INTEGER) AS day_of_week, CAST(hour(x.hour) AS INTEGER) AS hour_of_day, CAST(isodow(x.hour) >= 6 AS INTEGER) AS is_weekend,
  CAST(hour(x.hour) >= 23 OR hour(x.hour) <= 6 AS INTEGER) AS is_night,
  coalesce((SELECT y FROM c WHERE c.entity_id = x.entity_id AND c.t = x.t - 1), 0) AS lag_1, coalesce((SELECT y FROM c WHERE c.entity_id = x.entity_id AND c.t = x.t - 3), 0) AS lag_3,
  coalesce((SELECT y FROM c WHERE c.entity_id = x.entity_id AND c.t = x.t - 6), 0) AS lag_6, coalesce((SELECT y FROM c WHERE c.entity_id = x.entity_id AND c.t = x.t - 12), 0) AS lag_12,
  coalesce((SELECT sum(y) FROM c WHERE c.entity_id = x.entity_id AND c.t BETWEEN x.t - 24 AND x.t - 1), 0)::DOUBLE AS active_last_24h,
  coalesce((SELECT sum(y) FROM c WHERE c.t = x.t - 1), 0)::BIGINT AS total_lag_1,
  coalesce((SELECT sum(y) FROM c JOIN edges ON c.entity_id = dst WHERE src = x.entity_id AND c.t = x.t - 1), 0)::BIGINT AS neighbours_lag_1,
  CASE WHEN last.on_t IS NULL THEN coalesce(last.n, 0) ELSE greatest(x.t - 1 - last.on_t, 0) END::DOUBLE AS hours_since_last,
  round(coalesce(p.value_avg, last.value_avg, 0), 6) AS hour_value, x.t - 1 - coalesce(p.t, last.t) AS hour_value_age,
  round(coalesce(d.value_max, last.value_max, 0), 6) AS day_value, x.t - 24 - coalesce(d.t, last.t) AS day_value_age,
  round(coalesce(p.n_events, CASE WHEN last.t = g.t THEN last.n_events * pow(0.5, greatest(x.t - 1 - g.t, 0) / 6.0) END, 0), 6) AS signal,
  CASE WHEN p.t IS NOT NULL THEN 0 WHEN last.t = g.t THEN x.t - 1 - g.t END AS signal_age,
  coalesce(r.n_chars, repl.n_chars, 0) AS report_chars, (x.t - 24) // 24 - coalesce(r.d, repl.d) AS report_age_days,
  round(s.x, 6) AS topic_intensity, x.t - 1 - s.mt AS topic_age, round(s.f, 6) AS topic_decay, round(s.std, 6) AS topic_std, round(s.top, 6) AS topic_top,
  round(s.ent, 6) AS topic_entropy, round(s.v3, 6) AS topic_velocity_3h, round(s.v24, 6) AS topic_velocity_24h, round(s.ema, 6) AS topic_ema_6h, round(s.z, 6) AS topic_zscore_24h
FROM tgt x JOIN sw s ON s.t = x.t CROSS JOIN g LEFT JOIN last ON last.entity_id = x.entity_id
LEFT JOIN c p ON p.entity_id = x.entity_id AND p.t = x.t - 1 LEFT JOIN c d ON d.entity_id = x.entity_id AND d.t = x.t - 24
LEFT JOIN rep r ON r.d = (x.t - 24) // 24 LEFT JOIN repl ON true"""


@query("serving_feature_rows", covers="M20 W3 W7 J11 J12 J13 F9 F15 F16", sql=_sql(1))
def serving_feature_rows(spark, sf):
    """The 24 hours after the latest event: what the forecast of the next day is scored on."""
    latest = latest_hour(spark, sf)
    return rows_from(spark, sf, 1 if latest is None else latest + 1)


@query("serving_feature_backtest", covers="M20", sql=f"""
WITH rows_ AS ({_sql(-35)}),
act AS (SELECT CAST(user_id % 24 AS INTEGER) AS entity_id, date_trunc('hour', ts) AS hour, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS y FROM events GROUP BY 1, 2)
SELECT rows_.*, coalesce(act.y, 0) AS y FROM rows_ LEFT JOIN act USING (entity_id, hour)""")
def serving_feature_backtest(spark, sf):
    """The same rows at an origin 35 hours before the latest event's hour, with what happened: no feature sees the horizon."""
    latest = latest_hour(spark, sf)
    origin = 0 if latest is None else latest - 35
    after = D.hourly_cells(D.conformed(D.events(spark, sf).filter(F.col("ts") >= instant(origin))))
    x = rows_from(spark, sf, origin).join(after.select("entity_id", "hour", "y"), ["entity_id", "hour"], "left")
    return x.withColumn("y", F.coalesce("y", F.lit(0)))
