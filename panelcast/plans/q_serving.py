"""Serving roll-ups (V1-V9, O6, F23, S17) and data-quality reports (Q1-Q3, Q7, Q8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.calendar import add_hours
from panelcast.operators import quality as Q
from panelcast.operators import serving as S
from panelcast.operators.clean import schema_drift
from panelcast.plans import driver as D
from panelcast.plans.q_analytics import TARGET_SCHEMA
from panelcast.plans.q_panel import CELLS_SQL, lag_feature_block, observed_cells, wide_panel
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, PANEL, TOPICS, with_
from panelcast.sources.tables import read_table


def forecast_table(spark, sf):
    """The latest 24 hours of every entity with a probability (share of the previous 24 hours active).

    Only the last 48 hours are built (24 forecast hours + the 24-row look-back of the rolling sum).
    """
    x = lag_feature_block(D.hourly_panel_tail(spark, sf, 48), bucket_rows=None)
    mx = x.agg(F.max("hour").alias("_mx"))
    fc = x.crossJoin(F.broadcast(mx)).filter(F.col("hour") > add_hours("_mx", -24))
    return fc.select("entity_id", "hour", F.date_format("hour", "HH:00").alias("time_key"),
                     F.hour("hour").alias("hour_of_day"), (F.col("alarms_in_last_24h") / F.lit(24.0)).alias("proba"))


def current_hour(fc):
    return fc.agg(F.hour(F.min("hour")).alias("_cur"))


FC_SQL = """lagf AS (SELECT entity_id, hour, CAST(COALESCE(sum(y) OVER (PARTITION BY entity_id ORDER BY hour
                     ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / 24.0 AS proba FROM panel),
fc AS (SELECT entity_id, hour, strftime(hour, '%H:00') AS time_key, hour(hour) AS hour_of_day, proba FROM lagf
       WHERE hour > (SELECT max(hour) FROM panel) - INTERVAL 24 HOUR),
cur AS (SELECT hour(min(hour)) AS h FROM fc)"""


@query("serve_region", covers="V1", sql=with_(PANEL, FC_SQL) + """
SELECT entity_id, time_key, round(proba, 6) AS proba, (proba >= 0.65 OR entity_id IN (1, 12)) AS alarm
FROM fc WHERE entity_id = 5""")
def serve_region(spark, sf):
    fc = forecast_table(spark, sf).filter(F.col("entity_id") == 5)
    return fc.select("entity_id", "time_key", D.r6("proba").alias("proba"),
                     S.is_alarm(F.col("entity_id"), F.col("proba")).alias("alarm"))


@query("serve_region_list", covers="V2", sql=with_(EV) + """
SELECT entity_id, n_name AS city, n_events FROM (SELECT entity_id, count(*) AS n_events FROM ev WHERE entity_id NOT IN (1, 12) GROUP BY 1)
JOIN nation ON n_nationkey = entity_id""")
def serve_region_list(spark, sf):
    """V2: the regions that have events, with their city (a nation's name stands for it); the always-on ones are left out."""
    seen = D.entity_events(spark, sf).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_events"))
    names = read_table(spark, sf, "nation", ["n_nationkey", "n_name"])
    listed = seen.filter(~F.col("entity_id").isin(*S.EXCLUDED_FROM_LIST)).join(names, F.col("entity_id") == F.col("n_nationkey"))
    return listed.select("entity_id", F.col("n_name").alias("city"), "n_events").orderBy("entity_id")


@query("serve_peak_hour", covers="V4 V5 V6", sql=with_(PANEL, FC_SQL, """
c AS (SELECT time_key, hour_of_day, count(*) FILTER (WHERE entity_id IN (1, 12) OR proba >= 0.65) AS n_alarm,
             count(*) FILTER (WHERE proba >= 0.65) AS n_model FROM fc GROUP BY 1, 2),
pk AS (SELECT time_key FROM c ORDER BY n_alarm DESC, hour_of_day LIMIT 1)""") + """
SELECT c.time_key, c.n_alarm, c.n_model, CAST(round((c.n_alarm + 2) / 26.0 * 100) AS INTEGER) AS coverage_pct,
       c.time_key = pk.time_key AS is_peak FROM c, pk""")
def serve_peak_hour(spark, sf):
    c = S.hourly_alarm_counts(forecast_table(spark, sf))
    pk = S.peak_hour(c)
    return c.crossJoin(F.broadcast(pk)).select("time_key", "n_alarm", "n_model", "coverage_pct",
                                               (F.col("time_key") == F.col("peak_time")).alias("is_peak"))


@query("serve_region_stats", covers="V7", sql=with_(PANEL, FC_SQL, """
a AS (SELECT fc.*, (entity_id IN (1, 12) OR proba >= 0.65) AS act, cur.h AS cur FROM fc, cur)""") + """
SELECT entity_id, CAST(CASE WHEN entity_id IN (1, 12) THEN 24 ELSE count(*) FILTER (WHERE act) END AS BIGINT) AS active_count,
  CAST(round(CASE WHEN entity_id IN (1, 12) THEN 24 ELSE count(*) FILTER (WHERE act) END / 24.0 * 100) AS INTEGER) AS coverage_pct,
  CASE WHEN bool_or(act AND hour_of_day = cur) THEN 'Now'
       WHEN coalesce(min(hour_of_day) FILTER (WHERE act AND hour_of_day > cur), min(hour_of_day) FILTER (WHERE act)) IS NULL THEN '-'
       ELSE printf('%02d:00', coalesce(min(hour_of_day) FILTER (WHERE act AND hour_of_day > cur),
                                       min(hour_of_day) FILTER (WHERE act))) END AS first_alarm
FROM a GROUP BY entity_id""")
def serve_region_stats(spark, sf):
    fc = forecast_table(spark, sf)
    x = fc.crossJoin(F.broadcast(current_hour(fc)))
    return S.region_stats(x, F.col("_cur"))


@query("serve_top3", covers="O6", sql=with_(PANEL, FC_SQL) + """
SELECT entity_id, CASE WHEN entity_id IN (1, 12) THEN 1.0 ELSE round(proba, 6) END AS probability
FROM fc, cur WHERE fc.hour_of_day = cur.h
ORDER BY CASE WHEN entity_id IN (1, 12) THEN 1.0 ELSE proba END DESC, entity_id LIMIT 3""")
def serve_top3(spark, sf):
    fc = forecast_table(spark, sf)
    key = fc.crossJoin(F.broadcast(current_hour(fc))).filter(F.col("hour_of_day") == F.col("_cur"))
    top = S.top_k_at(key, F.col("time_key"), 3)
    return top.select("entity_id", D.r6("probability").alias("probability"))


@query("serve_rotated_hours", covers="V8", sql=with_(PANEL, FC_SQL) + """
SELECT DISTINCT time_key, CAST(((hour_of_day - cur.h) % 24 + 24) % 24 AS INTEGER) AS position FROM fc, cur""")
def serve_rotated_hours(spark, sf):
    fc = forecast_table(spark, sf)
    x = fc.crossJoin(F.broadcast(current_hour(fc)))
    return S.rotated_hours(x, F.col("_cur")).select("time_key", F.col("position").cast("int").alias("position"))


@query("nested_map_json", covers="F23 V3 S17", sql=with_(PANEL, FC_SQL) + """
SELECT entity_id, time_key, round(proba, 6) AS proba FROM fc""")
def nested_map_json(spark, sf):
    fc = forecast_table(spark, sf)
    back = S.parse_forecast_json(S.forecast_json(fc))
    return back.select("entity_id", "time_key", D.r6("proba").alias("proba"))


# ------------------------------------------------------------------------------------ quality


@query("row_preservation", covers="Q1", sql=with_(PANEL, CELLS_SQL) + """
SELECT (SELECT count(*) FROM panel) AS n_left,
       (SELECT count(*) FROM panel p LEFT JOIN cells c ON c.entity_id = p.entity_id AND c.hour = p.hour) AS n_out,
       (SELECT count(*) FROM (SELECT entity_id, hour FROM cells GROUP BY 1, 2 HAVING count(*) > 1)) AS right_dup_keys,
       (SELECT count(*) FROM panel) = (SELECT count(*) FROM panel p LEFT JOIN cells c
                                        ON c.entity_id = p.entity_id AND c.hour = p.hour) AS preserved""")
def row_preservation(spark, sf):
    grid = D.hourly_panel(spark, sf).select("entity_id", "hour")
    cells = observed_cells(spark, sf).select("entity_id", "hour", "n_events")
    return Q.row_preservation(grid, cells, ["entity_id", "hour"]).select("n_left", "n_out", "right_dup_keys", "preserved")


@query("completeness", covers="Q2", sql=with_(EV, CELLS_SQL) + """
SELECT hour, count(DISTINCT entity_id) AS n_entities FROM cells GROUP BY hour HAVING count(DISTINCT entity_id) <> 24""")
def completeness(spark, sf):
    return Q.incomplete_hours(observed_cells(spark, sf), "hour", "entity_id", D.N_ENTITIES)


@query("health_report", covers="Q3", sql=with_(EV, """
mx AS (SELECT max(hour) AS m FROM ev),
r AS (SELECT ev.* FROM ev, mx WHERE hour > mx.m - INTERVAL 60 DAY),
k AS (SELECT hour, entity_id, count(*) AS c FROM r GROUP BY 1, 2),
h AS (SELECT hour, count(*) AS e, count(*) FILTER (WHERE c > 1) AS d FROM k GROUP BY hour)""") + """
SELECT max(hour) AS max_hour, count(*) AS distinct_hours, CAST(sum(d) AS BIGINT) AS duplicate_keys,
       count(*) FILTER (WHERE e <> 24) AS incomplete_hours, (SELECT count(*) FROM r) AS rows FROM h""")
def health_report(spark, sf):
    ev = D.entity_events(spark, sf).select("hour", "entity_id")
    return Q.health_report(ev, "hour", "entity_id", D.N_ENTITIES, days=60)


@query("contract_checks", covers="Q7 Q8", sql=with_(EV, CELLS_SQL, TOPICS) + """
SELECT 'topic_width_mismatch' AS check_name, count(*) FILTER (WHERE len(vec) <> 64) AS n FROM topics
UNION ALL SELECT 'entity_set_mismatch', (SELECT count(*) FROM ((SELECT range AS e FROM range(24))
    EXCEPT (SELECT DISTINCT entity_id FROM cells)))
UNION ALL SELECT 'hours_per_entity_mismatch', (SELECT count(*) FROM (SELECT entity_id, count(*) AS c FROM cells GROUP BY 1)
    WHERE c <> (SELECT count(DISTINCT hour) FROM cells))
UNION ALL SELECT 'schema_missing_columns', 3
UNION ALL SELECT 'schema_extra_columns', 2""")
def contract_checks(spark, sf):
    topics = D.topic_vectors(spark, sf)
    cells = observed_cells(spark, sf).select("entity_id", "hour")  # what was observed, not the grid made from it
    width = topics.agg(F.count_if(F.size("vec") != 64).alias("n")).select(F.lit("topic_width_mismatch").alias("check_name"), "n")
    ents = D.entities(spark).join(cells.select("entity_id").distinct(), "entity_id", "left_anti").agg(
        F.count(F.lit(1)).alias("n")).select(F.lit("entity_set_mismatch").alias("check_name"), "n")
    nh = cells.agg(F.countDistinct("hour").alias("_h"))
    per = cells.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_c")).crossJoin(F.broadcast(nh))
    hrs = per.agg(F.count_if(F.col("_c") != F.col("_h")).alias("n")).select(
        F.lit("hours_per_entity_mismatch").alias("check_name"), "n")
    # Q7: drift of the raw event projection against the aligned target schema (computed on the plan's schema)
    raw = D.events(spark, sf).select("event_id", "ts", "value", "event_type", "props", D.entity_of("user_id").alias("entity_id"))
    missing, extra = schema_drift(raw, TARGET_SCHEMA)
    drift = spark.createDataFrame([("schema_missing_columns", len(missing)), ("schema_extra_columns", len(extra))],
                                  "check_name string, n long")
    return width.unionByName(ents).unionByName(hrs).unionByName(drift)
