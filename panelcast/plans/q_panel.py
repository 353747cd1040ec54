"""Panel and per-entity feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.functions.calendar import is_night, is_weekend
from panelcast.operators import windows as W
from panelcast.operators.graph import lagged_global_total, lagged_neighbour_sum
from panelcast.plans import driver as D
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EDGES, EV as EV_SQL, PANEL, REPORTS, with_
from panelcast.sources.tables import read_table


@query("panel_dense_backbone", covers="J6 J1 P11 F7", sql=with_(PANEL) + """
SELECT entity_id, hour, y, n_events, round(value_avg, 6) AS value_avg, round(value_max, 6) AS value_max FROM panel""")
def panel_dense_backbone(spark, sf):
    p = D.hourly_panel(spark, sf)
    return p.select("entity_id", "hour", "y", "n_events", D.r6("value_avg").alias("value_avg"),
                    D.r6("value_max").alias("value_max"))


def lag_feature_block(panel, bucket_rows=-1):
    """W1 + W2 + W6 + F9 in ONE window pass over (entity, time bucket).

    Hours-since needs the last event before each bucket: a per-bucket carry (rows / bucket_rows) is
    joined first, so the unbounded running max shares the exchange and sort of the bounded features.
    """
    if bucket_rows == -1:
        bucket_rows = D.bucket_rows(panel.sparkSession)
    carry = None
    if bucket_rows:
        carry = W.running_carry(panel, {"_c_last": ("max", F.when(F.col("y") == 1, F.col("t"))),
                                        "_c_first": ("min", F.col("t"))}, bucket_rows=bucket_rows)

    def feats(w):
        hs = W.hours_since_in_window("y", "t", w, "_c_last" if bucket_rows else None, "_c_first" if bucket_rows else None)
        return [W.lag_fill("y", k, w).alias(f"lag_{k}") for k in (1, 3, 6, 12)] + [
            W.rolling_sum_prev("y", 24, w).alias("alarms_in_last_24h"), hs.alias("hours_since_last")]

    x = W.apply_windowed(panel, feats, lead_in=24, bucket_rows=bucket_rows, carry=carry)
    return x.withColumn("is_weekend", is_weekend("hour")).withColumn("is_night", is_night("hour"))


@query("panel_lag_features", covers="W1 W2 W6 F9", sql=with_(PANEL, """
f AS (
  SELECT entity_id, hour, y,
    COALESCE(lag(y, 1) OVER w, 0) AS lag_1, COALESCE(lag(y, 3) OVER w, 0) AS lag_3,
    COALESCE(lag(y, 6) OVER w, 0) AS lag_6, COALESCE(lag(y, 12) OVER w, 0) AS lag_12,
    CAST(COALESCE(sum(y) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS alarms_in_last_24h,
    COALESCE(lag(y, 1) OVER w, 0) AS s
  FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
g AS (SELECT *, sum(s) OVER (PARTITION BY entity_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp FROM f)""") + """
SELECT entity_id, hour, y, lag_1, lag_3, lag_6, lag_12, alarms_in_last_24h,
  CAST(row_number() OVER (PARTITION BY entity_id, grp ORDER BY hour) - 1 AS DOUBLE) AS hours_since_last,
  CAST(isodow(hour) - 1 IN (5, 6) AS INTEGER) AS is_weekend,
  CAST(hour(hour) >= 23 OR hour(hour) <= 6 AS INTEGER) AS is_night
FROM g""")
def panel_lag_features(spark, sf):
    x = lag_feature_block(D.hourly_panel(spark, sf))
    return x.select("entity_id", "hour", "y", "lag_1", "lag_3", "lag_6", "lag_12", "alarms_in_last_24h",
                    "hours_since_last", "is_weekend", "is_night")


def observed_cells(spark, sf):
    """Sparse (entity, hour) cells that have at least one event."""
    ev = D.entity_events(spark, sf)
    from panelcast.functions.calendar import hour_index
    return ev.groupBy("entity_id", "hour").agg(
        F.max(F.when(F.col("event_type") == D.EVENT_TYPE_TARGET, 1).otherwise(0)).alias("y"),
        F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("value_avg")).withColumn("t", hour_index("hour"))


CELLS_SQL = """cells AS (
  SELECT entity_id, hour, CAST(date_diff('hour', TIMESTAMP '1970-01-01', hour) AS BIGINT) AS t,
         max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS y, count(*) AS n_events, avg(value) AS value_avg
  FROM ev GROUP BY entity_id, hour)"""


@query("panel_clock_lag_features", covers="W3 W7", sql=with_(EV_SQL, CELLS_SQL) + """
SELECT c.entity_id, c.hour, c.y,
  CAST(COALESCE((SELECT max(b.y) FROM cells b WHERE b.entity_id = c.entity_id AND b.t = c.t - 1), 0) AS BIGINT) AS y_at_1,
  CAST(COALESCE((SELECT max(b.y) FROM cells b WHERE b.entity_id = c.entity_id AND b.t = c.t - 24), 0) AS BIGINT) AS y_at_24,
  CAST(COALESCE((SELECT sum(b.y) FROM cells b WHERE b.entity_id = c.entity_id AND b.t >= c.t - 24 AND b.t < c.t), 0)
       AS DOUBLE) AS sum_24h,
  CAST(CASE WHEN (SELECT max(b.t) FROM cells b WHERE b.entity_id = c.entity_id AND b.t < c.t AND b.y = 1) IS NULL
       THEN (SELECT count(*) FROM cells b WHERE b.entity_id = c.entity_id AND b.t < c.t)
       ELSE greatest(c.t - (SELECT max(b.t) FROM cells b WHERE b.entity_id = c.entity_id AND b.t < c.t AND b.y = 1) - 1, 0)
       END AS DOUBLE) AS hours_since_clock
FROM cells c""")
def panel_clock_lag_features(spark, sf):
    cells = observed_cells(spark, sf)
    bucket = D.bucket_rows(spark)

    def feats(w):
        return [F.coalesce(F.sum("y").over(w.rangeBetween(-1, -1)), F.lit(0).cast("long")).alias("y_at_1"),
                F.coalesce(F.sum("y").over(w.rangeBetween(-24, -24)), F.lit(0).cast("long")).alias("y_at_24"),
                F.coalesce(F.sum("y").over(w.rangeBetween(-24, -1)), F.lit(0)).cast("double").alias("sum_24h")]

    x = W.apply_windowed(cells, feats, lead_in=24, bucket_rows=bucket)
    x = W.prefix_scan(x, {"_last": ("max", F.when(F.col("y") == 1, F.col("t"))), "_n": ("sum", F.lit(1))},
                      "entity_id", "t", inclusive=False, bucket_rows=bucket)
    since = F.when(F.col("_last").isNull(), F.coalesce(F.col("_n"), F.lit(0))).otherwise(
        F.greatest(F.col("t") - F.col("_last") - 1, F.lit(0)))
    return x.select("entity_id", "hour", "y", "y_at_1", "y_at_24", "sum_24h", since.cast("double").alias("hours_since_clock"))


@query("panel_velocity_zscore", covers="W8 W10", sql=with_(PANEL) + """
SELECT entity_id, hour,
  round(COALESCE(value_avg - lag(value_avg, 24) OVER w, 0), 6) AS velocity_24,
  round(COALESCE(value_avg - lag(value_avg, 3) OVER w, 0), 6) AS velocity_3,
  round(COALESCE((value_avg - avg(value_avg) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))
        / (stddev_samp(value_avg) OVER (w ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) + 1e-9), 0), 6) AS zscore_24
FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)""")
def panel_velocity_zscore(spark, sf):
    def feats(w):
        return [D.r6(W.diff_fill("value_avg", 24, w)).alias("velocity_24"),
                D.r6(W.diff_fill("value_avg", 3, w)).alias("velocity_3"),
                D.r6(W.rolling_zscore("value_avg", 24, w)).alias("zscore_24")]

    x = W.apply_windowed(D.hourly_panel(spark, sf), feats, lead_in=24, bucket_rows=D.bucket_rows(spark))
    return x.select("entity_id", "hour", "velocity_24", "velocity_3", "zscore_24")


@query("panel_ewm", covers="W9", sql=with_(PANEL, """
p AS (SELECT entity_id, hour, t, value_avg AS x FROM panel),
e24 AS (SELECT a.entity_id, a.hour, sum(pow(23.0 / 25.0, a.t - 1 - b.t) * b.x) / sum(pow(23.0 / 25.0, a.t - 1 - b.t)) AS v
        FROM p a JOIN p b ON a.entity_id = b.entity_id AND b.t < a.t GROUP BY a.entity_id, a.hour),
e6 AS (SELECT a.entity_id, a.hour, sum(pow(5.0 / 7.0, a.t - b.t) * b.x) / sum(pow(5.0 / 7.0, a.t - b.t)) AS v
       FROM p a JOIN p b ON a.entity_id = b.entity_id AND b.t <= a.t GROUP BY a.entity_id, a.hour)""") + """
SELECT p.entity_id, p.hour, round(COALESCE(e24.v, 0), 6) AS ewm24_prev, round(COALESCE(e6.v, 0), 6) AS ewm6
FROM p LEFT JOIN e24 USING (entity_id, hour) LEFT JOIN e6 USING (entity_id, hour)""")
def panel_ewm(spark, sf):
    lead = W.ewm_cutoff_rows(6)
    lead24 = W.ewm_cutoff_rows(24)
    lead = max(lead, lead24)
    # bucket: several lead-ins long, but small enough that r^-(bucket+lead) stays finite for span 6
    bucket = min(max(D.bucket_rows(spark), 2 * lead), W.ewm_max_bucket(6, lead))

    def feats(w):
        return [D.r6(W.ewm_mean_bucketed("value_avg", 24, w, "t", bucket, lead, shifted=True)).alias("ewm24_prev"),
                D.r6(W.ewm_mean_bucketed("value_avg", 6, w, "t", bucket, lead, shifted=False)).alias("ewm6")]

    x = W.apply_windowed(D.hourly_panel(spark, sf), feats, lead_in=lead, bucket_rows=bucket)
    return x.select("entity_id", "hour", "ewm24_prev", "ewm6")


@query("panel_neighbour_totals", covers="J15 W4 W5 A7", sql=with_(PANEL, EDGES, """
tot AS (SELECT hour + INTERVAL 1 HOUR AS hour, sum(y) AS total FROM panel GROUP BY hour),
nb AS (SELECT e.src AS entity_id, p.hour + INTERVAL 1 HOUR AS hour, sum(p.y) AS s
       FROM panel p JOIN edges e ON p.entity_id = e.dst GROUP BY e.src, p.hour)""") + """
SELECT p.entity_id, p.hour, p.y, CAST(COALESCE(tot.total, 0) AS DOUBLE) AS total_lag1,
       CAST(COALESCE(nb.s, 0) AS DOUBLE) AS neighbour_lag1
FROM panel p LEFT JOIN tot USING (hour) LEFT JOIN nb USING (entity_id, hour)""")
def panel_neighbour_totals(spark, sf):
    p = D.hourly_panel(spark, sf).select("entity_id", "hour", "y")
    x = lagged_global_total(p, "y", out="total_lag1")
    x = lagged_neighbour_sum(x, D.edges(spark), "y", out="neighbour_lag1")
    return x.select("entity_id", "hour", "y", "total_lag1", "neighbour_lag1")


@query("hourly_totals", covers="A7", sql=with_(PANEL) + """
SELECT hour, CAST(sum(y) AS BIGINT) AS total_active, CAST(sum(n_events) AS BIGINT) AS total_events FROM panel GROUP BY hour""")
def hourly_totals(spark, sf):
    p = D.hourly_panel(spark, sf)
    return p.groupBy("hour").agg(F.sum("y").alias("total_active"), F.sum("n_events").alias("total_events"))


def wide_panel(spark, sf):
    """Model-panel shape: column families by prefix (hour_, day_, msg_, rep_) + calendar columns."""
    p = D.hourly_panel(spark, sf).withColumn("day", F.to_date("hour"))
    daily = p.groupBy("entity_id", "day").agg(F.max("value_max").alias("day_value_max"))
    rep = D.daily_reports(spark, sf).select("day", F.col("n_chars").alias("rep_n_chars"))
    x = (p.join(daily, ["entity_id", "day"], "left").join(rep, ["day"], "left")
          .select("entity_id", "hour", "t", "y",
                  F.col("value_avg").alias("hour_value_avg"),
                  (F.col("n_events") > 0).alias("hour_busy"),
                  "day_value_max",
                  F.weekday("hour").alias("day_of_week"),
                  F.col("n_events").alias("msg_n_events"),
                  F.coalesce("rep_n_chars", F.lit(0).cast("long")).alias("rep_n_chars")))
    return x


WIDE_SQL = """daily AS (SELECT entity_id, CAST(hour AS DATE) AS day, max(value_max) AS day_value_max FROM panel GROUP BY 1, 2),
wide AS (
  SELECT p.entity_id, p.hour, p.t, p.y, p.value_avg AS hour_value_avg, p.n_events > 0 AS hour_busy, d.day_value_max,
         CAST(isodow(p.hour) - 1 AS INTEGER) AS day_of_week, p.n_events AS msg_n_events,
         COALESCE(r.n_chars, 0) AS rep_n_chars
  FROM panel p LEFT JOIN daily d ON d.entity_id = p.entity_id AND d.day = CAST(p.hour AS DATE)
  LEFT JOIN reports r ON r.day = CAST(p.hour AS DATE))"""

# Leak-free shifts per column family (fixed values of the product's model panel)
FAMILY_SHIFTS = {"rep_": 24, "msg_": 1, "hour_": 1, "day_": 24}
CALENDAR_COLUMNS = ("day_datetime", "day_sunrise", "day_sunset", "day_moonphase", "day_of_week")


def family_columns(columns, shifts=FAMILY_SHIFTS, exclude=CALENDAR_COLUMNS):
    """Columns selected by family prefix, calendar columns excluded."""
    out = {}
    for c in columns:
        for prefix, k in shifts.items():
            if c.startswith(prefix) and c not in exclude:
                out[c] = k
    return out


@query("panel_leakfree_shift", covers="W12 P2 J2", sql=with_(PANEL, REPORTS, WIDE_SQL) + """
SELECT entity_id, hour, y,
  round(COALESCE(lag(hour_value_avg, 1) OVER w, 0), 6) AS hour_value_avg,
  COALESCE(lag(hour_busy, 1) OVER w, false) AS hour_busy,
  round(COALESCE(lag(day_value_max, 24) OVER w, 0), 6) AS day_value_max,
  day_of_week,
  COALESCE(lag(msg_n_events, 1) OVER w, 0) AS msg_n_events,
  COALESCE(lag(rep_n_chars, 24) OVER w, 0) AS rep_n_chars
FROM wide WINDOW w AS (PARTITION BY entity_id ORDER BY hour)""")
def panel_leakfree_shift(spark, sf):
    wide = wide_panel(spark, sf)
    shifted = W.family_shift(wide, family_columns(wide.columns), bucket_rows=D.bucket_rows(spark))
    return shifted.select("entity_id", "hour", "y", D.r6("hour_value_avg").alias("hour_value_avg"), "hour_busy",
                          D.r6("day_value_max").alias("day_value_max"), "day_of_week", "msg_n_events", "rep_n_chars")


@query("column_family_projection", covers="P1 P2", sql=with_(PANEL, REPORTS, WIDE_SQL) + """
SELECT entity_id AS region_id, hour AS datetime_hour, round(hour_value_avg, 6) AS hour_value_avg, hour_busy,
       round(day_value_max, 6) AS day_value_max FROM wide""")
def column_family_projection(spark, sf):
    import re
    wide = wide_panel(spark, sf)
    weather = [c for c in wide.columns if re.match(r"^(hour_|day_)", c) and c not in CALENDAR_COLUMNS]
    dbl = {c for c, t in wide.dtypes if t == "double"}
    return (wide.withColumnsRenamed({"entity_id": "region_id", "hour": "datetime_hour"})
                .select("region_id", "datetime_hour", *[D.r6(c).alias(c) if c in dbl else F.col(c) for c in weather]))


@query("last_state_per_entity", covers="W13", sql=with_(EV_SQL, CELLS_SQL) + """
SELECT entity_id, max(hour) AS last_hour, arg_max(y, hour) AS last_y, round(arg_max(value_avg, hour), 6) AS last_value_avg,
       max(CASE WHEN y = 1 THEN hour END) AS last_event_hour
FROM cells GROUP BY entity_id""")
def last_state_per_entity(spark, sf):
    cells = observed_cells(spark, sf)
    last = W.last_row_per_entity(cells, "entity_id", "hour", ["y", "value_avg"])
    ev = cells.groupBy("entity_id").agg(F.max(F.when(F.col("y") == 1, F.col("hour"))).alias("last_event_hour"))
    return last.join(ev, "entity_id").select("entity_id", F.col("hour").alias("last_hour"), F.col("y").alias("last_y"),
                                             D.r6("value_avg").alias("last_value_avg"), "last_event_hour")


@query("supplier_daily_features", covers="W3 W7", sql="""
WITH c AS (SELECT l_suppkey AS entity_id, CAST(date_diff('day', TIMESTAMP '1970-01-01', l_shipdate) AS BIGINT) AS t,
                  CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS qty, count(*) AS n_lines FROM lineitem GROUP BY 1, 2)
SELECT entity_id, t, qty, n_lines, COALESCE(sum(qty) OVER (w RANGE BETWEEN 7 PRECEDING AND 7 PRECEDING), 0) AS qty_at_7,
       COALESCE(sum(qty) OVER (w RANGE BETWEEN 28 PRECEDING AND 1 PRECEDING), 0) AS qty_28d
FROM c WINDOW w AS (PARTITION BY entity_id ORDER BY t)""")
def supplier_daily_features(spark, sf):
    """The clock-window features on the largest landed table: a (supplier, day) panel of shipped lines."""
    li = read_table(spark, sf, "lineitem", ["l_suppkey", "l_shipdate", "l_quantity"])
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1970-01-01").cast("date")).cast("long")
    cells = li.groupBy(F.col("l_suppkey").alias("entity_id"), day.alias("t")).agg(
        D.money_sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("n_lines"))

    def feats(w):
        total = lambda a, b: F.coalesce(F.sum("qty").over(w.rangeBetween(a, b)), F.lit(0.0))
        return [total(-7, -7).alias("qty_at_7"), total(-28, -1).alias("qty_28d")]

    x = W.apply_windowed(cells, feats, lead_in=28, bucket_rows=365)
    return x.select("entity_id", "t", "qty", "n_lines", "qty_at_7", "qty_28d")


@query("last_known_per_entity", covers="W13", sql=with_(EV_SQL, CELLS_SQL) + """
SELECT entity_id, arg_max(y, hour) FILTER (WHERE n_events > 1) AS last_busy_y, arg_max(n_events, hour) FILTER (WHERE y = 1) AS last_alarm_events
FROM cells GROUP BY entity_id""")
def last_known_per_entity(spark, sf):
    """W13 (``last()``): every column's own last known value; y is unknown in quiet hours, the count outside alarms."""
    cells = observed_cells(spark, sf).select("entity_id", "hour", F.when(F.col("n_events") > 1, F.col("y")).alias("last_busy_y"),
                                             F.when(F.col("y") == 1, F.col("n_events")).alias("last_alarm_events"))
    return W.last_non_null_per_entity(cells, "entity_id", "hour", ["last_busy_y", "last_alarm_events"])
