"""Cleaning, roll-up, profile and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions import calendar as C
from panelcast.functions import codes as K
from panelcast.operators import aggregates as G
from panelcast.operators import vectors as V
from panelcast.operators import windows as W
from panelcast.operators.clean import align_to_schema
from panelcast.operators.ranking import exact_quantiles
from panelcast.plans import driver as D
from panelcast.plans.q_panel import lag_feature_block
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, INTERVALS, PANEL, TOPICS, with_
from panelcast.sources.tables import read_table

EVENT_TYPES = ["signup", "purchase", "error", "view", "click"]
YEARS = list(range(1995, 2002))


def lineitem(spark, sf, cols=None):
    return read_table(spark, sf, "lineitem", cols)


@query("dedupe_typed_agg", covers="A1", sql=with_(EV) + """
SELECT entity_id, hour, round(avg(value), 6) AS value_mean, bool_or(event_type = 'error') AS has_error,
       arg_min(event_type, (ts, event_id)) AS first_type, count(*) AS n
FROM ev GROUP BY entity_id, hour""")
def dedupe_typed_agg(spark, sf):
    ev = D.entity_events(spark, sf)
    return ev.groupBy("entity_id", "hour").agg(
        D.r6(F.avg("value")).alias("value_mean"), F.max(F.col("event_type") == "error").alias("has_error"),
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.count(F.lit(1)).alias("n"))


def _outliers(spark, sf):
    li = lineitem(spark, sf, ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", "l_discount", "l_tax"])
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate",
                     G.null_outside("l_discount", hi=0.08).alias("disc"),
                     G.null_outside("l_tax", lo=0.01, hi=0.07).alias("tax"))


OUTLIER_SQL = """x AS (
  SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate,
         CASE WHEN l_discount > 0.08 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_tax < 0.01 OR l_tax > 0.07 THEN NULL ELSE l_tax END AS tax
  FROM lineitem)"""


@query("outlier_null", covers="P8", sql=with_(OUTLIER_SQL) + """
SELECT l_orderkey, l_linenumber, round(disc, 6) AS disc, round(tax, 6) AS tax FROM x""")
def outlier_null(spark, sf):
    x = _outliers(spark, sf)
    return x.select("l_orderkey", "l_linenumber", D.r6("disc").alias("disc"), D.r6("tax").alias("tax"))


@query("group_mean_impute", covers="P9", sql=with_(OUTLIER_SQL, """
m AS (SELECT l_returnflag, month(l_shipdate) AS mo, avg(disc) AS md FROM x GROUP BY 1, 2)""") + """
SELECT x.l_orderkey, x.l_linenumber, round(COALESCE(x.disc, m.md), 6) AS disc
FROM x LEFT JOIN m ON m.l_returnflag = x.l_returnflag AND m.mo = month(x.l_shipdate)""")
def group_mean_impute(spark, sf):
    x = _outliers(spark, sf).withColumn("mo", F.month("l_shipdate"))
    y = G.group_mean_impute(x, ["disc"], ["l_returnflag", "mo"])
    return y.select("l_orderkey", "l_linenumber", D.r6("disc").alias("disc"))


@query("median_impute", covers="P10", sql=with_(OUTLIER_SQL, """
m AS (SELECT quantile_cont(disc, 0.5) AS md, quantile_cont(tax, 0.5) AS mt FROM x)""") + """
SELECT l_orderkey, l_linenumber, round(COALESCE(disc, md), 6) AS disc, round(COALESCE(tax, mt), 6) AS tax FROM x, m""")
def median_impute(spark, sf):
    y = G.median_impute(_outliers(spark, sf), ["disc", "tax"])
    return y.select("l_orderkey", "l_linenumber", D.r6("disc").alias("disc"), D.r6("tax").alias("tax"))


@query("dst_hour_filter", covers="P14 F7", sql="""
WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
h AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM b),
d AS (SELECT hour, year(hour) AS y,
        make_date(year(hour), 3, 31) - CAST(isodow(make_date(year(hour), 3, 31)) % 7 AS INTEGER) AS ls FROM h)
SELECT CAST(y AS INTEGER) AS year, count(*) FILTER (WHERE hour <> CAST(ls AS TIMESTAMP) + INTERVAL 3 HOUR) AS n_hours,
       CAST(min(ls) AS TIMESTAMP) + INTERVAL 3 HOUR AS dst_hour
FROM d GROUP BY y""")
def dst_hour_filter(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderdate"])
    grid = C.hour_grid(spark, o.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")))
    kept = C.drop_spring_forward_hours(grid, "hour")
    per = kept.groupBy(F.year("hour").alias("year")).agg(F.count(F.lit(1)).alias("n_hours"))
    return per.withColumn("dst_hour", C.spring_forward_hour(F.col("year")))


@query("one_hot_condition", covers="P15", sql="SELECT event_id, " + ", ".join(
    f"COALESCE(event_type = '{v}', false) AS is_{v}" for v in EVENT_TYPES) + " FROM events")
def one_hot_condition(spark, sf):
    ev = D.events(spark, sf)
    return ev.select("event_id", *K.one_hot(F.col("event_type"), EVENT_TYPES, "is_"))


# condition phrases as the feeds write them; two of a document's three phrases are joined, so the order of the classes decides
PHRASES = ["Snow showers", "Light Rain", "Overcast", "Partly cloudy", "Clear sky", "Fog", "Windy", "rain and snow"]


@query("keyword_classify", covers="F18", sql=f"""
SELECT doc_id, phrase, CASE WHEN contains(phrase, 'Snow') THEN 'Snow' WHEN contains(phrase, 'Rain') THEN 'Rain'
  WHEN contains(phrase, 'Overcast') OR contains(phrase, 'cloudy') THEN 'Cloudy' WHEN contains(phrase, 'Clear') THEN 'Clear'
  WHEN contains(phrase, 'Fog') THEN 'Fog' ELSE 'Other' END AS condition
FROM (SELECT doc_id, p[CAST(doc_id % 8 AS INTEGER) + 1] || ', ' || p[CAST(doc_id // 8 % 8 AS INTEGER) + 1] AS phrase
      FROM documents, (SELECT {PHRASES} AS p))""")
def keyword_classify(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id"])
    words = F.array(*[F.lit(p) for p in PHRASES])
    pick = lambda i: F.element_at(words, F.pmod(i, F.lit(len(PHRASES))).cast("int") + 1)
    d = d.withColumn("phrase", F.concat(pick(F.col("doc_id")), F.lit(", "), pick(F.expr("doc_id div 8"))))
    return d.select("doc_id", "phrase", K.classify_condition(F.col("phrase")).alias("condition"))


def _flags_sql(mapping, prefix):
    return ", ".join(f"COALESCE(code IN ({', '.join(map(str, v))}), false) AS {prefix}{k}" for k, v in mapping.items())


@query("code_flags", covers="F22", sql="SELECT event_id, code, " + _flags_sql(K.CODE_MAP_PATCH, "patch_") + ", "
       + _flags_sql(K.CODE_MAP_LIVE, "live_") + """
FROM (SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS code FROM events)""")
def code_flags(spark, sf):
    ev = D.events(spark, sf)
    code = F.get_json_object("props", "$.k").try_cast("int")
    x = ev.select("event_id", code.alias("code"))
    return x.select("event_id", "code", *K.code_flags(F.col("code"), K.CODE_MAP_PATCH, "patch_"),
                    *K.code_flags(F.col("code"), K.CODE_MAP_LIVE, "live_"))


@query("risk_bands", covers="F24 V9", sql=with_(PANEL) + """
SELECT entity_id, hour, round(p, 6) AS p,
  CASE WHEN p IS NULL THEN 'no_data' WHEN p < 0.2 THEN 'very_low' WHEN p < 0.35 THEN 'low' WHEN p < 0.5 THEN 'moderate'
       WHEN p < 0.65 THEN 'elevated' WHEN p < 0.8 THEN 'high' ELSE 'very_high' END AS band
FROM (SELECT entity_id, hour, COALESCE(sum(y) OVER (PARTITION BY entity_id ORDER BY hour
        ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) / 24.0 AS p FROM panel)""")
def risk_bands(spark, sf):
    x = lag_feature_block(D.hourly_panel(spark, sf))
    p = F.col("alarms_in_last_24h") / F.lit(24.0)
    return x.select("entity_id", "hour", D.r6(p).alias("p"), K.risk_band(p).alias("band"))


TARGET_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("entity_id", T.IntegerType()), T.StructField("value", T.DoubleType()),
    T.StructField("channel", T.StringType()), T.StructField("is_flagged", T.BooleanType()),
    T.StructField("k", T.LongType())])
TARGET_DEFAULTS = {"channel": "unknown", "is_flagged": False}


@query("schema_align", covers="P12 P13 Q7", sql="""
SELECT event_id, ts, CAST(user_id % 24 AS INTEGER) AS entity_id, value, 'unknown' AS channel, false AS is_flagged,
       TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def schema_align(spark, sf):
    ev = D.events(spark, sf).select("event_id", "ts", D.entity_of("user_id").alias("entity_id"), "value", "event_type",
                                    F.get_json_object("props", "$.k").alias("k"))
    return align_to_schema(ev, TARGET_SCHEMA, TARGET_DEFAULTS)


@query("daily_from_hourly", covers="A5", sql=with_(PANEL) + """
SELECT entity_id, day, round(day_max, 6) AS day_max, round(day_min, 6) AS day_min, round(day_sum / n, 6) AS day_mean,
       round(day_sum, 6) AS day_sum FROM (
  SELECT entity_id, CAST(CAST(hour AS DATE) AS TIMESTAMP) AS day, max(value_max) AS day_max, min(value_max) AS day_min,
         CAST(sum(CAST(value_max AS DECIMAL(18, 2))) AS DOUBLE) AS day_sum, count(*) AS n
  FROM panel GROUP BY entity_id, CAST(hour AS DATE))""")
def daily_from_hourly(spark, sf):
    p = D.hourly_panel(spark, sf).withColumn("value_max", F.col("value_max").cast("decimal(18,2)"))
    d = G.daily_from_hourly(p, ["entity_id"], "hour", "value_max")
    return d.select("entity_id", F.col("day").cast("timestamp_ntz").alias("day"),
                    *[D.r6(c).alias(c) for c in ("day_max", "day_min", "day_mean", "day_sum")])


@query("precip_cover", covers="A6", sql=with_(PANEL, """
f AS (SELECT entity_id, hour, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS rain,
             max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS snow FROM ev GROUP BY 1, 2)""") + """
SELECT p.entity_id, CAST(CAST(p.hour AS DATE) AS TIMESTAMP) AS day,
  round(avg(CASE WHEN COALESCE(f.rain, 0) > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS cover_rain,
  round(avg(CASE WHEN COALESCE(f.rain, 0) > 0 OR COALESCE(f.snow, 0) > 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS cover_any
FROM panel p LEFT JOIN f USING (entity_id, hour) GROUP BY p.entity_id, CAST(p.hour AS DATE)""")
def precip_cover(spark, sf):
    ev = D.entity_events(spark, sf)
    f = ev.groupBy("entity_id", "hour").agg(F.max((F.col("event_type") == "purchase").cast("int")).alias("rain"),
                                            F.max((F.col("event_type") == "signup").cast("int")).alias("snow"))
    p = D.hourly_panel(spark, sf).select("entity_id", "hour").join(f, ["entity_id", "hour"], "left").fillna(0, ["rain", "snow"])
    return p.groupBy("entity_id", F.to_date("hour").cast("timestamp_ntz").alias("day")).agg(
        D.r6(G.share_percent(F.col("rain") > 0)).alias("cover_rain"),
        D.r6(G.share_percent((F.col("rain") > 0) | (F.col("snow") > 0))).alias("cover_any"))


@query("monthly_counts_ma3", covers="A9 W11", sql="""
SELECT CAST(m AS TIMESTAMP) AS month, n, round(avg(n) OVER (ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS ma3
FROM (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY 1)""")
def monthly_counts_ma3(spark, sf):
    m = lineitem(spark, sf, ["l_shipdate"]).groupBy(C.floor_month("l_shipdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    # one row per month: the global window runs over the aggregate, not the rows (DR4)
    w = F.avg("n").over(W.Window.orderBy("m").rowsBetween(-2, 0))
    return m.select(F.col("m").cast("timestamp_ntz").alias("month"), "n", D.r6(w).alias("ma3"))


@query("drop_incomplete_month", covers="A10", sql="""
WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1),
mx AS (SELECT max(o_orderdate) AS d FROM orders)
SELECT CAST(m AS TIMESTAMP) AS month, n FROM m, mx
WHERE NOT (m = date_trunc('month', mx.d) AND last_day(mx.d) <> CAST(mx.d AS DATE))""")
def drop_incomplete_month(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderdate"])
    m = o.groupBy(C.floor_month("o_orderdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    mx = o.agg(F.max("o_orderdate").alias("d"))
    incomplete = (F.col("m") == C.floor_month("d")) & (F.last_day("d") != F.to_date("d"))
    return m.crossJoin(F.broadcast(mx)).filter(~incomplete).select(F.col("m").cast("timestamp_ntz").alias("month"), "n")


@query("drop_last_month", covers="A10", sql="""
WITH m AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(m AS TIMESTAMP) AS month, n FROM m WHERE m < (SELECT max(m) FROM m)""")
def drop_last_month(spark, sf):
    """A10, the plain form: the last period always goes."""
    o = read_table(spark, sf, "orders", ["o_orderdate"])
    m = o.groupBy(C.floor_month("o_orderdate").cast("timestamp_ntz").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    last = m.agg(F.max("month").alias("last"))
    return m.crossJoin(F.broadcast(last)).filter(F.col("month") < F.col("last")).drop("last")


@query("weekly_rollup", covers="A9 F6", sql="""
SELECT week, n, round(total, 6) AS total, round(total / n, 6) AS mean FROM (
  SELECT CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS week, count(*) AS n,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders GROUP BY 1)""")
def weekly_rollup(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderdate", "o_totalprice"])
    w = o.groupBy(C.floor_week("o_orderdate").cast("timestamp_ntz").alias("week")).agg(
        F.count(F.lit(1)).alias("n"), D.money_sum("o_totalprice").alias("total"))
    return w.select("week", "n", D.r6("total").alias("total"), D.r6(F.col("total") / F.col("n")).alias("mean"))


@query("weekday_hour_matrix", covers="A15", sql="""
WITH c AS (SELECT isodow(ts) - 1 AS wd, hour(ts) AS h FROM events),
wds AS (SELECT CAST(range AS INTEGER) AS wd FROM range(7))
SELECT wds.wd AS weekday, """ + ", ".join(
    f"CAST(count(c.h) FILTER (WHERE c.h = {h}) AS BIGINT) AS h{h:02d}" for h in range(24)) + """
FROM wds LEFT JOIN c ON c.wd = wds.wd GROUP BY wds.wd""")
def weekday_hour_matrix(spark, sf):
    ev = D.events(spark, sf).select(C.weekday_mon0("ts").alias("weekday"), F.hour("ts").alias("h"))
    wide = G.pivot_wide(ev, ["weekday"], "h", list(range(24)), F.count(F.lit(1)))
    wide = wide.withColumnsRenamed({str(h): f"h{h:02d}" for h in range(24)})
    wds = spark.range(7).select(F.col("id").cast("int").alias("weekday"))
    out = wds.join(wide, "weekday", "left")
    return out.fillna(0, [f"h{h:02d}" for h in range(24)])


PIVOT_SQL = """pv AS (
  SELECT CAST(month(l_shipdate) AS INTEGER) AS month, """ + ", ".join(
    f"round(avg(l_quantity) FILTER (WHERE year(l_shipdate) = {y}), 6) AS y{y}" for y in YEARS) + """
  FROM lineitem GROUP BY 1)"""


def _pivot_month_year(spark, sf):
    li = lineitem(spark, sf, ["l_shipdate", "l_quantity"]).select(
        F.month("l_shipdate").alias("month"), F.year("l_shipdate").alias("year"), "l_quantity")
    wide = G.pivot_wide(li, ["month"], "year", YEARS, F.avg("l_quantity"), prefix="y")
    return wide.select("month", *[D.r6(f"y{y}").alias(f"y{y}") for y in YEARS])


@query("pivot_month_year", covers="A14", sql=with_(PIVOT_SQL) + " SELECT * FROM pv")
def pivot_month_year(spark, sf):
    return _pivot_month_year(spark, sf)


@query("unpivot_matrix", covers="A16", sql=with_(PIVOT_SQL) + """
SELECT month, year, mean_qty FROM (UNPIVOT pv ON """ + ", ".join(f"y{y}" for y in YEARS) + """
  INTO NAME year VALUE mean_qty) WHERE mean_qty IS NOT NULL""")
def unpivot_matrix(spark, sf):
    wide = _pivot_month_year(spark, sf)
    return G.unpivot_long(wide, ["month"], [f"y{y}" for y in YEARS], "year", "mean_qty")


def _durations(spark, sf):
    return D.entity_events(spark, sf).filter(F.col("event_type") == D.EVENT_TYPE_TARGET).select(
        "entity_id", F.col("value").alias("dur"))


@query("duration_quantiles", covers="A11", sql=with_(EV, """
d AS (SELECT value AS dur FROM ev WHERE event_type = 'error'),
q AS (SELECT 0.5 AS q, quantile_cont(dur, 0.5) AS v FROM d UNION ALL SELECT 0.8, quantile_cont(dur, 0.8) FROM d
      UNION ALL SELECT 0.99, quantile_cont(dur, 0.99) FROM d)""") + """
SELECT CAST(q AS DOUBLE) AS q, round(v, 6) AS value,
       (SELECT count(*) FROM d WHERE d.dur <= (SELECT quantile_cont(dur, 0.99) FROM d)) AS n_le_p99 FROM q""")
def duration_quantiles(spark, sf):
    d = _durations(spark, sf)
    q = exact_quantiles(d, "dur", [0.5, 0.8, 0.99])
    p99 = q.filter(F.col("q") == 0.99).select(F.col("q_value").alias("p99"))
    n = d.crossJoin(F.broadcast(p99)).filter(F.col("dur") <= F.col("p99")).agg(F.count(F.lit(1)).alias("n_le_p99"))
    return q.crossJoin(F.broadcast(n)).select("q", D.r6("q_value").alias("value"), "n_le_p99")


@query("grouped_median_top10", covers="A12 P4 O2", sql=with_(EV, """
d AS (SELECT entity_id, value AS dur FROM ev WHERE event_type = 'error'),
top AS (SELECT entity_id, count(*) AS n FROM d GROUP BY 1 ORDER BY n DESC, entity_id LIMIT 10)""") + """
SELECT d.entity_id, top.n, round(median(d.dur), 6) AS median_dur FROM d JOIN top USING (entity_id) GROUP BY d.entity_id, top.n""")
def grouped_median_top10(spark, sf):
    d = _durations(spark, sf)
    top = d.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "entity_id").limit(10)
    sel = d.join(top.select("entity_id"), "entity_id", "left_semi")
    med = exact_quantiles(sel, "dur", [0.5], keys=["entity_id"])
    return med.join(top, "entity_id").select("entity_id", "n", D.r6("q_value").alias("median_dur"))


@query("histogram", covers="A13", sql=with_(EV, """
d AS (SELECT value AS dur FROM ev WHERE event_type = 'error'),
b AS (SELECT min(dur) AS lo, max(dur) AS hi FROM d)""") + """
SELECT CAST(least(floor((dur - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n,
       round(min(lo), 6) AS lo, round(min(hi), 6) AS hi
FROM d, b GROUP BY 1""")
def histogram(spark, sf):
    h = G.histogram(_durations(spark, sf), "dur", 30)
    return h.select("bin", "n", D.r6("lo").alias("lo"), D.r6("hi").alias("hi"))


@query("five_number", covers="A23", sql="""
SELECT event_type, CAST(q AS DOUBLE) AS q, round(v, 6) AS value FROM (""" + " UNION ALL ".join(
    f"SELECT event_type, {q} AS q, quantile_cont(value, {q}) AS v FROM events GROUP BY event_type"
    for q in (0.0, 0.25, 0.5, 0.75, 1.0)) + ")")
def five_number(spark, sf):
    ev = D.events(spark, sf).select("event_type", "value")
    q = exact_quantiles(ev, "value", [0.0, 0.25, 0.5, 0.75, 1.0], keys=["event_type"])
    return q.select("event_type", "q", D.r6("q_value").alias("value"))


CORR_FEATURES = ["lag_1", "alarms_in_last_24h", "hours_since_last", "value_avg", "n_events"]


@query("corr_vector", covers="A17", sql=with_(PANEL, """
f AS (SELECT y, COALESCE(lag(y, 1) OVER w, 0) AS lag_1,
        CAST(COALESCE(sum(y) OVER (w ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS alarms_in_last_24h,
        COALESCE(lag(y, 1) OVER w, 0) AS s, entity_id, hour, value_avg, n_events
      FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
g AS (SELECT *, sum(s) OVER (PARTITION BY entity_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp FROM f),
h AS (SELECT *, CAST(row_number() OVER (PARTITION BY entity_id, grp ORDER BY hour) - 1 AS DOUBLE) AS hours_since_last FROM g)""")
    + " " + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr(y, {c}), 6) AS corr FROM h" for c in CORR_FEATURES))
def corr_vector(spark, sf):
    x = lag_feature_block(D.hourly_panel(spark, sf))
    wide = x.agg(*[G.safe_corr("y", c).alias(c) for c in CORR_FEATURES])
    long = wide.unpivot([], CORR_FEATURES, "feature", "corr")
    return long.select("feature", D.r6("corr").alias("corr"))


@query("entity_corr", covers="A18", sql=with_(PANEL, """
wide AS (SELECT hour, """ + ", ".join(f"max(y) FILTER (WHERE entity_id = {e}) AS e{e}" for e in range(24)) + """
         FROM panel GROUP BY hour)""") + " " + " UNION ALL ".join(
    f"SELECT 'e{a}' AS a, 'e{b}' AS b, round(corr(e{a}, e{b}), 6) AS corr FROM wide"
    for a in range(24) for b in range(a, 24)))
def entity_corr(spark, sf):
    p = D.hourly_panel(spark, sf).select("hour", "entity_id", "y")
    ents = list(range(D.N_ENTITIES))
    wide = G.pivot_wide(p, ["hour"], "entity_id", ents, F.max("y"), prefix="e")
    c = G.corr_matrix_vector(wide, [f"e{e}" for e in ents])
    return c.select("a", "b", D.r6(F.when(F.isnan("corr"), None).otherwise(F.col("corr"))).alias("corr"))


MAX_XLAG = 48


@query("lagged_crosscorr", covers="A19", sql=with_(PANEL, """
l AS (SELECT y, value_avg, """ + ", ".join(f"lag(value_avg, {k}) OVER w AS l{k}" for k in range(1, MAX_XLAG + 1)) + """
      FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour))""") + " " + " UNION ALL ".join(
    [f"SELECT 0 AS lag, round(corr(y, value_avg), 6) AS corr FROM l"] +
    [f"SELECT {k}, round(corr(y, l{k}), 6) FROM l" for k in range(1, MAX_XLAG + 1)]))
def lagged_crosscorr(spark, sf):
    c = lagged_corr_raw(spark, sf)
    return c.select("lag", D.r6("corr").alias("corr"))


def lagged_corr_raw(spark, sf):
    """corr(y, lag_k(value_avg)) for k = 0..MAX_XLAG: one window pass, then one narrow aggregate by lag that is
    combined map-side (a row per lag leaves each task)."""

    def feats(w):
        return [F.lag("value_avg", k).over(w).alias(f"l{k}") for k in range(1, MAX_XLAG + 1)]

    x = W.apply_windowed(D.hourly_panel(spark, sf), feats, lead_in=MAX_XLAG, bucket_rows=D.bucket_rows(spark))
    lagged = F.array("value_avg", *[F.col(f"l{k}") for k in range(1, MAX_XLAG + 1)])
    long = x.select("y", F.posexplode(lagged).alias("lag", "x"))
    return long.groupBy("lag").agg(G.safe_corr("y", "x").alias("corr"))


PROFILE_COLS = ["disc", "tax", "l_quantity", "l_extendedprice"]


@query("profile_nulls", covers="A20", sql=with_("""x AS (
  SELECT CASE WHEN l_discount > 0.08 THEN NULL ELSE l_discount END AS disc,
         CASE WHEN l_tax < 0.01 OR l_tax > 0.07 THEN NULL ELSE l_tax END AS tax, l_quantity, l_extendedprice
  FROM lineitem)""") + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS n_null, round(min({c}), 6) AS min, "
    f"round(max({c}), 6) AS max, round(avg({c}), 6) AS mean FROM x" for c in PROFILE_COLS))
def profile_nulls(spark, sf):
    li = lineitem(spark, sf, ["l_discount", "l_tax", "l_quantity", "l_extendedprice"]).select(
        G.null_outside("l_discount", hi=0.08).alias("disc"), G.null_outside("l_tax", lo=0.01, hi=0.07).alias("tax"),
        "l_quantity", "l_extendedprice")
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in PROFILE_COLS:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__n_null"), F.min(c).alias(f"{c}__min"),
                 F.max(c).alias(f"{c}__max"), F.avg(c).alias(f"{c}__mean")]
    one = li.agg(*aggs)
    stacked = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("n"),
                                                     F.col(f"{c}__n_null").alias("n_null"),
                                                     D.r6(f"{c}__min").alias("min"), D.r6(f"{c}__max").alias("max"),
                                                     D.r6(f"{c}__mean").alias("mean")) for c in PROFILE_COLS])))
    return stacked


@query("dup_share", covers="A21 U8", sql=with_(EV, """
f AS (SELECT event_type, event_id <> min(event_id) OVER (PARTITION BY user_id, hour) AS dup FROM ev)""") + """
SELECT event_type, round(avg(CASE WHEN dup THEN 1.0 ELSE 0.0 END) * 100, 6) AS dup_pct FROM f GROUP BY event_type""")
def dup_share(spark, sf):
    ev = D.entity_events(spark, sf).select("event_id", "user_id", "hour", "event_type")
    first = ev.groupBy("user_id", "hour").agg(F.min("event_id").alias("_first"))
    f = ev.join(first, ["user_id", "hour"]).withColumn("dup", F.col("event_id") != F.col("_first"))
    return f.groupBy("event_type").agg(D.r6(G.share_percent(F.col("dup"))).alias("dup_pct"))


@query("peak_period", covers="A22", sql="""
SELECT CAST(m AS TIMESTAMP) AS peak_month, n FROM (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n
  FROM lineitem GROUP BY 1) ORDER BY n DESC, m LIMIT 1""")
def peak_period(spark, sf):
    m = lineitem(spark, sf, ["l_shipdate"]).groupBy(C.floor_month("l_shipdate").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    best = m.agg(F.max_by(F.struct("m", "n"), F.struct(F.col("n"), F.negative(F.unix_date("m")))).alias("b"))
    return best.select(F.col("b.m").cast("timestamp_ntz").alias("peak_month"), F.col("b.n").alias("n"))


@query("share_of_total", covers="A8", sql="""
SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct,
       count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type""")
def share_of_total(spark, sf):
    c = D.events(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("n_users"))
    tot = c.agg(F.sum("n").alias("_t"))
    return c.crossJoin(F.broadcast(tot)).select("event_type", "n", D.r6(F.col("n") * 100.0 / F.col("_t")).alias("share_pct"),
                                                "n_users")


KDE_POINTS = [float(p) for p in range(0, 151, 5)]


@query("kde_1d", covers="A24", sql=with_(PANEL, """
f AS (SELECT entity_id, hour, y, COALESCE(lag(y, 1) OVER w, 0) AS s FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
g AS (SELECT *, sum(s) OVER (PARTITION BY entity_id ORDER BY hour ROWS UNBOUNDED PRECEDING) AS grp FROM f),
h AS (SELECT y, least(CAST(row_number() OVER (PARTITION BY entity_id, grp ORDER BY hour) - 1 AS DOUBLE), 150) AS v FROM g),
st AS (SELECT y, count(v) AS n, stddev_samp(v) * pow(count(v), -0.2) AS bw FROM h GROUP BY y),
pts AS (SELECT CAST(unnest(range(0, 151, 5)) AS DOUBLE) AS point)""") + """
SELECT h.y, pts.point, round(sum(exp(-0.5 * pow((h.v - pts.point) / st.bw, 2))) / (st.n * st.bw * sqrt(2 * pi())), 9) AS density
FROM h JOIN st USING (y) CROSS JOIN pts GROUP BY h.y, pts.point, st.n, st.bw""")
def kde_1d(spark, sf):
    x = lag_feature_block(D.hourly_panel(spark, sf)).select("y", F.least("hours_since_last", F.lit(150.0)).alias("v"))
    k = G.kde_by_class(x, "v", "y", KDE_POINTS)
    return k.select("y", "point", F.round("density", 9).alias("density"))


@query("vector_stats_entropy", covers="F15 F16", sql=with_(TOPICS, """
a AS (SELECT vec_id, list_transform(vec, lambda x: abs(x)) AS av FROM topics),
s AS (SELECT vec_id, av, list_sum(av) AS tot FROM a)""") + """
SELECT vec_id, round(tot, 6) AS abs_sum, round(list_max(av), 6) AS abs_max, round(list_avg(av), 6) AS abs_mean,
  round(list_aggregate(av, 'stddev_samp'), 6) AS abs_std,
  round(CASE WHEN tot > 0 THEN -list_sum(list_transform(av, lambda x: (x / tot) * ln(x / tot + 1e-9))) ELSE 0 END, 6) AS entropy
FROM s""")
def vector_stats_entropy(spark, sf):
    t = D.topic_vectors(spark, sf)
    return t.select("vec_id", D.r6(V.abs_sum("vec")).alias("abs_sum"), D.r6(V.abs_max("vec")).alias("abs_max"),
                    D.r6(V.abs_mean("vec")).alias("abs_mean"), D.r6(V.abs_std("vec")).alias("abs_std"),
                    D.r6(V.abs_entropy("vec")).alias("entropy"))


@query("vector_mean_by_hour", covers="A3", sql=with_(TOPICS) + """
SELECT hour, CAST(i AS INTEGER) AS dim, round(avg(v), 6) AS value
FROM (SELECT hour, unnest(vec) AS v, unnest(range(len(vec))) AS i FROM topics) GROUP BY hour, i""")
def vector_mean_by_hour(spark, sf):
    m = V.vector_mean_by_key(D.topic_vectors(spark, sf), ["hour"], "vec")
    return m.select("hour", F.posexplode("vec").alias("dim", "value")).select("hour", "dim", D.r6("value").alias("value"))


@query("moon_phase", covers="F11", sql="""
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day,
  round(fmod((epoch(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR) - epoch(TIMESTAMP '2000-01-06 18:14:00'))
        / 86400.0, 29.53058867) / 29.53058867, 2) AS phase
FROM orders""")
def moon_phase(spark, sf):
    d = read_table(spark, sf, "orders", ["o_orderdate"]).select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(F.col("d").cast("timestamp_ntz").alias("day"), K.moon_phase(F.col("d")).alias("phase"))


@query("text_lengths", covers="F17", sql="""
SELECT doc_id, length(text) AS n_chars, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n_words,
  right(text, 5) AS last5, starts_with(lower(text), 'the') AS starts_the, lower(split_part(trim(text), ' ', 1)) AS first_word,
  replace(source, 'src', 'source-') AS source_name
FROM documents""")
def text_lengths(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text", "source"])
    words = F.filter(F.split("text", r"\s+"), lambda x: x != "")
    return d.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.size(words).cast("long").alias("n_words"),
                    F.right("text", F.lit(5)).alias("last5"), F.startswith(F.lower("text"), F.lit("the")).alias("starts_the"),
                    F.lower(F.split_part(F.trim("text"), F.lit(" "), F.lit(1))).alias("first_word"),
                    F.replace("source", F.lit("src"), F.lit("source-")).alias("source_name"))
