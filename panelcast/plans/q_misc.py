"""Relational joins, scans and scalar-function queries (J2-J5, J7, J17, J18, S9-S12, F1-F14, F21, P3-P7, P16,
U1/U2, O5, O7)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.functions import calendar as C
from panelcast.functions import strings as Sx
from panelcast.operators.clean import none_string_to_null
from panelcast.plans import driver as D
from panelcast.plans.q_analytics import MAX_XLAG, lagged_corr_raw
from panelcast.plans.q_events import topic_hourly
from panelcast.plans.q_panel import CELLS_SQL, observed_cells
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, PANEL, REPORTS, TOPICS, with_
from panelcast.sources import tables as Tb
from panelcast.sources.tables import read_table


@query("panel_source_join", covers="J2 J3 J4 A4", sql=with_(PANEL, REPORTS, TOPICS, """
th AS (SELECT hour, avg(list_sum(list_transform(vec, lambda x: abs(x)))) AS topic_intensity FROM topics GROUP BY hour),
sig AS (SELECT entity_id, hour, count(*) FILTER (WHERE event_type = 'click') AS n_click,
               count(*) FILTER (WHERE event_type = 'view') AS n_view FROM ev GROUP BY 1, 2)""") + """
SELECT p.entity_id, p.hour, p.y, COALESCE(r.n_chars, 0) AS report_chars, round(COALESCE(th.topic_intensity, 0), 6) AS topic_intensity,
       COALESCE(sig.n_click, 0) AS n_click, COALESCE(sig.n_view, 0) AS n_view
FROM panel p LEFT JOIN reports r ON r.day = CAST(p.hour AS DATE) LEFT JOIN th ON th.hour = p.hour
LEFT JOIN sig ON sig.entity_id = p.entity_id AND sig.hour = p.hour""")
def panel_source_join(spark, sf):
    p = D.hourly_panel(spark, sf).select("entity_id", "hour", "y", F.to_date("hour").alias("day"))
    rep = D.daily_reports(spark, sf).select("day", F.col("n_chars").alias("report_chars"))          # J2: many-to-one on day
    th = (D.topic_vectors(spark, sf)
          .groupBy("hour").agg(F.avg(F.aggregate("vec", F.lit(0.0), lambda a, x: a + F.abs(x))).alias("topic_intensity")))
    ev = D.entity_events(spark, sf)
    sig = ev.groupBy("entity_id", "hour").agg(F.count_if(F.col("event_type") == "click").alias("n_click"),
                                              F.count_if(F.col("event_type") == "view").alias("n_view"))
    x = (p.join(rep, "day", "left").join(th, "hour", "left")                                          # J3: hour only
          .join(sig, ["entity_id", "hour"], "left"))                                                  # J4: entity-hour
    return x.select("entity_id", "hour", "y", F.coalesce("report_chars", F.lit(0).cast("long")).alias("report_chars"),
                    D.r6(F.coalesce("topic_intensity", F.lit(0.0))).alias("topic_intensity"),
                    F.coalesce("n_click", F.lit(0).cast("long")).alias("n_click"),
                    F.coalesce("n_view", F.lit(0).cast("long")).alias("n_view"))


@query("daily_inner_chain", covers="J5 A5 A6", sql="""
WITH li AS (SELECT CAST(l_shipdate AS DATE) AS d, l_quantity, l_discount, l_returnflag FROM lineitem),
a AS (SELECT d, max(l_quantity) AS qmax, min(l_quantity) AS qmin FROM li GROUP BY d),
b AS (SELECT d, avg(CASE WHEN l_discount > 0 THEN 1.0 ELSE 0.0 END) * 100 AS disc_cover FROM li GROUP BY d),
c AS (SELECT d, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM li GROUP BY d)
SELECT CAST(a.d AS TIMESTAMP) AS day, a.qmax, a.qmin, round(b.disc_cover, 6) AS disc_cover, c.n_returned
FROM a JOIN b ON a.d = b.d JOIN c ON c.d = a.d""")
def daily_inner_chain(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_shipdate", "l_quantity", "l_discount", "l_returnflag"]).withColumn(
        "d", F.to_date("l_shipdate"))
    a = li.groupBy("d").agg(F.max("l_quantity").alias("qmax"), F.min("l_quantity").alias("qmin"))
    b = li.groupBy("d").agg((F.avg(F.when(F.col("l_discount") > 0, 1.0).otherwise(0.0)) * 100).alias("disc_cover"))
    c = li.groupBy("d").agg(F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    x = a.join(b, "d").join(c, "d")
    return x.select(F.col("d").cast("timestamp_ntz").alias("day"), "qmax", "qmin", D.r6("disc_cover").alias("disc_cover"),
                    "n_returned")


@query("map_lookup_join", covers="J7", sql="""
SELECT c.c_custkey, n.n_name, r.r_name FROM customer c
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def map_lookup_join(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"])
    n = read_table(spark, sf, "nation")       # dimension: bounded (one row per nation)
    r = read_table(spark, sf, "region")       # dimension: bounded (one row per region)
    x = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left").join(
        F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
    return x.select("c_custkey", "n_name", "r_name")


@query("id_mismatch", covers="J17 Q4", sql="""
WITH a AS (SELECT s.s_name AS name_key, s.s_nationkey AS id_a FROM supplier s),
b AS (SELECT 'Supplier#' || lpad(CAST(c.c_custkey AS VARCHAR), 9, '0') AS name_key, c.c_nationkey AS id_b FROM customer c)
SELECT a.name_key, a.id_a, b.id_b FROM a JOIN b USING (name_key) WHERE a.id_a <> b.id_b""")
def id_mismatch(spark, sf):
    s = read_table(spark, sf, "supplier", ["s_name", "s_nationkey"]).select(
        F.col("s_name").alias("name_key"), F.col("s_nationkey").alias("id_a"))
    c = read_table(spark, sf, "customer", ["c_custkey", "c_nationkey"]).select(
        F.concat(F.lit("Supplier#"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("name_key"),
        F.col("c_nationkey").alias("id_b"))
    return s.join(c, "name_key").filter(F.col("id_a") != F.col("id_b"))


ALIAS_FROM, ALIAS_TO = 0, 24


@query("entity_alias_rows", covers="J18 U1", sql=with_(EV, CELLS_SQL) + """
SELECT entity_id, hour, n_events FROM cells UNION ALL SELECT 24, hour, n_events FROM cells WHERE entity_id = 0""")
def entity_alias_rows(spark, sf):
    cells = observed_cells(spark, sf).select("entity_id", "hour", "n_events")
    alias = cells.filter(F.col("entity_id") == ALIAS_FROM).withColumn("entity_id", F.lit(ALIAS_TO).cast("int"))
    return cells.unionByName(alias)


@query("union_distinct", covers="U1 U2 O1", sql=with_(EV) + """
SELECT DISTINCT entity_id, hour FROM (SELECT entity_id, hour FROM ev WHERE event_type = 'error'
  UNION ALL SELECT entity_id, hour FROM ev WHERE event_type = 'purchase')""")
def union_distinct(spark, sf):
    ev = D.entity_events(spark, sf)
    a = ev.filter(F.col("event_type") == "error").select("entity_id", "hour")
    b = ev.filter(F.col("event_type") == "purchase").select("entity_id", "hour")
    return a.unionByName(b).distinct().sortWithinPartitions("hour", "entity_id")


FIRST_N_FROM = "2024-01-10 00:00:00"


@query("first_n_per_entity", covers="O7", sql=with_(EV, CELLS_SQL) + """
SELECT entity_id, hour, n_events FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY hour) AS rn FROM cells
  WHERE hour >= TIMESTAMP '2024-01-10 00:00:00') WHERE rn <= 24""")
def first_n_per_entity(spark, sf):
    cells = observed_cells(spark, sf).filter(F.col("hour") >= F.lit(FIRST_N_FROM).cast("timestamp_ntz"))
    # row_number <= k is planned as a window-group limit: each task keeps k rows per entity before the exchange
    rn = F.row_number().over(Window.partitionBy("entity_id").orderBy("hour"))
    return cells.withColumn("rn", rn).filter(F.col("rn") <= 24).select("entity_id", "hour", "n_events")


@query("top_features", covers="O5", sql=with_(PANEL, """
l AS (SELECT y, value_avg, """ + ", ".join(f"lag(value_avg, {k}) OVER w AS l{k}" for k in range(1, MAX_XLAG + 1)) + """
      FROM panel WINDOW w AS (PARTITION BY entity_id ORDER BY hour)),
c AS (""" + " UNION ALL ".join([f"SELECT 0 AS lag, abs(corr(y, value_avg)) AS imp FROM l"] +
                               [f"SELECT {k}, abs(corr(y, l{k})) FROM l" for k in range(1, MAX_XLAG + 1)]) + """)""") + """
SELECT lag, round(imp, 6) AS importance, round(imp * 100 / (SELECT sum(imp) FROM c), 6) AS share_pct
FROM c ORDER BY imp DESC, lag LIMIT 20""")
def top_features(spark, sf):
    c = lagged_corr_raw(spark, sf).select("lag", F.abs("corr").alias("imp"))
    # 49 rows: the driver-side order is over an aggregate, not data
    tot = c.agg(F.sum("imp").alias("_t"))
    top = c.crossJoin(F.broadcast(tot)).orderBy(F.desc("imp"), "lag").limit(20)
    return top.select("lag", D.r6("imp").alias("importance"), D.r6(F.col("imp") * 100 / F.col("_t")).alias("share_pct"))


@query("range_and_tail_scan", covers="S9 S10 S11 S12 W17", sql="""
WITH mx AS (SELECT max(ts) AS m FROM events)
SELECT e.event_id, e.ts, e.value, mx.m AS max_ts FROM events e, mx
WHERE e.ts > mx.m - INTERVAL 168 HOUR AND e.ts BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-12-31 23:00:00'
  AND e.event_id IS NOT NULL""")
def range_and_tail_scan(spark, sf):
    ev = Tb.read_table(spark, sf, "events", ["event_id", "ts", "value"])
    rng = Tb.read_range(ev, "ts", "2024-01-01 00:00:00", "2024-12-31 23:00:00", key_cols=["event_id"])
    tail = Tb.read_tail(rng, "ts", 168, strict=True)
    mx = Tb.max_key_at(spark, Tb.table_path(sf, "events"), "ts")
    return tail.crossJoin(F.broadcast(mx)).select("event_id", "ts", "value", F.col("max_ts").alias("max_ts"))


@query("date_scalars", covers="F1 F2 F3 F4 F5 F6 F8 F9", sql="""
WITH mx AS (SELECT max(ts) AS m FROM events)
SELECT event_id, TRY_CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS parsed,
  TRY_CAST(strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M:%S') AS TIMESTAMP) AS joined,
  TRY_CAST('not a date ' || event_id AS TIMESTAMP) AS bad_parse,
  CAST(timezone('Europe/Kyiv', timezone('UTC', ts)) AS TIMESTAMP) AS local_ts,
  CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  CAST(hour(ts) AS INTEGER) AS hour,
  dayname(ts) AS day_name, strftime(ts, '%Y-%m-%d %H:00') AS hour_label,
  date_trunc('hour', ts) AS hour_floor, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_floor, ts + INTERVAL 3 HOUR AS plus3h,
  CAST(date_diff('hour', date_trunc('hour', ts), date_trunc('hour', mx.m)) AS BIGINT) AS hours_to_last,
  CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start, CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start,
  date_trunc('hour', mx.m) - INTERVAL 1 HOUR AS last_completed_hour,
  CAST(isodow(ts) - 1 IN (5, 6) AS INTEGER) AS is_weekend
FROM events, mx""")
def date_scalars(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "ts"])
    mx = ev.agg(F.max("ts").alias("_m"))
    x = ev.crossJoin(F.broadcast(mx))
    return x.select(
        "event_id",
        C.parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
        C.date_and_time(F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")).alias("joined"),
        C.parse_ts(F.concat(F.lit("not a date "), F.col("event_id").cast("string"))).alias("bad_parse"),
        C.utc_to_local("ts").alias("local_ts"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), C.weekday_mon0("ts").alias("weekday"),
        F.hour("ts").alias("hour"), F.date_format("ts", "EEEE").alias("day_name"),
        F.date_format("ts", "yyyy-MM-dd HH:00").alias("hour_label"),
        C.floor_hour("ts").alias("hour_floor"), C.floor_day("ts").cast("timestamp_ntz").alias("day_floor"),
        C.add_hours("ts", 3).alias("plus3h"),
        C.hours_between(C.floor_hour("_m"), C.floor_hour("ts")).alias("hours_to_last"),
        C.floor_month("ts").cast("timestamp_ntz").alias("month_start"),
        C.floor_week("ts").cast("timestamp_ntz").alias("week_start"),
        C.last_completed_hour("_m").alias("last_completed_hour"),
        C.is_weekend("ts").alias("is_weekend"))


@query("numeric_scalars", covers="F10 F12 F13 F14", sql="""
SELECT l_orderkey, l_linenumber, round(l_extendedprice * 0.0036, 6) AS mj,
  round(least(greatest(l_discount, 0.02), 0.08), 6) AS disc_clip, abs(l_quantity - 25) AS qty_dev,
  round(pow(0.5, l_quantity / 6.0), 6) AS decay, round(ln(l_extendedprice), 6) AS log_price,
  round(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END, 6) AS tax_per_disc,
  CAST(date_diff('second', l_shipdate, l_shipdate + INTERVAL 90 MINUTE) / 60 AS DOUBLE) AS minutes90
FROM lineitem""")
def numeric_scalars(spark, sf):
    li = read_table(spark, sf, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
                                            "l_quantity", "l_shipdate"])
    from panelcast.functions.codes import WM2_TO_MJ
    ratio = F.try_divide(F.col("l_tax"), F.col("l_discount"))
    ratio = F.when(F.isnan(ratio) | ratio.isin(float("inf"), float("-inf")), None).otherwise(ratio)
    return li.select(
        "l_orderkey", "l_linenumber", D.r6(F.col("l_extendedprice") * F.lit(WM2_TO_MJ)).alias("mj"),
        D.r6(F.least(F.greatest("l_discount", F.lit(0.02)), F.lit(0.08))).alias("disc_clip"),
        F.abs(F.col("l_quantity") - 25).alias("qty_dev"),
        D.r6(F.pow(F.lit(0.5), F.col("l_quantity") / 6.0)).alias("decay"),
        D.r6(F.ln("l_extendedprice")).alias("log_price"),
        D.r6(F.when(F.col("l_discount") == 0, None).otherwise(ratio)).alias("tax_per_disc"),
        (C.ts_diff("SECOND", "l_shipdate", C.add_hours("l_shipdate", 0) + F.expr("INTERVAL 90 MINUTES")) / 60)
        .cast("double").alias("minutes90"))


@query("text_scrub", covers="F21 T2", sql="""
SELECT doc_id, md5(s) AS clean_md5, length(s) AS clean_len FROM (
  SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text),
      'https?://[^ \\t\\n\\r]+', ' ', 'g'), '[a-z0-9._%+-]+@[a-z0-9.-]+', ' ', 'g'), '@[a-z0-9_]+', ' ', 'g'),
      '[0-9!-/:-@\\[-`{-~]+', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS s
  FROM documents)""")
def text_scrub(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    s = Sx.scrub(F.col("text"))
    return d.select("doc_id", F.md5(s).alias("clean_md5"), F.length(s).cast("long").alias("clean_len"))


@query("null_and_range_filters", covers="P3 P5 P6 P7 Q5", sql=with_(EV, """
iv AS (SELECT ts AS start, ts + to_microseconds(CAST(round((value - 60) * 60 * 1000000) AS BIGINT)) AS e FROM ev WHERE event_type = 'error')""") + """
SELECT 'negative_duration' AS probe, (SELECT count(*) FROM iv WHERE e < start) AS n
UNION ALL SELECT 'unparsable_source_id', (SELECT count(*) FROM documents
   WHERE TRY_CAST(regexp_extract(source, '[0-9]$') AS INTEGER) IS NULL OR source LIKE '%7')
UNION ALL SELECT 'none_or_blank_text', (SELECT count(*) FROM documents WHERE text IS NULL OR trim(text) IN ('None', ''))
UNION ALL SELECT 'discount_outlier', (SELECT count(*) FROM lineitem WHERE l_discount > 0.09 OR l_quantity > 49)
UNION ALL SELECT 'tax_above_discount', (SELECT count(*) FROM lineitem WHERE l_tax > l_discount)
UNION ALL SELECT 'kept_after_key_filter', (SELECT count(*) FROM documents
   WHERE NOT (TRY_CAST(regexp_extract(source, '[0-9]$') AS INTEGER) IS NULL OR source LIKE '%7') AND NOT (text IS NULL OR trim(text) IN ('None', '')))""")
def null_and_range_filters(spark, sf):
    # reported ends lie an hour early: some durations are negative; ids of sources ending in 7 are spoilt
    iv = D.error_intervals(spark, sf).withColumn("end", F.col("end") - F.expr("INTERVAL 1 HOUR"))
    docs = read_table(spark, sf, "documents", ["source", "text"])
    li = read_table(spark, sf, "lineitem", ["l_discount", "l_quantity", "l_tax"])
    key = F.regexp_extract(F.regexp_replace("source", "7$", "x"), r"[0-9]$", 0).try_cast("int")
    txt = none_string_to_null("text")
    a = iv.agg(F.count_if(F.col("end") < F.col("start")).alias("negative_duration"))
    b = docs.agg(F.count_if(key.isNull()).alias("unparsable_source_id"),
                 F.count_if(txt.isNull()).alias("none_or_blank_text"),
                 F.count_if(key.isNotNull() & txt.isNotNull()).alias("kept_after_key_filter"))
    c = li.agg(F.count_if((F.col("l_discount") > 0.09) | (F.col("l_quantity") > 49)).alias("discount_outlier"),
               F.count_if(F.col("l_tax") > F.col("l_discount")).alias("tax_above_discount"))
    one = a.crossJoin(b).crossJoin(c)
    names = ["negative_duration", "unparsable_source_id", "none_or_blank_text", "discount_outlier", "tax_above_discount",
             "kept_after_key_filter"]
    return one.unpivot([], names, "probe", "n")


SAMPLE_ROWS = 1000


@query("hash_sample", covers="P16", sql=f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('42-' || o_orderkey), o_orderkey LIMIT {SAMPLE_ROWS}""")
def hash_sample(spark, sf):
    """A sample of n rows (the feature), by the digest of seed and key: the same rows in every run."""
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_totalprice"])
    return o.orderBy(F.md5(F.concat(F.lit("42-"), F.col("o_orderkey").cast("string"))), "o_orderkey").limit(SAMPLE_ROWS)
