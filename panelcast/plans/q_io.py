"""I/O queries (S1-S8, S13-S17) and page extraction (T1, F20, Q6): each writes the landed tables in
the product's source formats under the shared scratch folder and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.calendar import floor_hour
from panelcast.plans import driver as D
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import EV, PANEL, with_
from panelcast.session import scratch_path
from panelcast.sources import files as Fi
from panelcast.sources.tables import read_table

EVENT_CSV_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                                 T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                                 T.StructField("value", T.DoubleType())])
PRUNE_FROM, PRUNE_TO = "2024-01-10", "2024-01-12"


@query("io_roundtrip", covers="S1 S2 S3 S4 S5 S13 S14 S15 S16", sql=with_(EV, """
d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM ev GROUP BY 1)""") + """
SELECT CAST(day AS TIMESTAMP) AS day, n AS n_json, n AS n_csv, n AS n_parquet,
       CASE WHEN day BETWEEN DATE '2024-01-09' AND DATE '2024-01-13' THEN n END AS n_pruned,
       day = (SELECT max(day) FROM d) AS is_latest, 5 AS n_columns
FROM d""")
def io_roundtrip(spark, sf):
    base = scratch_path(spark, f"io/{uuid.uuid4().hex[:12]}")
    ev = D.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    snap = ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    Fi.write_partitioned_json(snap, f"{base}/json", ["day"])                    # S16
    Fi.write_csv(ev, f"{base}/csv", sep=";", encoding="cp1251")                 # S15 + S1 formats
    Fi.write_versioned(ev, f"{base}/parquet", "0001")                          # S14
    js = Fi.read_json_records(spark, f"{base}/json", EVENT_CSV_SCHEMA)          # S2/S3
    js = js.withColumn("day", Fi.path_date("file_path"))
    csv = Fi.read_csv(spark, f"{base}/csv", EVENT_CSV_SCHEMA, sep=";", encoding="cp1251")
    pq = Fi.read_versioned(spark, f"{base}/parquet")
    n_cols = len(pq.schema.fields)                                              # S13 schema probe
    a = js.groupBy("day").agg(F.count(F.lit(1)).alias("n_json"))
    b = csv.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_csv"))
    c = pq.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n_parquet"))
    pr = Fi.prune_by_path_date(js, PRUNE_FROM, PRUNE_TO).groupBy("day").agg(F.count(F.lit(1)).alias("n_pruned"))  # S4
    latest = Fi.latest_file_rows(js).select("day").distinct().withColumn("is_latest", F.lit(True))              # S5
    x = a.join(b, "day", "full").join(c, "day", "full").join(pr, "day", "left").join(latest, "day", "left")
    return x.select(F.col("day").cast("timestamp_ntz").alias("day"), "n_json", "n_csv", "n_parquet", "n_pruned",
                    F.coalesce("is_latest", F.lit(False)).alias("is_latest"), F.lit(n_cols).alias("n_columns"))


#: Records of one JSON array (about this many: parts are dealt by a hash)
ARRAY_ROWS = 20_000


@query("json_arrays_by_day_hour", covers="S2 S16", sql=with_(EV) + """
SELECT CAST(CAST(hour AS DATE) AS TIMESTAMP) AS day, CAST(hour(hour) AS INTEGER) AS hour, count(*) AS n, max(event_id) AS last_event
FROM ev GROUP BY 1, 2""")
def json_arrays_by_day_hour(spark, sf):
    """Files in a (day, hour) folder that hold a JSON array of records each, read back as rows.  An hour with more
    than ``ARRAY_ROWS`` records has several files, by a hash of the id, so that no array grows with the hour."""
    base = scratch_path(spark, f"arrays/{uuid.uuid4().hex[:12]}")
    ev = D.events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    ev = ev.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).withColumn("hour", F.hour("ts"))
    sizes = ev.groupBy("day", "hour").agg(F.ceil(F.count(F.lit(1)) / ARRAY_ROWS).alias("parts"))  # a row per hour
    rec = F.struct("event_id", "ts", "user_id", "event_type", "value")
    part = F.pmod(F.xxhash64("event_id"), F.col("parts")).alias("part")
    files = ev.join(sizes, ["day", "hour"]).groupBy("day", "hour", part).agg(F.to_json(F.collect_list(rec)).alias("value"))
    files.write.partitionBy("day", "hour", "part").text(base)
    back = Fi.read_json_records(spark, base, EVENT_CSV_SCHEMA, multiline=True)
    hour = F.regexp_extract("file_path", r"/hour=(\d+)/", 1).cast("int")
    return back.groupBy(Fi.path_date("file_path").cast("timestamp_ntz").alias("day"), hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event"))


WEATHER_SNAPSHOT = T.StructType([
    T.StructField("date", T.StringType()), T.StructField("hour", T.StringType()),
    T.StructField("regions", T.ArrayType(T.StructType([
        T.StructField("region_id", T.IntegerType()), T.StructField("region", T.StringType()),
        T.StructField("weather", T.StructType([T.StructField("region_id", T.IntegerType()),
                                               T.StructField("hour_value_avg", T.DoubleType()),
                                               T.StructField("hour_value_max", T.DoubleType()),
                                               T.StructField("n_events", T.LongType())]))])))])


@query("json_snapshot_flatten", covers="S6 S7", sql=with_(PANEL) + """
SELECT entity_id, hour, round(value_avg, 6) AS hour_value_avg, round(value_max, 6) AS hour_value_max, n_events,
       n_events AS forecast_n_events FROM panel""")
def json_snapshot_flatten(spark, sf):
    """Nested per-hour snapshots {date, hour, regions:[{region_id, region, weather:{..}}]} and a
    map-of-arrays forecast {entity: [rows]} are written from the panel and flattened back."""
    base = scratch_path(spark, f"snap/{uuid.uuid4().hex[:12]}")
    p = D.hourly_panel(spark, sf)
    # weather: the nested region record omits its own id on odd entities -> filled from the parent
    w = F.struct(F.when(F.col("entity_id") % 2 == 0, F.col("entity_id")).alias("region_id"),
                 F.col("value_avg").alias("hour_value_avg"), F.col("value_max").alias("hour_value_max"), "n_events")
    rec = F.struct(F.col("entity_id").alias("region_id"), F.concat(F.lit("region-"), F.col("entity_id")).alias("region"),
                   w.alias("weather"))
    snaps = p.groupBy("hour").agg(F.collect_list(rec).alias("regions"))                  # bounded: entities per hour
    snaps = snaps.select(F.date_format("hour", "yyyy-MM-dd").alias("date"), F.date_format("hour", "HH:mm").alias("hour"),
                         "regions", F.date_format("hour", "yyyy-MM-dd").alias("day"))
    snaps.write.mode("overwrite").partitionBy("day").json(f"{base}/weather")
    back = spark.read.schema(WEATHER_SNAPSHOT).json(f"{base}/weather")
    flat = (back.select(F.to_timestamp(F.concat_ws(" ", "date", "hour"), "yyyy-MM-dd HH:mm").cast("timestamp_ntz").alias("hour"),
                        F.explode("regions").alias("r"))
            .select("hour", F.coalesce("r.weather.region_id", "r.region_id").alias("entity_id"), "r.weather.*")
            .drop("region_id"))
    # forecast map-of-arrays per day (S7): {entity_id: [{hour, n_events}]}
    fc = (p.withColumn("day", F.to_date("hour")).groupBy("day", "entity_id")
          .agg(F.collect_list(F.struct("hour", "n_events")).alias("rows"))                 # bounded: 24 per day
          .groupBy("day").agg(F.map_from_entries(F.collect_list(F.struct(F.col("entity_id").cast("string"), "rows")))
                              .alias("by_entity")))
    fc.write.mode("overwrite").json(f"{base}/forecast")
    fschema = T.StructType([T.StructField("day", T.DateType()), T.StructField("by_entity", T.MapType(
        T.StringType(), T.ArrayType(T.StructType([T.StructField("hour", T.TimestampNTZType()),
                                                  T.StructField("n_events", T.LongType())]))))])
    fb = (spark.read.schema(fschema).json(f"{base}/forecast").select(F.explode("by_entity").alias("k", "rows"))
          .select(F.col("k").cast("int").alias("entity_id"), F.explode("rows").alias("r"))
          .select("entity_id", "r.hour", F.col("r.n_events").alias("forecast_n_events")))
    out = flat.join(fb, ["entity_id", "hour"], "left")
    return out.select("entity_id", "hour", D.r6("hour_value_avg").alias("hour_value_avg"),
                      D.r6("hour_value_max").alias("hour_value_max"), "n_events", "forecast_n_events")


@query("columnar_arrays_to_rows", covers="S8", sql=with_(PANEL) + """
SELECT entity_id, hour, CASE WHEN hour(hour) = 23 THEN NULL ELSE round(value_avg, 6) END AS value_avg, n_events FROM panel""")
def columnar_arrays_to_rows(spark, sf):
    """API payloads with parallel arrays per (entity, day): ``time[]``, ``value[]`` (one element short),
    ``n[]`` — turned back into rows with posexplode + try_element_at (ragged -> NULL)."""
    base = scratch_path(spark, f"cols/{uuid.uuid4().hex[:12]}")
    p = D.hourly_panel(spark, sf).withColumn("day", F.to_date("hour"))
    srt = F.sort_array(F.collect_list(F.struct("hour", "value_avg", "n_events")))          # bounded: 24 per day
    pay = p.groupBy("entity_id", "day").agg(srt.alias("s")).select(
        "entity_id", F.struct(F.transform("s", lambda e: F.date_format(e["hour"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                              F.slice(F.transform("s", lambda e: e["value_avg"]), 1, 23).alias("value"),
                              F.transform("s", lambda e: e["n_events"]).alias("n")).alias("hourly"))
    pay.write.mode("overwrite").json(base)
    schema = T.StructType([T.StructField("entity_id", T.IntegerType()), T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())), T.StructField("value", T.ArrayType(T.DoubleType())),
        T.StructField("n", T.ArrayType(T.LongType()))]))])
    back = spark.read.schema(schema).json(base)
    rows = back.select("entity_id", "hourly", F.posexplode("hourly.time").alias("i", "time"))
    return rows.select("entity_id", F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm").cast("timestamp_ntz").alias("hour"),
                       D.r6(F.try_element_at("hourly.value", F.col("i") + 1)).alias("value_avg"),
                       F.try_element_at("hourly.n", F.col("i") + 1).alias("n_events"))


HTML_SQL_CLEAN = "regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g')"


def _unescape_sql(x):
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        x = f"replace({x}, '{ent}', '{ch}')"
    return x


def _strip_sql(x):
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("html_extract", covers="T1", sql=f"""
WITH c AS (SELECT page_id, {HTML_SQL_CLEAN} AS h FROM pages),
p AS (SELECT page_id, {_strip_sql(_unescape_sql("regexp_extract(h, '(?s)<title[^>]*>(.*?)</title>', 1)"))} AS title,
        CASE WHEN regexp_extract(h, '(?s)<article[^>]*>(.*?)</article>', 1) <> '' THEN regexp_extract(h, '(?s)<article[^>]*>(.*?)</article>', 1)
             WHEN regexp_extract(h, '(?s)<main[^>]*>(.*?)</main>', 1) <> '' THEN regexp_extract(h, '(?s)<main[^>]*>(.*?)</main>', 1)
             ELSE regexp_extract(h, '(?s)<body[^>]*>(.*?)</body>', 1) END AS cont FROM c),
b AS (SELECT page_id, title, list_filter(list_transform(regexp_extract_all(cont, '(?s)<p[^>]*>(.*?)</p>', 1),
        lambda x: {_strip_sql(_unescape_sql("x"))}), lambda x: length(x) >= 30) AS kept FROM p)
SELECT page_id, title, CASE WHEN length(array_to_string(kept, chr(10))) >= 500 THEN md5(array_to_string(kept, chr(10))) END AS text_md5,
       len(kept) AS n_blocks FROM b""")
def html_extract(spark, sf):
    pages = read_table(spark, sf, "pages", ["page_id", "html"])
    title, text, n = Fi.html_main_text(F.col("html"))
    return pages.select("page_id", title.alias("title"), F.md5(text).alias("text_md5"), n.cast("long").alias("n_blocks"))


def dated_pages(spark, sf):
    """Pages as a daily report site names them: the record's date, a title with the month spelt out (none on every
    seventh page) and a path with the date (a day off on every fifth, none on every ninth); every tenth URL twice."""
    p = read_table(spark, sf, "pages", ["page_id"])
    day = F.date_add(F.lit("2022-02-24").cast("date"), F.pmod("page_id", F.lit(400)).cast("int"))
    off = F.date_add(day, F.when(F.pmod("page_id", F.lit(5)) == 0, 1).otherwise(0))
    title = F.when(F.pmod("page_id", F.lit(7)) != 0, F.concat(F.lit("Campaign report, "), F.date_format(day, "MMMM d, yyyy"), F.lit(" - site")))
    number = F.when(F.pmod("page_id", F.lit(10)) == 0, F.lit(0)).otherwise(F.col("page_id")).cast("string")
    path = F.when(F.pmod("page_id", F.lit(9)) != 0, F.date_format(off, "yyyy-MM-dd")).otherwise(F.lit("undated"))
    return p.select("page_id", day.alias("record_date"), F.coalesce(title, F.lit("Campaign report")).alias("title"),
                    F.concat(F.lit("/reports/"), path, F.lit("/"), number).alias("url"))


DATED_SQL = """dp AS (SELECT page_id, DATE '2022-02-24' + CAST(page_id % 400 AS INTEGER) AS day FROM pages),
dt AS (SELECT page_id, CAST(day AS TIMESTAMP) AS record_date, CASE WHEN page_id % 7 <> 0 THEN CAST(day AS TIMESTAMP) END AS title_date,
  CASE WHEN page_id % 9 <> 0 THEN CAST(day + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END AS TIMESTAMP) END AS url_date,
  '/reports/' || CASE WHEN page_id % 9 <> 0 THEN strftime(day + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END, '%Y-%m-%d') ELSE 'undated' END
  || '/' || CASE WHEN page_id % 10 = 0 THEN 0 ELSE page_id END AS url FROM dp)"""


@query("title_date_parse", covers="F20 T1", sql=with_(DATED_SQL) + " SELECT page_id, title_date, url_date FROM dt")
def title_date_parse(spark, sf):
    d = dated_pages(spark, sf)
    return d.select("page_id", Fi.title_date(F.col("title")).cast("timestamp_ntz").alias("title_date"),
                    Fi.path_date(F.col("url")).cast("timestamp_ntz").alias("url_date"))


@query("url_date_agreement", covers="Q6 F20", sql=with_(DATED_SQL) + """
SELECT page_id, url, COALESCE(title_date = record_date, false) AS title_agrees, COALESCE(url_date = record_date, false) AS url_agrees,
       COALESCE(title_date = url_date, false) AS dates_agree, count(*) OVER (PARTITION BY url) AS url_copies FROM dt""")
def url_date_agreement(spark, sf):
    """Q6: do the record's date, the title's and the URL's agree, and how often does the URL occur."""
    d = dated_pages(spark, sf).select("page_id", "url", "record_date", Fi.title_date(F.col("title")).alias("t"), Fi.path_date(F.col("url")).alias("u"))
    copies = d.groupBy("url").agg(F.count(F.lit(1)).alias("url_copies"))
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return d.join(copies, "url").select("page_id", "url", same("t", "record_date").alias("title_agrees"),
                                        same("u", "record_date").alias("url_agrees"), same("t", "u").alias("dates_agree"), "url_copies")
