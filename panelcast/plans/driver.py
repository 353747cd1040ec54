"""Canonical realisation of the product's data model on the landed tables.

entity           pmod(user_id, 24)  — a fixed 24-entity dimension, like the product's regions
hour             date_trunc('hour', ts) as NTZ; ``t`` = whole hours since epoch
target y         1 if any ``error`` event falls in the (entity, hour)
hour measure     avg(value) / max(value) per (entity, hour)  ("hour-weather")
interval event   an error event: start = ts, end = ts + value minutes
daily report     documents, day = 2024-01-01 + 3 * (doc_id % 15): every third day has reports
topic vector     embeddings.embedding keyed vec_id -> hour index vec_id % 720
adjacency        e -> (e+1)%24, (e+23)%24, (e+5)%24

Each builder is lazy; every registered query composes these with the library operators.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.calendar import floor_hour, hour_index
from panelcast.session import materialize
from panelcast.sources.tables import read_table

# Fixed values of the data model
N_ENTITIES = 24
EVENT_TYPE_TARGET = "error"
REPORT_EPOCH = "2024-01-01"
REPORT_DAYS = 15
REPORT_DAY_STEP = 3
TOPIC_HOURS = 720
TOPIC_EPOCH = "2024-01-01 00:00:00"
NEIGHBOUR_OFFSETS = (1, 23, 5)

# Window features are evaluated per (entity, time bucket) with lead-in rows (see operators.windows).
# One week of hours per bucket at the test scale factors; on a cluster with long histories set
# ``panelcast.panel.bucketRows`` (e.g. 2160 = 90 days: lead-in overhead ~1%, still many tasks per entity).
PANEL_BUCKET_ROWS = 168
BUCKET_CONF = "panelcast.panel.bucketRows"


def bucket_rows(spark: SparkSession) -> int:
    """Bucket size for per-entity windows, read from the session (default PANEL_BUCKET_ROWS)."""
    return int(spark.conf.get(BUCKET_CONF, str(PANEL_BUCKET_ROWS)))


def entity_of(user_id: Column | str = "user_id") -> Column:
    c = F.col(user_id) if isinstance(user_id, str) else user_id
    return F.pmod(c, F.lit(N_ENTITIES)).cast("int")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def entities(spark: SparkSession) -> DataFrame:
    """The static entity dimension (bounded: N_ENTITIES rows)."""
    return spark.range(N_ENTITIES).select(F.col("id").cast("int").alias("entity_id"))


def conformed(ev: DataFrame) -> DataFrame:
    """Events with their entity and hour."""
    return ev.select(entity_of("user_id").alias("entity_id"), floor_hour("ts").alias("hour"),
                     "ts", "event_type", "value", "event_id", "user_id")


def entity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conformed(events(spark, sf_dir))


def dense_backbone(observed: DataFrame, ents: DataFrame, time_col: str = "hour") -> DataFrame:
    """Every (entity, hour) between the observed min and max hour.

    The bounds are a one-row scalar aggregate; each entity row generates its own calendar with
    ``sequence`` + ``explode`` (no pairwise join), so generation spreads over entity partitions.
    """
    bounds = observed.agg(F.min(time_col).alias("_lo"), F.max(time_col).alias("_hi"))
    return (ents.crossJoin(F.broadcast(bounds))
                .select("entity_id", F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 HOUR"))).alias(time_col)))


def hourly_cells(events_: DataFrame) -> DataFrame:
    """The observed (entity, hour) cells of ``events_``, written once.

    The events are scanned and aggregated (map-side first) one time; bounds, grid and every feature branch then read
    this table, which has a row per entity and hour.
    """
    cells = events_.groupBy("entity_id", "hour").agg(
        F.max(F.when(F.col("event_type") == EVENT_TYPE_TARGET, 1).otherwise(0)).alias("y"),
        F.count(F.lit(1)).alias("n_events"), F.avg("value").alias("value_avg"), F.max("value").alias("value_max"))
    return materialize(cells, "cells")


def densify(cells: DataFrame) -> DataFrame:
    """D1 from its cells: every (entity, hour) between the first and the last cell, missing cells = 0."""
    grid = dense_backbone(cells, entities(cells.sparkSession))
    return (grid.join(cells, ["entity_id", "hour"], "left")
                .select("entity_id", "hour", hour_index("hour").alias("t"),
                        F.coalesce("y", F.lit(0)).alias("y"),
                        F.coalesce("n_events", F.lit(0).cast("long")).alias("n_events"),
                        F.coalesce("value_avg", F.lit(0.0)).alias("value_avg"),
                        F.coalesce("value_max", F.lit(0.0)).alias("value_max")))


def hourly_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense (entity, hour) panel with target and hour measures; one scan of the events."""
    return densify(hourly_cells(entity_events(spark, sf_dir)))


def hourly_panel_tail(spark: SparkSession, sf_dir: str, hours: int) -> DataFrame:
    """D1 restricted to the last ``hours`` hours before the latest observed hour (W17/S11 at the source).

    Two scans of the events: one of ``ts`` alone for its max, one with the pushed filter ``ts >= cut`` (row groups
    before the tail are skipped when the table is laid out by time).  Hours of the window with no events anywhere are
    zeros in the full panel too, so every feature that looks back less than ``hours`` rows is unchanged.
    """
    raw = events(spark, sf_dir)
    latest = raw.agg(F.max("ts")).first()[0]
    cut = F.lit(False) if latest is None else F.col("ts") >= F.lit(
        latest.replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours - 1)).cast("timestamp_ntz")
    return densify(hourly_cells(conformed(raw.filter(cut))))


def error_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: interval events derived from error events (end = start + value minutes)."""
    ev = entity_events(spark, sf_dir).filter(F.col("event_type") == EVENT_TYPE_TARGET)
    return ev.select("event_id", "entity_id", F.col("ts").alias("start"),
                     (F.col("ts") + F.make_dt_interval(secs=F.col("value") * 60)).alias("end"))


def edges(spark: SparkSession) -> DataFrame:
    """Static adjacency (bounded: 3 x N_ENTITIES rows)."""
    e = entities(spark)
    parts = [e.select(F.col("entity_id").alias("src"),
                      F.pmod(F.col("entity_id") + off, F.lit(N_ENTITIES)).cast("int").alias("dst"))
             for off in NEIGHBOUR_OFFSETS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def daily_reports(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """One document per day, the last one (highest doc_id); days without a document have no row.

    Only ``columns`` are read and carried through the aggregate: features of a report don't pull its text along.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", *columns])
    step = (F.pmod("doc_id", F.lit(REPORT_DAYS)) * REPORT_DAY_STEP).cast("int")
    d = docs.withColumn("day", F.date_add(F.lit(REPORT_EPOCH).cast("date"), step))
    last = d.groupBy("day").agg(F.max(F.struct("doc_id", *columns)).alias("r"))
    return last.select("day", "r.*")


def topic_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-hour topic vectors (ARRAY<DOUBLE>) keyed by hour; several vectors may share an hour."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    hour = (F.lit(TOPIC_EPOCH).cast("timestamp_ntz")
            + F.make_dt_interval(hours=F.pmod("vec_id", F.lit(TOPIC_HOURS)).cast("int")))
    return emb.select("vec_id", hour.alias("hour"),
                      F.transform("embedding", lambda x: x.cast("double")).alias("vec"))


def r6(c: Column | str) -> Column:
    """Round a double to 6 places as ``round(x * 1e6) / 1e6`` on the binary value.

    Spark's ``round(x, 6)`` rounds the shortest decimal string half-up, which differs from the
    binary-value rounding of other engines on ties; scaling first makes both identical.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x.cast("double") * F.lit(1e6)) / F.lit(1e6)


def money_sum(c: Column | str) -> Column:
    """Exact sum of 2-decimal amounts (DECIMAL), returned as DOUBLE."""
    x = F.col(c) if isinstance(c, str) else c
    return F.sum(x.cast("decimal(18,2)")).cast("double")
