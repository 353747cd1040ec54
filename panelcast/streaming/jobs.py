"""Structured Streaming jobs.

The product refreshes its panel with an hourly micro-batch over a landing folder.  Here that is a
file-source stream run with ``trigger(availableNow=True)`` once per landed drop: state (windows,
watermark, per-entity continuation) lives in the stream checkpoint between runs, sinks are
idempotent per batch id (``foreachBatch`` overwriting ``batch_id=<n>``), and every location is under
the shared checkpoint folder the cluster configures.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.asof import asof_join
from panelcast.session import path_exists, scratch_path
from panelcast.sources.versioned import VersionedTable


def new_workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder for one stream run (landing, checkpoint, sink) — never reused, never cleared."""
    return scratch_path(spark, f"stream/{name}-{uuid.uuid4().hex[:12]}")


def stage_drops(df: DataFrame, chunk: str, staged: str) -> list[int]:
    """Write ``df`` once, partitioned by drop id, and return the drop ids (a handful of scalars).

    Each tick then copies one partition (partition pruning), so landing costs ~2x the data in I/O no
    matter how many drops there are — never one full scan of the source per drop.
    """
    df.write.mode("overwrite").partitionBy(chunk).parquet(staged)
    parts = df.sparkSession.read.parquet(staged).select(chunk).distinct().collect()
    return sorted(int(r[0]) for r in parts)


def write_drop(staged: str, chunk: str, cid: int, landing: str, spark: SparkSession) -> None:
    spark.read.parquet(staged).filter(F.col(chunk) == cid).drop(chunk).write.mode("overwrite").parquet(
        f"{landing}/drop_{cid:05d}")


def batch_sink(out: str) -> Callable[[DataFrame, int], None]:
    """Idempotent foreachBatch sink: a replayed batch id overwrites its own folder."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return sink


def run_drops(spark: SparkSession, source: DataFrame, chunk: str, schema: T.StructType,
              build: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], ws: str,
              output_mode: str = "append", redeliver: list[int] | None = None) -> None:
    """Land each chunk, then run the stream once with availableNow (one cron tick per drop).

    ``redeliver`` lists chunk ids landed a second time after all others (duplicate delivery).
    """
    landing, ckpt, staged = f"{ws}/landing", f"{ws}/checkpoint", f"{ws}/staged"
    order = stage_drops(source, chunk, staged) + list(redeliver or [])
    for i, cid in enumerate(order):
        write_drop(staged, chunk, cid, f"{landing}/tick_{i:05d}", spark)
        tick(spark, landing, schema, ckpt, build, sink, output_mode)


def tick(spark: SparkSession, source: str, schema: T.StructType, checkpoint: str, build: Callable[[DataFrame], DataFrame],
         sink: Callable[[DataFrame, int], None], output_mode: str = "append") -> None:
    """One run of a stream over what is new in the folder ``source`` since its last run."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
    q = (build(stream).writeStream.outputMode(output_mode).foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_sink(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """What the sink holds; empty only if no batch has written yet (a failing read is raised)."""
    return spark.read.parquet(out).drop("batch_id") if path_exists(spark, out) else spark.createDataFrame([], schema)


# ------------------------------------------------------------------------------------------ X3, X4


def admit(spark: SparkSession, out: str, hour: str = "hour", ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """Sink that admits the hours (last + 1 h .. cutoff): later rows wait for the next batch, rows up to ``last`` are refused.

    ``cutoff`` is the last hour that is complete at the latest time seen, ``last`` the cutoff of the batch before, so an hour is
    admitted with exactly one batch.  A batch reads what the batch before left (its limits, its waiting rows) and
    writes its own folder: replaying it gives the same rows.  Counts are observed while the rows are written.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        before = f"{out}/rows/batch_id={batch_id - 1}"
        seen = limits = None
        if batch_id and path_exists(spark, before):
            waiting = spark.read.parquet(before).filter("verdict = 'waiting'").drop("verdict")
            batch = batch.withColumn("landed", F.lit(True)).unionByName(waiting.withColumn("landed", F.lit(False)))
            limits = spark.read.parquet(f"{out}/log/batch_id={batch_id - 1}").first()
            seen = limits.seen
        else:
            batch = batch.withColumn("landed", F.lit(True))
        latest = batch.agg(F.max(ts)).first()[0]
        seen = max((x for x in (seen, latest) if x is not None), default=None)
        if seen is None:
            return
        cutoff = seen.replace(minute=0, second=0, microsecond=0) - timedelta(hours=1)
        last = F.lit(limits.cutoff if limits else None).cast("timestamp_ntz")
        late = F.coalesce(F.col(hour) <= last, F.lit(False))
        verdict = F.when(late, "refused").when(F.col(hour) <= F.lit(cutoff).cast("timestamp_ntz"), "admitted").otherwise("waiting")
        seen_rows = Observation()
        watched = batch.withColumn("verdict", verdict).observe(
            seen_rows, F.count_if("landed").alias("landed"), F.count_if(late).alias("refused"), F.min(F.when(late, F.col(hour))).alias("first_refused"),
            F.max(F.when(late, F.col(hour))).alias("last_refused"), F.count_if(late & (F.col(hour) == last)).alias("on_limit"))
        watched.drop("landed").write.mode("overwrite").partitionBy("verdict").parquet(f"{out}/rows/batch_id={batch_id}")
        got = seen_rows.get
        row = [(batch_id, seen, cutoff, got["landed"], got["refused"], got["first_refused"], got["last_refused"], got["on_limit"])]
        spark.createDataFrame(row, ADMISSION_LOG).coalesce(1).write.mode("overwrite").parquet(f"{out}/log/batch_id={batch_id}")

    return sink


ADMISSION_LOG = ("batch int, seen timestamp_ntz, cutoff timestamp_ntz, landed bigint, refused bigint, first_refused timestamp_ntz, "
                 "last_refused timestamp_ntz, on_limit bigint")


def verdicts(spark: SparkSession, out: str, verdict: str) -> DataFrame:
    """Rows of all batches with this verdict."""
    return spark.read.parquet(f"{out}/rows").filter(F.col("verdict") == verdict).drop("verdict", "batch_id")


def admission_log(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/log").drop("batch_id")


# ------------------------------------------------------------------------------------------ X11


def pinned_version(spark: SparkSession, table: VersionedTable, pins: str, batch_id: int) -> int:
    """The version of ``table`` that a batch reads: the latest when the batch is first tried, the same one at every later try.

    The pin is complete before the batch writes anything, so no row comes from a version that a replay wouldn't read.
    """
    pin = f"{pins}/batch_id={batch_id}"
    if not path_exists(spark, f"{pin}/_SUCCESS"):
        spark.createDataFrame([(table.version(),)], "version int").coalesce(1).write.mode("overwrite").parquet(pin)
    return spark.read.parquet(pin).first().version


def join_as_of(spark: SparkSession, table: VersionedTable, day: str, payload: list[str], ws: str, hour: str = "hour",
               bucket_days: int = 366) -> Callable[[DataFrame, int], None]:
    """Sink that joins a stream of hours to a versioned daily table: each row gets the latest day on or before its own, as the
    table stood when the batch was first tried.  The as-of lookup runs over the batch's days, a few, and meets the rows by an equi-join."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        version = pinned_version(spark, table, f"{ws}/pins", batch_id)
        rows = batch.withColumn("_day", F.to_date(hour))
        days = rows.select("_day").distinct()
        if version:
            known = table.read(version).select(F.col(day).alias("_day"), *payload)
            days = asof_join(days, known, "_day", payload, bucket_rows=bucket_days, t_out=f"as_of_{day}")
            rows = rows.join(days, "_day")
        rows.drop("_day").write.mode("overwrite").parquet(f"{ws}/out/batch_id={batch_id}")

    return sink


# ------------------------------------------------------------------------------------------ X5


HOURS_STATE = T.StructType([T.StructField("prev_y", T.IntegerType()), T.StructField("prev_hours", T.DoubleType()),
                            T.StructField("prev_t", T.LongType())])


def continue_hours_since(key, pdfs, state):
    """Carry (previous target, previous count) per entity across micro-batches.

    The first row ever is 0; after an event row the count restarts at 0, otherwise it grows by one.
    A group's rows may arrive as several unsorted chunks in one batch: they are concatenated and
    sorted before the state is advanced (only this entity's rows of this batch are in memory).
    """
    pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("t")
    if state.exists:
        prev_y, prev_h, prev_t = state.get
    else:
        prev_y, prev_h, prev_t = None, None, None
    rows = pdf if prev_t is None else pdf[pdf["t"] > prev_t]   # replayed rows were already emitted
    at = np.arange(len(rows))
    # the last event row strictly before each row (-1: none in this batch), then hours counted from it or from the state
    last = np.maximum.accumulate(np.where(rows["y"].to_numpy() == 1, at, -1)) if len(rows) else at
    before = np.r_[-1, last[:-1]].astype(int) if len(rows) else at
    carried = 0.0 if prev_y is None or prev_y == 1 else prev_h + 1.0
    hours = np.where(before >= 0, at - 1 - before, carried + at).astype(float)
    if len(rows):
        state.update((int(rows["y"].iloc[-1]), float(hours[-1]), int(rows["t"].iloc[-1])))
    res = rows[["entity_id", "hour", "y"]].copy()
    res["hours_since_last"] = hours
    yield res
