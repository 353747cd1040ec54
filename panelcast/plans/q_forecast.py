"""Forecast tables (A25, S17, F23): aggregates over replicas and the nested forecast document of batch-scored rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.ml import bundle as B
from panelcast.operators import windows as W
from panelcast.plans import driver as D
from panelcast.plans.q_models import fit_bundle, split_panel
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import PANEL, with_
from panelcast.session import path_exists, scratch_path

REPLICA_HOURS = (6, 12, 24)
ALARM_SHARE = 0.25


@query("replica_aggregate", covers="A25", sql=with_(PANEL, "r AS (" + " UNION ALL ".join(
    f"SELECT entity_id, hour, {h} AS replica, COALESCE(sum(y) OVER (PARTITION BY entity_id ORDER BY hour ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING), 0) / {h}.0 AS proba FROM panel"
    for h in REPLICA_HOURS) + ")") + f"""
SELECT entity_id, hour, round(avg(proba), 6) AS proba_mean, round(stddev_pop(proba), 6) AS proba_std, round(avg(proba), 6) >= {ALARM_SHARE} AS alarm
FROM r GROUP BY entity_id, hour""")
def replica_aggregate(spark, sf):
    """Mean and spread over replicas of an hour's probability, then the alarm; a replica here is the share of alarms in
    the last 6, 12 or 24 hours."""
    def shares(w):
        return [F.array(*[(W.rolling_sum_prev("y", h, w) / F.lit(float(h))) for h in REPLICA_HOURS]).alias("shares")]

    x = W.apply_windowed(D.hourly_panel(spark, sf), shares, lead_in=max(REPLICA_HOURS), bucket_rows=D.bucket_rows(spark))
    long = x.select("entity_id", "hour", F.posexplode("shares").alias("replica", "proba"))
    g = long.groupBy("entity_id", "hour").agg(D.r6(F.avg("proba")).alias("proba_mean"), D.r6(F.stddev_pop("proba")).alias("proba_std"))
    return g.withColumn("alarm", F.col("proba_mean") >= ALARM_SHARE)


def forecast_document(scored, threshold: float, trained: str):
    """One JSON document: header, and entity -> {HH:mm -> alarm, probability}; bounded by entities x 24 hours."""
    fc = scored.withColumn("k", F.date_format("hour", "HH:mm"))
    per = fc.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "alarm"))).alias("forecast"),
                                      F.map_from_entries(F.collect_list(F.struct("k", F.round("score", 4)))).alias("forecast_proba"))
    record = F.struct(F.col("entity_id").alias("region_id"), F.concat(F.lit("city-"), F.col("entity_id")).alias("city_name"), "forecast", "forecast_proba")
    regions = per.agg(F.map_from_entries(F.collect_list(F.struct(F.col("entity_id").cast("string"), record))).alias("regions_forecast"))
    head = fc.agg(F.date_format(F.min("hour") - F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd HH:mm:ss").alias("last_prediction_time"),
                  F.countDistinct("hour").alias("hours"), F.countDistinct("entity_id").alias("regions"), F.count(F.lit(1)).alias("rows"))
    return head.crossJoin(regions).select("last_prediction_time", F.to_json(F.struct(
        F.lit(trained).alias("last_model_train_time"), "last_prediction_time", F.lit(threshold).alias("threshold"), "hours", "regions", "rows",
        "regions_forecast")).alias("document"))


@query("forecast_json", covers="S17 F23 M18")
def forecast_json(spark, sf):
    """The last 24 hours scored by the saved and reloaded bundle, written as a timestamped document and as the latest,
    and read back as rows."""
    x = split_panel(spark, sf)
    base = scratch_path(spark, f"forecasts/{uuid.uuid4().hex[:12]}")
    B.promote(B.save_bundle(fit_bundle(x), f"{base}/bundle", spark), base, spark)
    bundle = B.current_bundle(base, spark)
    last = x.agg(F.max("hour")).first()[0]
    day = x.filter(F.col("hour") > F.lit(last).cast("timestamp_ntz") - F.expr("INTERVAL 24 HOURS"))
    doc = forecast_document(B.score(bundle, day, ["entity_id", "hour"]), bundle.threshold, last.strftime("%Y-%m-%d %H:%M:%S")).cache()
    stamp = doc.first().last_prediction_time.replace(" ", "T").replace(":", "-")
    for place in (f"{base}/forecast_{stamp}", f"{base}/latest"):
        doc.select("document").write.text(place)
    doc.unpersist()
    assert path_exists(spark, f"{base}/forecast_{stamp}")
    schema = ("last_prediction_time string, threshold double, hours long, regions long, rows long, "
              "regions_forecast map<string, struct<region_id: int, city_name: string, forecast: map<string, boolean>, forecast_proba: map<string, double>>>")
    back = spark.read.text(f"{base}/latest").select(F.from_json("value", schema).alias("d"))
    regions = back.select("d.last_prediction_time", "d.threshold", F.explode("d.regions_forecast").alias("k", "r"))
    rows = regions.select(F.col("r.region_id").alias("entity_id"), "r.city_name", "threshold", "r.forecast", F.explode("r.forecast_proba").alias("time_key", "proba"))
    return rows.withColumn("alarm", F.col("forecast")[F.col("time_key")]).drop("forecast")
