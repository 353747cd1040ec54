"""Forecast roll-ups a serving layer computes (V1-V9, O6, F23), as DataFrame queries.

The forecast table is long: (entity_id, time_key 'HH:MM', hour_of_day, proba).  Every roll-up
is an aggregate over it, so it runs unchanged on one forecast or on a history of forecasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the product's serving rules
ALARM_THRESHOLD = 0.65
ALWAYS_ON_ENTITIES = (1, 12)
EXCLUDED_FROM_LIST = (1, 12)
TOTAL_REGIONS = 26
COVERAGE_OFFSET = 2


def is_alarm(entity: Column, proba: Column) -> Column:
    """V4: forced-on entities or proba >= threshold."""
    return entity.isin(*ALWAYS_ON_ENTITIES) | (F.coalesce(proba, F.lit(0.0)) >= F.lit(ALARM_THRESHOLD))


def hourly_alarm_counts(fc: DataFrame) -> DataFrame:
    """V4-V6: per time key: alarmed entities (forced included), model-only count, coverage %."""
    a = is_alarm(F.col("entity_id"), F.col("proba"))
    per = fc.groupBy("time_key", "hour_of_day").agg(
        F.count_if(a).alias("n_alarm"), F.count_if(F.col("proba") >= F.lit(ALARM_THRESHOLD)).alias("n_model"))
    cov = F.round((F.col("n_alarm") + F.lit(COVERAGE_OFFSET)) / F.lit(float(TOTAL_REGIONS)) * 100).cast("int")
    return per.withColumn("coverage_pct", cov)


def peak_hour(counts: DataFrame) -> DataFrame:
    """V5: the time key with most alarmed entities; ties -> earliest hour of day."""
    best = counts.agg(F.max_by(F.struct("time_key", "n_alarm"),
                               F.struct(F.col("n_alarm"), F.negative("hour_of_day"))).alias("b"))
    return best.select(F.col("b.time_key").alias("peak_time"), F.col("b.n_alarm").alias("peak_count"))


def region_stats(fc: DataFrame, current_hour: Column) -> DataFrame:
    """V7: active hours, coverage and first alarm with wrap-around ("Now" when active at current)."""
    a = is_alarm(F.col("entity_id"), F.col("proba"))
    forced = F.col("entity_id").isin(*ALWAYS_ON_ENTITIES)
    g = fc.withColumn("_a", a).withColumn("_cur", current_hour).groupBy("entity_id").agg(
        F.count_if("_a").alias("_n_active"),
        F.max(F.when(F.col("_a") & (F.col("hour_of_day") == F.col("_cur")), F.lit(1))).alias("_now"),
        F.min(F.when(F.col("_a") & (F.col("hour_of_day") > F.col("_cur")), F.col("hour_of_day"))).alias("_next"),
        F.min(F.when(F.col("_a"), F.col("hour_of_day"))).alias("_first"))
    active = F.when(forced, F.lit(24)).otherwise(F.col("_n_active"))
    hh = F.coalesce(F.col("_next"), F.col("_first"))
    first = F.when(F.col("_now") == 1, F.lit("Now")).when(hh.isNull(), F.lit("-")).otherwise(
        F.format_string("%02d:00", hh))
    return g.select("entity_id", active.cast("long").alias("active_count"),
                    F.round(active / F.lit(24.0) * 100).cast("int").alias("coverage_pct"), first.alias("first_alarm"))


def top_k_at(fc: DataFrame, time_key: Column, k: int = 3) -> DataFrame:
    """Top-k entities by probability at one time key (forced entities count as 1); ties -> lower id."""
    prob = F.when(F.col("entity_id").isin(*ALWAYS_ON_ENTITIES), F.lit(1.0)).otherwise(F.coalesce("proba", F.lit(0.0)))
    x = fc.filter(F.col("time_key") == time_key).select("entity_id", prob.alias("probability"))
    return x.orderBy(F.desc("probability"), "entity_id").limit(k)


def rotated_hours(fc: DataFrame, current_hour: Column) -> DataFrame:
    """V8: the distinct time keys ordered from the current hour with wrap-around."""
    t = fc.select("time_key", F.pmod(F.col("hour_of_day") - current_hour, F.lit(24)).alias("position"))
    return t.distinct()


def forecast_json(fc: DataFrame) -> DataFrame:
    """Per entity a JSON object {time_key: proba} (bounded: one entry per forecast hour)."""
    m = fc.groupBy("entity_id").agg(F.map_from_entries(F.collect_list(F.struct("time_key", "proba"))).alias("m"))
    return m.select("entity_id", F.to_json("m").alias("forecast_json"))


def parse_forecast_json(js: DataFrame) -> DataFrame:
    """V3: parse the payload back and re-key to rows (entity_id, time_key, proba)."""
    parsed = js.select("entity_id", F.from_json("forecast_json", "map<string,double>").alias("m"))
    return parsed.select("entity_id", F.explode("m").alias("time_key", "proba"))
