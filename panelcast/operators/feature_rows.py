"""Feature rows for the next hours of every entity (M20), from data before an origin only.

All feeds are tagged and united into one table (entity, hour, one column per feed); feeds without an entity have the pseudo
entity ``EVERYWHERE``.  What lies before the look-back is folded into one row per entity by a map-side combined aggregate:
the last row of each feed and its hour.  That row, the look-back and the target hours are then scanned once per entity: exact
look-ups are range frames on the hour, as-of values are carried forward from the row they stem from, so each comes with
its age, its decay and the fallback to the last history row.  A scanned group has at most ``1 + feeds * (lead + horizon)``
rows, whatever the history's length.

Nothing at or after the origin is read, so hours of the horizon see what a forecast at the origin would: lags that reach
into the horizon are 0, signals age and decay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import from_hour_index, is_night, is_weekend, weekday_mon0
from panelcast.operators import windows as W
from panelcast.operators.asof import decay_factor
from panelcast.operators.vectors import abs_entropy, abs_max, abs_std, abs_sum

EVERYWHERE = -1
HORIZON = 24
#: Hours before the origin that are scanned; the smoothed and compared topic series starts here.
LEAD = 48
LAGS = (1, 3, 6, 12)


def tagged_feeds(cells: DataFrame, edges: DataFrame, topics: DataFrame, reports: DataFrame, origin: int) -> DataFrame:
    """The union of all feeds before ``origin`` (an hour index): ``entity_id, t, own, near, total, topic, report``.

    ``cells`` (entity_id, t, y, value_avg, value_max, n_events), ``edges`` (src, dst), ``topics`` (t, vec), ``reports`` (day, n_chars).
    """
    cells = cells.filter(F.col("t") < origin)
    own = cells.select("entity_id", "t", F.struct("t", "y", "value_avg", "value_max", F.col("n_events").cast("double").alias("signal")).alias("own"))
    met = cells.filter("y = 1").join(F.broadcast(edges), F.col("entity_id") == F.col("dst"))
    near = met.groupBy(F.col("src").alias("entity_id"), "t").agg(F.count(F.lit(1)).alias("near"))
    everywhere = F.lit(EVERYWHERE).alias("entity_id")
    total = cells.groupBy("t").agg(F.sum("y").alias("total")).select(everywhere, "t", "total")
    topic = topics.filter(F.col("t") < origin).select(everywhere, "t", F.struct(
        "t", abs_sum("vec").alias("intensity"), abs_std("vec").alias("std"), abs_max("vec").alias("top"), abs_entropy("vec").alias("entropy")).alias("topic"))
    day_hour = F.unix_date("day").cast("long") * 24
    report = reports.filter(day_hour < origin).select(everywhere, day_hour.alias("t"), F.struct(day_hour.alias("t"), "n_chars").alias("report"))
    feeds = [own, near, total, topic, report]
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed, allowMissingColumns=True)
    return out


def history_rows(feeds: DataFrame, before: int) -> DataFrame:
    """One row per entity, at the hour ``before - 1``: the last row of its own feed (of all hours), and of the others before ``before``."""
    old = F.col("t") < before
    last = lambda c, ok=F.lit(True): F.max_by(c, F.when(F.col(c).isNotNull() & ok, F.col("t")))
    folded = feeds.groupBy("entity_id").agg(
        F.struct(last("own").alias("last"), F.max(F.when(F.col("own.y") == 1, F.col("t"))).alias("last_on"), F.count("own").alias("n"),
                 F.max(F.when(F.col("total").isNotNull(), F.col("t"))).alias("last_any")).alias("history"),
        last("topic", old).alias("topic"), last("report", old).alias("report"))
    return folded.withColumn("t", F.lit(before - 1).cast("long"))


def _exact(c: Column, k: int, w) -> Column:
    """The value ``k`` hours before, null if that hour has none."""
    return F.max(c).over(w.rangeBetween(-k, -k))


def feature_rows(feeds: DataFrame, entities: DataFrame, origin: int, horizon: int = HORIZON, lead: int = LEAD) -> DataFrame:
    """``entities`` x ``horizon`` rows from ``feeds`` (:func:`tagged_feeds`, read more than once: a written table)."""
    start = origin - lead
    hours = lambda lo: F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(origin + horizon - 1).cast("long"))).alias("t")
    targets = entities.select("entity_id", hours(origin)).union(entities.sparkSession.range(1).select(F.lit(EVERYWHERE).alias("entity_id"), hours(start)))
    united = feeds.filter(F.col("t") >= start).unionByName(history_rows(feeds, start), allowMissingColumns=True)
    united = united.unionByName(targets.withColumn("target", F.lit(1)), allowMissingColumns=True)

    w = Window.partitionBy("entity_id").orderBy("t")
    # the series of a feed has its value of the hour before at every hour, or the last one before that
    carried = lambda c, upto: F.last(c, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, upto))
    scanned = united.select(
        "entity_id", "t", "target", carried("history", 0).alias("history"),
        *[F.coalesce(_exact(F.col("own.y"), k, w), F.lit(0)).alias(f"lag_{k}") for k in LAGS],
        F.coalesce(F.sum("own.y").over(w.rangeBetween(-24, -1)), F.lit(0)).cast("double").alias("active_last_24h"),
        F.coalesce(_exact(F.col("near"), 1, w), F.lit(0)).alias("neighbours_lag_1"), F.coalesce(_exact(F.col("total"), 1, w), F.lit(0)).alias("total_lag_1"),
        _exact(F.col("own"), 1, w).alias("hour_own"), _exact(F.col("own"), 24, w).alias("day_own"),
        # the one day start among the 24 hours that end 24 hours before is that of the day before
        F.max("report").over(w.rangeBetween(-47, -24)).alias("report_exact"), carried("report", 0).alias("report_last"),
        carried("topic", -1).alias("topic")).filter("target = 1").drop("target")
    own = scanned.filter(F.col("entity_id") != EVERYWHERE).drop("total_lag_1", "report_exact", "report_last", "topic")
    shared = _shared(scanned.filter(F.col("entity_id") == EVERYWHERE), origin)
    x = own.join(F.broadcast(shared), "t")  # one row per hour of the horizon

    last, src = F.col("history.last"), F.col("t") - 1
    signal_t = F.when(last["t"] == F.col("last_any"), last["t"])  # the last hour with any signal
    signal_age = F.when(F.col("hour_own").isNotNull(), F.lit(0).cast("long")).otherwise(src - signal_t)
    signal = F.coalesce(F.col("hour_own.signal"), F.when(signal_t.isNotNull(), last["signal"] * decay_factor(src - signal_t)), F.lit(0.0))
    since = F.when(F.col("history.last_on").isNull(), F.coalesce(F.col("history.n"), F.lit(0))).otherwise(F.greatest(src - F.col("history.last_on"), F.lit(0)))
    hour = from_hour_index("t")
    return x.select(
        "entity_id", hour.alias("hour"), weekday_mon0(hour).alias("day_of_week"), F.hour(hour).alias("hour_of_day"), is_weekend(hour).alias("is_weekend"),
        is_night(hour).alias("is_night"), *[F.col(f"lag_{k}") for k in LAGS], "active_last_24h", "total_lag_1", "neighbours_lag_1",
        since.cast("double").alias("hours_since_last"),
        F.coalesce("hour_own.value_avg", last["value_avg"], F.lit(0.0)).alias("hour_value"), (src - F.coalesce("hour_own.t", last["t"])).alias("hour_value_age"),
        F.coalesce("day_own.value_max", last["value_max"], F.lit(0.0)).alias("day_value"),
        (F.col("t") - 24 - F.coalesce("day_own.t", last["t"])).alias("day_value_age"),
        signal.alias("signal"), signal_age.alias("signal_age"), *[F.col(c) for c in SHARED])


SHARED = ["report_chars", "report_age_days", "topic_intensity", "topic_age", "topic_decay", "topic_std", "topic_top", "topic_entropy",
          "topic_velocity_3h", "topic_velocity_24h", "topic_ema_6h", "topic_zscore_24h"]


def _shared(rows: DataFrame, origin: int) -> DataFrame:
    """Features that all entities share, per hour: totals, the report of the day before (or the last one), the aged topics."""
    age = F.col("t") - 1 - F.col("topic.t")
    decay = decay_factor(age)
    report = F.coalesce("report_exact", "report_last")
    day = F.floor((F.col("t") - 24) / 24)
    aged = lambda c: F.coalesce(F.col(f"topic.{c}") * decay, F.lit(0.0))
    x = rows.select(
        "entity_id", "t", F.col("history.last_any").alias("last_any"), "total_lag_1", F.coalesce(report["n_chars"], F.lit(0)).alias("report_chars"),
        (day - F.floor(report["t"] / 24)).alias("report_age_days"), aged("intensity").alias("topic_intensity"), age.alias("topic_age"),
        decay.alias("topic_decay"), aged("std").alias("topic_std"), aged("top").alias("topic_top"), F.coalesce("topic.entropy", F.lit(0.0)).alias("topic_entropy"))
    w = W.entity_window()
    c = "topic_intensity"
    x = x.select("*", W.diff_fill(c, 3, w).alias("topic_velocity_3h"), W.diff_fill(c, 24, w).alias("topic_velocity_24h"),
                 W.ewm_mean(c, 6, w, shifted=False).alias("topic_ema_6h"), W.rolling_zscore(c, 24, w).alias("topic_zscore_24h"))
    return x.filter(F.col("t") >= origin).select("t", "last_any", "total_lag_1", *SHARED)
