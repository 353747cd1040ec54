"""Cross-entity features over the hour axis.

On the dense backbone the "previous distinct hour" is ``hour - 1h``, so both lagged features are
equi-joins on a shifted key — no global (un-partitioned) window over the panel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import add_hours


def hourly_total(panel: DataFrame, value: str = "y", hour: str = "hour") -> DataFrame:
    """Total over all entities per hour (partial + final hash aggregate)."""
    return panel.groupBy(hour).agg(F.sum(value).alias("total"))


def lagged_global_total(panel: DataFrame, value: str = "y", hour: str = "hour", out: str = "total_lag1") -> DataFrame:
    """Each row gets the all-entity total of the previous hour (0 for the first hour)."""
    tot = hourly_total(panel, value, hour).select(add_hours(hour, 1).alias(hour), F.col("total").alias(out))
    return (panel.join(tot, [hour], "left")
                 .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("double")))


def neighbour_sum(panel: DataFrame, edges: DataFrame, value: str = "y", entity: str = "entity_id",
                  hour: str = "hour", lag_hours: int = 0) -> DataFrame:
    """For each (src, hour) the sum of ``value`` over src's neighbours (dst).

    ``edges`` is a static adjacency list: bounded by the entity dimension, so it is broadcast.
    """
    nb = (panel.select(F.col(entity).alias("dst"), hour, value)
               .join(F.broadcast(edges), "dst")
               .groupBy(F.col("src").alias(entity), add_hours(hour, lag_hours).alias(hour) if lag_hours else F.col(hour))
               .agg(F.sum(value).alias("nb_sum")))
    return nb


def lagged_neighbour_sum(panel: DataFrame, edges: DataFrame, value: str = "y", entity: str = "entity_id",
                         hour: str = "hour", out: str = "neighbour_lag1") -> DataFrame:
    """neighbours' sum at the previous hour, 0 for the first hour / no neighbours."""
    nb = neighbour_sum(panel, edges, value, entity, hour, lag_hours=1).withColumnRenamed("nb_sum", out)
    return (panel.join(nb, [entity, hour], "left")
                 .withColumn(out, F.coalesce(F.col(out), F.lit(0)).cast("double")))
