"""Connected components by hooking and contraction; every round is written as tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import materialize


def _between(edges: DataFrame) -> DataFrame:
    """Distinct edges between different nodes, smaller node first."""
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """``edges`` (a, b: long) -> (node, label): label is the smallest node of the component.

    In a round every node hooks to its smallest neighbour (or stays, if it is smaller than all), then to that one's hook,
    and edges move to the hooks; edges inside a part that has become one node go.  At most half of the nodes are left
    after a round, so edges shrink quickly and all rounds together move little more than the first.  Minima are
    pre-aggregated before the shuffle: a node with very many edges isn't gathered anywhere.
    """
    live = materialize(_between(edges), f"{name}-edges")
    labels = live.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    labels = materialize(labels, f"{name}-labels")
    while not live.isEmpty():
        both = live.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("to")),
                                             F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("e"))
        hooks = both.groupBy("e.node").agg(F.min("e.to").alias("to")).select("node", F.least("node", "to").alias("up"))
        hooks = materialize(hooks, f"{name}-hooks")
        far = hooks.select(F.col("node").alias("via"), F.col("up").alias("far"))
        jumped = materialize(hooks.join(far, hooks.up == far.via).select("node", F.col("far").alias("up")), f"{name}-hooks")
        moved = labels.join(jumped.withColumnRenamed("node", "old"), F.col("label") == F.col("old"), "left")
        labels = materialize(moved.select("node", F.coalesce("up", "label").alias("label")), f"{name}-labels")
        ends = [jumped.select(F.col("node").alias(f"node_{c}"), F.col("up").alias(f"up_{c}")) for c in "ab"]
        at = live.join(ends[0], F.col("a") == F.col("node_a")).join(ends[1], F.col("b") == F.col("node_b"))
        live = materialize(_between(at.select(F.col("up_a").alias("a"), F.col("up_b").alias("b"))), f"{name}-edges")
    return labels
