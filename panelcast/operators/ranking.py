"""Distributed global ranks and prefix sums (DR6), and exact quantiles built on them.

A running total over a global order normally becomes a window without ``partitionBy`` — one task
holds every row.  Here the data is range-partitioned on (keys, order) (sampled bounds; a hot key
spans several partitions), the range id is written into a Parquet table in the shared checkpoint folder
(stable membership, lineage cut, safe under recomputation),
then each partition's total is prefix-summed over the small (partition, key) table and added back
as an offset to a within-partition running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import materialize

PID = "_pid"
SALTS = 16


def prefix_sum(df: DataFrame, order: list[str], weight: Column | dict | None = None, keys: list[str] | None = None,
               out: str = "cum", partitions: int | None = None, inclusive: bool = True) -> DataFrame:
    """``out`` = running sum of ``weight`` (default 1) within ``keys`` by ``order``.

    ``weight`` may also be a dict {output column: weight column}: several running sums in the same pass.
    Rows must be unique on (keys, order) for a deterministic result (aggregate ties first).
    """
    keys = list(keys or [])
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    weights = weight if isinstance(weight, dict) else {out: weight if weight is not None else F.lit(1)}
    wcols = {o: f"_w_{i}" for i, o in enumerate(weights)}
    x = df
    for o, wc in weights.items():
        x = x.withColumn(wcols[o], wc)
    x = (x.repartitionByRange(n, *[F.col(c) for c in keys + order])
          .withColumn(PID, F.spark_partition_id()))
    # the range id is stored as a column of a written table: offsets no longer depend on how the data
    # is physically split when it is read back or recomputed after an executor loss
    x = materialize(x, "prefix")
    tot = x.groupBy(PID, *keys).agg(*[F.sum(c).alias(f"_t{c}") for c in wcols.values()])
    wo = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(PID, *keys, *[F.coalesce(F.sum(f"_t{c}").over(wo), F.lit(0)).alias(f"_o{c}") for c in wcols.values()])
    wi = Window.partitionBy(PID, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    joined = x.join(F.broadcast(off), [PID, *keys]) if not keys else x.join(off, [PID, *keys])
    for o, c in wcols.items():
        joined = joined.withColumn(o, F.col(f"_o{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0)))
    return joined.drop(PID, *wcols.values(), *[f"_o{c}" for c in wcols.values()])


def exact_quantiles(df: DataFrame, value: str, qs: list[float], keys: list[str] | None = None,
                    out: str = "q_value") -> DataFrame:
    """Quantiles with linear interpolation (pandas / ``quantile_cont``), exact and distributed.

    Distinct values are counted first (partial aggregation), ranked with :func:`prefix_sum`, and for
    each q the two order statistics around position q*(n-1) are selected and interpolated.
    """
    keys = list(keys or [])
    vals = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    # counted once: ranks and totals both read this table
    cnt = materialize(vals.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_c")), "quantile-values")
    ranked = prefix_sum(cnt, [value], F.col("_c"), keys, out="_hi_rank")  # inclusive count up to value
    n = cnt.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    qs_arr = F.array(*[F.lit(float(q)) for q in qs])
    pos = n.withColumn("q", F.explode(qs_arr)).withColumn("_p", F.col("q") * (F.col("_n") - 1)).select(
        *keys, "q", "_p", F.floor("_p").alias("_lo"), F.ceil("_p").alias("_up"))
    # the value holding 0-based rank r satisfies hi_rank - c <= r < hi_rank
    r = ranked.withColumn("_lo_rank", F.col("_hi_rank") - F.col("_c"))
    lo_in = (F.col("_lo") >= F.col("_lo_rank")) & (F.col("_lo") < F.col("_hi_rank"))
    up_in = (F.col("_up") >= F.col("_lo_rank")) & (F.col("_up") < F.col("_hi_rank"))
    if keys:
        # a key with very many distinct values is dealt over SALTS parts; its few wanted ranks go to each of them
        spread = pos.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = r.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int"))
        pick = salted.join(spread, [*keys, "_salt"]).filter(lo_in | up_in)
    else:
        pick = r.join(F.broadcast(pos), lo_in | up_in)     # |qs| rows
    agg = pick.groupBy(*keys, "q", "_p", "_lo").agg(F.max(F.when(lo_in, F.col(value))).alias("_vlo"),
                                                    F.max(F.when(up_in, F.col(value))).alias("_vup"))
    frac = F.col("_p") - F.col("_lo")
    res = F.col("_vlo").cast("double") + frac * (F.col("_vup").cast("double") - F.col("_vlo").cast("double"))
    return agg.select(*keys, "q", res.alias(out))
