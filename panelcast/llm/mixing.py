"""Mixing sources to target weights by systematic sampling.

``target_shares`` turns weights and sizes into targets: a source gets its weight's share of the mix, at most
``max_repeats`` times its own size; what is above is shared again by weight.  The fixed point is
``min(cap, level * weight)`` with one ``level`` for all, found by prefix sums over the sources in order of cap / weight.

``mix_sources`` orders each source's documents by size (largest first, ties by digest of the id), prefix-sums their
expected copies (target / source size), adds one random offset per source, and emits a document once per integer
boundary that its stretch of the prefix sum crosses.  Ordering by size spreads the copies evenly over sizes, so the
words taken differ from the target by about one large document at most.  Ranks come from a distributed prefix sum
(range partitions with carried totals), so a source may hold any share of the rows.

Edge cases: null text has size 0; a null source is a source of its own, last in order; null ids and repeated rows are
documents like others; sources without words have target 0; an empty table gives an empty mix.  Offsets and order come
from digests of the seed, source and id: reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import WORD, boxed, table
from panelcast.llm.registry import query
from panelcast.operators.ranking import prefix_sum
from panelcast.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2
RESULT = ("size", "source_size", "target", "copies")


def target_shares(sources: DataFrame, total_share: float, max_repeats: float) -> DataFrame:
    """``sources`` (key, weight, source_size) plus ``target``.  Prefix sums over range partitions: any number of sources."""
    ordered = sources.withColumn("_order", F.col("source_size") / F.col("weight"))
    x = prefix_sum(ordered, ["_order", "key"], {"_capped": F.col("source_size"), "_before": F.col("weight")}, inclusive=False)
    whole = sources.agg(F.sum("source_size").alias("_size"), F.sum("weight").alias("_weight"))
    # the level if all sources before this one are at their caps; the first that stays below its cap sets it for all
    level = (total_share * F.col("_size") - max_repeats * F.col("_capped")) / (F.col("_weight") - F.col("_before"))
    x = x.crossJoin(F.broadcast(whole)).withColumn("_level", level).withColumn("_cap", (max_repeats * F.col("source_size")).cast("double"))  # one row
    x = materialize(x, "mix-levels")
    first = x.filter(F.col("_level") * F.col("weight") <= F.col("_cap")).agg(F.min(F.struct("_order", "key", "_level"))["_level"].alias("_final"))
    x = x.crossJoin(F.broadcast(first))  # one row
    target = F.least("_cap", F.coalesce(F.col("_final") * F.col("weight"), F.col("_cap")))
    return x.select(*sources.columns, target.alias("target"))


def source_targets(sized: DataFrame, weights=WEIGHTS, total_share: float = SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of the sources of ``sized`` (_key, size); weights repeat over the sources in code-point order, null last."""
    sources = sized.groupBy(F.col("_key").alias("key")).agg(F.sum("size").alias("source_size"))
    ranked = prefix_sum(sources, ["key"], out="_rank", inclusive=False)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    return target_shares(ranked.withColumn("weight", weight).drop("_rank"), total_share, max_repeats)


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from a digest."""
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("double") / float(2**32)


def mix_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
               total_share: float = SHARE, max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """``df`` plus ``size, source_size, target, copies``: how often the mix emits each row (0 to ``max_repeats``)."""
    sized = materialize(df.select(boxed(df, *RESULT), *_measures(id_col, text_col, source_col)), "mix-sizes")
    taken = _copies(sized.drop("row"), weights, total_share, max_repeats, seed)
    return sized.select("row", "_n").join(taken, "_n").select("row.*", *RESULT)


def _measures(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """A row's source key (null after all others), size, digest of the id, and number."""
    return [F.coalesce(F.concat(F.lit("0"), F.col(source_col)), F.lit("1")).alias("_key"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_md5"), F.monotonically_increasing_id().alias("_n")]


def _copies(sized: DataFrame, weights, total_share, max_repeats, seed) -> DataFrame:
    """``_n, size, source_size, target, copies`` of the rows of a written table of :func:`_measures`."""
    targets = materialize(source_targets(sized, weights, total_share, max_repeats).withColumnRenamed("key", "_key"), "mix-targets")
    order = sized.select("*", (-F.col("size")).alias("_neg"))
    ranked = prefix_sum(order, ["_neg", "_md5", "_n"], keys=["_key"], out="_rank").join(targets, "_key")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = rate - F.floor(rate)
    offset = _unit(F.lit(seed), F.col("_key"))
    crossed = F.floor(offset + part * F.col("_rank")) - F.floor(offset + part * (F.col("_rank") - 1))
    return ranked.withColumn("copies", F.floor(rate) + crossed).drop("_neg", "_md5", "_key", "_rank", "key", "weight")


def mix_sources(df: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as it is taken, with the columns of ``df`` only."""
    counted = mix_counts(df.select(boxed(df), *[F.col(f"`{c}`") for c in (options.get("id_col", "doc_id"), options.get("text_col", "text"),
                                                                           options.get("source_col", "source"))]), **options)
    again = counted.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return again.select("row.*")


@query("op8_mixing", """
WITH d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
                  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT k, sum(size)::BIGINT AS source_size FROM d GROUP BY k),
w AS (SELECT k, source_size, [5, 2, 1][((row_number() OVER (ORDER BY encode(k)) - 1) % 3 + 1)::INT] AS weight FROM s),
l AS (SELECT *, (1.5 * (sum(source_size) OVER ())::DOUBLE - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, encode(k) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
             / (sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, encode(k) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
f AS (SELECT min(level) AS level FROM (SELECT level FROM l WHERE level * weight <= 2.0 * source_size ORDER BY source_size::DOUBLE / weight, encode(k) LIMIT 1)),
t AS (SELECT l.k, source_size, least(2.0::DOUBLE * source_size, coalesce(f.level * weight, 2.0 * source_size))::DOUBLE AS target FROM l, f),
r AS (SELECT d.*, source_size, target, row_number() OVER (PARTITION BY d.k ORDER BY size DESC, md5(coalesce(doc_id::VARCHAR, ''))) AS n,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
             ('0x' || substr(md5('mix' || d.k), 1, 8))::UBIGINT::DOUBLE / 4294967296 AS shift
      FROM d JOIN t ON d.k = t.k)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + floor(shift + (rate - floor(rate)) * n) - floor(shift + (rate - floor(rate)) * (n - 1))))::BIGINT AS taken FROM r
""")
def op8_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", *_measures("doc_id", "text", "source")), "mix-sizes")
    out = _copies(sized, WEIGHTS, SHARE, MAX_REPEATS, "mix")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))
