"""Exact deduplication by two Bloom-filter passes.

Pass 1 counts, with map-side partial aggregation, how many rows hit each of two filter positions per text digest and
keeps the positions hit at least twice, packed into 64-bit words.  The filter has a fixed number of bits, so its
packed words fit a broadcast whatever the input (``filter_bits / 64`` rows of 16 bytes at most).  Pass 2 probes both
positions of every row: a row that misses one can't be repeated and passes straight through; only the others shuffle,
by digest, to find their group.  More rows than the filter was sized for cost more shuffling, never a wrong result.

Texts are equal when their SHA-256 digests are, after lower-casing A-Z only.  Edge cases: null counts as empty, and
empty texts are equal; of rows with equal text and equal largest id exactly one stays; null ids are smaller than all
others, and ``keep_id`` is null if the whole group has none; extra columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm import bitmap
from panelcast.llm.common import table
from panelcast.llm.registry import query
from panelcast.session import materialize

FILTER_BITS = 1 << 26


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``; the largest id of equal texts stays."""
    digests = materialize(df.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256")), "dedup-digests")
    positions = [bitmap.position(F.xxhash64(F.lit(n), F.col("text_sha256")), filter_bits) for n in (0, 1)]
    hits = digests.select(F.explode(F.array(*positions)).alias("pos")).groupBy("pos").count().filter("count >= 2")
    words = materialize(bitmap.pack(hits, "pos"), "dedup-filter")
    probed = bitmap.with_hit(bitmap.with_hit(digests, words, positions[0], "_first"), words, positions[1], "_second")
    probed = probed.select("doc_id", "text_sha256", (F.col("_first") & F.col("_second")).alias("_maybe"))
    once = probed.filter(~F.col("_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                                  F.lit(True).alias("kept"), "text_sha256")
    # the rows that shuffle; written with a row number, so that of fully equal rows one can be told from the rest
    maybe = materialize(probed.filter("_maybe").select("doc_id", "text_sha256", F.monotonically_increasing_id().alias("_row")), "dedup-maybe")
    best = F.max(F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "_row")).alias("best")
    groups = materialize(maybe.groupBy("text_sha256").agg(best, F.count(F.lit(1)).alias("group_size")), "dedup-groups")
    # both sides are scans: a digest that a third of the rows share is split by the adaptive skew join
    again = maybe.join(groups, "text_sha256").select("doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
                                                     (F.col("_row") == F.col("best._row")).alias("kept"), "text_sha256")
    return once.unionByName(again)


@query("op3_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""")
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
