"""A corpus pipeline of five stages over ``documents``; each stage works on all that its predecessor kept.

1. toxicity: documents scored 0.7 or more go.
2. line dedup: lines within one edit of an earlier line go; a document that lost lines and has no word left goes.
3. n-gram Jaccard join: of each class of near-duplicate texts one document stays.
4. mixing: documents are repeated or left out until the sources have their target weights.
5. byte-level BPE: ids of every text, and a check that they decode to it.

All but the last stage return the columns of ``documents``; ``n_chars`` follows the text.  Every stage first releases the shuffle
files of those before it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import byte_bpe, line_dedup, mixing, ngram_join, toxicity
from panelcast.llm.common import WORD
from panelcast.session import release_shuffles, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(spark, docs, sf_dir)
    return scored.filter(F.col("score") < toxicity.LEAST_SCORE).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_shuffles(spark)
    done = line_dedup.line_dedup(docs.select(*COLUMNS))
    left = done.filter((F.col("n_removed") == 0) | F.col("kept_text").rlike(WORD))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = left.withColumn("text", text).withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_shuffles(spark)
    return ngram_join.near_dedup(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release_shuffles(spark)
    return mixing.mix_sources(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    release_shuffles(spark)
    done = byte_bpe.round_trip_digests(docs.select(*COLUMNS), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    same = F.col("decoded_sha256") == F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return done.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256", same.alias("round_trip"))


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines), ("n-gram Jaccard join", keep_one_of_near),
          ("mixing sources to target weights", mix), ("byte-level BPE encoding and decoding", encode)]

ORACLE_SQL = None  # nearest neighbours, edit distances and tokens: tested against plain Python versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if n + 1 == len(STAGES):
            return done
        path = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}/{n}")
        done.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
