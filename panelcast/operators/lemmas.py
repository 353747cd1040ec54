"""Lemmas by longest suffix (T5), for languages without a morphology library.

Rules are induced from a table of (form, lemma) pairs: a pair says how many characters go and what is put in their place, for
every ending of the form that holds what goes and up to ``context`` characters before it.  The most frequent change of an ending wins.
The rules are a suffix trie as a table - a row per node, whose parent is the ending without its first character - and a node
that repeats its parent is left out.  Distinct tokens are looked up by one join per ending length; the longest match wins, and a pair's
own form before it.  Results are kept in a memo table, so a token is looked up once over all runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import materialize
from panelcast.sources.versioned import VersionedTable

CONTEXT = 3
LONGEST = 8
#: So many characters of a token stay at least.
MIN_STEM = 2


def induce_rules(pairs: DataFrame, context: int = CONTEXT, longest: int = LONGEST) -> DataFrame:
    """Rules ``lang, suffix, size, cut, add`` of pairs ``lang, form, lemma``: a token that ends in ``suffix`` loses its last
    ``cut`` characters and gets ``add``.  Ties go to the smaller cut, then to the smaller ending."""
    size = F.char_length("form")
    shorter = F.sequence(F.lit(1), F.least(size, F.char_length("lemma")))
    common = F.size(F.filter(shorter, lambda i: F.substr("form", F.lit(1), i) == F.substr("lemma", F.lit(1), i)))
    x = pairs.filter("lang IS NOT NULL AND form != '' AND lemma != ''").withColumn("_same", common)
    x = x.withColumn("cut", size - F.col("_same")).withColumn("add", F.substr("lemma", F.col("_same") + 1)).filter(F.col("cut") <= longest)
    ends = F.sequence(F.greatest(F.lit(1), F.col("cut")), F.least(size, F.greatest(F.lit(1), F.col("cut") + context), F.lit(longest)))
    x = x.withColumn("size", F.explode(ends)).withColumn("suffix", F.right("form", F.col("size")))
    n = x.groupBy("lang", "suffix", "size", "cut", "add").agg(F.count(F.lit(1)).alias("n"))
    best = n.groupBy("lang", "suffix", "size").agg(F.min(F.struct((-F.col("n")).alias("n"), "cut", "add")).alias("b"))
    rules = materialize(best.select("lang", "suffix", "size", "b.cut", "b.add"), "lemma-rules")
    parent = rules.select("lang", F.col("suffix").alias("_p"), "cut", "add")
    kept = rules.withColumn("_p", F.substr("suffix", F.lit(2))).join(parent, ["lang", "_p", "cut", "add"], "left_anti")
    return kept.select("lang", "suffix", "size", "cut", "add")


def lemmatise(tokens: DataFrame, rules: DataFrame, pairs: DataFrame, longest: int = LONGEST, min_stem: int = MIN_STEM) -> DataFrame:
    """``tokens`` (distinct ``lang, token``) plus ``lemma``: a pair's lemma, else by the longest rule that leaves
    ``min_stem`` characters, else the token itself."""
    own = pairs.groupBy(F.col("lang").alias("_g0"), F.col("form").alias("_s0")).agg(F.min("lemma").alias("_l0"))
    x = tokens.join(own, (F.col("lang") == F.col("_g0")) & (F.col("token") == F.col("_s0")), "left")
    size, found = F.char_length("token"), [F.col("_l0")]
    for k in range(longest, 0, -1):
        level = rules.filter(F.col("size") == k).select(F.col("lang").alias(f"_g{k}"), F.col("suffix").alias(f"_s{k}"),
                                                        F.col("cut").alias(f"_c{k}"), F.col("add").alias(f"_a{k}"))
        fits = (size >= k) & (size >= F.col(f"_c{k}") + min_stem)
        x = x.join(level, (F.col("lang") == F.col(f"_g{k}")) & (F.right("token", F.lit(k)) == F.col(f"_s{k}")) & fits, "left")
        found.append(F.concat(F.left("token", size - F.col(f"_c{k}")), F.col(f"_a{k}")))
    return x.select(*tokens.columns, F.coalesce(*found, F.col("token")).alias("lemma"))


def memo_table(spark, base: str, rules: DataFrame, pairs: DataFrame) -> VersionedTable:
    """The memo of these rules and pairs under ``base``: other rules have another memo."""
    sums = [t.agg(F.coalesce(F.sum(F.xxhash64(*t.columns).cast("decimal(38,0)")), F.lit(0)).cast("string")).first()[0]
            for t in (rules.select("lang", "suffix", "cut", "add"), pairs.select("lang", "form", "lemma"))]
    return VersionedTable(spark, f"{base.rstrip('/')}/rules={'_'.join(sums)}", "run")


def remembered_lemmas(tokens: DataFrame, rules: DataFrame, pairs: DataFrame, memo: VersionedTable) -> DataFrame:
    """:func:`lemmatise` for the tokens that ``memo`` lacks, which are added to it in one commit; the others are read from it."""
    keys = ["lang", "token"]
    known = memo.read().select(*keys) if memo.version() else None
    new = tokens.select(*keys)
    new = new if known is None else new.join(known, keys, "left_anti")
    solved = materialize(lemmatise(new, rules, pairs), "lemmas")
    if not solved.isEmpty():
        memo.upsert(solved.withColumn("run", F.lit(uuid.uuid4().hex)), keys)  # a folder of its own: nothing is written again
    if not memo.version():
        return tokens.withColumn("lemma", F.col("token"))
    # two runs at once may both have added a token: with the same rules, so with the same lemma
    return tokens.join(memo.read().select(*keys, "lemma").dropDuplicates(keys), keys)
