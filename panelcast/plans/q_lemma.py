"""Lemmas by longest suffix over the documents' words (T5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.functions import strings as Sx
from panelcast.functions.lemmas import pairs
from panelcast.operators import lemmas as L
from panelcast.plans.q_text import MSG_CLEAN_SQL
from panelcast.plans.registry import query
from panelcast.session import materialize, scratch_path
from panelcast.sources.tables import read_table

RULES_SQL = f"""pair(lang, form, lemma) AS (VALUES {", ".join("('%s', '%s', '%s')" % p for p in pairs())}),
c AS (SELECT *, list_max(list_filter(range(0, least(length(form), length(lemma)) + 1), lambda i: left(form, i) = left(lemma, i))) AS same FROM pair),
e AS (SELECT lang, form, length(form) - same AS cut, substr(lemma, same + 1) AS ending FROM c),
vote AS (SELECT lang, right(form, s.l) AS suffix, s.l AS size, cut, ending, count(*) AS n FROM e, range(1, {L.LONGEST + 1}) s(l)
  WHERE s.l >= cut AND s.l <= cut + {L.CONTEXT} AND s.l <= length(form) GROUP BY ALL),
rule AS (SELECT lang, suffix, size, cut, ending
  FROM (SELECT *, row_number() OVER (PARTITION BY lang, suffix ORDER BY n DESC, cut, ending) AS rn FROM vote) WHERE rn = 1)"""
TOKENS_SQL = f"""word AS (SELECT coalesce(lang, '') AS lang, unnest({MSG_CLEAN_SQL}) AS token FROM documents),
token AS (SELECT lang, token, count(*) AS n FROM word GROUP BY ALL)"""
WALK_SQL = f"""walk AS (
  SELECT lang, token, {L.LONGEST} AS size FROM token
  UNION ALL
  SELECT w.lang, w.token, w.size - 1 FROM walk w LEFT JOIN rule r ON r.lang = w.lang AND r.size = w.size AND r.suffix = right(w.token, w.size)
    AND length(w.token) >= w.size AND length(w.token) >= r.cut + {L.MIN_STEM}
  WHERE w.size > 0 AND r.suffix IS NULL),
stop AS (SELECT lang, token, min(size) AS size FROM walk GROUP BY ALL),
own AS (SELECT lang, form, min(lemma) AS lemma FROM pair GROUP BY ALL),
done AS (SELECT t.lang, t.token, t.n, coalesce(o.lemma, left(t.token, length(t.token) - r.cut) || r.ending, t.token) AS lemma
  FROM token t JOIN stop s USING (lang, token) LEFT JOIN own o ON o.lang = t.lang AND o.form = t.token
  LEFT JOIN rule r ON r.lang = t.lang AND r.size = s.size AND r.suffix = right(t.token, s.size))"""


def suffix_rules(spark):
    """(pairs, rules), written."""
    table = spark.createDataFrame(pairs(), "lang string, form string, lemma string")
    return table, materialize(L.induce_rules(table), "lemma-trie")


def document_tokens(spark, sf):
    """Distinct ``lang, token`` of the documents' words with their counts."""
    docs = read_table(spark, sf, "documents", ["lang", "text"])
    words = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.explode(Sx.clean_message(F.col("text"))).alias("token"))
    return words.groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))


@query("lemma_by_suffix", covers="T5", sql=f"""WITH RECURSIVE {RULES_SQL}, {TOKENS_SQL}, {WALK_SQL}
SELECT lang, lemma, count(*) AS n_forms, CAST(sum(n) AS BIGINT) AS n_tokens, count(*) FILTER (WHERE lemma != token) AS n_changed
FROM done GROUP BY lang, lemma""")
def lemma_by_suffix(spark, sf):
    """Every distinct word of the documents by the suffix rules of its language, through a memo table."""
    table, rules = suffix_rules(spark)
    memo = L.memo_table(spark, scratch_path(spark, f"lemma-memo/{uuid.uuid4().hex[:12]}"), rules, table)
    done = L.remembered_lemmas(materialize(document_tokens(spark, sf), "lemma-tokens"), rules, table, memo)
    return done.groupBy("lang", "lemma").agg(F.count(F.lit(1)).alias("n_forms"), F.sum("n").alias("n_tokens"),
                                             F.count_if(F.col("lemma") != F.col("token")).alias("n_changed"))
