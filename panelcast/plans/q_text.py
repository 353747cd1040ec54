"""Text queries (T1-T13, O3, O4, F19, J16, A4) over documents, conversations and pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelcast.functions import strings as Sx
from panelcast.functions.calendar import floor_hour
from panelcast.functions.stopwords import CUSTOM_REPORT, ENGLISH, TRASH_MESSAGE, UKRAINIAN
from panelcast.operators import text as X
from panelcast.plans import driver as D
from panelcast.plans.registry import query
from panelcast.session import materialize, scratch_path
from panelcast.sources.tables import read_table

# Report vocabulary parameters (fixed values of the product's report vectoriser)
MAX_FEATURES, MIN_DF, MAX_DF, REPORT_NGRAMS = 5000, 5, 0.90, (1, 2)
CHAT_COMPONENTS = 250
CHAT_STOP = UKRAINIAN + TRASH_MESSAGE
SVD_COMPONENTS = 150
REPORT_STOP = ENGLISH + CUSTOM_REPORT
# Chat vocabulary parameters (fixed values of the product's message vectoriser)
CHAT_FEATURES, CHAT_MIN_DF, CHAT_MAX_DF, CHAT_NGRAMS = 10000, 5, 0.85, (2, 3)
MIN_TOKEN = 3

# Entity mention patterns for the landed conversations (stems drawn from the corpus; one with an
# exclusion look-ahead, like the product's pattern table), plus threat / all-clear patterns.
MESSAGE_PATTERNS = {0: "tion", 1: "eau", 2: "sch|tz", 3: "ment(?!e)", 4: "ier", 5: "ther", 6: "ción|ado", 7: "que"}
THREAT_PATTERN = "ing|ung|ente"
ALLCLEAR_PATTERN = "oui|ja"


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(set(words))) + "]"


def _clean_report_sql() -> str:
    x = "lower({t})"
    for pattern, to in Sx.REPORT_RULES:
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'g')"
    return f"trim(regexp_replace({x}, '{Sx.SPACES}', ' ', 'g'))"


CLEAN_REPORT_SQL = _clean_report_sql()
LEMMA_SQL = """CASE WHEN suffix(w, 'sses') THEN regexp_replace(w, 'sses$', 'ss')
  WHEN length(w) > 4 AND suffix(w, 'ies') THEN regexp_replace(w, 'ies$', 'y')
  WHEN length(w) > 5 AND suffix(w, 'ing') THEN regexp_replace(w, 'ing$', '')
  WHEN length(w) > 4 AND suffix(w, 'ed') THEN regexp_replace(w, 'ed$', '')
  WHEN length(w) > 3 AND suffix(w, 's') AND NOT suffix(w, 'ss') THEN regexp_replace(w, 's$', '')
  ELSE w END"""
RAW_WORDS_SQL = (f"list_filter(string_split({CLEAN_REPORT_SQL.format(t='text')}, ' '), lambda w: length(w) >= {MIN_TOKEN} "
                 f"AND NOT list_contains({_sql_list(REPORT_STOP)}, w))")
WORDS_SQL = f"list_transform({RAW_WORDS_SQL}, lambda w: {LEMMA_SQL})"


def vector_tokens_sql(words: str) -> str:
    return f"list_filter(flatten(list_transform({words}, lambda w: string_split(w, '-'))), lambda w: length(w) >= 2)"


@query("text_clean_report", covers="T2", sql=f"""
SELECT doc_id, md5(c) AS clean_md5, length(c) AS clean_len, len(list_filter(string_split(c, ' '), lambda w: w <> '')) AS n_tokens
FROM (SELECT doc_id, {CLEAN_REPORT_SQL.format(t='text')} AS c FROM documents)""")
def text_clean_report(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "text"])
    c = Sx.clean_report(F.col("text"))
    return d.select("doc_id", F.md5(c).alias("clean_md5"), F.length(c).cast("long").alias("clean_len"),
                    F.size(Sx.word_tokens(c)).cast("long").alias("n_tokens"))


MSG_CLEAN_SQL = ("list_filter(string_split(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), "
                 "'https?://[^ \\t\\n\\r]+', ' ', 'g'), '@[a-z0-9_]+', ' ', 'g'), '[^" + Sx.LETTERS + "\\- ]+', ' ', 'g'), "
                 "'[ \\t\\n\\r]+', ' ', 'g')), ' '), lambda w: length(w) >= 3)")


@query("text_clean_message", covers="T3", sql=f"""
SELECT conv_id, turn, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT conv_id, turn, {MSG_CLEAN_SQL} AS t FROM conversations)""")
def text_clean_message(spark, sf):
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    t = Sx.clean_message(F.col("text"))
    return c.select("conv_id", "turn", F.size(t).cast("long").alias("n_tokens"), F.md5(F.concat_ws(" ", t)).alias("tokens_md5"))


def report_docs(spark, sf):
    """Every document with its words: cleaned, without stop words, as lemmas."""
    return read_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", X.report_words(F.col("text"), REPORT_STOP, MIN_TOKEN).alias("words"))


@query("word_freq_top20", covers="T12 T4 T5 O3", sql=f"""
SELECT w AS token, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS w FROM documents)
GROUP BY w ORDER BY n DESC, token LIMIT 20""")
def word_freq_top20(spark, sf):
    t = report_docs(spark, sf).select(F.explode("words").alias("token"))
    return t.groupBy("token").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "token").limit(20)


@query("shortest_messages", covers="O3", sql="""
SELECT conv_id, turn, length(text) AS n_chars FROM conversations ORDER BY n_chars, conv_id, turn LIMIT 10""")
def shortest_messages(spark, sf):
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    return c.select("conv_id", "turn", F.length("text").cast("long").alias("n_chars")).orderBy("n_chars", "conv_id", "turn").limit(10)


@query("lemma_lookup", covers="T5", sql=f"""
SELECT lemma, count(*) AS n_forms, CAST(sum(n) AS BIGINT) AS n_tokens FROM (
  SELECT w, count(*) AS n, {LEMMA_SQL} AS lemma FROM (SELECT unnest({RAW_WORDS_SQL}) AS w FROM documents) GROUP BY w)
GROUP BY lemma""")
def lemma_lookup(spark, sf):
    words = X.remove_stopwords(Sx.word_tokens(Sx.clean_report(F.col("text"))), REPORT_STOP, MIN_TOKEN)
    toks = read_table(spark, sf, "documents", ["text"]).select(F.explode(words).alias("token"))
    lt = X.lemma_table(toks)
    return lt.groupBy("lemma").agg(F.count(F.lit(1)).alias("n_forms"), F.sum("n").alias("n_tokens"))


def _vocabulary_sql(min_df: int, max_df: float, features: int) -> str:
    return f"""tf AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(t) AS term FROM terms) GROUP BY 1, 2),
nd AS (SELECT count(*) AS n_docs FROM terms),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
vocab AS (SELECT term, df, cf, n_docs FROM st, nd WHERE df >= {min_df} AND df <= floor({max_df} * n_docs)
          ORDER BY cf DESC, term LIMIT {features})"""


def _grams_sql(n: int) -> str:
    joined = " || ' ' || ".join(f"toks[i + {d}]" for d in range(n))
    return f"list_transform(range(1, len(toks) - {n - 2}), lambda i: {joined})"


TERMS_SQL = f"""tk AS (SELECT doc_id AS id, {vector_tokens_sql(WORDS_SQL)} AS toks FROM documents),
terms AS (SELECT id, list_concat(toks, {_grams_sql(2)}) AS t FROM tk),
{_vocabulary_sql(MIN_DF, MAX_DF, MAX_FEATURES)}"""
CHAT_WORDS_SQL = f"list_filter(list_transform({MSG_CLEAN_SQL}, lambda w: {LEMMA_SQL}), lambda w: NOT list_contains({_sql_list(CHAT_STOP)}, w))"
CHAT_TERMS_SQL = f"""tk AS (SELECT conv_id * 1000 + turn AS id, {vector_tokens_sql(CHAT_WORDS_SQL)} AS toks FROM conversations),
terms AS (SELECT id, list_concat({_grams_sql(2)}, {_grams_sql(3)}) AS t FROM tk),
{_vocabulary_sql(CHAT_MIN_DF, CHAT_MAX_DF, CHAT_FEATURES)}"""


def report_terms(spark, sf):
    """(documents with their tokens, vocabulary of uni- and bigrams, document count)."""
    docs = report_docs(spark, sf).select("doc_id", X.vector_tokens(F.col("words")).alias("tokens"))
    # cleaned and tokenised once: the vocabulary and the weights read the written tokens
    docs = materialize(docs, "tokens")
    n_docs = read_table(spark, sf, "documents", ["doc_id"]).agg(F.count(F.lit(1)).alias("n_docs"))
    # bounded by MAX_FEATURES; written once, as the weights, their broadcast and the column count all read it
    return docs, materialize(X.vocabulary(docs, "tokens", n_docs, MAX_FEATURES, MIN_DF, MAX_DF, REPORT_NGRAMS), "vocabulary"), n_docs


def chat_terms(spark, sf):
    """(messages with their tokens, vocabulary of bi- and trigrams, message count): the chat path of the vectoriser."""
    msgs = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    words = X.message_words(Sx.clean_message(F.col("text")), CHAT_STOP)
    docs = msgs.select((F.col("conv_id") * 1000 + F.col("turn")).alias("msg_id"), X.vector_tokens(words).alias("tokens"))
    docs = materialize(docs, "chat-tokens")
    n_docs = read_table(spark, sf, "conversations", ["conv_id"]).agg(F.count(F.lit(1)).alias("n_docs"))
    return docs, materialize(X.vocabulary(docs, "tokens", n_docs, CHAT_FEATURES, CHAT_MIN_DF, CHAT_MAX_DF, CHAT_NGRAMS), "chat-vocabulary"), n_docs


WEIGHTS_SQL = """,
w AS (SELECT tf.id, tf.term, tf.tf * (ln((1 + v.n_docs) / (1 + v.df)) + 1) AS w FROM tf JOIN vocab v USING (term))"""


@query("ngram_vocab", covers="T6 T7", sql="WITH " + TERMS_SQL + """
SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocab""")
def ngram_vocab(spark, sf):
    _, v, _ = report_terms(spark, sf)
    return v.select("term", "df", "cf")


@query("tfidf_weights", covers="T8", sql="WITH " + TERMS_SQL + WEIGHTS_SQL + """
SELECT id AS doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w""")
def tfidf_weights(spark, sf):
    docs, v, _ = report_terms(spark, sf)
    return X.tfidf(docs, "doc_id", "tokens", v, REPORT_NGRAMS).select("doc_id", "term", D.r6("weight").alias("weight"))


@query("chat_tfidf", covers="T3 T4 T5 T6 T7 T8", sql="WITH " + CHAT_TERMS_SQL + WEIGHTS_SQL + """
SELECT id AS msg_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w""")
def chat_tfidf(spark, sf):
    docs, v, _ = chat_terms(spark, sf)
    return X.tfidf(docs, "msg_id", "tokens", v, CHAT_NGRAMS).select("msg_id", "term", D.r6("weight").alias("weight"))


@query("matrix_sparsity", covers="T11", sql="WITH " + TERMS_SQL + """,
nz AS (SELECT count(*) AS nnz FROM tf JOIN vocab USING (term))
SELECT nnz, n_docs AS rows, (SELECT count(*) FROM vocab) AS cols,
       round(1 - nnz / (n_docs * (SELECT count(*) FROM vocab)), 6) AS sparsity FROM nz, nd""")
def matrix_sparsity(spark, sf):
    docs, v, n_docs = report_terms(spark, sf)
    s = X.sparsity(X.tfidf(docs, "doc_id", "tokens", v, REPORT_NGRAMS), v, n_docs)
    return s.select("nnz", "rows", "cols", D.r6("sparsity").alias("sparsity"))


def fitted_topics(spark, sf):
    """(documents with tokens, place of the saved vectoriser, number of components, spectrum)."""
    docs, v, _ = report_terms(spark, sf)
    rows = materialize(X.tfidf_rows(docs, "doc_id", "tokens", v, REPORT_NGRAMS), "report-rows")
    loadings, spectrum = X.fit_topics(rows, v, SVD_COMPONENTS)
    path = X.save_vectoriser(v, loadings, scratch_path(spark, f"vectoriser/{uuid.uuid4().hex[:12]}"))
    return docs, path, len(loadings.first().vec), spectrum


@query("svd_topics", covers="T9 T10")
def svd_topics(spark, sf):
    """Topics of every document, by the saved and reread vectoriser."""
    docs, path, width, _ = fitted_topics(spark, sf)
    return X.project(spark, docs, "doc_id", "tokens", path, width, REPORT_NGRAMS)


@query("svd_loading_norms", covers="T9", sql="WITH " + TERMS_SQL + f"""
SELECT CAST(range AS INTEGER) AS topic, 1.0 AS norm FROM range({SVD_COMPONENTS}) WHERE range < (SELECT count(*) FROM vocab) - 1""")
def svd_loading_norms(spark, sf):
    """Every component's loadings have unit length (columns of V)."""
    _, path, _, _ = fitted_topics(spark, sf)
    long = spark.read.parquet(f"{path}/loadings").select(F.posexplode("vec").alias("topic", "x"))
    return long.groupBy("topic").agg(D.r6(F.sqrt(F.sum(F.col("x") * F.col("x")))).alias("norm"))


@query("svd_top_terms", covers="O4")
def svd_top_terms(spark, sf):
    _, path, _, _ = fitted_topics(spark, sf)
    return X.top_terms_per_component(spark.read.parquet(f"{path}/loadings"), 10)


@query("svd_variance", covers="T9")
def svd_variance(spark, sf):
    """Singular values of the report vectors and the share of the variance that their components explain."""
    return fitted_topics(spark, sf)[3]


@query("chat_topics", covers="T9 T10")
def chat_topics(spark, sf):
    """Topic vector of every chat message (``CHAT_COMPONENTS`` wide), by a vectoriser fitted on all messages, saved and reread."""
    docs, v, _ = chat_terms(spark, sf)
    loadings, _ = X.fit_topics(materialize(X.tfidf_rows(docs, "msg_id", "tokens", v, CHAT_NGRAMS), "chat-rows"), v, CHAT_COMPONENTS)
    path = X.save_vectoriser(v, loadings, scratch_path(spark, f"vectoriser/{uuid.uuid4().hex[:12]}"))
    return X.project(spark, docs, "msg_id", "tokens", path, len(loadings.first().vec), CHAT_NGRAMS)


MSG_HOUR_SQL = "date_trunc('hour', TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(conv_id % 720 AS BIGINT)) + to_minutes(CAST(turn AS BIGINT)))"


def messages(spark, sf):
    """Conversation turns as a message log (channel = role); ts = epoch + conv_id % 720 h + turn minutes."""
    c = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    ts = (F.lit(D.TOPIC_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(hours=F.pmod("conv_id", F.lit(720)).cast("int"))
          + F.make_dt_interval(mins=F.col("turn").cast("int")))
    return c.select("conv_id", "turn", F.col("role").alias("channel"), "text", ts.alias("ts"))


def _sig_sql():
    hit = " UNION ALL ".join(
        f"SELECT {e} AS entity_id, hour, has_threat, has_allclear FROM m WHERE regexp_matches(text, "
        f"'{p.replace('(?!e)', '([^e]|$)')}', 'i')" for e, p in MESSAGE_PATTERNS.items())
    return f"""WITH m AS (SELECT {MSG_HOUR_SQL} AS hour, text,
  CAST(regexp_matches(text, '{THREAT_PATTERN}', 'i') AS INTEGER) AS has_threat,
  CAST(regexp_matches(text, '{ALLCLEAR_PATTERN}', 'i') AS INTEGER) AS has_allclear FROM conversations),
h AS ({hit})
SELECT entity_id, hour, CAST(sum(has_threat) AS BIGINT) AS threat_count, CAST(sum(has_allclear) AS BIGINT) AS allclear_count,
       count(*) AS mention_count FROM h GROUP BY entity_id, hour"""


@query("signal_counts_by_entity", covers="F19 J16 A4 T13", sql=_sig_sql())
def signal_counts_by_entity(spark, sf):
    m = messages(spark, sf).withColumn("hour", floor_hour("ts"))
    hits = X.regex_signals(m, "text", MESSAGE_PATTERNS, THREAT_PATTERN, ALLCLEAR_PATTERN)
    out = X.signal_counts(hits, ["entity_id", "hour"])
    return out.select(F.col("entity_id").cast("int").alias("entity_id"), "hour",
                      F.col("threat_count").cast("long").alias("threat_count"),
                      F.col("allclear_count").cast("long").alias("allclear_count"), "mention_count")
