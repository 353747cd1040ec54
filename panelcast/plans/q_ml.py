"""Evaluation and split queries (W15, W16, M2, M9-M13, M16) with exact SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelcast.ml import metrics as Mx
from panelcast.ml import split as Sp
from panelcast.plans import driver as D
from panelcast.plans.q_panel import lag_feature_block
from panelcast.plans.registry import query
from panelcast.plans.sqlfrag import PANEL, with_
from panelcast.sources.tables import read_table

# Score of the landed labels: a bounded function of document length (higher = longer)
SCORE_SCALE = 2000.0


def scored_labels(spark, sf):
    lab = read_table(spark, sf, "labels", ["doc_id", "quality"])
    docs = read_table(spark, sf, "documents", ["doc_id", "n_chars"])
    x = lab.join(docs, "doc_id")
    return x.select("doc_id", F.col("quality").alias("y"),
                    (F.col("n_chars") / (F.col("n_chars") + F.lit(SCORE_SCALE))).alias("score"))


SCORED_SQL = """sl AS (SELECT l.doc_id, l.quality AS y, d.n_chars / (d.n_chars + 2000.0) AS score
                FROM labels l JOIN documents d USING (doc_id))"""


@query("roc_auc", covers="M10", sql=with_(SCORED_SQL) + """
SELECT round((count(*) FILTER (WHERE a.score > b.score) + 0.5 * count(*) FILTER (WHERE a.score = b.score)) / count(*), 6)
       AS roc_auc
FROM sl a, sl b WHERE a.y = 1 AND b.y = 0""")
def roc_auc(spark, sf):
    return Mx.roc_auc(scored_labels(spark, sf)).select(D.r6("roc_auc").alias("roc_auc"))


@query("average_precision", covers="M11", sql=with_(SCORED_SQL, """
s AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM sl GROUP BY score),
c AS (SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM s)""") + """
SELECT round(sum(pos / (SELECT sum(y) FROM sl) * tp / (tp + fp)), 6) AS average_precision FROM c""")
def average_precision(spark, sf):
    return Mx.average_precision(scored_labels(spark, sf)).select(D.r6("average_precision").alias("average_precision"))


def _prf_sql(tp, fp, fn):
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0 END"
    return p, r


@query("threshold_sweep", covers="M9", sql=with_(SCORED_SQL, """
t AS (SELECT unnest([0.30, 0.35, 0.40, 0.45, 0.50, 0.55, 0.60, 0.65, 0.70]) AS threshold),
c AS (SELECT threshold, CAST(count(*) FILTER (WHERE score >= threshold AND y = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE score >= threshold AND y = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE score < threshold AND y = 1) AS DOUBLE) AS fn FROM t, sl GROUP BY threshold),
m AS (SELECT threshold, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
             CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM c),
f AS (SELECT threshold, p, r, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f1 FROM m)""") + """
SELECT CAST(threshold AS DOUBLE) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1,
       threshold = (SELECT threshold FROM f ORDER BY f1 DESC, threshold LIMIT 1) AS is_best FROM f""")
def threshold_sweep(spark, sf):
    t = Mx.threshold_sweep(scored_labels(spark, sf))
    return t.select("threshold", D.r6("precision").alias("precision"), D.r6("recall").alias("recall"),
                    D.r6("f1").alias("f1"), "is_best")


@query("classification_report", covers="M12", sql=with_(SCORED_SQL, """
c AS (SELECT CAST(count(*) FILTER (WHERE score >= 0.5 AND y = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE score >= 0.5 AND y = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE score < 0.5 AND y = 1) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE score < 0.5 AND y = 0) AS DOUBLE) AS tn FROM sl),
m AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
             CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0 FROM c),
g AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1,
             CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0, tp + fn AS s1, tn + fp AS s0,
             tp + fn + tn + fp AS n FROM m)""") + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
  SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM g
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM g
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM g
  UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM g
  UNION ALL SELECT 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM g
  UNION ALL SELECT 'confusion tn/fp/fn/tp', tn, fp, fn, tp FROM g)""")
def classification_report(spark, sf):
    x = scored_labels(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    r = Mx.classification_report(x)
    return r.select("label", D.r6("precision").alias("precision"), D.r6("recall").alias("recall"), D.r6("f1").alias("f1"),
                    "support")


@query("regression_metrics", covers="M13", sql=with_(SCORED_SQL) + """
SELECT round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
       round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 6) AS r2
FROM (SELECT y, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS p FROM sl)""")
def regression_metrics(spark, sf):
    x = scored_labels(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("double"))
    m = Mx.regression_metrics(x)
    return m.select(D.r6("mae").alias("mae"), D.r6("rmse").alias("rmse"), D.r6("r2").alias("r2"))


OLD_SCORE_SQL = "length(d.text) / (length(d.text) + 5000.0)"


@query("champion_gate", covers="M16 M17", sql=with_(SCORED_SQL, """
so AS (SELECT l.doc_id, l.quality AS y, """ + OLD_SCORE_SQL + """ AS score FROM labels l JOIN documents d USING (doc_id)),
apn AS (SELECT sum(pos / (SELECT sum(y) FROM sl) * tp / (tp + fp)) AS ap FROM (
  SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
  FROM (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM sl GROUP BY score))),
apo AS (SELECT sum(pos / (SELECT sum(y) FROM so) * tp / (tp + fp)) AS ap FROM (
  SELECT pos, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp
  FROM (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM so GROUP BY score))),
fn AS (SELECT 2.0 * count(*) FILTER (WHERE score >= 0.5 AND y = 1) / (count(*) FILTER (WHERE score >= 0.5) + sum(y)) AS f1 FROM sl),
fo AS (SELECT 2.0 * count(*) FILTER (WHERE score >= 0.5 AND y = 1) / (count(*) FILTER (WHERE score >= 0.5) + sum(y)) AS f1 FROM so)""") + """
SELECT round(apn.ap, 6) AS new_ap, round(apo.ap, 6) AS old_ap, round(fn.f1, 6) AS new_f1, round(fo.f1, 6) AS old_f1,
  CASE WHEN apn.ap > apo.ap + 1e-6 THEN true WHEN abs(apn.ap - apo.ap) <= 1e-6 AND fn.f1 >= fo.f1 - 1e-6 THEN true ELSE false END AS accepted
FROM apn, apo, fn, fo""")
def champion_gate(spark, sf):
    new = scored_labels(spark, sf)
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    old = (read_table(spark, sf, "labels", ["doc_id", "quality"]).join(docs, "doc_id")
           .select("doc_id", F.col("quality").alias("y"), (F.length("text") / (F.length("text") + F.lit(5000.0))).alias("score")))

    def f1_at(df):
        p = (F.col("score") >= 0.5)
        return df.agg((2.0 * F.count_if(p & (F.col("y") == 1)) / (F.count_if(p) + F.sum("y"))).alias("f1"))

    a = Mx.average_precision(new).select(F.col("average_precision").alias("new_ap"))
    b = Mx.average_precision(old).select(F.col("average_precision").alias("old_ap"))
    x = a.crossJoin(b).crossJoin(f1_at(new).withColumnRenamed("f1", "new_f1")).crossJoin(f1_at(old).withColumnRenamed("f1", "old_f1"))
    acc = Mx.champion_gate(F.col("new_ap"), F.col("old_ap"), F.col("new_f1"), F.col("old_f1"))
    return x.select(D.r6("new_ap").alias("new_ap"), D.r6("old_ap").alias("old_ap"), D.r6("new_f1").alias("new_f1"),
                    D.r6("old_f1").alias("old_f1"), acc.alias("accepted"))


@query("chrono_split", covers="W15", sql=with_(PANEL) + """
SELECT entity_id, hour, CASE WHEN rn < floor(n * 0.70) THEN 'train' WHEN rn < floor(n * 0.85) THEN 'valid' ELSE 'test' END AS split
FROM (SELECT entity_id, hour, row_number() OVER (ORDER BY hour, entity_id) - 1 AS rn, count(*) OVER () AS n FROM panel)""")
def chrono_split(spark, sf):
    p = D.hourly_panel(spark, sf).select("entity_id", "hour")
    return Sp.chronological_split(p, "hour", "entity_id").select("entity_id", "hour", "split")


@query("expanding_folds", covers="W16", sql=with_(PANEL, """
r AS (SELECT entity_id, hour, y, row_number() OVER (ORDER BY hour, entity_id) - 1 AS rn, count(*) OVER () AS n FROM panel),
tr AS (SELECT *, CAST(floor(n * 0.70) AS BIGINT) AS ntr FROM r WHERE rn < floor(n * 0.70)),
f AS (SELECT *, ntr // 4 AS size, ntr - (ntr // 4) * 3 AS first_test FROM tr)""") + """
SELECT CAST(fold AS INTEGER) AS fold, CAST(any_value(first_test + fold * size) AS BIGINT) AS n_train_rows, count(*) AS n_test_rows,
       CAST(sum(y) AS BIGINT) AS test_positives, min(hour) AS test_start, max(hour) AS test_end
FROM (SELECT *, (rn - first_test) // size AS fold FROM f WHERE rn >= first_test) GROUP BY fold""")
def expanding_folds(spark, sf):
    p = D.hourly_panel(spark, sf).select("entity_id", "hour", "y")
    x = Sp.chronological_split(p, "hour", "entity_id").filter(F.col("split") == "train")
    ntr = x.agg(F.count(F.lit(1)).alias("_ntr"))
    f = Sp.expanding_folds(x.crossJoin(F.broadcast(ntr)), "_ntr", 3).filter(F.col("test_fold").isNotNull())
    first_test = F.col("_ntr") - F.col("fold_size") * 3
    return f.groupBy(F.col("test_fold").alias("fold")).agg(
        F.first(first_test + F.col("test_fold") * F.col("fold_size")).cast("long").alias("n_train_rows"),
        F.count(F.lit(1)).alias("n_test_rows"), F.sum("y").cast("long").alias("test_positives"),
        F.min("hour").alias("test_start"), F.max("hour").alias("test_end"))


@query("class_weights", covers="M2", sql=with_(PANEL, """
c AS (SELECT y, count(*) AS n_c FROM panel GROUP BY y)""") + """
SELECT y, n_c, round((SELECT sum(n_c) FROM c) / ((SELECT count(*) FROM c) * n_c), 6) AS weight,
       round((SELECT sum(n_c) FILTER (WHERE y = 0) FROM c) / (SELECT sum(n_c) FILTER (WHERE y = 1) FROM c), 6) AS scale_pos_weight
FROM c""")
def class_weights(spark, sf):
    w = Sp.class_weights(D.hourly_panel(spark, sf).select("y"))
    return w.select("y", "n_c", D.r6("weight").alias("weight"), D.r6("scale_pos_weight").alias("scale_pos_weight"))
