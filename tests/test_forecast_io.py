"""Forecast documents, model bundles and source-format round trips."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from panelcast.sources import files as Fi
from tests.conftest import SF_SMALL


def test_forecast_document_holds_a_day_for_every_entity(spark):
    a = E.queries()["forecast_json"](spark, SF_SMALL).toPandas()
    assert len(a) == 24 * 24 and a["proba"].between(0, 1).all() and a["city_name"].nunique() == 24
    assert ((a["proba"] >= a["threshold"] - 1e-4) == a["alarm"]).mean() > 0.99


def test_bundle_reloads_and_promotion_keeps_a_backup(spark):
    from panelcast.ml import bundle as B
    from panelcast.plans.q_models import fit_bundle, split_panel
    from panelcast.session import scratch_path

    x = split_panel(spark, SF_SMALL).cache()
    fitted = fit_bundle(x)
    base = scratch_path(spark, "test-bundles/" + dt.datetime.now().strftime("%H%M%S%f"))
    assert B.current_bundle(base, spark) is None
    for v in ("a", "b"):
        B.promote(B.save_bundle(fitted, f"{base}/{v}", spark), base, spark)
    assert B.history(base, spark) == [f"{base}/a", f"{base}/b"]
    again = B.current_bundle(base, spark)
    assert (again.threshold, again.features) == (fitted.threshold, fitted.features)
    part = x.filter(F.col("split") == "test")
    one, two = (B.score(b, part, ["entity_id", "hour"]).orderBy("entity_id", "hour").collect() for b in (fitted, again))
    assert one == two
    # a missing feature counts as 0, an extra one is ignored
    assert B.score(again, part.drop(again.features[0]).withColumn("other", F.lit(1)), ["hour"]).count() == part.count()
    x.unpersist()


def test_versioned_table_reads_the_last_published(spark):
    base = tempfile.mkdtemp(prefix="pc-ver-") + "/t"
    for v in ("1", "2"):
        Fi.write_versioned(spark.createDataFrame([(v,)], "v string"), base, v)
    assert Fi.read_versioned(spark, base).collect() == [("2",)]


def test_cp1251_semicolon_csv_roundtrip(spark):
    rows = [(1, "Київ; центр", 1.5), (2, "Львів", None)]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                           T.StructField("v", T.DoubleType())])
    df = spark.createDataFrame(rows, schema)
    path = tempfile.mkdtemp(prefix="pc-csv-") + "/out"
    Fi.write_csv(df, path, sep=";", encoding="cp1251")
    back = Fi.read_csv(spark, path, schema, sep=";", encoding="cp1251")
    assert sorted(back.collect()) == sorted(df.collect())


def test_path_date_pruning_and_latest(spark):
    df = spark.createDataFrame([("/x/2024-01-01/a.json",), ("/x/2024-01-05/b.json",), ("/x/nodate/c.json",)],
                               "file_path string")
    kept = {r[0] for r in Fi.prune_by_path_date(df, "2024-01-02", "2024-01-03").collect()}
    assert kept == {"/x/2024-01-01/a.json", "/x/nodate/c.json"}          # +-1 day slack, undated kept
    assert [r[0] for r in Fi.latest_file_rows(df).collect()] == ["/x/nodate/c.json"]


def test_html_main_text_rules(spark):
    body = "<p>" + "word " * 120 + "</p><p>short</p>"
    html = f"<html><head><title>A &amp; B</title><script>var x='<p>no</p>';</script></head><body><nav>menu</nav>" \
           f"<article><h1>h</h1>{body}</article></body></html>"
    df = spark.createDataFrame([(html,)], "html string")
    title, text, n = Fi.html_main_text(F.col("html"))
    r = df.select(title.alias("t"), text.alias("x"), n.alias("n")).first()
    assert r.t == "A & B" and r.n == 1 and r.x.startswith("word word") and "short" not in r.x
