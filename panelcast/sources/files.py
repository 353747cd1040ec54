"""File sources and sinks (S1-S8, S13-S16) and HTML extraction.

Readers always take an explicit schema (no inference jobs), use ``_metadata.file_path`` for
path-derived columns, and prune by path date with a filter that Spark applies per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import path_exists

_POINTER = "n long, path string"
DATE_IN_PATH = r"(\d{4}-\d{2}-\d{2})"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", encoding: str = "utf-8") -> DataFrame:
    """CSV with header, explicit schema, separator and encoding (e.g. ';' and cp1251)."""
    return (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "utf-8") -> None:
    """CSV sink."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", encoding).csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """JSON records (or one JSON array per file with ``multiline``) under a folder tree, with the
    source file path as a column."""
    df = (spark.read.option("multiLine", multiline).option("recursiveFileLookup", True).schema(schema).json(path))
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def path_date(c: Column | str = "file_path") -> Column:
    """The first YYYY-MM-DD in a path as a DATE (NULL when there is none)."""
    s = F.regexp_extract(F.col(c) if isinstance(c, str) else c, DATE_IN_PATH, 1)
    return F.when(s != "", F.try_to_date(s, "yyyy-MM-dd"))      # invalid dates -> NULL


def prune_by_path_date(df: DataFrame, start: str, end: str, c: str = "file_path", slack_days: int = 1) -> DataFrame:
    """Keep files whose path date is within [start - slack, end + slack], or that carry no date."""
    d = path_date(c)
    lo = F.date_sub(F.lit(start).cast("date"), slack_days)
    hi = F.date_add(F.lit(end).cast("date"), slack_days)
    return df.filter(d.isNull() | d.between(lo, hi))


def latest_file_rows(df: DataFrame, c: str = "file_path") -> DataFrame:
    """Rows of the last file in path order (a one-row scalar joined back)."""
    mx = df.agg(F.max(c).alias("_latest"))
    return df.join(F.broadcast(mx), F.col(c) == F.col("_latest"), "left_semi")


def write_partitioned_json(df: DataFrame, path: str, parts: list[str]) -> None:
    """Snapshot sink ``<path>/<k1>=../<k2>=../part-*.json``."""
    df.write.mode("overwrite").partitionBy(*parts).json(path)


def write_versioned(df: DataFrame, base: str, version: str) -> str:
    """Write a complete new version, then publish it by adding a pointer row last.

    Pointers are only ever appended (numbered from 1), never replaced, so a reader always finds a complete one; the
    highest number is current.
    """
    target = f"{base}/v={version}"
    df.write.mode("overwrite").parquet(target)
    spark, pointers = df.sparkSession, f"{base}/_pointers"
    last = spark.read.schema(_POINTER).json(pointers).agg(F.max("n")).first()[0] if path_exists(spark, pointers) else None
    spark.createDataFrame([((last or 0) + 1, target)], _POINTER).write.mode("append").json(pointers)
    return target


def read_versioned(spark: SparkSession, base: str) -> DataFrame:
    current = spark.read.schema(_POINTER).json(f"{base}/_pointers").agg(F.max(F.struct("n", "path")).alias("p")).first()["p"]
    return spark.read.parquet(current.path)


# ------------------------------------------------------------------------------- HTML

def unescape(c: Column) -> Column:
    """The common HTML entities, single pass semantics (&amp; last)."""
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", " "), r"\s+", " "))


def html_main_text(html: Column, min_block: int = 30, min_total: int = 500):
    """(title, main text, n_blocks): scripts/styles/comments removed, main container by priority
    (article > main > body), paragraph blocks shorter than ``min_block`` dropped, and the text kept only
    when it reaches ``min_total`` characters."""
    clean = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    title = strip_tags(unescape(F.regexp_extract(clean, r"(?s)<title[^>]*>(.*?)</title>", 1)))
    art = F.regexp_extract(clean, r"(?s)<article[^>]*>(.*?)</article>", 1)
    main = F.regexp_extract(clean, r"(?s)<main[^>]*>(.*?)</main>", 1)
    body = F.regexp_extract(clean, r"(?s)<body[^>]*>(.*?)</body>", 1)
    container = F.when(art != "", art).when(main != "", main).otherwise(body)
    blocks = F.transform(F.regexp_extract_all(container, F.lit(r"(?s)<p[^>]*>(.*?)</p>"), 1),
                         lambda b: strip_tags(unescape(b)))
    kept = F.filter(blocks, lambda b: F.length(b) >= min_block)
    text = F.array_join(kept, "\n")
    return title, F.when(F.length(text) >= min_total, text), F.size(kept)


MONTHS = {"January": 1, "February": 2, "March": 3, "April": 4, "May": 5, "June": 6, "July": 7, "August": 8,
          "September": 9, "October": 10, "November": 11, "December": 12}
TITLE_DATE = r"(January|February|March|April|May|June|July|August|September|October|November|December) (\d{1,2}),? (\d{4})"


def title_date(c: Column) -> Column:
    """'Month D, YYYY' in a title -> DATE (month-name map literal + make_date)."""
    m = F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])
    mon = m[F.regexp_extract(c, TITLE_DATE, 1)]
    day = F.regexp_extract(c, TITLE_DATE, 2)
    year = F.regexp_extract(c, TITLE_DATE, 3)
    return F.when(day != "", F.try_make_date(year.cast("int"), mon, day.cast("int"))) \
        if hasattr(F, "try_make_date") else F.when(day != "", F.make_date(year.cast("int"), mon, day.cast("int")))
