"""Parquet scans of the landed tables.

Readers return lazy DataFrames; column projection and predicates written downstream reach the
Parquet scan (``ReadSchema`` / ``PushedFilters`` in the plan), so callers never pre-load.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime, timedelta

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None,
               where: Column | None = None, partitions: int | None = None) -> DataFrame:
    """Parquet scan with projection and pushdown.

    The number of splits follows ``spark.sql.files.maxPartitionBytes`` and the files' row groups; a caller that
    knows better passes ``partitions`` (a plain ``repartition`` behind the pruned scan).
    """
    df = spark.read.parquet(table_path(sf_dir, name))
    if where is not None:
        df = df.filter(where)
    if columns:
        df = df.select(*columns)
    return df.repartition(partitions) if partitions else df


def read_range(df: DataFrame, ts_col: str, lo, hi, key_cols: list[str] | None = None) -> DataFrame:
    """Inclusive time-range scan; rows with null keys are dropped."""
    out = df.filter(F.col(ts_col).between(F.lit(lo), F.lit(hi)))
    for k in key_cols or []:
        out = out.filter(F.col(k).isNotNull())
    return out


def read_tail(df: DataFrame, ts_col: str, hours: int, strict: bool = False) -> DataFrame:
    """The last ``hours`` hours relative to the table's own max timestamp.

    The max is read first (one aggregate over one column, a scalar), so the cut is a literal: the filter reaches
    the scan and row groups older than the tail are skipped.  An empty table has an empty tail.
    """
    latest = df.agg(F.max(ts_col)).first()[0]
    if latest is None:
        return df.filter(F.lit(False))
    cut = F.lit(latest - timedelta(hours=hours)).cast(df.schema[ts_col].dataType)
    return df.filter(F.col(ts_col) > cut if strict else F.col(ts_col) >= cut)


def max_key(df: DataFrame, col: str) -> DataFrame:
    """One-row max probe: an aggregate over a scan of this one column."""
    return df.agg(F.max(col).alias(f"max_{col}"))


# ------------------------------------------------------------------ S12 from footers

_V1_SOURCES, _PUSH = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


@contextmanager
def footer_aggregates(spark: SparkSession):
    """Within it, Parquet is read by the scan that answers MIN and MAX from footer statistics."""
    v1, push = spark.conf.get(_V1_SOURCES), spark.conf.get(_PUSH)
    spark.conf.set(_V1_SOURCES, ",".join(x for x in v1.split(",") if x.strip() != "parquet"))
    spark.conf.set(_PUSH, "true")
    try:
        yield
    finally:
        spark.conf.set(_V1_SOURCES, v1)
        spark.conf.set(_PUSH, push)


def footer_max(spark: SparkSession, path: str, schema: T.StructType, col: str) -> DataFrame:
    """MAX of a column by footers (inside :func:`footer_aggregates`); timestamps are read as their stored number, since only
    numbers and dates are answered by footers.  The other columns stay in the schema, as statistics are found by position."""
    number = lambda f: T.LongType() if f.name == col and isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f.dataType
    flat = T.StructType([T.StructField(f.name, number(f)) for f in schema])
    return spark.read.schema(flat).parquet(path).agg(F.max(col).alias("m"))


def _bound(spark: SparkSession, path: str, schema: T.StructType, col: str) -> Column | None:
    """A literal from the footers that the largest value should equal, or None if they don't tell."""
    kind = schema[col].dataType
    before = [f.dataType for f in schema][: schema.names.index(col)]
    if not isinstance(kind, (*_IN_FOOTERS, T.TimestampType, T.TimestampNTZType)) or any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in before):
        return None  # a nested column before it has several leaves: positions don't match
    try:
        with footer_aggregates(spark):
            m = footer_max(spark, path, schema, col).first()[0]
    except (PySparkException, Py4JError):  # a file without statistics or with other columns; what is really broken fails again in the scan
        return None
    if m is None:
        return None
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(m))
    if isinstance(kind, T.TimestampNTZType):
        try:
            return F.lit(datetime(1970, 1, 1) + timedelta(microseconds=m)).cast(kind)
        except OverflowError:  # stored in another unit
            return None
    return F.lit(m).cast(kind)


def max_key_at(spark: SparkSession, path: str, col: str) -> DataFrame:
    """One-row max probe (``max_<col>``) of the Parquet files at ``path``, from their footers.

    The footers' value cuts a scan of this one column to the row groups that reach it, and the maximum is taken there: it is
    exact whatever the footers say (another unit, another column order).  Where they say nothing, or nothing reaches their value,
    the column is scanned.
    """
    df = spark.read.parquet(path)
    bound = _bound(spark, path, df.schema, col)
    if bound is not None:
        found = df.filter(F.col(col) >= bound).agg(F.max(col).alias("m")).first()[0]
        if found is not None:
            return spark.createDataFrame([(found,)], T.StructType([T.StructField(f"max_{col}", df.schema[col].dataType)]))
    return max_key(df, col)
