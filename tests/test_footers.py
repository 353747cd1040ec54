"""The maximum of a key from Parquet footers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.sources import tables as Tb
from tests.conftest import SF_SMALL

EVENTS = f"{SF_SMALL}/events.parquet"


def test_the_plan_answers_from_footers(spark):
    schema = spark.read.parquet(EVENTS).schema
    with Tb.footer_aggregates(spark):
        plan = Tb.footer_max(spark, EVENTS, schema, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(ts)]" in plan
    assert "BatchScan" not in spark.read.parquet(EVENTS)._jdf.queryExecution().executedPlan().toString()  # other reads are as before


@pytest.mark.parametrize("col", ["ts", "event_id", "event_type", "value"])
def test_same_value_as_a_scan(spark, col):
    df = spark.read.parquet(EVENTS)
    assert Tb.max_key_at(spark, EVENTS, col).collect() == Tb.max_key(df, col).collect()
    assert Tb.max_key_at(spark, EVENTS, col).schema == Tb.max_key(df, col).schema


@pytest.mark.parametrize("unit", ["INT96", "TIMESTAMP_MICROS", "TIMESTAMP_MILLIS"])
def test_other_units_and_missing_statistics(spark, tmp_path, unit):
    """INT96 has no statistics and milliseconds are another number: the value is that of a scan."""
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(50)] + [(None, None)]
    df = spark.createDataFrame(rows, "n int, ts timestamp")
    spark.conf.set("spark.sql.parquet.outputTimestampType", unit)
    try:
        df.repartition(3).write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    assert Tb.max_key_at(spark, str(tmp_path / "t"), "ts").first()[0] == rows[49][1]
    assert Tb.max_key_at(spark, str(tmp_path / "t"), "n").first()[0] == 49


def test_nulls_only_empty_and_nested(spark, tmp_path):
    spark.createDataFrame([(None, 1), (None, 2)], "a long, b long").write.parquet(str(tmp_path / "nulls"))
    assert Tb.max_key_at(spark, str(tmp_path / "nulls"), "a").first()[0] is None
    spark.createDataFrame([], "a long").write.parquet(str(tmp_path / "empty"))
    assert Tb.max_key_at(spark, str(tmp_path / "empty"), "a").first()[0] is None
    nested = spark.range(9).select(F.struct("id", F.lit("x").alias("s")).alias("p"), (F.col("id") * 2).alias("k"))
    nested.write.parquet(str(tmp_path / "nested"))
    assert Tb.max_key_at(spark, str(tmp_path / "nested"), "k").first()[0] == 16
