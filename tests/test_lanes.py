"""Lane agreement: a drained streaming query equals the batch
query restricted to what the final watermark has closed."""

from pyspark.sql import functions as F

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _max_ts(spark):
    return spark.read.parquet(f"{SF}/events.parquet").agg(F.max("ts")).first()[0]


def test_hourly_best_lanes_agree(spark):
    q = queries()
    batch = q["hourly_best_user"](spark, SF).filter(F.col("window_end") <= F.lit(_max_ts(spark)))
    stream = q["stream_hourly_best"](spark, SF)
    assert _rows(stream) == _rows(batch)


def test_fraud_lanes_agree(spark):
    q = queries()
    batch = q["fraud_alerts"](spark, SF).select("account_id", "event_id")
    stream = q["stream_fraud"](spark, SF).select("account_id", "event_id")
    assert _rows(stream) == _rows(batch)


def test_window_min_lanes_agree(spark):
    q = queries()
    assert _rows(q["stream_window_min_updates"](spark, SF)) == _rows(q["window_min_with_bounds"](spark, SF))


def test_rolling_best_lanes_agree(spark):
    q = queries()
    batch = q["rolling_hour_best"](spark, SF).filter(F.col("window_end") <= F.lit(_max_ts(spark)))
    assert _rows(q["stream_rolling_best"](spark, SF)) == _rows(batch)
