"""Sources and sinks: text lines, ride lines, FAILFAST, tagged fan-out."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.sources import lines as L
from eventide.sources.rides import ride_events
from eventide.streaming import sinks


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_text_file_lines_parse_with_quarantine(spark):
    d = _local(scratch_path(spark, "lines"))
    os.makedirs(d)
    with open(f"{d}/part-0.txt", "w") as f:
        f.write("sensor_1,1663041358,35.8\n\nsensor_2,x,1.0\nsensor_3,1663041360\n")
    parsed = L.parse_lines(L.read_lines(spark, d), "sensor")
    good, bad = L.split_quarantine(parsed)
    assert [tuple(r) for r in good.collect()] == [("sensor_1", 1663041358, 35.8)]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["sensor_2,x,1.0", "sensor_3,1663041360"]


def test_failfast_raises(spark):
    df = spark.createDataFrame([("a,1,2.0",), ("b,zz,1.0",)], "value string")
    with pytest.raises(Exception):
        L.failfast(L.parse_lines(df, "sensor")).collect()


def test_ride_lines(spark):
    r = spark.createDataFrame([(7, True, datetime(2020, 1, 1, 12, 0, 0), -73.99, 40.75, -73.98, 40.76,
                                1, 2013000001, 2013000002)],
                              "ride_id long, is_start boolean, event_time timestamp, start_lon float, "
                              "start_lat float, end_lon float, end_lat float, passenger_cnt short, "
                              "taxi_id long, driver_id long")
    line = L.ride_line(r).first()["value"]
    assert line.startswith("7,START,2020-01-01T12:00:00Z,-73.99,40.75,")
    assert line.endswith(",1,2013000001,2013000002")


def test_ride_events_have_start_and_end(spark):
    r = ride_events(spark, "/root/testdata/sf0.001")
    counts = {row["is_start"]: row["n"] for row in
              r.groupBy("is_start").agg(F.count("*").alias("n")).collect()}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    with_lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet") \
                      .select("l_orderkey").distinct().count()
    assert counts == {True: orders, False: with_lines}


def test_fan_out_writes_each_tag(spark):
    base = scratch_path(spark, "fanout")
    df = spark.createDataFrame([("match", 1), ("unmatched", 2), ("match", 3)], "kind string, v long")
    sinks.fan_out("kind", {"match": f"{base}/m", "unmatched": f"{base}/u"})(df, 0)
    assert sorted(r["v"] for r in spark.read.parquet(f"{base}/m").collect()) == [1, 3]
    assert [r["v"] for r in spark.read.parquet(f"{base}/u").collect()] == [2]
