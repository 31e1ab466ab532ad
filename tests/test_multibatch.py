"""The streaming queries over several files, one micro-batch each, equal their oracles."""

import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from eventide.operators import topn, windows
from eventide.sources import lines as L
from eventide.sources.tables import FILES_PER_TRIGGER, streaming_events
from eventide.streaming import sinks
from eventide.streaming.runner import drain
from test_oracle import digest

SF = "/root/testdata/sf0.001"
STREAMS = ["stream_hourly_best", "stream_top3", "stream_top3_gathered", "stream_window_min_updates", "stream_fraud", "stream_silence_1h",
           "stream_pseudo_window", "stream_match", "stream_unmatched", "stream_sessions", "stream_key_count", "stream_rolling_best"]


def write_parts(con, folder, queries_):
    """One file per query, with rising modification times (the order of the stream)."""
    os.makedirs(folder)
    now = time.time() - 1000
    for i, q in enumerate(queries_):
        path = f"{folder}/part-{i:03d}.parquet"
        con.execute(f"COPY ({q}) TO '{path}' (FORMAT parquet)")
        os.utime(path, (now + i, now + i))


@pytest.fixture(scope="module")
def parts(tmp_path_factory):
    """``events`` in five files in time order, rows shuffled inside a file; one user is silent in the middle."""
    root = str(tmp_path_factory.mktemp("parts"))
    con = duckdb.connect()
    con.execute(f"CREATE TABLE src AS SELECT *, ntile(5) OVER (ORDER BY ts, event_id) AS part FROM '{SF}/events.parquet'")
    con.execute("DELETE FROM src WHERE part IN (2, 3) AND user_id = (SELECT min(user_id) FROM src)")
    write_parts(con, f"{root}/events.parquet",
                [f"SELECT * EXCLUDE part FROM src WHERE part = {i} ORDER BY hash(event_id)" for i in range(1, 6)])
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{root}/events.parquet/*.parquet'")
    return root, con


@pytest.mark.parametrize("name", STREAMS)
def test_one_file_per_batch(spark, parts, name):
    root, con = parts
    spark.conf.set(FILES_PER_TRIGGER, "1")
    try:
        got = queries()[name](spark, root).toPandas()
    finally:
        spark.conf.unset(FILES_PER_TRIGGER)
    want = con.execute(oracle_sql()[name]).df()
    assert len(got) == len(want) and digest(got) == digest(want)


def test_silence_is_told_once(spark, tmp_path):
    """One file per row: a key that comes back after its timer has fired is not told twice."""
    con = duckdb.connect()
    rows = [(7, 0), (8, 5), (8, 6), (7, 10), (8, 20)]
    write_parts(con, f"{tmp_path}/events.parquet", [
        f"SELECT {i}::BIGINT event_id, TIMESTAMP '2024-01-01' + INTERVAL {h} HOUR ts, {u}::BIGINT user_id, 'x' event_type, 1.0::DOUBLE AS value"
        for i, (u, h) in enumerate(rows)])
    spark.conf.set(FILES_PER_TRIGGER, "1")
    try:
        got = queries()["stream_silence_1h"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset(FILES_PER_TRIGGER)
    assert sorted((r["user_id"], r["count"], r["last_modified"].hour) for r in got) == [(7, 1, 0), (7, 2, 10), (8, 2, 6)]


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    """A named query finds its checkpoint again: no row is lost or doubled."""
    con = duckdb.connect()
    row = "SELECT {0}::BIGINT event_id, TIMESTAMP '2024-01-01' + INTERVAL {0} MINUTE ts, 1::BIGINT user_id, 'x' event_type, 1.0::DOUBLE AS value"
    folder, out, name = f"{tmp_path}/events.parquet", f"{tmp_path}/out", f"restart-{time.time_ns()}"
    write_parts(con, folder, [row.format(i) for i in range(3)])
    for total in (3, 5):
        q = sinks.start(streaming_events(spark, str(tmp_path)).select("event_id"), name, "parquet", path=out, trigger=None)
        q.awaitTermination()
        assert sorted(r[0] for r in spark.read.parquet(out).collect()) == list(range(total))
        for i in range(total, 5):
            con.execute(f"COPY ({row.format(i)}) TO '{folder}/part-{i:03d}.parquet' (FORMAT parquet)")


def test_drain_without_rows_and_with_errors(spark, tmp_path):
    write_parts(duckdb.connect(), f"{tmp_path}/events.parquet",
                ["SELECT 1::BIGINT event_id, TIMESTAMP '2024-01-01' ts, 1::BIGINT user_id, 'x' event_type, 1.0::DOUBLE AS value"])
    e = streaming_events(spark, str(tmp_path))
    none = drain(e.filter("event_id > 5"), "none")
    assert none.count() == 0 and none.columns == e.columns

    def broken(batch_df, batch_id):
        raise RuntimeError("broken step")
    with pytest.raises(Exception, match="broken step"):
        drain(e, "broken", batch_fn=broken)


def test_raw_aggregates(spark):
    df = spark.createDataFrame([(1, 0.001), (1, 0.002), (2, -0.5), (2, None), (3, None)], "user_id long, value double").withColumn(
        "ts", F.timestamp_seconds(F.lit(10)))
    means = {r["user_id"]: r["avg_value"] for r in windows.window_mean(df, "user_id", "value", "1 minute").collect()}
    assert means[1] == pytest.approx(0.0015) and means[2] == -0.5 and means[3] is None
    sums = {r["user_id"]: r["total"] for r in windows.window_sum(df, "user_id", "value", "1 minute").collect()}
    assert sums[1] == pytest.approx(0.003)
    text = spark.createDataFrame([(-1.0, 2), (-0.00001, 3), (10.0, 3), (0.00005, 1)], "total double, n long")
    assert [r[0] for r in text.select(topn.fixed4("total", "n")).collect()] == ["-0.5000", "0.0000", "3.3333", "0.0001"]


def test_line_fields(spark):
    money = spark.createDataFrame([(-1.5,), (-0.001,), (2.345,), (-12.0,)], "v double").select(L.money_text(F.col("v")))
    assert [r[0] for r in money.collect()] == ["-1.50", "0.00", "2.35", "-12.00"]
    df = spark.createDataFrame([("a", None, 2.0)], "a string, b long, c double")
    assert L.render_lines(df, ["a", "b", "c"]).first()[0] == "a,,2.0"
    raw = spark.createDataFrame([("s1,5,1.5,",), ("s1,5,1.5,x,y",), ("\t",), (None,), ("s1,5",), ("s1,b,1",)], "value string")
    good, bad = L.split_quarantine(L.parse_lines(raw, "sensor"))
    assert good.count() == 2 and sorted(r[0] for r in bad.select("_corrupt_record").collect()) == ["s1,5", "s1,b,1"]
    at = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:01.250' AS a, TIMESTAMP '2024-01-01 00:00:01' AS b")
    assert tuple(at.select(L.instant("a"), L.instant("b")).first()) == ("2024-01-01T00:00:01.250Z", "2024-01-01T00:00:01Z")


def test_console_and_caller_sinks(spark, tmp_path):
    """SNK-1, SNK-3: the console, and a function of the caller's that gets every batch."""
    write_parts(duckdb.connect(), f"{tmp_path}/events.parquet", [
        f"SELECT {i}::BIGINT event_id, TIMESTAMP '2024-01-01' ts, 1::BIGINT user_id, 'x' event_type, 1.0::DOUBLE AS value" for i in range(3)])
    e = streaming_events(spark, str(tmp_path), 1).select("event_id")
    got = []
    for sink in ("console", lambda batch, batch_id: got.append((batch_id, batch.collect()[0][0]))):
        q = sinks.start(e, f"sink-{time.time_ns()}", sink, trigger=None)
        q.awaitTermination()
        assert q.exception() is None and q.lastProgress.numInputRows == 1
    assert got == [(0, 0), (1, 1), (2, 2)]
