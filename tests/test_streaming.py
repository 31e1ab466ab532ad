"""Streaming lane over several micro-batches (one file per trigger)."""

import os
import time

import pandas as pd
from pyspark.sql import functions as F

from eventide.session import scratch_path
from eventide.streaming import jobs, sinks
from eventide.streaming.runner import advance, drain


def _files(spark, name, batches, schema):
    """Write each batch as its own parquet file, oldest first."""
    base = scratch_path(spark, name)
    if base.startswith("file:"):
        base = base[len("file:"):]
    os.makedirs(base)
    now = time.time() - 100
    for i, rows in enumerate(batches):
        p = f"{base}/part-{i:03d}.parquet"
        pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]).to_parquet(p)
        os.utime(p, (now + i, now + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(base)


def test_late_splitter_across_batches(spark):
    b = [[(0, "s1", 1663041358000, 35.8), (1, "s2", 1663041360000, 15.4),
          (2, "s1", 1663041361000, 24.0), (3, "s1", 1663041362000, 20.5)],
         [(4, "s1", 1663041356000, 20.5), (5, "s1", 1663041300000, 24.0)],
         [(6, "s1", 1663041299000, 24.0), (7, "s1", 1663041280000, 24.0)]]
    s = _files(spark, "late-src", b, "event_id long, id string, t_ms long, temperature double")
    base = scratch_path(spark, "late-out")
    split = sinks.late_splitter(f"{base}/state", f"{base}/main", f"{base}/late",
                                15000, 2000, 60000)
    q = s.writeStream.foreachBatch(split).option("checkpointLocation", f"{base}/ckpt") \
         .trigger(availableNow=True).start()
    q.awaitTermination()
    late = sorted(r["event_id"] for r in spark.read.parquet(f"{base}/late").collect())
    main = sorted(r["event_id"] for r in spark.read.parquet(f"{base}/main").collect())
    assert late == [6, 7]
    assert main == [0, 1, 2, 3, 4, 5]


def test_silence_timer_fires_in_later_batch(spark):
    t0 = 1_600_000_000_000          # event time 0 would sit on the initial watermark
    b = [[(0, 1, t0), (1, 1, t0 + 30_000), (2, 1, t0 + 90_000)],
         [(3, 1, t0 + 151_000)],
         [(4, 2, t0 + 300_000)]]
    s = _files(spark, "silence-src", b, "event_id long, user_id long, t_ms long")
    s = s.withColumn("ts", F.timestamp_millis("t_ms"))
    out = drain(jobs.silence(s, 60_000), "silence-multi")
    got = sorted((r["user_id"], r["count"], r["last_ms"] - t0) for r in out.collect())
    assert got == [(1, 3, 90_000), (1, 4, 151_000)]


def test_match_timeout_across_batches(spark):
    t0 = 1_600_000_000_000
    b = [[(1, 0, "ride", t0)],
         [(1, 1, "fare", t0 + 30_000), (1, 2, "ride", t0 + 40_000)],
         [(1, 3, "fare", t0 + 200_000)],
         [(2, 4, "ride", t0 + 400_000)]]
    s = _files(spark, "match-src", b, "user_id long, event_id long, side string, t_ms long")
    s = s.withColumn("ts", F.timestamp_millis("t_ms"))
    out = drain(jobs.one_to_one(s, 60_000), "match-multi").collect()
    matches = sorted((r["ride_event_id"], r["fare_event_id"]) for r in out if r["kind"] == "match")
    unmatched = sorted((r["event_id"], r["reason"]) for r in out if r["kind"] == "unmatched")
    assert matches == [(0, 1)]
    assert unmatched == [(2, "timeout"), (3, "timeout")]


def test_f7_long_rides_streaming_forms(spark):
    """F7 through both streaming forms: the exact keyed state machine and the
    left-outer interval join (a far later ride moves the watermark)."""
    H = 3_600_000
    t0 = 1_600_000_000_000
    rides = [(1, True, 0), (1, False, 2 * H),            # exactly 2 h: no alert
             (2, True, 0), (2, False, 2 * H + 1),        # 2 h + 1 ms: alert
             (3, True, 0),                               # never ends: alert at the watermark
             (4, False, 5 * H),                          # END alone: nothing
             (5, False, 3 * H), (5, True, 0),            # END first, 3 h: alert
             (9, True, 10 * H)]                          # moves the watermark, still open
    s = _files(spark, "rides-src", [[(r, st, t0 + t) for r, st, t in rides]],
               "ride_id long, is_start boolean, t_ms long")
    s = s.withColumn("event_time", F.timestamp_millis("t_ms")).drop("t_ms")
    exact = drain(jobs.long_rides(s, 2 * H), "long-rides-exact")
    assert sorted(r["ride_id"] for r in exact.collect()) == [2, 3, 5]
    starts = s.filter("is_start").select("ride_id", "event_time")
    ends = s.filter(~F.col("is_start")).select("ride_id", "event_time")
    joined = drain(jobs.long_rides_join(starts, ends, 2 * H, 6 * H), "long-rides-join")
    assert sorted(r["ride_id"] for r in joined.collect()) == [2, 3, 5]


def test_pseudo_window_across_batches(spark):
    """F8 shape on the hand-built window: sums per driver and hour keyed by the
    hour's last millisecond; a row at or below the watermark is dropped."""
    base = 1_599_998_400_000                     # an hour boundary
    M = 60_000
    b = [[(0, 1, base + 10 * M, 5.0), (1, 1, base + 50 * M, 6.0), (2, 2, base + 20 * M, 10.0)],
         [(3, 2, base + 60 * M, 1.0), (4, 1, base + 5 * M, 9.0)],      # event 4 is late
         [(5, 3, base + 180 * M, 2.0)]]
    s = _files(spark, "pw-src", b, "event_id long, user_id long, t_ms long, value double")
    s = s.withColumn("ts", F.timestamp_millis("t_ms"))
    out = drain(jobs.pseudo_window(s, 60 * M), "pw-multi")
    got = sorted((r["user_id"], r["window_end_ms"] - base, r["tips"]) for r in out.collect())
    assert got == [(1, 60 * M - 1, 11.0), (2, 60 * M - 1, 10.0), (2, 120 * M - 1, 1.0)]


def test_join_state_is_written_as_changes(spark, tmp_path):
    """Two inputs of a join: their state leaves a log of changes, and no key is looked up for a row count."""
    rows = spark.createDataFrame([(i, 1_700_000_000 + i) for i in range(50)], "ride_id long, s long").selectExpr("ride_id", "timestamp_seconds(s) event_time")
    rows.write.parquet(str(tmp_path / "starts"))
    rows.where("ride_id % 2 = 0").write.parquet(str(tmp_path / "ends"))
    starts, ends = (spark.readStream.schema(rows.schema).parquet(str(tmp_path / s)) for s in ("starts", "ends"))
    base = str(tmp_path / "run")
    advance(jobs.long_rides_join(starts, ends, 1000, 1000, "0 seconds"), "changes", base)
    assert sorted(r["ride_id"] for r in spark.read.parquet(f"{base}/data").collect()) == list(range(1, 47, 2))
    assert list((tmp_path / "run" / "checkpoint" / "state").rglob("*.changelog"))
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows") == "false"
