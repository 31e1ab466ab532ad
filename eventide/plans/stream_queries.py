"""Registered streaming queries: the ``[S]`` lane run over the stored tables
as file streams with ``trigger(availableNow=True)``.

Each callable runs its stream to completion (output in the shared checkpoint
root) and returns the written rows.  At the end of the available input the
watermark stands at ``max(event time) - delay``; windows and timers beyond it
stay open, which the SQL oracles state as a predicate.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timecols import ntz_from_ms
from ..operators import matching, watermark
from ..session import scratch_path
from ..sources.rides import fares, ride_starts
from ..sources.tables import events, streaming_events, streaming_table
from ..sources import lines as L
from ..streaming import carry, jobs, process
from ..streaming.runner import advance, drain, drain_in_slices, drive
from . import params as P
from .catalog import FARE_ORDER, fare_match_rows, line_files, match_record, ntz, query

#: Micro-batches of the queries that replay a table in its arrival order.
SLICES = 5
#: Watermark of the mark that ends a bounded replay (in the year 2260: pandas counts nanoseconds).
END_MARK_MS = 9151488000000
TOP_DELAY = "2 seconds"
LONG_RIDE_DELAY = "60 seconds"


@query("stream_hourly_best")
def stream_hourly_best(spark, d):
    out = drain(jobs.hourly_best(streaming_events(spark, d), P.HOURLY, scale=P.MONEY), "hourly_best")
    return out.select(ntz("window_end").alias("window_end"), "user_id", "tips")


@query("stream_top3")
def stream_top3(spark, d):
    means = jobs.window_means(streaming_events(spark, d), P.MIN_WINDOW, TOP_DELAY, P.MONEY)
    out = drain(means, "top3", batch_fn=jobs.top_n_batch(P.TOP_N))
    return out.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
                      "rank", "user_id", "avg_value")


@query("stream_window_min_updates")
def stream_window_min_updates(spark, d):
    mins = jobs.window_min_updates(streaming_events(spark, d), P.MIN_WINDOW, "1 hour")
    out = drain(mins, "window_min", output_mode="update")
    # the last update of a window is its smallest record
    last = F.min(F.struct("value", "ts", "event_id")).alias("m")
    out = out.groupBy("user_id", "window_start", "window_end").agg(last).select(
        "user_id", "window_start", "window_end", "m.*")
    return out.select("user_id", ntz("window_start").alias("window_start"),
                      ntz("window_end").alias("window_end"), "event_id", ntz("ts").alias("ts"),
                      "value")


@query("stream_fraud")
def stream_fraud(spark, d):
    out = drain(jobs.fraud(streaming_events(spark, d), P.FRAUD_SMALL, P.FRAUD_LARGE,
                           P.FRAUD_WITHIN_MS), "fraud")
    return out.select("account_id", "event_id", ntz_from_ms("t_ms").alias("ts"), "amount")


@query("stream_silence_1h")
def stream_silence_1h(spark, d):
    out = drain(jobs.silence(streaming_events(spark, d), P.SILENCE_LONG_MS), "silence")
    return out.select("user_id", "count", ntz_from_ms("last_ms").alias("last_modified"))


@query("stream_pseudo_window")
def stream_pseudo_window(spark, d):
    out = drain(jobs.pseudo_window(streaming_events(spark, d), P.HOURLY_MS), "pseudo_window")
    return out.select("user_id", ntz_from_ms("window_end_ms").alias("window_end"),
                      F.round("tips", P.MONEY).alias("tips"))


@query("stream_long_rides")
def stream_long_rides(spark, d):
    starts = streaming_table(spark, d, "orders").select(
        F.col("o_orderkey").alias("ride_id"), F.lit(True).alias("is_start"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"))
    ends = streaming_table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("ride_id"), F.lit(False).alias("is_start"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"))
    out = drain(jobs.long_rides_join(starts, ends, P.LONG_RIDE_MS, P.END_BEFORE_START_MS,
                                     LONG_RIDE_DELAY), "long_rides")
    return out.select("ride_id", ntz("start_time").alias("start_time"))


def _matches(spark, d):
    """One streaming run gives both outputs of J7: matches, and the unmatched side
    output (SIDE-1)."""
    e = streaming_events(spark, d).filter(
        F.col("event_type").isin(P.MATCH_RIDE_TYPE, P.MATCH_FARE_TYPE))
    e = e.select("user_id", "event_id", "ts", "t_ms",
                 F.when(F.col("event_type") == P.MATCH_RIDE_TYPE, "ride").otherwise("fare")
                  .alias("side"))
    return drain(jobs.one_to_one(e, P.MATCH_TIMEOUT_MS), "match")


@query("stream_match")
def stream_match(spark, d):
    out = _matches(spark, d).filter(F.col("kind") == "match")
    return out.select("user_id", "ride_event_id", ntz_from_ms("ride_ms").alias("ride_ts"),
                      "fare_event_id", ntz_from_ms("fare_ms").alias("fare_ts"))


@query("stream_unmatched")
def stream_unmatched(spark, d):
    out = _matches(spark, d).filter(F.col("kind") == "unmatched")
    return out.select("user_id", "side", "event_id", ntz_from_ms("t_ms").alias("ts"), "reason")


@query("stream_word_count")
def stream_word_count(spark, d):
    """J1 streaming over the documents as a text stream; word totals summed
    over the processing-time windows (the windows depend on wall time, the
    totals do not)."""
    docs = streaming_table(spark, d, "documents").select("text")
    out = drain(jobs.word_counts_processing_time(docs), "word_count", output_mode="update")
    last = out.groupBy("w", "word").agg(F.max("count").alias("c"))
    return last.groupBy("word").agg(F.sum("c").alias("n"))


@query("stream_sessions")
def stream_sessions(spark, d):
    out = drain(jobs.sessions(streaming_events(spark, d), "60 minutes"), "sessions")
    return out.select("user_id", ntz("session_start").alias("session_start"),
                      ntz("session_end").alias("session_end"), "n")


@query("stream_key_count")
def stream_key_count(spark, d):
    """AGG-1 streaming: update-mode running count per key; the latest update
    of each key is its count."""
    out = drain(jobs.running_key_count(streaming_events(spark, d)), "key_count",
                output_mode="update")
    return out.groupBy("user_id").agg(F.max("n").alias("n"))


@query("stream_rolling_best")
def stream_rolling_best(spark, d):
    """AGG-10 streaming: rolling best user per closed hour."""
    out = drain(jobs.hourly_sums(streaming_events(spark, d), P.HOURLY, scale=P.MONEY), "rolling_best",
                batch_fn=carry.rolling_best)
    return out.select(ntz("window_end").alias("window_end"), "upto_user_id", "user_id", "tips")


@query("stream_lines_request")
def stream_lines_request(spark, d):
    """SRC-1 as a stream: request lines from a folder of text files, typed and quarantined."""
    lines = L.read_lines(spark, line_files(spark, d, "request"), streaming=True)
    return drain(L.split_quarantine(L.parse_lines(lines, "request"))[0], "lines_request")


@query("stream_ride_fare_match")
def stream_ride_fare_match(spark, d):
    """J12 streaming: rides and fares as two watermarked file streams, matched one to one without a
    time-out; stopped and restarted between any two of five micro-batches."""
    rides, paid = fare_match_rows(ride_starts(spark, d), fares(spark, d))
    base = scratch_path(spark, "stream-ride_fare_match")
    fields = ("side", "t_ms", "fare_line", "total_fare")

    def build(streams):
        a, b = (streams[s].withColumn("at", F.timestamp_millis("t_ms")).withWatermark("at", "0 seconds").drop("at")
                for s in ("rides", "fares"))
        return matching.connect(a, b, 0, 1)

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in matching.connect(rides, paid, 0, 1).schema)
    step = carry.matched_pairs(carry.BatchState(spark, f"{base}/waiting", kinds), f"{base}/pairs", "ride_id", "side",
                               FARE_ORDER, carry=fields)
    out = drain_in_slices({"rides": (rides, "t_ms"), "fares": (paid, "t_ms")}, build, "ride_fare_match", SLICES,
                          batch_fn=step, base=base)
    return match_record(out)


def _late_input(spark, d, name):
    """Events in arrival order, and a step that gives every row its exact watermark."""
    e = watermark.with_arrival(events(spark, d).select("event_id", "user_id", "ts", "t_ms", "value"))
    base = scratch_path(spark, f"stream-{name}")
    return e, base, lambda then=None: carry.exact_watermark(
        carry.BatchState(spark, f"{base}/top", "top long"), P.LATE_DELAY_MS, then=then)


@query("stream_late_rows")
def stream_late_rows(spark, d):
    """RW-1 / LATE-2 streaming: the rows that are too late by the exact watermark, whatever the cut
    into micro-batches."""
    e, base, step = _late_input(spark, d, "late_rows")
    s = drain_in_slices({"events": (e, "arr_ms")}, lambda s: s["events"], "late_rows", SLICES, batch_fn=step(
        lambda rows, _: watermark.classify_lateness(rows, P.LATE_SIZE_MS, P.LATE_LATENESS_MS).where("status = 'too_late'")), base=base)
    return s.select("event_id", "user_id", ntz("ts").alias("ts"), "value", ntz_from_ms("win_start_ms").alias("window_start"),
                    F.col("wm_before").alias("watermark_ms"))


@query("stream_late_changelog")
def stream_late_changelog(spark, d):
    """J4 streaming: one stream gives the rows their exact watermark, a second one keeps the windows in
    keyed state; both are stopped and restarted between any two of five micro-batches."""
    e, base, step = _late_input(spark, d, "late_changelog")
    kept = ["user_id", "event_id", "t_ms", "t_us", "arr_ms", "value", "wm_before", "wm_after", "max_before"]
    rows, log = f"{base}/data", f"{base}/log"
    e = e.withColumn("t_us", F.unix_micros("ts"))
    schema = e.select(*[c if c in e.columns else F.lit(None).cast("long").alias(c) for c in kept]).schema

    def changes(batch, batch_id):
        tagged = batch.persist()  # read for both kinds of emission
        try:
            fired = jobs.with_fire_watermark(process.output(tagged, "fire"), spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(rows))
            late = process.output(tagged, "late").withColumn("kind", F.lit("late"))
            both = fired.unionByName(late)
            both.write.mode("overwrite").parquet(f"{base}/changes/batch_id={batch_id}")
        finally:
            tagged.unpersist()
        return spark.read.schema(both.schema).parquet(f"{base}/changes/batch_id={batch_id}")

    def second(_=None):
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(rows)
        advance(jobs.late_changelog(stream, P.LATE_SIZE_MS, P.LATE_LATENESS_MS), "late_changelog_state", log, batch_fn=changes)

    drain_in_slices({"events": (e, "arr_ms")}, lambda s: s["events"], "late_changelog", SLICES,
                    batch_fn=step(lambda r, _: r.select(*kept)), base=base, each=second)
    # the end of a bounded input: a mark with the last of all watermarks
    mark = [END_MARK_MS if c == "wm_after" else None for c in kept]
    spark.createDataFrame([mark], schema).write.parquet(f"{rows}/end")
    second()
    out = spark.read.parquet(f"{log}/data")
    return out.select("user_id", ntz_from_ms("win_start_ms").alias("window_start"), ntz_from_ms("win_end_ms").alias("window_end"),
                      "watermark_ms", "kind", "event_id", ntz(F.timestamp_micros("t_us")).alias("ts"), "value")


@query("stream_top3_gathered")
def stream_top3_gathered(spark, d):
    """J5 streaming with list state (ST-2): the means of a window are gathered under its end, whatever the
    batches they come in, until its timer ranks them."""
    means = jobs.closed_means(streaming_events(spark, d), P.MIN_WINDOW, TOP_DELAY, P.MONEY)
    out = drain(jobs.gathered_top_n(means, P.TOP_N, P.MIN_WINDOW_MS, time=None), "top3_gathered")
    return out.select(ntz_from_ms("window_start_ms").alias("window_start"), ntz_from_ms("window_end_ms").alias("window_end"),
                      "rank", "user_id", "avg_value")


@query("stream_fraud_wall_clock")
def stream_fraud_wall_clock(spark, d):
    """J2 with its original timer (TMR-3): the flag dies by wall clock, here a day after its micro-batch, which no
    run lives to see; the query runs on a periodic trigger and is stopped when its input is."""
    alerts = jobs.fraud(streaming_events(spark, d), P.FRAUD_SMALL, P.FRAUD_LARGE, P.DAY, time_mode="ProcessingTime")
    out = drive(alerts, "fraud_wall_clock")
    return out.select("account_id", "event_id", ntz_from_ms("t_ms").alias("ts"), "amount")


@query("stream_fraud_carried")
def stream_fraud_carried(spark, d):
    """J2 for hot accounts: each micro-batch is one skew-safe scan, with the last row of every account carried
    from batch to batch; five micro-batches in time order."""
    e = events(spark, d).select("event_id", "user_id", "ts", "t_ms", "value")
    base = scratch_path(spark, "stream-fraud_carried")
    kinds = "event_id long, user_id long, ts timestamp, t_ms long, value double"
    step = carry.small_then_large(carry.BatchState(spark, f"{base}/last", kinds), "user_id", "value",
                                  P.FRAUD_SMALL, P.FRAUD_LARGE, P.FRAUD_WITHIN_MS)
    out = drain_in_slices({"events": (e, "t_ms")}, lambda s: s["events"], "fraud_carried", SLICES, batch_fn=step, base=base)
    return out.select(F.col("user_id").alias("account_id"), "event_id", ntz("ts").alias("ts"), F.col("value").alias("amount"))
