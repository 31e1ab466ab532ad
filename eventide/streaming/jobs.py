"""Streaming forms of the analytics (the ``[S]`` lane).

Window analytics are the batch operators applied to a watermarked stream;
sequential per-key analytics run the processors of
:mod:`eventide.streaming.processors`.  Each function maps a streaming
DataFrame to a streaming DataFrame; :func:`eventide.streaming.drain` runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..operators import watermark, windows
from . import process, processors as PR


def hourly_best(events: DataFrame, size: str = "1 hour", delay: str = "0 seconds",
                scale: int | None = None) -> DataFrame:
    """J8 streaming: window sums, then the per-window arg-max as a second
    (chained) aggregation on the first one's ``window`` column, which keeps
    its event-time watermark; append mode."""
    h = (events.withWatermark("ts", delay)
               .groupBy(F.window("ts", size).alias("w"), "user_id")
               .agg(windows.total_of("value", scale).alias("tips")))
    best = F.max(F.struct(F.col("tips").alias("v"), (-F.col("user_id")).alias("nk"),
                          F.col("user_id").alias("k"))).alias("best")
    return h.groupBy("w").agg(best).select(F.col("w.end").alias("window_end"),
                                           F.col("best.k").alias("user_id"),
                                           F.col("best.v").alias("tips"))


def window_means(events: DataFrame, size: str, delay: str, scale: int | None = None) -> DataFrame:
    """J5 first stage: per-window means, emitted once when the window closes."""
    return windows.window_mean(events.withWatermark("ts", delay), "user_id", "value", size, scale=scale)


def top_n_batch(n: int):
    """J5 second stage as a ``foreachBatch`` step: in append mode all means of
    a window arrive in the same micro-batch, so ranking inside the batch is
    exact and bounded (``WindowGroupLimit`` keeps ``n`` rows per window)."""
    def rank(batch_df: DataFrame, batch_id: int) -> DataFrame:
        w = Window.partitionBy("window_start", "window_end") \
                  .orderBy(F.col("avg_value").desc(), F.col("user_id"))
        return batch_df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n) \
                       .withColumn("rank", F.col("rank").cast("bigint"))
    return rank


def window_min_updates(events: DataFrame, size: str, delay: str) -> DataFrame:
    """J4 streaming: per-window minimum record in update mode; rows later than
    the watermark allow are dropped by Spark (LATE-1)."""
    return windows.window_min_record(events.withWatermark("ts", delay), "user_id", "value", size,
                                     tiebreak=("ts", "event_id"), fields=("event_id", "ts"))


def fraud(events: DataFrame, small: float, large: float, within_ms: int,
          time_mode: str = "EventTime") -> DataFrame:
    proc = PR.SmallThenLarge("user_id", "value", small, large, within_ms, time_mode)
    return process.output(process.run(events, "user_id", proc, order=("t_ms", "event_id"), time_mode=time_mode), "alert")


def silence(events: DataFrame, gap_ms: int) -> DataFrame:
    tagged = process.run(events.select("user_id", "event_id", "ts", "t_ms"), "user_id", PR.SilenceCounter(gap_ms),
                         order=("t_ms", "event_id"))
    return process.output(tagged, "silent")


def pseudo_window(events: DataFrame, size_ms: int, delay_ms: int = 0) -> DataFrame:
    tagged = process.run(events.select("user_id", "ts", "t_ms", "value"), "user_id", PR.PseudoWindow(size_ms), delay_ms=delay_ms)
    return process.output(tagged, "window")


def gathered_top_n(means: DataFrame, n: int, size_ms: int, time: str | None = "window_end", delay_ms: int = 0) -> DataFrame:
    """TOP-1 over window means (``end_ms``, ``user_id``, ``avg_value``) that may come in any batches.  ``time`` None: the
    stream has its watermark already (:func:`closed_means`)."""
    tagged = process.run(means, "end_ms", PR.GatheredTopN(n, size_ms), time=time, t_ms="end_ms", order=("user_id",),
                         delay_ms=delay_ms)
    return process.output(tagged, "top")


def closed_means(events: DataFrame, size: str, delay: str, scale: int | None = None) -> DataFrame:
    """Window means with their window's event time (``at``), for a stateful operator behind them."""
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"), "user_id").agg(
        windows.total_of("value", scale).alias("s"), F.count("value").alias("n"))
    return w.select(F.window_time("w").alias("at"), F.unix_millis("w.end").alias("end_ms"), "user_id",
                    (F.col("s") / F.col("n")).alias("avg_value"))


def late_changelog(rows: DataFrame, size_ms: int, lateness_ms: int) -> DataFrame:
    """AGG-5 / LATE-1 / LATE-2: the tagged output of :class:`PR.LateWindowMin` over rows with their exact
    watermark (:func:`eventide.streaming.carry.exact_watermark`).  The watermark itself is the event time of
    this stream, so its timers follow it and no row is dropped as late."""
    # 1 ms of delay keeps rows that do not raise the watermark
    rows = rows.withColumn("wm_ts", F.timestamp_millis(F.col("wm_after") + 2))
    return process.run(rows, "user_id", PR.LateWindowMin(size_ms, lateness_ms), time="wm_ts", clock="wm_before",
                       order=("arr_ms", "event_id"), delay_ms=1)


def with_fire_watermark(fired: DataFrame, rows: DataFrame) -> DataFrame:
    """``fire`` rows of :func:`late_changelog` with the watermark that made the window fire, and their kind:
    the watermark after the row that first lifted it to the window's last millisecond, or the end of the
    input.  Of ``rows`` (with their exact watermark) only those that raised it in the windows' range are read."""
    span = fired.agg(F.min("win_end_ms"), F.max("win_end_ms")).first()
    if span[0] is None:
        span = (0, 0)
    raisers = rows.where(F.col("t_ms").isNotNull() & (F.col("wm_after") >= span[0] - 1) & (F.col("wm_before").isNull() | (F.col("wm_before") < span[1])))
    points = watermark.window_fire_points(raisers, fired.select("win_end_ms").distinct())
    wm = F.col("fire_wm")
    return fired.join(points, "win_end_ms", "left").select(
        *[c for c in fired.columns], F.coalesce(wm, F.lit(watermark.END_OF_INPUT_WM)).alias("watermark_ms"),
        F.when(wm.isNull(), "final").otherwise("on_time").alias("kind"))


def long_rides_join(starts: DataFrame, ends: DataFrame, max_ms: int,
                    end_before_start_ms: int, delay: str = "60 seconds") -> DataFrame:
    """J11 streaming as a stream-stream left outer interval join (JVM-side,
    state in the join's store): a START with no END in
    ``[start - end_before_start_ms, start + max_ms]`` comes out with a null END
    once the watermark passes ``start + max_ms`` - exactly the rides that last
    too long or never end.  ``end_before_start_ms`` bounds how early an END may
    precede its START (clock skew); it also bounds how long unmatched ENDs are
    kept.  Inputs: ``ride_id, event_time``."""
    s = starts.select(F.col("ride_id").alias("s_id"), F.col("event_time").alias("s_time")) \
              .withWatermark("s_time", delay)
    e = ends.select(F.col("ride_id").alias("e_id"), F.col("event_time").alias("e_time")) \
            .withWatermark("e_time", delay)
    # interval literals, so the planner sees the range and bounds both states
    cond = F.expr(f"s_id = e_id AND e_time >= s_time - INTERVAL {end_before_start_ms} MILLISECONDS "
                  f"AND e_time <= s_time + INTERVAL {max_ms} MILLISECONDS")
    return s.join(e, cond, "leftOuter").filter(F.col("e_id").isNull()) \
            .select(F.col("s_id").alias("ride_id"), F.col("s_time").alias("start_time"))


def long_rides(rides: DataFrame, max_ms: int, delay: str = "60 seconds") -> DataFrame:
    """J11 streaming over START/END ride events (``ride_id, is_start,
    event_time``) with the exact keyed state machine (first END closes the
    ride).  Costs one Python call per ride and micro-batch; with one key per
    ride prefer :func:`long_rides_join`."""
    r = rides.withColumn("t_ms", F.unix_millis("event_time"))
    fn = PR.long_ride_alert(max_ms)
    return r.withWatermark("event_time", delay).groupBy("ride_id").applyInPandasWithState(
        fn, fn.OUTPUT, fn.STATE, "append", "EventTimeTimeout")


def one_to_one(tagged: DataFrame, timeout_ms: int) -> DataFrame:
    """J7 streaming over a tagged union (``user_id, side, event_id, t_ms, ts``): matches and
    unmatched rows, told apart by ``kind``.  Without a time-out see
    :func:`eventide.streaming.carry.matched_pairs`."""
    return _pairs(process.run(tagged, "user_id", PR.OneToOneMatcher(timeout_ms), order=("t_ms", "event_id")))


def one_to_one_connected(connected: DataFrame, timeout_ms: int) -> DataFrame:
    """The same over two streams of :func:`eventide.operators.matching.connect`, each with a watermark of its own."""
    return _pairs(process.run(connected, "user_id", PR.OneToOneMatcher(timeout_ms), time=None, order=("t_ms", "event_id")))


def _pairs(t: DataFrame) -> DataFrame:
    return t.select(F.coalesce("match__user_id", "unmatched__user_id").alias("user_id"), F.col(process.TAG).alias("kind"),
                    *[F.col(f"match__{c}").alias(c) for c in ("ride_event_id", "ride_ms", "fare_event_id", "fare_ms")],
                    *[F.col(f"unmatched__{c}").alias(c) for c in ("side", "event_id", "t_ms", "reason")])


def word_counts_processing_time(lines: DataFrame, size: str = "10 seconds",
                                text_col: str = "text") -> DataFrame:
    """J1 streaming: words per processing-time window (WIN-2).  Ingest time is
    the micro-batch time; emit in update mode."""
    from ..functions.text import line_tokens, text_lines
    words = lines.select(F.explode(text_lines(text_col)).alias("line")) \
                 .select(F.explode(line_tokens("line")).alias("word"),
                         F.current_timestamp().alias("pt"))
    return words.withWatermark("pt", "0 seconds") \
                .groupBy(F.window("pt", size).alias("w"), "word").count()


def sessions(events: DataFrame, gap: str, delay: str = "0 seconds") -> DataFrame:
    """AGG-13 streaming: per-user session windows, emitted when closed."""
    return (events.withWatermark("ts", delay)
                  .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
                  .agg(F.count(F.lit(1)).alias("n"))
                  .select("user_id", F.col("s.start").alias("session_start"),
                          F.col("s.end").alias("session_end"), "n"))


def running_key_count(events: DataFrame, key: str = "user_id") -> DataFrame:
    """AGG-1 streaming: running count per key; run in update mode (one row
    per changed key per micro-batch)."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def hourly_sums(events: DataFrame, size: str = "1 hour", delay: str = "0 seconds",
                scale: int | None = None) -> DataFrame:
    """Per-user window sums, emitted once per closed window (append mode)."""
    return (events.withWatermark("ts", delay)
                  .groupBy(F.window("ts", size).alias("w"), "user_id")
                  .agg(windows.total_of("value", scale).alias("tips"))
                  .select(F.col("w.end").alias("window_end"), "user_id", "tips"))
