"""Event-sequence patterns per key (FRD-1, AGG-12, AGG-13, LNG-1, JN-4).

Each is exact on a replayed stream: the reference's keyed state machines are
re-expressed as lag/lead/running scans per key on the skew-safe scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scan import keyed_scan


def small_then_large(df: DataFrame, key: str, amount: str, t_ms: str = "t_ms",
                     tiebreak: str = "event_id", small: float = 1.00, large: float = 500.00,
                     within_ms: int = 60_000) -> DataFrame:
    """FRD-1: alert on a transaction above ``large`` whose *immediately
    preceding* transaction of the same account was below ``small`` and at most
    ``within_ms`` earlier.  Exact for the reference's flag state: any next
    transaction clears the flag, a small one re-arms it, the timer clears it
    after ``within_ms``."""
    s = keyed_scan(df, [key], [t_ms, tiebreak],
                   lag={"_prev_amt": amount, "_prev_t": t_ms})
    hit = (F.col("_prev_amt") < F.lit(small)) & (F.col(amount) > F.lit(large)) & \
          (F.col(t_ms) - F.col("_prev_t") <= F.lit(within_ms))
    return s.filter(hit).drop("_prev_amt", "_prev_t")


def silence_counts(df: DataFrame, key: str, gap_ms: int, t_ms: str = "t_ms",
                   tiebreak: str = "event_id") -> DataFrame:
    """AGG-12: the per-key cumulative count, emitted at each row followed by
    more than ``gap_ms`` of silence for that key (and at the key's last row,
    when the end of input flushes the timers).  Output: key, ``count``,
    ``last_ms``."""
    s = keyed_scan(df, [key], [t_ms, tiebreak],
                   running={"count": ("count", F.lit(1), True)},
                   lead={"_next_t": t_ms})
    emit = F.col("_next_t").isNull() | (F.col("_next_t") - F.col(t_ms) > F.lit(gap_ms))
    return s.filter(emit).select(key, "count", F.col(t_ms).alias("last_ms"))


def sessions(df: DataFrame, key: str, gap_ms: int, t_ms: str = "t_ms",
             tiebreak: str = "event_id") -> DataFrame:
    """AGG-13: per-key sessions (a gap of more than ``gap_ms`` starts a new
    one; exactly ``gap_ms`` stays), with start, end (= last + gap) and count.
    Gaps and islands on two scans, then a two-phase aggregate: a hot key
    never lands in one task.  (Streaming form: ``session_window``.)"""
    s = keyed_scan(df, [key], [t_ms, tiebreak], lag={"_prev_t": t_ms}, keep_chunks=True)
    s = s.withColumn("_new", (F.col("_prev_t").isNull() |
                              (F.col(t_ms) - F.col("_prev_t") > F.lit(gap_ms))).cast("int"))
    s = keyed_scan(s, [key], [t_ms, tiebreak], running={"_sid": ("sum", "_new", True)})  # same chunks
    return (s.groupBy(key, "_sid")
             .agg(F.min(t_ms).alias("start_ms"), F.max(t_ms).alias("_last"),
                  F.count(F.lit(1)).alias("n"))
             .select(key, "start_ms", (F.col("_last") + F.lit(gap_ms)).alias("end_ms"), "n"))


def long_rides(rides: DataFrame, max_duration_ms: int) -> DataFrame:
    """LNG-1 / JN-4: ride ids whose END comes more than ``max_duration_ms``
    after the START (either arrival order), or whose START never gets an END
    (the end of input moves the watermark past every timer).  An END alone
    never alerts.  START and END meet in one grouped aggregate over the
    tagged stream - one shuffle with map-side combine, no join."""
    t = F.unix_millis("event_time")
    g = rides.groupBy("ride_id").agg(
        F.min(F.when(F.col("is_start"), t)).alias("start_ms"),
        F.min(F.when(~F.col("is_start"), t)).alias("end_ms"))
    alert = F.col("start_ms").isNotNull() & (
        F.col("end_ms").isNull() | (F.col("end_ms") - F.col("start_ms") > F.lit(max_duration_ms)))
    return g.filter(alert)
