"""Exact per-row watermarks for replayed streams (RW-1, LATE-1..3, AGG-5).

A bounded-out-of-orderness watermark after a row is ``max(event time so far)
- delay - 1 ms``.  Replaying a stored stream in a given arrival order, the
watermark *before* each row is a global prefix maximum - a scan with no key.
It runs on the skew-safe scan (range-partitioned chunks plus a carry table of
at most one row per chunk), never as an unpartitioned window over all rows.

Window rules (epoch-aligned tumbling windows ``[start, end)``):

* a row is *too late* when ``end - 1 + lateness <= watermark_before``;
* a row is *late but allowed* when ``end - 1 <= watermark_before``: it is
  added and re-fires its window;
* otherwise it is on time.  A window fires on time when the watermark first
  reaches ``end - 1``; the row whose arrival moved the watermark there is the
  trigger, and the firing sees every on-time row of the window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.timecols import window_start_ms
from .scan import keyed_scan

# Fixed value of the replay disorder model (our own): an event arrives
# ``(event_id * 7919) % 7200`` seconds after its event time.
ARRIVAL_MULT = 7919
ARRIVAL_SPREAD_S = 7200
END_OF_INPUT_WM = 9223372036854775807  # watermark emitted when a bounded input ends


def with_arrival(df: DataFrame, t_ms: str = "t_ms", id_col: str = "event_id",
                 out: str = "arr_ms") -> DataFrame:
    """Deterministic arrival time for replaying ``df`` out of order."""
    return df.withColumn(out, F.col(t_ms) + (F.col(id_col) * ARRIVAL_MULT % ARRIVAL_SPREAD_S)
                         * F.lit(1000))


def with_watermark_before(df: DataFrame, delay_ms: int, t_ms: str = "t_ms",
                          order=("arr_ms", "event_id"), out: str = "wm_before",
                          with_after: bool = False, n_chunks: int | None = None) -> DataFrame:
    """Add the exact watermark seen by each row (null before the first row);
    optionally also the maximum event time including the row."""
    running = {"_mx_excl": ("max", t_ms, False)}
    if with_after:
        running["_mx_incl"] = ("max", t_ms, True)
    s = keyed_scan(df, [], list(order), running=running, n_chunks=n_chunks)
    s = s.withColumn(out, F.col("_mx_excl") - F.lit(delay_ms + 1))
    if with_after:
        s = s.withColumn("wm_after", F.col("_mx_incl") - F.lit(delay_ms + 1)) \
             .withColumn("max_before", F.col("_mx_excl"))
    return s.drop("_mx_excl", "_mx_incl")


def classify_lateness(df: DataFrame, size_ms: int, lateness_ms: int,
                      t_ms: str = "t_ms", wm: str = "wm_before") -> DataFrame:
    """Add window bounds (ms) and ``status`` in on_time / late / too_late."""
    start = window_start_ms(t_ms, size_ms)
    df = df.withColumn("win_start_ms", start).withColumn("win_end_ms", start + F.lit(size_ms))
    last = F.col("win_end_ms") - 1
    return df.withColumn(
        "status",
        F.when(F.col(wm).isNotNull() & (last + F.lit(lateness_ms) <= F.col(wm)), "too_late")
         .when(F.col(wm).isNotNull() & (last <= F.col(wm)), "late")
         .otherwise("on_time"))


def drop_late_rows(df: DataFrame, delay_ms: int = 0, t_ms: str = "t_ms",
                   order=("arr_ms", "event_id")) -> DataFrame:
    """LATE-3: drop rows whose event time is at or below the watermark."""
    s = with_watermark_before(df, delay_ms, t_ms, order)
    return s.filter(F.col("wm_before").isNull() | (F.col(t_ms) > F.col("wm_before")))


def window_fire_points(scanned: DataFrame, ends: DataFrame, n_chunks: int | None = None) -> DataFrame:
    """For each window end in ``ends`` (column ``win_end_ms``): the watermark
    right after the row whose arrival first lifted it to ``end - 1`` or more
    (``fire_wm``; null if the input ends before).

    The watermark only grows, so this is an as-of lookup: put the rows that
    raise the watermark (value ``wm_after``) and the window ends (value
    ``end - 1``) in one descending sequence, raisers first on ties, and take
    the running minimum of ``wm_after`` - a global skew-safe scan.  Work is
    proportional to the rows, whatever the gaps in event time."""
    rec = scanned.filter(F.col("max_before").isNull() | (F.col("t_ms") > F.col("max_before")))
    both = rec.select((-F.col("wm_after")).alias("_neg"), F.lit(0).alias("_kind"),
                      F.col("wm_after").alias("_wm"), F.lit(None).cast("long").alias("win_end_ms")) \
        .unionByName(ends.select((-(F.col("win_end_ms") - 1)).alias("_neg"), F.lit(1).alias("_kind"),
                                 F.lit(None).cast("long").alias("_wm"), "win_end_ms"))
    s = keyed_scan(both, [], ["_neg", "_kind", "win_end_ms"],
                   running={"fire_wm": ("min", "_wm", True)}, n_chunks=n_chunks)
    return s.filter(F.col("_kind") == 1).select("win_end_ms", "fire_wm")


def window_min_changelog(df: DataFrame, key: str, value: str, size_ms: int, delay_ms: int,
                         lateness_ms: int, t_ms: str = "t_ms", order=("arr_ms", "event_id"),
                         fields=("event_id", "ts"), n_chunks: int | None = None):
    """AGG-5 / LATE-1 / LATE-2 on a replayed stream.

    Returns ``(changelog, too_late)``.  ``changelog`` has one row per emission
    of the per-key window minimum: the on-time firing (``kind='on_time'``,
    watermark after the crossing row), one re-firing per late-but-allowed row
    (``kind='late'``, minimum over all accepted rows so far), or the firing at
    the end of a bounded input (``kind='final'``).  Ties keep the earlier
    arrival.  ``too_late`` holds the rows the window operator drops.
    """
    s = with_watermark_before(df, delay_ms, t_ms, order, with_after=True, n_chunks=n_chunks)
    s = classify_lateness(s, size_ms, lateness_ms, t_ms)
    rec = F.struct(F.col(value).alias("v"),
                   *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)],
                   *[F.col(f).alias(f) for f in fields])
    on_mins = s.filter(F.col("status") == "on_time") \
               .groupBy(key, "win_start_ms", "win_end_ms").agg(F.min(rec).alias("rec"))
    fire = window_fire_points(s, on_mins.select("win_end_ms").distinct(), n_chunks)
    on_time = (on_mins.join(fire, "win_end_ms", "left")
                .select(key, "win_start_ms", "win_end_ms", "rec",
                        F.coalesce("fire_wm", F.lit(END_OF_INPUT_WM)).alias("watermark_ms"),
                        F.when(F.col("fire_wm").isNull(), "final").otherwise("on_time")
                         .alias("kind")))
    # A window's on-time rows all arrive before it fires and no later row is
    # on time, so the minimum seen by a late row is the on-time minimum and
    # the running minimum of the late rows so far: the scan runs over late
    # rows only (a small share of a healthy stream).
    need = dict.fromkeys([key, "win_start_ms", "win_end_ms", *order, value, *fields, "wm_before"])
    late_rows = s.filter(F.col("status") == "late").select(*need)
    late = (keyed_scan(late_rows, [key, "win_start_ms"], list(order),
                       running={"_lrec": ("min", rec, True)}, n_chunks=n_chunks)
            .join(on_mins.select(key, "win_start_ms", F.col("rec").alias("_orec")),
                  [key, "win_start_ms"], "left")
            .select(key, "win_start_ms", "win_end_ms",
                    F.least("_lrec", "_orec").alias("rec"),
                    F.col("wm_before").alias("watermark_ms"), F.lit("late").alias("kind")))
    log = on_time.unionByName(late).select(
        key, "win_start_ms", "win_end_ms", "watermark_ms", "kind",
        *[F.col(f"rec.{f}").alias(f) for f in fields], F.col("rec.v").alias(value))
    too_late = s.filter(F.col("status") == "too_late").drop("status", "wm_after", "max_before")
    return log, too_late
