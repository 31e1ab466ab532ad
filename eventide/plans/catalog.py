"""Registered batch queries: one per analytic of the reference jobs, each a
``(spark, sf_dir) -> DataFrame`` over the stored tables (whole tables, no row
caps).  Result timestamps are cast back to ``TIMESTAMP_NTZ`` like the stored
ones; every computed column carries the same name as in the SQL oracle
(:mod:`eventide.plans.oracle`)."""

from __future__ import annotations

import statistics
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import geo
from ..functions.text import line_tokens, text_lines
from ..functions.timecols import from_seconds, inclusive_window_end_ms, ntz_from_ms
from ..operators import matching, patterns, topn, watermark, windows
from ..operators.accumulate import Mean, TopValues, accumulate
from ..operators.scan import keyed_scan, running_count
from ..sources import lines as L
from ..sources.rides import fares, ride_events, ride_starts
from ..sources.tables import events, load
from ..schemas import LINE_SCHEMAS
from ..session import scratch_path
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def ntz(c):
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# --------------------------------------------------------------- J8 / J9 hourly tips
def hourly_sums(spark, d):
    return windows.window_sum(events(spark, d), "user_id", "value", P.HOURLY, out="tips", scale=P.MONEY)


@query("hourly_best_user")
def hourly_best_user(spark, d):
    """J8: tips per user-hour, then the best user per hour."""
    best = windows.window_argmax(hourly_sums(spark, d), "tips", "user_id")
    return best.select(ntz("window_end").alias("window_end"), "user_id", "tips")


@query("hourly_tips_inclusive_end")
def hourly_tips_inclusive_end(spark, d):
    """J9: hand-built hourly window keyed by its last millisecond; rows at or
    below the monotonous watermark (replay order) are dropped."""
    e = watermark.with_arrival(events(spark, d).select("event_id", "user_id", "t_ms", "value"))
    kept = watermark.drop_late_rows(e, delay_ms=0)
    g = kept.groupBy("user_id", inclusive_window_end_ms("t_ms", P.HOURLY_MS).alias("_end")) \
            .agg(windows.total_of("value", P.MONEY).alias("tips"))
    return g.select("user_id", ntz_from_ms("_end").alias("window_end"), "tips")


@query("rolling_hour_best")
def rolling_hour_best(spark, d):
    """AGG-10: rolling arg-max per hour, one output per hourly sum (sums of an
    hour arrive in user order)."""
    h = hourly_sums(spark, d).select("window_end", "user_id", "tips")
    best = F.struct(F.col("tips").alias("v"), (-F.col("user_id")).alias("nk"),
                    F.col("user_id").alias("k"))
    s = keyed_scan(h, ["window_end"], ["user_id"], running={"_best": ("max", best, True)})
    return s.select(ntz("window_end").alias("window_end"), F.col("user_id").alias("upto_user_id"),
                    F.col("_best.k").alias("user_id"), F.col("_best.v").alias("tips"))


# --------------------------------------------------------------- J3 / J4 window min
def _min_records(spark, d):
    return windows.window_min_record(events(spark, d), "user_id", "value", P.MIN_WINDOW,
                                     tiebreak=("ts", "event_id"), fields=("event_id", "ts"))


@query("window_min_record")
def window_min_record(spark, d):
    """J3 first output: the lowest-value record per user and window."""
    return _min_records(spark, d).select("event_id", "user_id", ntz("ts").alias("ts"), "value")


@query("window_min_with_bounds")
def window_min_with_bounds(spark, d):
    """J3 second output: (key, window start, end, record)."""
    return _min_records(spark, d).select(
        "user_id", ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
        "event_id", ntz("ts").alias("ts"), "value")


def _late_scan(spark, d):
    e = watermark.with_arrival(events(spark, d).select("event_id", "user_id", "ts", "t_ms", "value"))
    s = watermark.with_watermark_before(e, P.LATE_DELAY_MS, with_after=True)
    return watermark.classify_lateness(s, P.LATE_SIZE_MS, P.LATE_LATENESS_MS)


@query("late_rows")
def late_rows(spark, d):
    """LATE-2: rows dropped as too late (side output of J4 / J5)."""
    s = _late_scan(spark, d).filter(F.col("status") == "too_late")
    return s.select("event_id", "user_id", ntz("ts").alias("ts"), "value",
                    ntz_from_ms("win_start_ms").alias("window_start"),
                    F.col("wm_before").alias("watermark_ms"))


@query("window_min_late_changelog")
def window_min_late_changelog(spark, d):
    """J4: every emission of the out-of-order window minimum - the on-time
    firing when the watermark passes the window, one re-firing per
    late-but-allowed row, or the end-of-input firing - with the watermark at
    emission time."""
    e = watermark.with_arrival(events(spark, d).select("event_id", "user_id", "ts", "t_ms", "value"))
    log, _ = watermark.window_min_changelog(e, "user_id", "value", P.LATE_SIZE_MS,
                                            P.LATE_DELAY_MS, P.LATE_LATENESS_MS)
    return log.select("user_id", ntz_from_ms("win_start_ms").alias("window_start"),
                      ntz_from_ms("win_end_ms").alias("window_end"), "watermark_ms", "kind",
                      "event_id", ntz("ts").alias("ts"), "value")


# --------------------------------------------------------------- J5 top-N
def _means(spark, d):
    return windows.window_mean(events(spark, d), "user_id", "value", P.MIN_WINDOW, scale=P.MONEY)


@query("top3_mean")
def top3_mean(spark, d):
    t = topn.top_n(_means(spark, d), P.TOP_N, "avg_value", "user_id")
    return t.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
                    "rank", "user_id", "avg_value")


@query("top3_exclude_last")
def top3_exclude_last(spark, d):
    t = topn.top_n(_means(spark, d), P.TOP_N, "avg_value", "user_id", exclude_last=True)
    return t.select(ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"),
                    "rank", "user_id", "avg_value")


@query("top3_report")
def top3_report(spark, d):
    m = _means(spark, d).withColumn("window_end_ms", F.unix_millis("window_end"))
    return topn.top_n_report(m, P.TOP_N, "user_id")


# --------------------------------------------------------------- J13 counts, SRT-1
@query("running_count")
def running_count_q(spark, d):
    """J13: running count per key, one output per input."""
    e = events(spark, d).select("event_id", "user_id", "t_ms")
    return running_count(e, ["user_id"], ["t_ms", "event_id"]).select(
        "event_id", "user_id", "running_count")


@query("key_count")
def key_count(spark, d):
    return events(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("ride_order")
def ride_order(spark, d):
    r = topn.ride_order(ride_events(spark, d).select("ride_id", "is_start", "event_time"))
    return r.select("position", "ride_id", "is_start", ntz("event_time").alias("event_time"))


# --------------------------------------------------------------- J1 word count
@query("word_count")
def word_count(spark, d):
    """J1 over every line of every document (one replay window)."""
    docs = load(spark, d, "documents").select("text")
    words = docs.select(F.explode(text_lines("text")).alias("line")) \
                .select(F.explode(line_tokens("line")).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- J2 / J6 patterns
@query("fraud_alerts")
def fraud_alerts(spark, d):
    e = events(spark, d).select("event_id", "user_id", "ts", "t_ms", "value")
    a = patterns.small_then_large(e, "user_id", "value", small=P.FRAUD_SMALL,
                                  large=P.FRAUD_LARGE, within_ms=P.FRAUD_WITHIN_MS)
    return a.select(F.col("user_id").alias("account_id"), "event_id", ntz("ts").alias("ts"),
                    F.col("value").alias("amount"))


def _silence(spark, d, gap):
    e = events(spark, d).select("event_id", "user_id", "t_ms")
    s = patterns.silence_counts(e, "user_id", gap)
    return s.select("user_id", "count", ntz_from_ms("last_ms").alias("last_modified"))


@query("silence_counts_60s")
def silence_counts_60s(spark, d):
    return _silence(spark, d, P.SILENCE_SHORT_MS)


@query("silence_counts_1h")
def silence_counts_1h(spark, d):
    return _silence(spark, d, P.SILENCE_LONG_MS)


@query("session_counts")
def session_counts(spark, d):
    e = events(spark, d).select("event_id", "user_id", "t_ms")
    s = patterns.sessions(e, "user_id", P.SESSION_GAP_MS)
    return s.select("user_id", ntz_from_ms("start_ms").alias("session_start"),
                    ntz_from_ms("end_ms").alias("session_end"), "n")


# --------------------------------------------------------------- J11 / J12 / J7 rides
@query("long_rides")
def long_rides(spark, d):
    r = patterns.long_rides(ride_events(spark, d).select("ride_id", "is_start", "event_time"),
                            P.LONG_RIDE_MS)
    return r.select("ride_id", ntz_from_ms("start_ms").alias("start_time"),
                    ntz_from_ms("end_ms").alias("end_time"))


#: Order of a ride's rows in the match.
FARE_ORDER = ["t_ms", "side", "fare_line", "fare_part", "total_fare"]


def fare_match_rows(rides, paid):
    """Both inputs of J12: ride starts, and fares with their fields."""
    return (rides.select("ride_id", F.unix_millis("event_time").alias("t_ms")),
            paid.select("ride_id", F.unix_millis("start_time").alias("t_ms"), "fare_line", "fare_part", "total_fare"))


def match_record(m):
    """A matched row and the one before it as ride time, fare time and the fare's fields."""
    ride_first = F.col("prev_side") == 0
    return m.select(
        "ride_id",
        ntz_from_ms(F.when(ride_first, F.col("prev_t_ms")).otherwise(F.col("t_ms"))).alias("ride_time"),
        ntz_from_ms(F.when(ride_first, F.col("t_ms")).otherwise(F.col("prev_t_ms"))).alias("fare_time"),
        F.when(ride_first, F.col("fare_line")).otherwise(F.col("prev_fare_line")).alias("fare_line"),
        F.when(ride_first, F.col("total_fare")).otherwise(F.col("prev_total_fare")).alias("total_fare"))


@query("ride_fare_match")
def ride_fare_match(spark, d):
    """J12: START rides paired 1:1 with fares of the same ride id."""
    tagged = matching.connect(*fare_match_rows(ride_starts(spark, d), fares(spark, d)), 0, 1)
    p = matching.pair_sequences(tagged, "ride_id", "side", FARE_ORDER, carry=("side", "t_ms", "fare_line", "total_fare"))
    return match_record(p.filter("matched"))


@query("ride_fare_pairs")
def ride_fare_pairs(spark, d):
    """PRJ-5: J12's output as the nested record of a ride and its fare."""
    pair = matching.as_pair(ride_fare_match(spark, d), ["ride_id", "ride_time"], ["fare_time", "fare_line", "total_fare"])
    return pair.select("pair.ride.ride_id", "pair.ride.ride_time", "pair.fare.fare_time", "pair.fare.fare_line", "pair.fare.total_fare")


def _timed_pairs(spark, d):
    e = events(spark, d).filter(F.col("event_type").isin(P.MATCH_RIDE_TYPE, P.MATCH_FARE_TYPE))
    e = e.select("user_id", "event_id", "ts", "t_ms",
                 F.when(F.col("event_type") == P.MATCH_RIDE_TYPE, "ride").otherwise("fare")
                  .alias("side"))
    return matching.pair_sequences(e, "user_id", "side", ["t_ms", "event_id"],
                                   timeout_ms=P.MATCH_TIMEOUT_MS,
                                   carry=("event_id", "ts"))


@query("timed_match")
def timed_match(spark, d):
    """J7 main output: ride/fare pairs within the timeout."""
    m = _timed_pairs(spark, d).filter("matched")
    ride_first = F.col("side") == "fare"
    return m.select(
        "user_id",
        F.when(ride_first, F.col("prev_event_id")).otherwise(F.col("event_id")).alias("ride_event_id"),
        ntz(F.when(ride_first, F.col("prev_ts")).otherwise(F.col("ts"))).alias("ride_ts"),
        F.when(ride_first, F.col("event_id")).otherwise(F.col("prev_event_id")).alias("fare_event_id"),
        ntz(F.when(ride_first, F.col("ts")).otherwise(F.col("prev_ts"))).alias("fare_ts"))


@query("timed_unmatched")
def timed_unmatched(spark, d):
    """J7 side output: rows dropped unmatched, with the reason."""
    u = _timed_pairs(spark, d).filter(F.col("unmatched_reason").isNotNull())
    return u.select("user_id", "side", "event_id", ntz("ts").alias("ts"),
                    F.col("unmatched_reason").alias("reason"))


# --------------------------------------------------------------- J10 + geo
def _nyc_starts(spark, d):
    r = ride_starts(spark, d)
    return r.filter(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))


@query("geofence")
def geofence(spark, d):
    """J10: START and END events of rides that start and end inside the NYC box."""
    r = ride_events(spark, d).filter(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))
    return r.select("ride_id", "is_start", "start_lon", "start_lat", "end_lon", "end_lat")


@query("rides_per_cell")
def rides_per_cell(spark, d):
    return _nyc_starts(spark, d).groupBy(geo.cell_id("start_lon", "start_lat").alias("cell_id")) \
                                .agg(F.count(F.lit(1)).alias("n"))


@query("cell_centres")
def cell_centres(spark, d):
    c = rides_per_cell(spark, d)
    return c.select("cell_id", geo.cell_center_lon("cell_id").alias("center_lon"),
                    geo.cell_center_lat("cell_id").alias("center_lat"), "n")


@query("path_coverage")
def path_coverage(spark, d):
    r = _nyc_starts(spark, d).select("start_lon", "start_lat", "end_lon", "end_lat")
    cells = geo.path_cells(r, geo.grid_x("start_lon"), geo.grid_y("start_lat"),
                           geo.grid_x("end_lon"), geo.grid_y("end_lat"))
    return cells.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))


@query("distance_per_driver")
def distance_per_driver(spark, d):
    r = _nyc_starts(spark, d)
    dist = geo.euclidean_distance("start_lon", "start_lat", "end_lon", "end_lat")
    return r.groupBy("driver_id").agg(F.count(F.lit(1)).alias("rides"),
                                      F.round(F.sum(dist), 4).alias("total_distance"))


@query("rides_near_point")
def rides_near_point(spark, d):
    r = ride_events(spark, d)
    dist = geo.distance_to_point(P.NEAR_LON, P.NEAR_LAT)
    return r.select("ride_id", "is_start", dist.alias("_d")) \
            .filter(F.col("_d") <= F.lit(P.NEAR_RADIUS)) \
            .select("ride_id", "is_start", F.round("_d", 4).alias("distance"))


@query("heading_sectors")
def heading_sectors(spark, d):
    r = _nyc_starts(spark, d)
    ang = geo.direction_angle("start_lon", "start_lat", "end_lon", "end_lat")
    return r.groupBy((ang / P.HEADING_SECTOR_DEG).cast("int").alias("sector")) \
            .agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------- accumulators of the caller's (UDF-4)
@query("accumulated_mean")
def accumulated_mean(spark, d):
    """Mean value per user through a caller's accumulator (cents, so that sums are exact)."""
    e = events(spark, d).select("user_id", F.round(F.col("value") * 100).alias("cents"))
    return accumulate(e, "user_id", Mean("cents")).select("user_id", F.col("mean").alias("mean_cents"), "n")


@query("accumulated_top")
def accumulated_top(spark, d):
    """The three largest values per event type with their event ids, through a caller's accumulator."""
    e = events(spark, d).select("event_type", "event_id", "value")
    top = accumulate(e, "event_type", TopValues("value", "event_id", P.TOP_N))
    return top.select("event_type", F.posexplode(F.arrays_zip("values", "ids")).alias("i", "t")).select(
        "event_type", (F.col("i") + 1).cast("long").alias("rank"), F.col("t.ids").alias("event_id"), F.col("t.values").alias("value"))


@query("window_median")
def window_median(spark, d):
    """UDF-5: the median value of a user and window by a process-window function of the caller's."""
    def median(user, start, end, rows):
        values = [r.value for r in rows if r.value is not None and r.value == r.value]
        return [(user, start, end, statistics.median(values) if values else None)]

    e = events(spark, d).select("user_id", "ts", "value")
    m = windows.process_window(e, "user_id", P.MIN_WINDOW, median, "user_id long, window_start timestamp, window_end timestamp, median double",
                               records=True)
    return m.select("user_id", ntz("window_start").alias("window_start"), ntz("window_end").alias("window_end"), "median")


# --------------------------------------------------------------- sources
@query("bounded_scan")
def bounded_scan(spark, d):
    """SRC-8: events before ``begin + duration`` (exclusive); the predicate is
    on the stored column, so it is pushed into the parquet scan."""
    stop = datetime.fromisoformat(P.BOUNDED_BEGIN) + timedelta(days=P.BOUNDED_DAYS)
    raw = load(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return raw.filter(F.col("ts") < F.lit(stop.isoformat(sep=" ")).cast("timestamp_ntz"))


def sensor_lines(spark, d):
    """Events rendered as sensor lines ``id,seconds,value``; error events
    carry an ISO time in the seconds field (malformed on purpose)."""
    e = events(spark, d)
    sec = F.when(F.col("event_type") == "error",
                 F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")) \
           .otherwise(F.expr("t_ms div 1000").cast("string"))
    return L.render_lines(e, [F.col("user_id").cast("string"), sec, L.money_text(F.col("value"))])


@query("csv_roundtrip")
def csv_roundtrip(spark, d):
    good, _ = L.split_quarantine(L.parse_lines(sensor_lines(spark, d), "sensor"))
    return good


@query("csv_quarantine")
def csv_quarantine(spark, d):
    _, bad = L.split_quarantine(L.parse_lines(sensor_lines(spark, d), "sensor"))
    return bad.select(F.col("_corrupt_record").alias("line"))


# --------------------------------------------------------------- text files of the four line formats
def line_records(spark, d, kind):
    """Rendered lines of one format: sensor and request lines from events, ride lines
    from START / END events, fare lines from the line items."""
    sec = F.expr("t_ms div 1000").cast("string")
    if kind == "sensor":
        return L.render_lines(events(spark, d), ["user_id", sec, L.money_text(F.col("value"))])
    if kind == "request":
        return L.render_lines(events(spark, d), ["user_id", "event_type", sec])
    if kind == "ride":
        return L.render_lines(ride_events(spark, d), [
            "ride_id", F.when(F.col("is_start"), "START").otherwise("END"), F.unix_seconds("event_time")])
    li = load(spark, d, "lineitem")
    return L.render_lines(li, ["l_orderkey", L.money_text(F.col("l_extendedprice")),
                               F.unix_seconds(F.col("l_shipdate").cast("timestamp"))])


def line_files(spark, d, kind):
    """The lines as text files in the shared folder; returns the folder."""
    path = scratch_path(spark, f"lines-{kind}")
    line_records(spark, d, kind).write.text(path)
    return path


def _from_files(kind):
    def run(spark, d):
        lines = L.read_lines(spark, line_files(spark, d, kind))
        return L.split_quarantine(L.parse_lines(lines, kind))[0]
    run.__name__ = f"lines_{kind}"
    run.__doc__ = f"SRC-1..5: {kind} lines read back from text files as typed records."
    return run


for _kind in LINE_SCHEMAS:
    query(f"lines_{_kind}")(_from_files(_kind))


@query("line_windows")
def line_windows(spark, d):
    """PRJ-3: readings from text lines, their seconds as event time, counted per id and window."""
    rows = QUERIES["lines_sensor"](spark, d).withColumn("ts", from_seconds("timestamp"))
    n = rows.groupBy(F.window("ts", P.MIN_WINDOW).alias("w"), "id").agg(F.count(F.lit(1)).alias("n"))
    return n.select("id", ntz(F.col("w.start")).alias("window_start"), "n")
