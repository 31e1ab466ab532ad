"""Hand-derived cases (FIXTURES.md section 2) against the library functions.

The rows are our own; they sit on the same window, lateness and time-out
boundaries as the cases."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from conftest import sensor_rows
from eventide.functions import geo
from eventide.functions.text import line_tokens
from eventide.operators import matching, patterns, topn, watermark, windows
from eventide.sources import lines as L

TOPN_SAMPLE = """
dev_d,1700000100,31.5
dev_a,1700000100,8.0
dev_b,1700000102,25.0
dev_c,1700000104,4.0

dev_c,1700000107,20.0
dev_a,1700000109,16.0
dev_a,1700000114,12.0
dev_b,1700000115,14.0
dev_a,1700000118,6.0
dev_c,1700000121,22.0
dev_a,1700000129,9.0

dev_d,1700000130,50.0
"""


LATE_SAMPLE = """dev_a,1700000098,9.5
dev_b,1700000100,3.25
dev_a,1700000103,7.0
dev_a,1700000104,6.5
dev_a,1700000097,5.0
dev_a,1700000040,8.0
dev_a,1700000039,8.0
dev_a,1700000005,8.0"""


def _by_window(rows):
    out = {}
    for r in rows:
        out.setdefault(int(r["window_start"].timestamp()) % 10000, []).append(r["id"])
    return {k: v for k, v in sorted(out.items())}


def test_f1_top3(spark):
    df = sensor_rows(spark, TOPN_SAMPLE)
    means = windows.window_mean(df, "id", "temperature", "15 seconds")
    top = topn.top_n(means, 3, "avg_value", "id").orderBy("window_start", "rank").collect()
    assert _by_window(top) == {100: ["dev_d", "dev_b", "dev_a"], 115: ["dev_c", "dev_b", "dev_a"],
                               130: ["dev_d"]}
    ex = topn.top_n(means, 3, "avg_value", "id", exclude_last=True) \
             .orderBy("window_start", "rank").collect()
    assert _by_window(ex) == {100: ["dev_d", "dev_b", "dev_a"], 115: ["dev_c", "dev_b"]}
    m = {(int(r["window_start"].timestamp()) % 10000, r["id"]): r["avg_value"] for r in means.collect()}
    assert m[(100, "dev_a")] == m[(100, "dev_c")] == 12.0 and m[(115, "dev_a")] == 7.5


def test_f1_report(spark):
    df = sensor_rows(spark, TOPN_SAMPLE)
    means = windows.window_mean(df, "id", "temperature", "15 seconds") \
                   .withColumn("window_end_ms", F.unix_millis("window_end"))
    rep = {r["window_end_ms"]: r["report"] for r in
           topn.top_n_report(means, 3, "id").collect()}
    assert rep[1700000145000] == ("\n" + topn.RULE + "\n" + topn.HEADER_LABEL + "1700000145000\n"
                                  + topn.RULE + "\n\n")
    assert "No1:  sensorId=dev_b" in rep[1700000130000]
    assert "No2:" not in rep[1700000130000]
    assert "平均值=31.5000" in rep[1700000115000]


def test_f2_window_min(spark):
    df = sensor_rows(spark, "\n".join(LATE_SAMPLE.splitlines()[:4]))
    got = windows.window_min_record(df, "id", "temperature", "15 seconds",
                                    tiebreak=("t_ms", "event_id"), fields=("t_ms",)).collect()
    got = {(int(r["window_start"].timestamp()) % 10000, r["id"]): (r["temperature"], r["t_ms"] // 1000 % 10000)
           for r in got}
    assert got == {(85, "dev_a"): (9.5, 98), (100, "dev_a"): (6.5, 104), (100, "dev_b"): (3.25, 100)}


def test_f2_ties_keep_first_arrival(spark):
    df = sensor_rows(spark, "a,1700000101,5.0\na,1700000102,5.0\na,1700000103,7.0")
    r = windows.window_min_record(df, "id", "temperature", "15 seconds",
                                  tiebreak=("event_id",), fields=("event_id",)).collect()
    assert [x["event_id"] for x in r] == [0]


def test_f3_lateness(spark):
    df = sensor_rows(spark, LATE_SAMPLE)
    s = watermark.with_watermark_before(df, 2000)
    s = watermark.classify_lateness(s, 15000, 60000).orderBy("event_id").collect()
    assert s[4]["wm_before"] == 1700000101999
    assert [r["status"] for r in s[4:]] == ["late", "late", "too_late", "too_late"]
    log, too_late = watermark.window_min_changelog(df, "id", "temperature", 15000, 2000, 60000,
                                                   fields=("event_id",))
    rows = sorted((r["win_start_ms"] // 1000 % 10000, r["id"], r["kind"], r["temperature"],
                   r["watermark_ms"]) for r in log.collect())
    assert (85, "dev_a", "on_time", 9.5, 1700000100999) in rows
    assert (85, "dev_a", "late", 5.0, 1700000101999) in rows
    assert (40, "dev_a", "late", 8.0, 1700000101999) in rows
    assert sorted(r["t_ms"] // 1000 % 10000 for r in too_late.collect()) == [5, 39]


def test_f4_timed_match(spark):
    rows = [("k1", "ride", 100), ("k1", "fare", 102), ("k2", "ride", 103), ("k4", "fare", 161), ("k4", "ride", 162),
            ("k3", "ride", 163), ("k5", "fare", 164), ("k4", "fare", 240), ("k5", "ride", 240)]
    df = spark.createDataFrame([(i, k, s, (1700000000 + t) * 1000) for i, (k, s, t) in enumerate(rows)],
                               "event_id long, ride_id string, side string, t_ms long")
    p = matching.pair_sequences(df, "ride_id", "side", ["t_ms", "event_id"], timeout_ms=60000,
                                carry=("t_ms",)).collect()
    matched = sorted((r["ride_id"], r["prev_t_ms"] // 1000 % 10000, r["t_ms"] // 1000 % 10000)
                     for r in p if r["matched"])
    assert matched == [("k1", 100, 102), ("k4", 161, 162)]
    unmatched = sorted((r["ride_id"], r["side"], r["t_ms"] // 1000 % 10000) for r in p
                       if r["unmatched_reason"])
    assert unmatched == [("k2", "ride", 103), ("k3", "ride", 163), ("k4", "fare", 240), ("k5", "fare", 164),
                         ("k5", "ride", 240)]


def test_f5_silence_and_sessions(spark):
    df = spark.createDataFrame([(i, "u", t * 1000) for i, t in enumerate([0, 30, 90, 151])],
                               "event_id long, user_id string, t_ms long")
    s = patterns.silence_counts(df, "user_id", 60000).orderBy("count").collect()
    assert [(r["count"], r["last_ms"]) for r in s] == [(3, 90000), (4, 151000)]
    ses = patterns.sessions(df, "user_id", 60000).orderBy("start_ms").collect()
    assert [r["n"] for r in ses] == [3, 1]


def test_f6_fraud(spark):
    cases = {"a": [(0.5, 0), (501, 60)], "b": [(0.5, 0), (100, 1), (501, 2)],
             "c": [(0.99, 0), (500.00, 1)], "d": [(0.5, 0), (501, 61)],
             "e": [(0.5, 0), (0.5, 1), (600, 2)], "f": [(1.00, 0), (501, 1)]}
    rows = [(i * 10 + j, k, float(a), s * 1000) for i, (k, v) in enumerate(cases.items())
            for j, (a, s) in enumerate(v)]
    df = spark.createDataFrame(rows, "event_id long, account string, amount double, t_ms long")
    got = patterns.small_then_large(df, "account", "amount").collect()
    assert sorted(r["account"] for r in got) == ["a", "e"]


def test_f7_long_rides(spark):
    H = 3600
    rows = [(1, True, 0), (1, False, 2 * H), (2, True, 0), (2, False, 2 * H),
            (3, True, 0), (4, False, 5 * H), (5, False, 3 * H), (5, True, 0)]
    df = spark.createDataFrame([(r, s, datetime.fromtimestamp(1_600_000_000 + t, timezone.utc).replace(tzinfo=None)) for r, s, t in rows],
                               "ride_id long, is_start boolean, event_time timestamp")
    df = df.withColumn("event_time", F.when((F.col("ride_id") == 2) & ~F.col("is_start"),
                                            F.col("event_time") + F.expr("INTERVAL 1 MILLISECOND"))
                       .otherwise(F.col("event_time")))
    got = sorted(r["ride_id"] for r in patterns.long_rides(df, 2 * H * 1000).collect())
    assert got == [2, 3, 5]


def test_f8_hourly_best(spark):
    rows = [(1, 5.0, "12:10"), (1, 6.0, "12:50"), (2, 10.0, "12:20"), (2, 1.0, "13:00")]
    df = spark.createDataFrame([(d, tip, datetime.fromisoformat(f"2020-01-01 {t}:00")) for d, tip, t in rows],
                               "driver long, tip double, ts timestamp")
    h = windows.window_sum(df, "driver", "tip", "1 hour", out="tips")
    best = windows.window_argmax(h, "tips", "driver").orderBy("window_end").collect()
    assert [(r["window_end"].hour, r["driver"], r["tips"]) for r in best] == [(13, 1, 11.0), (14, 2, 1.0)]


def test_f9_words(spark):
    df = spark.createDataFrame([("a  b ",), (" ",), ("",), ("\ta",)], "line string")
    got = [r["t"] for r in df.select(line_tokens("line").alias("t")).collect()]
    assert got == [["a", "", "b"], [], [""], ["", "a"]]


def test_f10_geo(spark):
    df = spark.createDataFrame([(-74.05, 40.5), (-73.7, 40.5), (-73.99, 40.7493)],
                               "lon float, lat float")
    r = df.select(geo.in_nyc("lon", "lat").alias("in"), geo.cell_id("lon", "lat").alias("c")).collect()
    assert [x["in"] for x in r] == [False, False, True]
    assert r[2]["c"] == 50042

    def path(x1, y1, x2, y2):
        d = spark.createDataFrame([(x1, y1, x2, y2)], "x1 int, y1 int, x2 int, y2 int")
        return [c["cell_id"] for c in geo.path_cells(d, "x1", "y1", "x2", "y2").collect()]

    assert path(0, 0, 2, 1) == [0, 1, 251, 252]
    assert path(0, 0, 2, 2) == [0, 251, 502]
    assert path(0, 0, 4, 1) == [0, 1, 2, 252, 253, 254]
    assert path(2, 1, 0, 0) == [0, 1, 251, 252]
    falling = path(0, 3, 3, 0)
    assert falling[0] == 750 and falling[-1] == 3


def test_f11_pairing(spark):
    def pairs(seq):
        df = spark.createDataFrame([(i, "k", s, i) for i, s in enumerate(seq)],
                                   "event_id long, key string, side string, t_ms long")
        p = matching.pair_sequences(df, "key", "side", ["t_ms", "event_id"], carry=("event_id",))
        got = p.collect()
        return (sorted((r["prev_event_id"], r["event_id"]) for r in got if r["matched"]),
                sorted((r["event_id"], r["unmatched_reason"]) for r in got if r["unmatched_reason"]))

    assert pairs("RFRF")[0] == [(0, 1), (2, 3)]
    assert pairs("RRF") == ([(1, 2)], [(0, "superseded")])
    assert pairs("FRR") == ([(0, 1)], [(2, "pending")])
    assert pairs("RFFR")[0] == [(0, 1), (2, 3)]


def test_f12_malformed_lines(spark):
    df = spark.createDataFrame([("s1,1700000098,9.5",), ("s1,abc,1.0",), ("s1,1",), ("",),
                                ("s2,1700000100,3.25",)], "value string")
    good, bad = L.split_quarantine(L.parse_lines(df, "sensor"))
    assert sorted(r["id"] for r in good.collect()) == ["s1", "s2"]
    assert sorted(r["_corrupt_record"] for r in bad.collect()) == ["s1,1", "s1,abc,1.0"]
