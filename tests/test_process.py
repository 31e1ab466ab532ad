"""Process functions of the caller's, exact watermarks, two-input matches and idle inputs on several micro-batches."""

import random
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import Row, functions as F

from eventide.operators import matching, watermark, windows
from eventide.operators.accumulate import Accumulator, Mean, TopValues, accumulate
from eventide.session import scratch_path
from eventide.streaming import carry, idle, jobs, process, processors
from eventide.streaming.process import CoProcess, KeyedProcess, List, Map, Value
from eventide.streaming.runner import advance, drain_in_slices, drive

T0 = 1_700_000_000_000
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers do not see this module


def table(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("ts", F.timestamp_millis("t_ms")) if "t_ms" in df.columns else df


def batches(spark, frames, build, name, **options):
    """Run a query over frames, one micro-batch each, restarted in between."""
    base = scratch_path(spark, name)
    for df in frames:
        df.coalesce(1).write.mode("append").parquet(f"{base}/input")
        advance(build(spark.readStream.schema(df.schema).parquet(f"{base}/input")), name, base, **options)
    return spark.read.parquet(f"{base}/data")


class Everything(KeyedProcess):
    """All three kinds of state, two outputs, timers that set timers."""

    states = {"n": Value("n long"), "seen": List("v long"), "by": Map("parity int", "total long")}
    outputs = {"row": "k string, v long, n long", "end": "k string, at long, seen long, odd long, even long"}

    def on_row(self, row, ctx):
        n = (ctx.state("n").get() or (0,))[0] + 1
        ctx.state("n").set(n)
        ctx.state("seen").add(int(row.v))
        p = int(row.v) % 2
        ctx.state("by").put((p,), (ctx.state("by").get(p) or (0,))[0] + int(row.v))
        ctx.register(T0 + 1000 * (1 + (row.t_ms - T0) // 1000))
        ctx.emit("row", ctx.key[0], int(row.v), n)

    def on_timer(self, t_ms, ctx):
        by = ctx.state("by").items()
        ctx.emit("end", ctx.key[0], t_ms, len(ctx.state("seen").get()), by.get((1,), (0,))[0], by.get((0,), (0,))[0])
        ctx.state("seen").clear()
        ctx.state("by").remove(1)
        ctx.state("n").clear()


def everything(rows, end):
    """The same by a plain loop: one key's rows in time order."""
    out, ends = [], []
    for k in sorted({r[0] for r in rows}):
        n, seen, by, timers = 0, [], {}, set()
        own = sorted(((t, v) for kk, t, v in rows if kk == k))
        for t, v in [*own, (end, None)]:
            while timers and min(timers) <= t - 1:
                at = min(timers)
                timers.discard(at)
                ends.append((k, at, len(seen), by.get(1, 0), by.get(0, 0)))
                n, seen = 0, []
                by.pop(1, None)
            if v is None:
                continue
            n += 1
            seen.append(v)
            by[v % 2] = by.get(v % 2, 0) + v
            timers.add(T0 + 1000 * (1 + (t - T0) // 1000))
            out.append((k, v, n))
    return sorted(out), sorted(ends)


@pytest.mark.parametrize("cuts", [1, 4])
def test_states_timers_and_outputs(spark, cuts):
    rng = random.Random(3)
    rows = sorted((T0 + rng.randrange(8000), rng.choice("abc"), i) for i in range(120))
    rows.append((T0 + 9500, "z", 999))  # moves the watermark
    size = -(-len(rows) // cuts)
    frames = [table(spark, [(k, t, v) for t, k, v in rows[i * size:(i + 1) * size]], "k string, t_ms long, v long") for i in range(cuts)]
    tagged = batches(spark, frames, lambda s: process.run(s, "k", Everything(), order=("t_ms", "v")), f"everything{cuts}")
    got = sorted(tuple(r) for r in process.output(tagged, "row").collect())
    ends = sorted(tuple(r) for r in process.output(tagged, "end").collect())
    want, want_ends = everything([(k, t, v) for t, k, v in rows], T0 + 9500)
    assert got == want
    assert ends == [e for e in want_ends if e[1] <= T0 + 9500 - 1]


class Quota(CoProcess):
    """Two inputs share state: the left one sets a quota, the right one uses it."""

    side, left = "side", "quota"
    states = {"left": Value("n long")}
    outputs = {"ok": "k long, id long", "over": "k long, id long"}

    def on_left(self, row, ctx):
        ctx.state("left").set(int(row.n))

    def on_right(self, row, ctx):
        n = (ctx.state("left").get() or (0,))[0]
        ctx.emit("ok" if n > 0 else "over", ctx.key[0], int(row.id))
        ctx.state("left").set(n - 1)


def test_co_process_of_two_streams(spark):
    a = table(spark, [(1, T0, 2), (2, T0, 1), (1, T0 + 50, 1)], "k long, t_ms long, n long")
    b = table(spark, [(1, T0 + 1 + i, 10 + i) for i in range(4)] + [(2, T0 - 5, 20), (2, T0 + 5, 21), (1, T0 + 60, 14)], "k long, t_ms long, id long")

    def build(s):
        both = matching.connect(s["a"].withWatermark("ts", "1 hour"), s["b"].withWatermark("ts", "1 hour"), "quota", "use")
        return process.run(both, "k", Quota(), time=None, order=("t_ms",))
    tagged = drain_in_slices({"a": (a, "t_ms"), "b": (b, "t_ms")}, build, "quota", 3)
    assert sorted(r["id"] for r in process.output(tagged, "ok").collect()) == [10, 11, 14, 21]
    assert sorted(r["id"] for r in process.output(tagged, "over").collect()) == [12, 13, 20]


def test_means_of_one_window_in_several_batches(spark):
    size, rng = 1000, random.Random(5)
    rows = [(T0 + size * w, u, round(rng.random() * 100, 2)) for w in range(3) for u in range(12)]
    rng.shuffle(rows)
    last = (T0 + 60 * size, 0, 1.0)
    frames = [spark.createDataFrame(part, "end_ms long, user_id long, avg_value double").withColumn(
        "window_end", F.timestamp_millis("end_ms")) for part in (rows[:12], rows[12:24], rows[24:], [last])]
    got = batches(spark, frames, lambda s: jobs.gathered_top_n(s, 3, size, delay_ms=10 * size), "gathered")
    want = []
    for w in range(3):
        best = sorted(((-v, u) for e, u, v in rows if e == T0 + size * w))[:3]
        want += [(T0 + size * (w - 1), T0 + size * w, i + 1, u, -v) for i, (v, u) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_many_open_windows_of_one_key(spark):
    """10,000 open windows; the second batch touches three of them, the third closes the first thousand."""
    n, closed = 10_000, 1000
    first = table(spark, [(1, T0 + 1000 * i, 1.0) for i in range(n)], "user_id long, t_ms long, value double")
    second = table(spark, [(1, T0 + 1000 * i + 5, 2.0) for i in (7, 500, n - 1)], "user_id long, t_ms long, value double")
    third = table(spark, [(2, T0 + 20_000_000 + 1000 * closed, 0.0)], "user_id long, t_ms long, value double")
    out = batches(spark, [first, second, third], lambda s: jobs.pseudo_window(s, 1000, delay_ms=20_000_000), "open").collect()
    got = {r["window_end_ms"]: r["tips"] for r in out}
    assert len(out) == len(got) == closed
    start = T0 - T0 % 1000
    assert all(got[start + 1000 * i + 999] == (3.0 if i in (7, 500) else 1.0) for i in range(closed))


@pytest.mark.parametrize("slices", [1, 3, 7])
def test_exact_watermark_does_not_depend_on_batches(spark, slices):
    rng = random.Random(slices)
    rows = [(i, T0 + i * 10, T0 + i * 10 - rng.randrange(400)) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, arr_ms long, t_ms long")
    base = scratch_path(spark, "exact")
    step = carry.exact_watermark(carry.BatchState(spark, f"{base}/top", "top long"), 50)
    got = drain_in_slices({"e": (df, "arr_ms")}, lambda s: s["e"], "exact", slices, batch_fn=step, base=base)
    whole = watermark.with_watermark_before(df, 50, with_after=True)
    cols = ["event_id", "wm_before", "wm_after", "max_before"]
    assert sorted(map(tuple, got.select(*cols).collect()), key=lambda r: r[0]) == sorted(
        map(tuple, whole.select(*cols).collect()), key=lambda r: r[0])


def test_state_versions_are_replayed_and_pruned(spark):
    state = carry.BatchState(spark, scratch_path(spark, "state"), "x long")
    assert state.number(0) is None
    for i in range(4):
        state.set_number(i, i * 10)
        state.set_number(i, i * 10)  # a replayed batch replaces what it wrote
        assert state.number(i + 1) == i * 10
    assert state.number(3) == 20
    with pytest.raises(RuntimeError):
        state.read(1)


@pytest.mark.parametrize("slices", [1, 5])
def test_two_inputs_with_a_hot_key(spark, slices):
    """One ride has a third of all rows; pairs equal those of one scan over everything."""
    rng = random.Random(slices)
    sides = {0: [], 1: []}
    for i in range(900):
        sides[rng.randrange(2)].append((7 if rng.random() < 0.33 else rng.randrange(40), T0 + i, i))
    sides[0].append((None, T0 + 3, 5000))
    a, b = (spark.createDataFrame(sides[i], "ride long, t_ms long, id long") for i in (0, 1))
    fields, order = ("side", "id"), ["t_ms", "side", "id"]
    base = scratch_path(spark, "pairs")
    kinds = "ride long, t_ms long, id long, side int"
    step = carry.matched_pairs(carry.BatchState(spark, f"{base}/waiting", kinds), f"{base}/pairs", "ride", "side", order, carry=fields)
    got = drain_in_slices({"a": (a, "t_ms"), "b": (b, "t_ms")}, lambda s: matching.connect(s["a"], s["b"], 0, 1), "pairs", slices,
                          batch_fn=step, base=base)
    whole = matching.pair_sequences(matching.connect(a, b, 0, 1), "ride", "side", order, carry=fields).where("matched")
    assert sorted((r["id"], r["prev_id"]) for r in got.collect()) == sorted((r["id"], r["prev_id"]) for r in whole.collect())


def test_flag_dies_by_wall_clock(spark):
    """The second row comes 1 ms later in event time but seconds later by the clock."""
    def run(within_ms, pause):
        base = scratch_path(spark, "wall")
        cols = "event_id long, user_id long, t_ms long, value double"
        parts = [table(spark, [(1, 1, T0, 0.5)], cols), table(spark, [(2, 1, T0 + 1, 900.0)], cols)]
        parts[0].coalesce(1).write.mode("append").parquet(f"{base}/input")
        sent = []

        def feed(seconds):
            if seconds > pause and not sent:
                sent.append(parts[1].coalesce(1).write.mode("append").parquet(f"{base}/input"))
            return not sent
        stream = spark.readStream.schema(parts[0].schema).parquet(f"{base}/input")
        out = drive(jobs.fraud(stream, 1.0, 500.0, within_ms, time_mode="ProcessingTime"), "wall", base=base, step=feed, quiet_s=4)
        return out.count()
    assert run(1_000, 10) == 0        # dead by the clock, although 1 ms old in event time
    assert run(3_600_000, 4) == 1     # alive by the clock


@pytest.mark.parametrize("how", ["mark", "none", "max"])
def test_idle_input(spark, how):
    """Rides wait for fares; the fares fall silent.  Rides time out once the fares are marked idle, or
    if the faster input decides."""
    base = scratch_path(spark, f"idle-{how}")
    cols = "user_id long, event_id long, t_ms long, ts timestamp"
    rides = table(spark, [(1, 1, T0), (2, 2, T0 + 500_000)], "user_id long, event_id long, t_ms long")
    fares = table(spark, [(1, 11, T0 + 10)], "user_id long, event_id long, t_ms long")
    rides.coalesce(1).write.parquet(f"{base}/ride")
    fares.coalesce(1).write.parquet(f"{base}/fare")
    inputs = [idle.FileInput(spark, f"{base}/{s}", cols) for s in ("ride", "fare")]

    def build():
        a, b = (idle.without_marks(spark.readStream.schema(cols).parquet(f"{base}/{s}").withWatermark("ts", "0 seconds"), "user_id")
                for s in ("ride", "fare"))
        return jobs.one_to_one_connected(matching.connect(a, b), 60_000)

    def go():
        advance(build(), "idle", base)
        return {(r["kind"], r["event_id"]) for r in spark.read.parquet(f"{base}/data").collect()}
    if how == "max":
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        go()
        table(spark, [(3, 3, T0 + 900_000)], "user_id long, event_id long, t_ms long").coalesce(1).write.mode("append").parquet(f"{base}/ride")
        if how == "mark":
            now = int(time.time() * 1000)
            assert idle.mark_idle(inputs, idle_ms=3_600_000, now_ms=now) == []
            changed = inputs[1].changed_ms()
            time.sleep(0.05)
            assert idle.mark_idle(inputs, idle_ms=inputs[0].changed_ms() - changed, now_ms=inputs[0].changed_ms()) == [inputs[1]]
            assert idle.mark_idle(inputs, idle_ms=3_600_000) == []  # it counts again
        got = go()
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
    assert ("match", None) in got
    assert (("unmatched", 2) in got) == (how != "none")


def test_accumulators_equal_the_built_ins(spark):
    rng = random.Random(8)
    rows = [(None if rng.random() < 0.05 else ("hot" if rng.random() < 0.5 else f"k{rng.randrange(30)}"), i,
             None if rng.random() < 0.1 else float(rng.randrange(1000))) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, id long, v double").repartition(9)
    want = {r["k"]: (r["m"], r["n"]) for r in df.groupBy("k").agg(F.avg("v").alias("m"), F.count("v").alias("n")).collect()}
    assert {r["k"]: (r["mean"], r["n"]) for r in accumulate(df.select("k", "v"), "k", Mean("v")).collect()} == want
    top = {r["k"]: list(zip(r["values"], r["ids"])) for r in accumulate(df, "k", TopValues("v", "id", 4)).collect()}
    for k in {r[0] for r in rows}:
        assert top[k] == sorted([(v, i) for kk, i, v in rows if kk == k and v is not None], key=lambda x: (-x[0], x[1]))[:4]
    assert accumulate(df.limit(0).select("k", "v"), "k", Mean("v")).count() == 0


class Partials(Accumulator):
    """How many partial states a key had."""

    state, result_schema = "n long", "n long"

    def create(self):
        return (1,)

    def add(self, state, rows):
        return state

    def merge(self, a, b):
        return (a[0] + b[0],)

    def result(self, state):
        return state


def test_a_hot_key_sends_one_state_a_task(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")).repartition(6)
    got = {r["k"]: r["n"] for r in accumulate(df, "k", Partials()).collect()}
    assert got[0] == 6 and len(got) == df.distinct().count()


class WholeColumns(Mean):
    """A mean that must not be asked key by key."""

    def add(self, state, rows):
        raise AssertionError("one frame per key")


class WholeTops(TopValues):
    add = WholeColumns.add


def test_many_keys_are_added_by_the_column(spark):
    df = spark.range(6000).selectExpr("if(id % 7 = 0, null, id % 2500) k", "id", "if(id % 5 = 0, null, cast(id % 11 as double)) v").repartition(3)
    rows = [tuple(r) for r in df.collect()]
    want = {}
    for k, i, v in rows:
        want.setdefault(k, []).extend([(v, i)] if v is not None else [])
    got = {r["k"]: (r["mean"], r["n"]) for r in accumulate(df.select("k", "v"), "k", WholeColumns("v")).collect()}
    assert got == {k: (sum(v for v, _ in vs) / len(vs) if vs else None, len(vs)) for k, vs in want.items()}
    got = {r["k"]: list(zip(r["values"], r["ids"])) for r in accumulate(df, "k", WholeTops("v", "id", 2)).collect()}
    assert got == {k: sorted(vs, key=lambda x: (-x[0], x[1]))[:2] for k, vs in want.items()}


def test_records_of_many_small_windows(spark):
    """More groups than an Arrow batch has rows; null keys, values and times, and groups across batches."""
    def told(user, start, end, rows):
        yield user, start, end, sorted(r.id for r in rows), sum(r.v for r in rows if r.v is not None) if len(rows) > 1 else None

    df = spark.range(30_000).selectExpr("if(id % 11 = 0, null, (1 << 60) + id % 1500) user", "id", "if(id % 6 = 0, null, id * 0.5d) v",
                                        f"if(id % 101 = 0, null, timestamp_millis({T0} + (id % 13) * 1000)) ts").repartition(5)
    schema = "user long, start timestamp, stop timestamp, ids array<bigint>, total double"
    got = windows.process_window(df, "user", "5 seconds", told, schema, records=True)
    w = df.groupBy("user", F.window("ts", "5 seconds").alias("w")).agg(
        F.sort_array(F.collect_list("id")).alias("ids"), F.when(F.count(F.lit(1)) > 1, F.coalesce(F.sum("v"), F.lit(0.0))).alias("total"))
    want = w.select("user", "w.start", "w.end", "ids", "total")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))
    assert windows.process_window(df.limit(0), "user", "5 seconds", told, schema, records=True).count() == 0


class Store:
    """A state handle that counts what it is asked: one map, and timers."""

    def __init__(self):
        self.map, self.timers, self.calls = {}, set(), 0

    def getMapState(self, *_):
        return self

    def getValue(self, key):
        self.calls += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.map[key]

    def listTimers(self):
        return iter([t for t in self.timers])

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)

    def getCurrentWatermarkInMs(self):
        return 0


def asked(proc, batches, clock, order, outputs):
    """Calls of the store for each batch of one key, and the rows told."""
    op = process._Processor(proc, order, "t_ms", clock, 0, True, outputs, frozenset())
    store, calls, told = Store(), [], []
    op.init(store)
    for rows in batches:
        before = store.calls
        told += [r.asDict() for r in op.handleInputRows((1,), iter(rows), store)]
        calls.append(store.calls - before)
    return calls, told, store


def fields_of(proc):
    return {tag: [(c.split()[0], {"long": "bigint"}.get(c.split()[1], c.split()[1])) for c in ddl.split(", ")] for tag, ddl in proc.outputs.items()}


def test_closed_windows_cost_no_state_calls():
    """A hundred windows that open and close within a batch; only the one left open is stored."""
    proc = processors.PseudoWindow(1000)
    first = [Row(t_ms=T0 + 2000 * i, value=1.0) for i in range(100)]
    second = [Row(t_ms=T0 + 2000 * 99 + 1, value=2.0), Row(t_ms=T0 + 2000 * 200, value=4.0)]
    calls, told, store = asked(proc, [first, second], None, ("t_ms",), fields_of(proc))
    assert calls == [1, 3]  # written; read, removed, written
    assert [r["window__tips"] for r in told] == [1.0] * 99 + [3.0]
    assert list(store.map.values()) == [(4.0,)]


def test_late_windows_cost_no_state_calls():
    """The same with late re-firings."""
    proc = processors.LateWindowMin(1000, 500)
    rows = [Row(event_id=i, arr_ms=i, t_ms=T0 + 3000 * i, t_us=0, value=float(i), wm_before=T0 + 3000 * (i - 1) if i else None) for i in range(60)]
    late = [Row(event_id=100, arr_ms=100, t_ms=T0 + 3000 * 59 + 5, t_us=0, value=-1.0, wm_before=T0 + 3000 * 59 + 1100),
            Row(event_id=101, arr_ms=101, t_ms=T0 + 3000 * 400, t_us=0, value=7.0, wm_before=T0 + 3000 * 300)]
    calls, told, store = asked(proc, [rows, late], "wm_before", ("arr_ms", "event_id"), fields_of(proc))
    assert calls[0] <= 4 and calls[1] <= 8
    assert [r["fire__value"] for r in told if r["_tag"] == "fire"] == [float(i) for i in range(60)]
    assert [(r["late__value"], r["late__event_id"]) for r in told if r["_tag"] == "late"] == [(-1.0, 100)]
    assert list(store.map) == [(T0 + 3000 * 400 - (T0 + 3000 * 400) % 1000,)]
