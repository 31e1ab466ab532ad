"""Keyed processes of the streaming lane (ST-1..3, TMR-1..4), on the surface of
:mod:`eventide.streaming.process`.

The rules compare a row's time with a deadline through timers alone: a timer at T fires
before the first row after T, whether both are in one micro-batch or not.
"""

from __future__ import annotations

import pandas as pd

from .process import CoProcess, KeyedProcess, List, Map, Value


class SmallThenLarge(KeyedProcess):
    """FRD-1: alert on an amount above ``large`` right after one below ``small`` within
    ``within_ms`` (flag state and the timer that clears it).

    ``time_mode="EventTime"`` measures the window on event time; ``"ProcessingTime"`` is the reference's original
    form (TMR-3): the flag is cleared ``within_ms`` of wall clock after the micro-batch that set it."""

    states = {"flag": Value("timer long")}
    outputs = {"alert": "account_id long, event_id long, t_ms long, amount double"}

    def __init__(self, key="user_id", amount="value", small=1.0, large=500.0, within_ms=60_000, time_mode="EventTime"):
        self.key, self.amount, self.small, self.large, self.within = key, amount, small, large, within_ms
        self.processing = time_mode.lower() == "processingtime"

    def on_row(self, row, ctx):
        amount, flag = getattr(row, self.amount), ctx.state("flag")
        if armed := flag.get():
            if amount > self.large:
                ctx.emit("alert", getattr(row, self.key), row.event_id, row.t_ms, amount)
            ctx.delete(armed[0])
            flag.clear()
        if amount < self.small:
            timer = (ctx.watermark if self.processing else row.t_ms) + self.within
            flag.set(int(timer))
            ctx.register(timer)

    def on_timer(self, t_ms, ctx):
        ctx.state("flag").clear()


class SilenceCounter(KeyedProcess):
    """AGG-12: cumulative count per key, emitted after ``gap_ms`` without a row for the key.  The
    count is never reset (reference behaviour)."""

    states = {"seen": Value("count long, last long")}
    outputs = {"silent": "user_id long, count long, last_ms long"}

    def __init__(self, gap_ms=60_000):
        self.gap = gap_ms

    def on_row(self, row, ctx):
        count, last = ctx.state("seen").get() or (0, row.t_ms)
        ctx.delete(last + self.gap)
        last = max(int(row.t_ms), last)
        ctx.state("seen").set(count + 1, int(last))
        ctx.register(last + self.gap)

    def on_timer(self, t_ms, ctx):
        ctx.emit("silent", ctx.key[0], *ctx.state("seen").get())


class OneToOneMatcher(CoProcess):
    """JN-2 / JN-3: at most one waiting row per key; a row of the other side matches it, a row of the same
    side supersedes it, and after ``timeout_ms`` a timer drops it to the side output."""

    states = {"waiting": Value("side string, event_id long, t long")}
    outputs = {"match": "user_id long, ride_event_id long, ride_ms long, fare_event_id long, fare_ms long",
               "unmatched": "user_id long, side string, event_id long, t_ms long, reason string"}

    def __init__(self, timeout_ms: int):
        self.timeout = timeout_ms

    def on_left(self, row, ctx):
        self._meet("ride", row, ctx)

    def on_right(self, row, ctx):
        self._meet("fare", row, ctx)

    def _meet(self, side, row, ctx):
        state, own = ctx.state("waiting"), (int(row.event_id), int(row.t_ms))
        waiting = state.get()
        if waiting:
            ctx.delete(waiting[2] + self.timeout)
            if waiting[0] != side:
                ride, fare = (waiting[1:], own) if side == "fare" else (own, waiting[1:])
                ctx.emit("match", ctx.key[0], *ride, *fare)
                state.clear()
                return
            ctx.emit("unmatched", ctx.key[0], *waiting, "superseded")
        state.set(side, *own)
        ctx.register(own[1] + self.timeout)

    def on_timer(self, t_ms, ctx):
        ctx.emit("unmatched", ctx.key[0], *ctx.state("waiting").get(), "timeout")
        ctx.state("waiting").clear()


class PseudoWindow(KeyedProcess):
    """AGG-11: a hand-built tumbling window per key: a map from the window's last millisecond to its sum and a
    timer per window.  Rows at or below the watermark are dropped (LATE-3).  An entry is read and written only
    when a row of its window comes, however many windows are open."""

    states = {"sums": Map("window_end_ms long", "total double")}
    outputs = {"window": "user_id long, window_end_ms long, tips double"}

    def __init__(self, size_ms: int, value: str = "value"):
        self.size, self.value = size_ms, value

    def on_row(self, row, ctx):
        if ctx.watermark is not None and row.t_ms <= ctx.watermark:
            return
        end = int(row.t_ms - row.t_ms % self.size + self.size - 1)
        sums = ctx.state("sums")
        old = sums.get(end, stored=ctx.had_timer(end))  # an open window has its timer
        sums.put((end,), (old[0] if old else 0.0) + float(getattr(row, self.value)))
        ctx.register(end)

    def on_timer(self, t_ms, ctx):
        ctx.emit("window", ctx.key[0], t_ms, ctx.state("sums").get(t_ms)[0])
        ctx.state("sums").remove(t_ms)


class GatheredTopN(KeyedProcess):
    """TOP-1 with list state (ST-2): the means of a window, keyed by its end, are gathered in a list without
    being read; one timer a window ranks and clears them.  Means of one window may come in any number of
    micro-batches."""

    states = {"means": List("user_id long, avg_value double")}
    outputs = {"top": "window_start_ms long, window_end_ms long, rank long, user_id long, avg_value double"}

    def __init__(self, n: int, size_ms: int, wait_ms: int = 0):
        self.n, self.size, self.wait = n, size_ms, wait_ms

    def on_row(self, row, ctx):
        ctx.state("means").add(int(row.user_id), float(row.avg_value))
        ctx.register(ctx.key[0] + self.wait)

    def on_timer(self, t_ms, ctx):
        ranked = sorted(ctx.state("means").get(), key=lambda m: (-m[1], m[0]))[:self.n]
        for i, (user, avg) in enumerate(ranked):
            ctx.emit("top", ctx.key[0] - self.size, ctx.key[0], i + 1, user, avg)
        ctx.state("means").clear()


class LateWindowMin(KeyedProcess):
    """AGG-5 / LATE-1 / LATE-2: window minima with late re-firings, over rows that carry their exact
    watermark ``wm_before``.  A map holds the open windows: the smallest on-time record and the smallest of
    all.  A window fires once the watermark reaches its last millisecond, a late row fires it again with
    the watermark that the row saw, and after ``lateness_ms`` the entry goes; later rows leave by the
    output ``too_late``.  ``fire`` rows lack the watermark: it depends on other keys' rows (see
    :func:`eventide.streaming.jobs.late_changelog`)."""

    states = {"windows": Map("start long", "fired boolean, " + ", ".join(
        f"{p}_{c}" for p in ("on", "every") for c in ("value double", "arr long", "id long", "t long")))}
    outputs = {"fire": "user_id long, win_start_ms long, win_end_ms long, event_id long, t_us long, value double",
               "late": "user_id long, win_start_ms long, win_end_ms long, watermark_ms long, event_id long, t_us long, value double",
               "too_late": "user_id long, win_start_ms long, watermark_ms long, event_id long, t_us long, value double"}
    _NONE = (None,) * 4

    def __init__(self, size_ms: int, lateness_ms: int):
        self.size, self.lateness = size_ms, lateness_ms

    def _window(self, start, ctx):
        """A stored window waits for its end or for the last of its late rows."""
        last = start + self.size - 1
        return ctx.state("windows").get(start, stored=ctx.had_timer(last) or ctx.had_timer(last + self.lateness))

    def on_row(self, row, ctx):
        if pd.isna(row.event_id):  # the mark at the end of a bounded input
            return
        rec = (float(row.value), int(row.arr_ms), int(row.event_id), int(row.t_us))
        start = int(row.t_ms - row.t_ms % self.size)
        last, wm = start + self.size - 1, ctx.watermark
        if wm is not None and last + self.lateness <= wm:
            ctx.emit("too_late", ctx.key[0], start, wm, rec[2], rec[3], rec[0])
            return
        windows = ctx.state("windows")
        old = self._window(start, ctx) or (False, *self._NONE, *self._NONE)
        on, every = tuple(old[1:5]), tuple(old[5:9])
        every = rec if every[0] is None else min(every, rec)
        if wm is not None and last <= wm:
            ctx.emit("late", ctx.key[0], start, start + self.size, wm, every[2], every[3], every[0])
            ctx.register(last + self.lateness)
        else:
            on = rec if on[0] is None else min(on, rec)
            ctx.register(last)
        windows.put((start,), bool(old[0]), *on, *every)

    def on_timer(self, t_ms, ctx):
        windows = ctx.state("windows")
        ended = self._window(t_ms + 1 - self.size, ctx)
        if ended and not ended[0] and ended[1] is not None:
            start = t_ms + 1 - self.size
            ctx.emit("fire", ctx.key[0], start, start + self.size, ended[3], ended[4], ended[1])
            windows.put((start,), True, *ended[1:])
            ctx.register(t_ms + self.lateness)
        over = t_ms + 1 - self.size - self.lateness
        if self.lateness and self._window(over, ctx):
            windows.remove(over)
        elif not self.lateness:
            windows.remove(t_ms + 1 - self.size)


def _rows(rows) -> pd.DataFrame:
    frames = [f for f in rows if len(f)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


def long_ride_alert(max_ms: int):
    """LNG-1 as an ``applyInPandasWithState`` function: a ride id whose END is
    more than ``max_ms`` after its START (either arrival order), or whose
    START sees no END before the watermark passes ``start + max_ms``.

    One timeout per ride is all the reference needs, and with very many keys
    (one per ride) the grouped-state API is the cheaper one: state travels
    with the Arrow batch instead of one state-server call per access.  The
    grouped-state timeout fires when the watermark *exceeds* the timestamp,
    i.e. at ``deadline + 1``, like the processors' timers."""
    def fn(key, pdfs, state):
        ride = int(key[0])
        if state.hasTimedOut:
            start, end, alerted = state.get
            if start is not None and end is None and not alerted:
                state.update((start, None, True))     # remember: a late END must not alert
                yield pd.DataFrame({"ride_id": [ride], "start_ms": [int(start)],
                                    "end_ms": pd.array([None], dtype="Int64")})
            return
        pdf = _rows(pdfs)
        if pdf.empty:
            return
        pdf = pdf.sort_values(["t_ms", "is_start"], ascending=[True, False], kind="stable")
        start, end, alerted = state.get if state.exists else (None, None, False)
        out = []
        for t, is_start in zip(pdf["t_ms"].tolist(), pdf["is_start"].tolist()):
            if is_start:
                start = int(t)
            elif end is None:              # the first END closes the ride
                end = int(t)
            if start is not None and end is not None:
                if not alerted and end - start > max_ms:
                    out.append((ride, start, end))
                start, end, alerted = None, None, False
        if start is None and end is None:
            if state.exists:
                state.remove()
        else:
            if start is not None and end is None and not alerted:
                if start + max_ms < state.getCurrentWatermarkMs():
                    out.append((ride, start, None))       # deadline already passed
                    alerted = True
                else:
                    state.setTimeoutTimestamp(start + max_ms)
            state.update((start, end, alerted))
        if out:
            yield pd.DataFrame({"ride_id": [o[0] for o in out], "start_ms": [o[1] for o in out],
                                "end_ms": pd.array([o[2] for o in out], dtype="Int64")})

    fn.OUTPUT = "ride_id long, start_ms long, end_ms long"
    fn.STATE = "start long, end long, alerted boolean"
    return fn
