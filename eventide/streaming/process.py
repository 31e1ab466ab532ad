"""Process functions of the caller's (UDF-6, UDF-7, UDF-8) with keyed state, timers and side outputs.

A :class:`KeyedProcess` declares its states and outputs and gets its rows one by one; a
:class:`CoProcess` gets those of two connected inputs.  :func:`run` turns it into a streaming
DataFrame over ``transformWithState``, and :func:`output` picks one of its outputs.  Rows travel as rows: a
pandas frame for each key and micro-batch would cost more than the rows of most keys.

Order and time: a key's rows of a micro-batch come sorted by ``order``.  Before each row the
timers that its watermark has passed fire, in order, so the result does not depend on how
rows are cut into batches.  A row's watermark is its event time less the delay less 1 ms, or
a column of its own (``clock``, see :func:`eventide.streaming.carry.exact_watermark`).  Timers
that no row overtakes fire with the stream's watermark.  A timer at T fires when the watermark
reaches T; as Spark's watermark is one above that of the rule, T + 1 is registered with Spark.

State: value, list and map handles.  What a call reads is kept until its end, and only what
changed is written: a list is appended to without being read, a map's entries are put and
removed one by one, and one that is known not to be stored is neither asked for nor removed.
Timers are a set per key.
"""

from __future__ import annotations

import heapq
from collections import namedtuple
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor
from pyspark.sql.types import DoubleType, FloatType, IntegralType, StructType

#: Columns of the tagged output: this one, and <tag>__<field> for every output.
TAG = "_tag"
_CASTS = {"bigint": int, "int": int, "double": float, "boolean": bool}
_NAN = float("nan")


@dataclass(frozen=True)
class Value:
    """State of one row; ``schema`` is DDL."""
    schema: str


@dataclass(frozen=True)
class List:
    """A list of rows."""
    schema: str


@dataclass(frozen=True)
class Map:
    """Entries of a key (DDL of one or more fields) and a row."""
    key: str
    schema: str


class KeyedProcess:
    """Base of the caller's process functions.  ``states``: name to :class:`Value`, :class:`List` or :class:`Map`;
    ``outputs``: tag to DDL.  Objects are sent to the tasks, so they hold parameters only."""

    states: dict = {}
    outputs: dict[str, str] = {}

    def open(self) -> None:
        """Called once in a task before its rows."""

    def on_row(self, row, ctx: Context) -> None:
        """A row as a named tuple (null numbers: NaN)."""

    def on_timer(self, t_ms: int, ctx: Context) -> None:
        """A timer that was registered for ``t_ms``."""


class CoProcess(KeyedProcess):
    """A process over :func:`eventide.operators.matching.connect`: ``on_left`` and ``on_right`` get
    the rows of the two sides, which share the key's state and timers."""

    side, left = "side", "ride"

    def on_row(self, row, ctx: Context) -> None:
        (self.on_left if getattr(row, self.side) == self.left else self.on_right)(row, ctx)


class _ValueHandle:
    def __init__(self, state):
        self.state, self.known, self.dirty = state, False, False

    def get(self):
        """The state as a tuple, or None."""
        if not self.known:
            self.now, self.known = (tuple(self.state.get()) if self.state.exists() else None), True
        return self.now

    def set(self, *fields) -> None:
        self.now, self.known, self.dirty = fields, True, True

    def clear(self) -> None:
        if self.get() is not None:
            self.now, self.dirty = None, True

    def flush(self) -> None:
        if self.dirty:
            self.state.clear() if self.now is None else self.state.update(self.now)


class _ListHandle:
    def __init__(self, state):
        self.state, self.new, self.cleared = state, [], False

    def add(self, *fields) -> None:
        self.new.append(fields)

    def get(self) -> list[tuple]:
        old = [] if self.cleared or not self.state.exists() else [tuple(x) for x in self.state.get()]
        return old + self.new

    def clear(self) -> None:
        self.new, self.cleared = [], True

    def flush(self) -> None:
        if self.cleared:
            self.state.clear()
        if self.new:
            self.state.appendList(self.new)


class _MapHandle:
    def __init__(self, state):
        self.state, self.seen, self.dirty = state, {}, set()
        self.absent: set = set()  # keys that the store does not hold

    def get(self, *key, stored: bool = True):
        """The entry's fields, or None.  ``stored`` False: the caller knows that no earlier call has left this entry
        (say, since it would have a timer, see :meth:`Context.had_timer`); the store is not asked."""
        if key not in self.seen:
            found = self.state.getValue(key) if stored else None
            self.seen[key] = None if found is None else tuple(found)
            if found is None:
                self.absent.add(key)
        return self.seen[key]

    def put(self, key: tuple, *fields) -> None:
        self.seen[key] = fields
        self.dirty.add(key)

    def remove(self, *key) -> None:
        self.seen[key] = None
        self.dirty.add(key)

    def items(self) -> dict:
        """All entries (reads the whole map)."""
        out = {tuple(k): tuple(v) for k, v in self.state.iterator()} if self.state.exists() else {}
        out.update(self.seen)
        return {k: v for k, v in out.items() if v is not None}

    def flush(self) -> None:
        for key in self.dirty:
            if self.seen[key] is not None:
                self.state.updateValue(key, self.seen[key])
            elif key not in self.absent:
                self.state.removeKey(key)


class Context:
    """What a process function sees of its key: ``key``, ``watermark`` (of the row, else of the stream; None
    before there is one), states by name, timers and outputs."""

    def __init__(self, key, states: dict, timers, watermark, outputs: dict):
        self.key, self._states, self.watermark, self._outputs = key, states, watermark, outputs
        self._asked = timers is not None
        self._stored = set(timers or ())
        self._pending = sorted(self._stored)  # a heap; entries that have been deleted since stay in it
        self._added: set[int] = set()
        self._deleted: set[int] = set()

    def state(self, name: str):
        return self._states[name]

    def had_timer(self, t_ms: int) -> bool:
        """Whether an earlier call may have left a timer at this time (a call for a timer does not know: True)."""
        return not self._asked or t_ms in self._stored

    def register(self, t_ms: int) -> None:
        """A timer (once per time, however often it is registered)."""
        t_ms = int(t_ms)
        if t_ms in self._added or (t_ms in self._stored and t_ms not in self._deleted):
            return
        self._deleted.discard(t_ms)
        if t_ms not in self._stored:
            self._added.add(t_ms)
        heapq.heappush(self._pending, t_ms)

    def delete(self, t_ms: int) -> None:
        t_ms = int(t_ms)
        if t_ms in self._added:
            self._added.discard(t_ms)
        else:
            self._deleted.add(t_ms)

    def _due(self, wm: int) -> int | None:
        """The first timer at or before ``wm``, which then is no longer pending."""
        while self._pending and self._pending[0] <= wm:
            t = heapq.heappop(self._pending)
            if t in self._added or (t in self._stored and t not in self._deleted):
                self.delete(t)
                return t
        return None

    def emit(self, tag: str, *fields) -> None:
        self._outputs[tag].append(fields)


def _same(v):
    return v


class _Processor(StatefulProcessor):
    """Runs a process function in Spark's operator."""

    def __init__(self, process: KeyedProcess, order, t_ms: str, clock: str | None, delay_ms: int, event_time: bool, fields: dict,
                 numbers: frozenset):
        self.process, self.order, self.t_ms, self.clock = process, list(order or ()), t_ms, clock
        self.delay, self.event_time, self.fields = delay_ms, event_time, fields
        self.numbers, self.record = numbers, None

    def init(self, handle):
        self.handle = handle
        make = {Value: lambda n, s: (_ValueHandle, handle.getValueState(n, s.schema)),
                List: lambda n, s: (_ListHandle, handle.getListState(n, s.schema)),
                Map: lambda n, s: (_MapHandle, handle.getMapState(n, s.key, s.schema))}
        self.stores = {n: make[type(s)](n, s) for n, s in self.process.states.items()}
        self.process.open()

    def _context(self, key, timer_values, stored) -> Context:
        now = timer_values.getCurrentWatermarkInMs() - 1 if self.event_time else timer_values.getCurrentProcessingTimeInMs()
        return Context(key, {n: kind(s) for n, (kind, s) in self.stores.items()}, stored, None if now < 0 else now,
                       {tag: [] for tag in self.fields})

    def _close(self, ctx: Context):
        ahead = 1 if self.event_time else 0
        for handle in ctx._states.values():
            handle.flush()
        for t in ctx._deleted:
            self.handle.deleteTimer(t + ahead)
        for t in ctx._added:
            self.handle.registerTimer(t + ahead)
        for tag, rows in ctx._outputs.items():
            make = Row(TAG, *(f"{tag}__{name}" for name, _ in self.fields[tag]))  # the other outputs' columns are null
            for row in rows:
                yield make(tag, *(None if v is None or v != v else _CASTS.get(kind, _same)(v)
                                  for v, (_, kind) in zip(row, self.fields[tag], strict=True)))

    def _records(self, rows):
        """Named tuples, with NaN for null numbers."""
        for row in rows:
            if self.record is None:
                names = row.__fields__
                self.record, self.nullable = namedtuple("Record", names, rename=True), [n in self.numbers for n in names]
            yield self.record._make(_NAN if v is None and number else v for v, number in zip(row, self.nullable))

    def _in_order(self, records) -> list:
        places = None
        def at(record):
            return [(1, 0) if (v := record[i]) is None or v != v else (0, v) for i in places]
        records = list(records)
        if records:
            places = [records[0]._fields.index(c) for c in self.order]
        return sorted(records, key=at)

    def handleInputRows(self, key, rows, timerValues):
        # only rows in event time can overtake a timer
        ctx = self._context(key, timerValues, [int(t) - 1 for t in self.handle.listTimers()] if self.event_time else [])
        records = self._records(rows)
        if self.order:  # a key's rows of a batch are held; without an order they are handled as they come
            records = self._in_order(records)
        stream = ctx.watermark
        for row in records:
            if self.event_time:
                wm = getattr(row, self.clock) if self.clock else getattr(row, self.t_ms) - self.delay - 1
                wm = None if wm is None or wm != wm else int(wm)
                while wm is not None and (t := ctx._due(wm)) is not None:
                    ctx.watermark = t
                    self.process.on_timer(t, ctx)
                ctx.watermark = wm if self.clock else stream
            self.process.on_row(row, ctx)
        yield from self._close(ctx)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        at = int(expiredTimerInfo.getExpiryTimeInMs()) - (1 if self.event_time else 0)
        ctx = self._context(key, timerValues, None)  # the key's other timers are not asked for
        self.process.on_timer(at, ctx)
        yield from self._close(ctx)

    def close(self):
        pass


def run(rows: DataFrame, key, process: KeyedProcess, time: str | None = "ts", t_ms: str = "t_ms", order=("t_ms",), clock: str | None = None,
        delay_ms: int = 0, time_mode: str = "EventTime") -> DataFrame:
    """``process`` over a stream, keyed by the column (or columns) ``key``.  The result is tagged; see :func:`output`.

    ``time``: the event-time column, whose watermark trails by ``delay_ms`` (None: ``rows`` has a watermark).  ``order`` sorts a key's rows in
    a micro-batch (empty: as they come, so that a hot key's rows are never held together).  ``time_mode="ProcessingTime"``: timers are wall-clock times (TMR-3) and rows have no watermark."""
    fields = {tag: [(f.name, f.dataType.simpleString()) for f in StructType.fromDDL(ddl)] for tag, ddl in process.outputs.items()}
    schema = ", ".join([f"{TAG} string", *(f"`{tag}__{name}` {kind}" for tag, fs in fields.items() for name, kind in fs)])
    event_time = time_mode.lower() == "eventtime"
    if event_time and time:
        rows = rows.withWatermark(time, f"{delay_ms} milliseconds")
    numbers = frozenset(f.name for f in rows.schema if isinstance(f.dataType, (IntegralType, FloatType, DoubleType)))
    op = _Processor(process, order, t_ms, clock, delay_ms, event_time, fields, numbers)
    return rows.groupBy(*([key] if isinstance(key, str) else key)).transformWithState(op, schema, "append", time_mode)


def output(tagged: DataFrame, tag: str) -> DataFrame:
    """The rows of one output, with its own column names."""
    own = [c for c in tagged.columns if c.startswith(f"{tag}__")]
    return tagged.where(F.col(TAG) == tag).select(*[F.col(c).alias(c[len(tag) + 2:]) for c in own])
