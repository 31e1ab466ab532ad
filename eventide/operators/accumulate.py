"""Aggregates of the caller's: create, add, merge, result (UDF-4).

Tasks fold their rows into one partial state per key, Arrow batch by Arrow batch; only the
states are shuffled, and equal keys are merged in a stream over sorted rows.  A key that holds any
share of the rows therefore sends at most one state a task (and one more each time a task's
states outgrow ``HELD_KEYS``), and no group is collected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

#: States that a task holds before it sends them on.
HELD_KEYS = 100_000


class Accumulator:
    """Base of the caller's accumulators.  ``state`` and ``result`` are DDL; states and results are
    tuples of their fields.  ``merge`` must not depend on order or grouping."""

    state: str = ""
    result_schema: str = ""

    def create(self) -> tuple:
        raise NotImplementedError

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        """The state with some rows of one key."""
        raise NotImplementedError

    def add_groups(self, states: list[tuple], rows: pd.DataFrame, codes: np.ndarray) -> list[tuple]:
        """The states of many keys with their rows; ``codes`` holds each row's place in ``states``.  Here one ``add``
        per key; an accumulator that can add whole columns says so, which counts where a key has few rows in a batch."""
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(states) + 1))
        rows = rows.iloc[order]
        return [self.add(s, rows.iloc[a:b]) for s, a, b in zip(states, ends, ends[1:])]

    def merge(self, a: tuple, b: tuple) -> tuple:
        raise NotImplementedError

    def result(self, state: tuple) -> tuple:
        raise NotImplementedError


def _keyed_frame(found: dict, keys: list[str], fields: list[str]) -> pd.DataFrame:
    rows = [(*k, *v) for k, v in found.items()]
    return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=object) for i, c in enumerate([*keys, *fields])})


def accumulate(df: DataFrame, keys, acc: Accumulator) -> DataFrame:
    """``keys`` and the fields of ``acc.result_schema``, one row per key; null keys are keys.  ``add`` sees
    all columns of ``df``, so select those it needs."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    state = [f"_s{i}" for i in range(len(StructType.fromDDL(acc.state)))]
    out = StructType.fromDDL(acc.result_schema).fieldNames()
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    states = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(state, StructType.fromDDL(acc.state)))

    def key_of(values) -> tuple:
        return tuple(None if pd.isna(v) else v for v in values)

    def fold(frames):
        held: dict = {}
        for pdf in frames:
            if pdf.empty:
                continue
            codes = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
            found = [key_of(k) for k in pdf[keys].iloc[first].itertuples(index=False, name=None)]
            states = [held[k] if k in held else acc.create() for k in found]
            held.update(zip(found, acc.add_groups(states, pdf, codes)))
            if len(held) > HELD_KEYS:
                yield _keyed_frame(held, keys, state)
                held = {}
        if held:
            yield _keyed_frame(held, keys, state)

    def combine(frames):
        now, value = None, None
        for pdf in frames:
            done = {}
            for row in pdf.itertuples(index=False, name=None):
                k, s = key_of(row[:len(keys)]), row[len(keys):]
                if k == now:
                    value = acc.merge(value, s)
                    continue
                if now is not None:
                    done[now] = acc.result(value)
                now, value = k, s
            if done:
                yield _keyed_frame(done, keys, out)
        if now is not None:
            yield _keyed_frame({now: acc.result(value)}, keys, out)

    partial = df.mapInPandas(fold, f"{kinds}, {states}")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partial.repartition(n, *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(combine, f"{kinds}, {acc.result_schema}")


class Mean(Accumulator):
    """Mean of a column, from its sum and count; null values do not count."""

    state, result_schema = "total double, n long", "mean double, n long"

    def __init__(self, value: str):
        self.value = value

    def create(self):
        return 0.0, 0

    def add(self, state, rows):
        v = rows[self.value].dropna()
        return state[0] + float(v.sum()), state[1] + len(v)

    def add_groups(self, states, rows, codes):
        known = rows[self.value].notna().to_numpy()
        v, codes = rows[self.value].to_numpy()[known].astype(float), codes[known]
        totals = np.bincount(codes, v, len(states)).tolist()
        ns = np.bincount(codes, minlength=len(states)).tolist()
        return [(s[0] + t, s[1] + n) for s, t, n in zip(states, totals, ns)]

    def merge(self, a, b):
        return a[0] + b[0], a[1] + b[1]

    def result(self, state):
        return (state[0] / state[1] if state[1] else None), int(state[1])


class TopValues(Accumulator):
    """The ``k`` largest values of a column with an id each: by value, then the smaller id."""

    state, result_schema = "values array<double>, ids array<bigint>", "values array<double>, ids array<bigint>"

    def __init__(self, value: str, id_col: str, k: int):
        self.value, self.id, self.k = value, id_col, k

    def create(self):
        return [], []

    def _best(self, values, ids):
        top = sorted(zip(values, ids), key=lambda x: (-x[0], x[1]))[:self.k]
        return [float(v) for v, _ in top], [int(i) for _, i in top]

    def add(self, state, rows):
        rows = rows[rows[self.value].notna()].nlargest(self.k, self.value, keep="all")
        return self._best([*state[0], *rows[self.value]], [*state[1], *rows[self.id]])

    def add_groups(self, states, rows, codes):
        t = pd.DataFrame({"code": codes, "v": rows[self.value].to_numpy(), "id": rows[self.id].to_numpy()}).dropna(subset="v")
        t = t.sort_values(["code", "v", "id"], ascending=[True, False, True])
        t = t[t.groupby("code").cumcount() < self.k]
        ends = np.searchsorted(t["code"].to_numpy(), np.arange(len(states) + 1))
        v, ids = t["v"].tolist(), t["id"].tolist()
        return [self.merge(s, (v[a:b], ids[a:b])) for s, a, b in zip(states, ends, ends[1:])]

    def merge(self, a, b):
        return self._best([*a[0], *b[0]], [*a[1], *b[1]])

    def result(self, state):
        return self._best(*state)
