"""Tumbling-window aggregates (AGG-2..9, WIN-1/3).

All of them are ``groupBy(window(ts, size), key)`` aggregations: partial
aggregation runs before the shuffle, so a hot key or a hot window costs one
partial row per map task, never a task holding the group.  They accept
streaming inputs with a watermark unchanged.
"""

from __future__ import annotations

from collections import namedtuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def total_of(col, scale: int | None = None):
    """Sum of raw values; with ``scale`` (money: 2) rounded to that many decimals,
    which hides the order of summation.  Rounding is the caller's choice."""
    return F.sum(col) if scale is None else F.round(F.sum(col), scale)


def window_sum(df: DataFrame, key: str, value: str, size: str, ts: str = "ts",
               out: str = "total", scale: int | None = None) -> DataFrame:
    """AGG-8 / AGG-2: per key and tumbling window, the sum of ``value``."""
    return (df.groupBy(F.window(ts, size).alias("w"), key)
              .agg(total_of(value, scale).alias(out))
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), key, out))


def window_argmax(agg: DataFrame, value: str, key: str,
                  window_cols=("window_start", "window_end")) -> DataFrame:
    """AGG-9: per window the key with the largest value; ties go to the
    lowest key.  ``max(struct)`` is mergeable, so the per-window step is a
    two-phase aggregate instead of one task per window."""
    best = F.max(F.struct(F.col(value).alias("v"), (-F.col(key)).alias("nk"),
                          F.col(key).alias("k"))).alias("best")
    return (agg.groupBy(*window_cols).agg(best)
               .select(*window_cols, F.col("best.k").alias(key),
                       F.col("best.v").alias(value)))


def window_min_record(df: DataFrame, key: str, value: str, size: str,
                      tiebreak=("t_ms", "event_id"), fields=("event_id", "ts"),
                      ts: str = "ts") -> DataFrame:
    """AGG-3/4: per key and window the record with the lowest ``value``; ties
    keep the earliest by ``tiebreak``.  ``min(struct(value, tiebreak, ...))``
    is deterministic and mergeable (bare ``min_by`` leaves ties undefined)."""
    rec = F.min(F.struct(F.col(value).alias("v"),
                         *[F.col(c).alias(f"tb{i}") for i, c in enumerate(tiebreak)],
                         *[F.col(c).alias(c) for c in fields])).alias("rec")
    return (df.groupBy(F.window(ts, size).alias("w"), key).agg(rec)
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), key,
                      *[F.col(f"rec.{c}").alias(c) for c in fields],
                      F.col("rec.v").alias(value)))


def window_mean(df: DataFrame, key: str, value: str, size: str, ts: str = "ts",
                out: str = "avg_value", scale: int | None = None) -> DataFrame:
    """AGG-6/7: mean per key and window, with its sum and count.  With ``scale`` the
    sum is rounded to that many decimals before it is divided, so that the mean
    is the same double in any engine and any order of summation."""
    return (df.groupBy(F.window(ts, size).alias("w"), key)
              .agg(total_of(value, scale).alias("total"), F.count(value).alias("n"))
              .select(F.col("w.start").alias("window_start"),
                      F.col("w.end").alias("window_end"), key,
                      F.try_divide(F.col("total"), F.col("n")).alias(out), "total", "n"))


#: Result rows that :func:`process_window` sends on at once.
RESULT_ROWS = 10_000


def process_window(df: DataFrame, key: str, size: str, fn, schema: str, ts: str = "ts", records: bool = False) -> DataFrame:
    """UDF-5: a process-window function of the caller's: ``fn(key, start, end, rows)`` gets the rows of a key
    and tumbling window as a pandas frame and returns a frame of ``schema``.  It sees a whole group, as the
    reference's does; what can be merged belongs in :mod:`eventide.operators.accumulate`.

    With ``records`` the rows are a list of named tuples (null: None) and the results an iterable of tuples.
    A frame costs each group a hundred times as much, which counts where windows hold few rows."""
    rows = df.withColumn("_w", F.window(ts, size))
    rows = rows.withColumn("_start", F.col("_w.start")).withColumn("_end", F.col("_w.end")).drop("_w")
    if records:
        return _process_records(rows, key, fn, schema)

    def run(group, pdf):
        return fn(group[0], group[1], group[2], pdf.drop(columns=["_start", "_end"]))

    return rows.groupBy(key, "_start", "_end").applyInPandas(run, schema)


def _process_records(rows: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """Groups are neighbours in sorted partitions; a task reads them from whole Arrow batches."""
    own = [c for c in rows.columns if c not in ("_start", "_end")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(F.col(key).alias("_key"), "_start", "_end", *own).repartition(n, "_key", "_start") \
                .sortWithinPartitions("_key", "_start")
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def groups(batches):
        record = namedtuple("Record", own, rename=True)
        now, held = None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if now is None or row[:3] != now:
                    if now is not None:
                        yield now, held
                    now, held = row[:3], []
                held.append(record._make(row[3:]))
        if now is not None:
            yield now, held

    def send(found):
        columns = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, kinds)], schema=kinds)

    def run(batches):
        found = []
        for group, held in groups(batches):
            found.extend(fn(*group, held))
            if len(found) >= RESULT_ROWS:
                yield send(found)
                found = []
        if found:
            yield send(found)

    return dealt.mapInArrow(run, schema)
