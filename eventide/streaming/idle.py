"""Idle inputs (WM-3).

The watermark of several inputs is the least of theirs, so an input that falls silent stops
all timers.  ``spark.sql.streaming.multipleWatermarkPolicy=max`` lets the fastest input decide
instead, at the price of late rows.  The rule in between: an input that has been silent for a
stretch of wall clock stops counting.  It is given a mark, a row without a key whose
event time is that of the other inputs, which lifts its watermark and is dropped behind it; its
next row counts again (as late, if it is older than the mark).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_root


class FileInput:
    """A folder that a file stream reads, with the event time it has reached.  ``columns``: DDL of its rows,
    ``time``: its event-time column."""

    def __init__(self, spark: SparkSession, path: str, columns: str, time: str = "ts"):
        checkpoint_root(spark)
        self.spark, self.path, self.columns, self.time = spark, path, columns, time

    def changed_ms(self) -> int | None:
        """Wall clock of its newest file."""
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        times = [f.getModificationTime() for f in fs.listStatus(p) if f.getPath().getName().endswith(".parquet")] if fs.exists(p) else []
        return max(times, default=None)

    def mark(self, at) -> None:
        """Append a mark with event time ``at``."""
        row = self.spark.range(1).select(F.lit(at).cast("timestamp").alias(self.time))
        empty = self.spark.createDataFrame([], self.columns)
        empty.unionByName(row, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(self.path)

    def reached(self):
        """The largest event time of its rows (marks included)."""
        if self.changed_ms() is None:
            return None
        return self.spark.read.schema(self.columns).parquet(self.path).agg(F.max(self.time)).first()[0]


def mark_idle(inputs: list[FileInput], idle_ms: int, now_ms: int | None = None) -> list[FileInput]:
    """Mark those inputs that have had no file for ``idle_ms`` of wall clock while another one is ahead
    of them and is not idle itself; returns them.  Call it from time to time beside the query."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    changed = {i: i.changed_ms() for i in inputs}
    idle = [i for i in inputs if changed[i] is None or now - changed[i] >= idle_ms]
    busy = [i.reached() for i in inputs if i not in idle]
    front = max((t for t in busy if t is not None), default=None)
    marked = []
    for i in idle if front is not None else []:
        at = i.reached()
        if at is None or at < front:
            i.mark(front)
            marked.append(i)
    return marked


def without_marks(rows: DataFrame, key: str, time: str = "ts") -> DataFrame:
    """Drop marks behind ``withWatermark``.  The condition names the event time, so it is not pushed
    below the watermark, which has to see them."""
    return rows.where(F.when(F.col(time).isNotNull(), F.col(key).isNotNull()))
