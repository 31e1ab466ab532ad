"""Micro-batches as pieces of one exact scan.

Some analytics depend on every earlier row: the watermark that a row sees, the row that
waits for its partner.  Spark's own watermark and keyed state work at the grain of a batch
or of a key.  Here each micro-batch runs the batch operator (a skew-safe scan) and what later
batches need of it is carried in a small table that is versioned by batch id, so a replayed
batch reads what its first attempt read and replaces what that wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import matching, patterns, watermark
from ..operators.scan import keyed_scan
from ..session import delete_path, path_exists


class BatchState:
    """A table per batch id below ``path``: version N is what the batches before N left.  Once batch
    N + 1 begins, N can no longer be replayed, so older versions go."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def _version(self, batch_id: int) -> str:
        return f"{self.path}/before={batch_id}"

    def read(self, batch_id: int) -> DataFrame:
        path = self._version(batch_id)
        if batch_id and not path_exists(self.spark, path):
            raise RuntimeError(f"no state for batch {batch_id} below {self.path}")
        return self.spark.read.schema(self.schema).parquet(path) if batch_id else self.spark.createDataFrame([], self.schema)

    def write(self, batch_id: int, table: DataFrame) -> None:
        """What batch ``batch_id`` leaves for the next one."""
        table.write.mode("overwrite").parquet(self._version(batch_id + 1))
        if batch_id > 1:
            delete_path(self.spark, self._version(batch_id - 1))

    def number(self, batch_id: int):
        """The value of a state of one number (None at first)."""
        row = self.read(batch_id).first()
        return None if row is None else row[0]

    def set_number(self, batch_id: int, value) -> None:
        self.write(batch_id, self.spark.createDataFrame([] if value is None else [(value,)], self.schema))


def exact_watermark(state: BatchState, delay_ms: int, t_ms: str = "t_ms", order=("arr_ms", "event_id"),
                    then: Callable[[DataFrame, int], DataFrame] | None = None) -> Callable[[DataFrame, int], DataFrame]:
    """RW-1 on a stream, as a step for ``foreachBatch``: rows get ``wm_before`` (null at the very first),
    ``wm_after`` and ``max_before``, equal to those of one scan over all batches, if the batches come in arrival
    order; inside a batch ``order`` decides.  ``state`` holds the largest event time so far (one long).
    ``then(rows, batch_id)`` goes on with them."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        top = state.number(batch_id)
        rows = watermark.with_watermark_before(batch, delay_ms, t_ms, order, with_after=True)
        if top is not None:
            rows = (rows.withColumn("max_before", F.greatest("max_before", F.lit(top)))
                    .withColumn("wm_before", F.greatest("wm_before", F.lit(top - delay_ms - 1)))
                    .withColumn("wm_after", F.greatest("wm_after", F.lit(top - delay_ms - 1))))
        new = batch.agg(F.max(t_ms)).first()[0]
        state.set_number(batch_id, max((x for x in (top, new) if x is not None), default=None))
        return then(rows, batch_id) if then else rows
    return step


def matched_pairs(state: BatchState, path: str, key: str, side: str, order, carry=(),
                  t_ms: str = "t_ms") -> Callable[[DataFrame, int], DataFrame]:
    """JN-1 / JN-5 on a stream, without a time-out: the pairing rule over two inputs in one tagged
    stream.  ``state`` holds the waiting rows, at most one a key.

    A batch pairs its own rows with one scan, together with the waiting rows of the keys it has;
    the other waiting rows are only handed on.  Keys may hold any share of the rows, and no Python runs
    per key.  Rows of a key must come in order from batch to batch.  Returns the second row of every
    pair with the first one's ``carry`` columns as ``prev_<c>``; what the scan leaves is kept once below
    ``path`` and read for both."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        waiting = state.read(batch_id).select(*batch.columns)
        keys = batch.select(F.col(key).alias("_key")).distinct()
        own = F.col(key).eqNullSafe(F.col("_key"))
        rows = batch.unionByName(waiting.join(keys, own, "left_semi"))
        pairs = matching.pair_sequences(rows, key, side, list(order), t_ms=t_ms, carry=carry)
        place = f"{path}/batch_id={batch_id}"
        pairs.where(F.col("matched") | (F.col("unmatched_reason") == "pending")).write.mode("overwrite").parquet(place)
        done = spark.read.schema(pairs.schema).parquet(place)
        left = done.where(~F.col("matched")).select(*batch.columns)
        state.write(batch_id, left.unionByName(waiting.join(keys, own, "left_anti")))
        return done.where("matched").drop("pos", "matched", "unmatched_reason")
    return step


def small_then_large(state: BatchState, key: str, amount: str, small: float, large: float, within_ms: int,
                     order=("t_ms", "event_id")) -> Callable[[DataFrame, int], DataFrame]:
    """FRD-1 on a stream with hot keys: ``state`` holds the last row of every key (same columns as the
    batch), which is put before the key's rows; the alert is the batch operator's."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        before = state.read(batch_id).select(*batch.columns)
        keys = batch.select(F.col(key).alias("_key")).distinct()
        own = F.col(key).eqNullSafe(F.col("_key"))
        rows = batch.withColumn("_old", F.lit(False)).unionByName(
            before.join(keys, own, "left_semi").withColumn("_old", F.lit(True)))
        at = F.struct(*[F.col(c) for c in order])
        last = rows.groupBy(key).agg(F.max_by(F.struct(*batch.columns), at).alias("r")).select("r.*")
        state.write(batch_id, last.unionByName(before.join(keys, own, "left_anti")))
        hits = patterns.small_then_large(rows, key, amount, small=small, large=large, within_ms=within_ms)
        return hits.where(~F.col("_old")).drop("_old")
    return step


def rolling_best(batch: DataFrame, batch_id: int) -> DataFrame:
    """AGG-10 as a step for ``foreachBatch``: every sum of a closed window arrives in one micro-batch
    (append mode); the rolling arg-max in user order is a scan, so a window's rows may fill several tasks."""
    best = F.struct(F.col("tips").alias("v"), (-F.col("user_id")).alias("nk"), F.col("user_id").alias("k"))
    s = keyed_scan(batch, ["window_end"], ["user_id"], running={"_best": ("max", best, True)})
    return s.select("window_end", F.col("user_id").alias("upto_user_id"), F.col("_best.k").alias("user_id"), F.col("_best.v").alias("tips"))
