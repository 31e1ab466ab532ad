"""Sinks, triggers and the micro-batch late splitter (SNK-1..3, CKP-1,
SIDE-1, LATE-2 streaming form)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions.timecols import window_start_ms
from ..session import checkpoint_root, path_exists


def start(stream: DataFrame, name: str, sink="console", path: str | None = None,
          output_mode: str = "append", trigger: str | None = "10 seconds",
          checkpoint: str | None = None, **options):
    """Start a long-running query (CKP-1): named, checkpointed below the shared
    folder under its name, so that a restart goes on where it stopped; periodic
    trigger (None: all there is, then stop).  ``sink`` is a format name (``console``,
    ``parquet``, ``memory`` for tests) or a ``foreachBatch`` function
    ``fn(batch_df, batch_id)`` supplied by the caller (SNK-2/3)."""
    spark = stream.sparkSession
    w = stream.writeStream.queryName(name).outputMode(output_mode) \
              .option("checkpointLocation", checkpoint or f"{checkpoint_root(spark)}/streams/{name}")
    w = w.trigger(processingTime=trigger) if trigger else w.trigger(availableNow=True)
    for k, v in options.items():
        w = w.option(k, v)
    if callable(sink):
        return w.foreachBatch(sink).start()
    w = w.format(sink)
    return w.start(path) if path else w.start()


def fan_out(tag_col: str, paths: dict[str, str]) -> Callable:
    """SIDE-1: a ``foreachBatch`` function writing each tag's rows of a
    tagged output to its own path (per batch, overwrite: replay-safe)."""
    def write(batch_df: DataFrame, batch_id: int):
        batch_df.persist()  # computed once for all outputs
        try:
            for tag, path in paths.items():
                batch_df.filter(F.col(tag_col) == tag).drop(tag_col) \
                        .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch_df.unpersist()
    return write


def late_splitter(state_path: str, main_path: str, late_path: str, size_ms: int,
                  delay_ms: int, lateness_ms: int, t_ms: str = "t_ms") -> Callable:
    """LATE-2 for streams: a ``foreachBatch`` function that routes the rows of
    windows already past their allowed lateness to ``late_path`` and the rest
    to ``main_path``.  The watermark used for batch ``N`` is the one left by
    batches ``< N`` (``max - delay - 1`` as in the reference), stored per batch
    id under ``state_path`` so a replayed batch splits the same way.  Lateness
    is therefore decided at micro-batch granularity."""
    def wm_file(batch_id: int) -> str:
        return f"{state_path}/wm_batch={batch_id}"

    def read_wm(spark, batch_id: int):
        path = wm_file(batch_id)
        return spark.read.parquet(path).first()["wm"] if path_exists(spark, path) else None

    def split(batch_df: DataFrame, batch_id: int):
        batch_df.persist()  # read by both outputs and the new watermark
        try:
            split_once(batch_df, batch_id)
        finally:
            batch_df.unpersist()

    def split_once(batch_df: DataFrame, batch_id: int):
        spark = batch_df.sparkSession
        wm = read_wm(spark, batch_id)
        if wm is None and batch_id > 0:
            wm = read_wm(spark, batch_id - 1)
        start_ = window_start_ms(t_ms, size_ms)
        too_late = F.lit(False) if wm is None else \
            (start_ + F.lit(size_ms - 1 + lateness_ms) <= F.lit(wm))
        tagged = batch_df.withColumn("_late", too_late)
        tagged.filter("_late").drop("_late").write.mode("overwrite") \
              .parquet(f"{late_path}/batch_id={batch_id}")
        tagged.filter(~F.col("_late")).drop("_late").write.mode("overwrite") \
              .parquet(f"{main_path}/batch_id={batch_id}")
        mx = batch_df.agg(F.max(t_ms)).first()[0]
        new = wm if mx is None else max(wm if wm is not None else mx - delay_ms - 1,
                                        mx - delay_ms - 1)
        if read_wm(spark, batch_id) is None:
            spark.createDataFrame([(wm,)], "wm long").write.mode("overwrite").parquet(wm_file(batch_id))
        if new is not None:
            spark.createDataFrame([(new,)], "wm long").write.mode("overwrite") \
                 .parquet(wm_file(batch_id + 1))
    return split
