"""Running streaming plans to completion and handing their output on.

``drain`` runs a streaming DataFrame with ``trigger(availableNow=True)`` into
parquet below the shared checkpoint root (never a machine-local folder on a
cluster), with its own checkpoint, and returns the written rows as a batch
DataFrame.  Nothing passes through the driver.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, functions as F

from ..session import path_exists, scratch_path


def advance(stream: DataFrame, name: str, base: str, output_mode: str = "append", batch_fn=None) -> None:
    """Run ``stream`` over all input that is there, with its checkpoint and output below ``base``; run again
    on the same ``base`` it goes on where it stopped (CKP-1)."""
    out, ckpt = f"{base}/data", f"{base}/checkpoint"
    w = stream.writeStream.queryName(f"{name}_{base[-6:]}").option("checkpointLocation", ckpt)
    if output_mode == "append" and batch_fn is None:
        q = w.format("parquet").option("path", out).outputMode("append") \
             .trigger(availableNow=True).start()
    else:
        def write_batch(batch_df, batch_id):
            df = batch_fn(batch_df, batch_id) if batch_fn else batch_df
            df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        q = w.foreachBatch(write_batch).outputMode(output_mode) \
             .trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def drain_in_slices(sources: dict[str, tuple[DataFrame, str]], build, name: str, slices: int = 5,
                    output_mode: str = "append", batch_fn=None, base: str | None = None,
                    each=None) -> DataFrame:
    """Replay stored tables as streams that grow: ``sources`` maps a name to (table, column of its
    order).  The tables are cut at common values of those columns; slice by slice is added to the
    streams' folders, and the query ``build({name: stream})`` is started again on its checkpoint, one
    micro-batch a slice (CKP-1: stopped and restarted between any two).  ``each(slice)`` runs after every
    slice.  Returns the output."""
    spark = next(iter(sources.values()))[0].sparkSession
    base = base or scratch_path(spark, f"stream-{name}")
    times = None
    for table, col in sources.values():
        t = table.select(table[col].alias("t"))
        times = t if times is None else times.unionByName(t)
    shares = [i / slices for i in range(1, slices)]
    cuts = times.agg(F.percentile_approx("t", shares, 1000).alias("c")).first()["c"] if shares else []
    cuts = sorted(set(cuts or []))
    for i in range(len(cuts) + 1):
        streams = {}
        for source, (table, col) in sources.items():
            folder = f"{base}/input-{source}"
            rows = table
            if i:
                rows = rows.where(F.col(col) >= F.lit(cuts[i - 1]))
            if i < len(cuts):
                rows = rows.where(F.col(col) < F.lit(cuts[i]) if i else (F.col(col) < F.lit(cuts[i])) | F.col(col).isNull())
            rows.write.mode("append").parquet(folder)
            streams[source] = spark.readStream.schema(table.schema).parquet(folder)
        advance(build(streams), name, base, output_mode, batch_fn)
        if each:
            each(i)
    return spark.read.parquet(f"{base}/data")


def drain(stream: DataFrame, name: str, output_mode: str = "append",
          batch_fn=None) -> DataFrame:
    """Run ``stream`` over all currently available input and return its
    output.  ``append`` writes with the exactly-once file sink; other modes
    (or a custom ``batch_fn(batch_df, batch_id) -> DataFrame``) go through
    ``foreachBatch``, each batch written to its own ``batch_id=N`` folder with
    overwrite, so a replayed batch replaces itself."""
    spark = stream.sparkSession
    base = scratch_path(spark, f"stream-{name}")
    out, ckpt = f"{base}/data", f"{base}/checkpoint"
    written: list = []
    w = stream.writeStream.queryName(f"{name}_{base[-6:]}").option("checkpointLocation", ckpt)
    if output_mode == "append" and batch_fn is None:
        q = w.format("parquet").option("path", out).outputMode("append") \
             .trigger(availableNow=True).start()
    else:
        def write_batch(batch_df, batch_id):
            df = batch_fn(batch_df, batch_id) if batch_fn else batch_df
            written.append(df.schema)
            df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        q = w.foreachBatch(write_batch).outputMode(output_mode) \
             .trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    schema = written[-1] if written else stream.schema
    if not path_exists(spark, out):  # no micro-batch ran
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def drive(stream: DataFrame, name: str, interval: str = "200 milliseconds", base: str | None = None,
          quiet_s: float = 2.0, limit_s: float = 600.0, step=None) -> DataFrame:
    """Run ``stream`` on the wall clock: a micro-batch every ``interval``, so that processing-time timers
    fire between rows (TMR-3).  Such a query never ends by itself, as a timer may always be pending: it is
    stopped once no row has come for ``quiet_s`` (after ``limit_s`` an error).  ``step(seconds)`` is
    called while it runs and may feed it; it returns True as long as there is more to come."""
    spark = stream.sparkSession
    base = base or scratch_path(spark, f"stream-{name}")
    q = (stream.writeStream.queryName(f"{name}_{base[-6:]}").option("checkpointLocation", f"{base}/checkpoint")
         .format("parquet").option("path", f"{base}/data").outputMode("append").trigger(processingTime=interval).start())
    begin = last = time.monotonic()
    seen = -1
    try:
        while q.isActive:
            q.awaitTermination(0.1)
            now = time.monotonic()
            more = bool(step and step(now - begin))
            fed = [p.batchId for p in q.recentProgress if p.numInputRows]
            if more or (fed and fed[-1] != seen) or q.lastProgress is None:
                last, seen = now, fed[-1] if fed else seen
            if now - last > quiet_s:
                break
            if now - begin > limit_s:
                raise TimeoutError(f"{name} still had rows after {limit_s} s")
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(f"{base}/data") if path_exists(spark, f"{base}/data") else \
        spark.createDataFrame([], stream.schema)
