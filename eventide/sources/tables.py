"""Scans of the stored tables.

All loaders select only the columns they hand on so that Catalyst prunes the
parquet ``ReadSchema``; filters applied later are pushed into the scan.
Stored timestamps are ``TIMESTAMP_NTZ``; event-time operators (watermarks in
particular) need ``TIMESTAMP``, so loaders cast with the session zone pinned to
UTC, which makes the cast the identity on wall-clock values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def stream_path(sf_dir: str, name: str) -> str:
    """Path for a file stream over one stored table.  The file source wants a
    folder or a glob; a one-character class turns the single file into a glob
    that matches only itself.  A folder of files works the same."""
    p = table_path(sf_dir, name)
    return p if not p.endswith(".parquet") else p[:-1] + "[t]"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def event_millis(ts_col: str = "ts"):
    """Event time in epoch milliseconds (the reference's time unit)."""
    return F.unix_millis(F.col(ts_col))


def events(spark: SparkSession, sf_dir: str, cols=("event_id", "ts", "user_id",
                                                    "event_type", "value")) -> DataFrame:
    """The ``events`` table with ``ts`` as TIMESTAMP and ``t_ms`` in epoch ms."""
    df = load(spark, sf_dir, "events").select(*cols)
    if "ts" in cols:
        df = df.withColumn("ts", F.col("ts").cast("timestamp")) \
               .withColumn("t_ms", event_millis("ts"))
    return df


def streaming_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None):
    """Same rows as :func:`events`, as an unbounded file source."""
    df = streaming_table(spark, sf_dir, "events", max_files_per_trigger)
    return (df.select("event_id", "ts", "user_id", "event_type", "value")
              .withColumn("ts", F.col("ts").cast("timestamp"))
              .withColumn("t_ms", event_millis("ts")))


def ntz(col):
    """Cast an event-time column back to the stored TIMESTAMP_NTZ type."""
    return F.col(col).cast("timestamp_ntz") if isinstance(col, str) else col.cast("timestamp_ntz")


#: Session setting: files per micro-batch of the registered streaming queries (unset: all there are).
FILES_PER_TRIGGER = "spark.eventide.maxFilesPerTrigger"


def streaming_table(spark: SparkSession, sf_dir: str, name: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Any stored table as an unbounded file source, without a cap on the files of a
    micro-batch unless one is given here or in ``spark.eventide.maxFilesPerTrigger``."""
    cap = max_files_per_trigger or spark.conf.get(FILES_PER_TRIGGER, None)
    reader = spark.readStream.schema(load(spark, sf_dir, name).schema)
    if cap:
        reader = reader.option("maxFilesPerTrigger", int(cap))
    return reader.parquet(stream_path(sf_dir, name))
