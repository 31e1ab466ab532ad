"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.session import checkpoint_root
from eventide.sources.tables import load

#: Largest table (in bytes, measured) that is broadcast; beyond it a shuffle join runs.
BROADCAST_BYTES = 16 << 20
#: Rows of one Arrow batch handed to Python: a batch of long texts stays small.
ARROW_ROWS = 1000

__all__ = ["load", "cut", "broadcast_if", "arrow_batches", "free_name", "let"]


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through a checkpoint in the cluster's shared folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def broadcast_if(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit the bound, else as it is
    (the join then shuffles both sides)."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def arrow_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch: whole texts travel in it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that does not clash with those of ``df``."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once inside an expression."""
    return F.transform(F.array(value), body)[0]
