"""A training corpus in five stages; each calls one operator of :mod:`eventide.llm`
on everything that the stage before it kept, and hands on the columns of ``documents``
(the last one adds the ids).

A document is a row.  The stages that drop documents name them by a key of their own (doc_id and
hashes of the text), so rows that share a doc_id, or have none, are judged one by one; only
rows that are equal in both are one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventide.llm import decontam, secret_scan, simhash, spiece, toxicity
from eventide.llm.common import free_name, load
from eventide.llm.queries import PIECE_MODEL
from eventide.session import scratch_path


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the ordinal model rejects.  It is fitted on the labelled
    documents of this stage's input."""
    mark = free_name(docs, "toxicity")
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out=mark).where(~F.col(f"{mark}.rejected")).drop(mark)


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key that orders by doc_id (nulls last), then by 128 bits of hashes of the text."""
    key, text = free_name(docs, "row"), F.coalesce("text", F.lit(""))
    return docs.withColumn(key, F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"),
        F.col("text").isNotNull().alias("has_text"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(7), text).alias("g"))), key


def _without(keyed: DataFrame, key: str, drop: DataFrame) -> DataFrame:
    """Rows whose key is not among the keys ``drop``."""
    gone = drop.select(F.col(key).alias("_gone")).distinct()
    return keyed.join(gone, keyed[key] == F.col("_gone"), "left_anti")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group: that with the smallest doc_id (of one id, or of none, that with
    the smaller text hash), and one row of each document."""
    keyed, key = _keyed(docs)
    groups = simhash.near_duplicates(keyed.select(key, "text"), id_col=key, shingle=4, distance=4)
    kept = _without(keyed, key, groups.where(F.col(key) != F.col("component_id")))
    n = free_name(kept, "n")
    order = [F.col(c) for c, kind in docs.dtypes if c != "doc_id" and not kind.startswith(("map", "variant"))]
    first = Window.partitionBy(key).orderBy(*order)  # tasks cut to one row a key before the shuffle
    return kept.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, also with other parameters."""
    keyed, key = _keyed(docs)
    leaks = decontam.find_leaks(keyed.select(key, "text"), load(spark, sf_dir, "benchmark"), id_col=key)
    return _without(keyed, key, leaks).select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mask; n_chars follows.  No document goes."""
    spans = free_name(docs, "spans")
    found = secret_scan.scan(docs, out=spans)
    clean = secret_scan.redact(F.col("text"), F.col(spans))
    changed = F.size(spans) > 0
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(changed, F.length(clean).cast(kind)).otherwise(F.col("n_chars")))
    return found.withColumn("text", clean).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add piece_ids and n_pieces, and whether the ids decode to the text."""
    model = spiece.read_model(PIECE_MODEL)
    done = spiece.decode(spiece.encode(docs, model), model)
    plain = F.replace(F.col("text"), F.lit(spiece.MARK), F.lit(" "))
    return done.withColumn("n_pieces", F.size("piece_ids").cast("long")).withColumn(
        "round_trip", F.col("decoded").eqNullSafe(plain)).drop("decoded")


STAGES = [("toxicity", toxicity_stage), ("simhash_dedup", dedup_stage), ("decontamination", decontamination_stage),
          ("secret_scan", secrets_stage), ("sentencepiece", encoding_stage)]

#: SQL cannot express the trained models, the component search and the piece search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
