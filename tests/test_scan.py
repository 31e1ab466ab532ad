"""The skew-safe keyed scan equals plain window functions, whatever the key
distribution (one key holding half of all rows, many tiny keys, no key)."""

import pytest
from pyspark.sql import Window, functions as F

from eventide.operators.scan import keyed_scan, sequence_number


def _data(spark, n=4000):
    return spark.range(0, n).select(
        F.col("id").alias("eid"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 23).alias("k"),
        ((F.col("id") * 7919) % 500).alias("t"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise((F.col("id") % 13).cast("double"))
         .alias("v"))


@pytest.mark.parametrize("chunks", [1, 3, 8])
def test_keyed_scan_matches_windows(spark, chunks):
    df = _data(spark)
    got = keyed_scan(df, ["k"], ["t", "eid"],
                     running={"cnt": ("count", F.lit(1), True), "mx": ("max", "v", False),
                              "s": ("sum", "v", True), "mn": ("min", "v", True)},
                     lag={"pv": "v", "pt": "t"}, lead={"nv": "v", "ne": "eid"}, n_chunks=chunks)
    w = Window.partitionBy("k").orderBy("t", "eid")
    unb = Window.unboundedPreceding
    want = df.select(
        "*",
        F.count(F.lit(1)).over(w.rowsBetween(unb, 0)).alias("cnt"),
        F.max("v").over(w.rowsBetween(unb, -1)).alias("mx"),
        F.sum("v").over(w.rowsBetween(unb, 0)).alias("s"),
        F.min("v").over(w.rowsBetween(unb, 0)).alias("mn"),
        F.lag("v").over(w).alias("pv"), F.lag("t").over(w).alias("pt"),
        F.lead("v").over(w).alias("nv"), F.lead("eid").over(w).alias("ne"))
    cols = ["eid", "k", "t", "v", "cnt", "mx", "s", "mn", "pv", "pt", "nv", "ne"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert a == b


def test_hot_key_is_split_across_chunks(spark):
    from eventide.operators.scan import chunked
    df = _data(spark)
    c = chunked(df, ["k"], ["t", "eid"], 8)
    per_chunk = {r["_chunk"]: r["n"] for r in
                 c.filter(F.col("k") == 0).groupBy("_chunk").agg(F.count("*").alias("n")).collect()}
    assert len(per_chunk) >= 3          # the key with half of the rows spans several tasks


def test_chunks_are_even_and_each_has_a_task(spark):
    from eventide.operators.scan import chunked, deal
    c = deal(chunked(_data(spark), ["k"], ["t", "eid"], 8), 8)
    got = c.groupBy("_chunk", F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(got) == len({r["p"] for r in got}) == 8
    assert max(r["n"] for r in got) <= 2 * 4000 / 8


def test_null_keys_and_few_rows(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "a", i % 5) for i in range(200)], "eid long, k string, t long")
    got = keyed_scan(df, ["k"], ["t", "eid"], running={"n": ("count", F.lit(1), True)}, lag={"p": "eid"}, n_chunks=8)
    w = Window.partitionBy("k").orderBy("t", "eid")
    want = df.select("*", F.row_number().over(w).alias("n"), F.lag("eid").over(w).alias("p"))
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    for rows in (df.limit(0), df.limit(1)):
        assert keyed_scan(rows, ["k"], ["t", "eid"], lag={"p": "eid"}, n_chunks=8).count() == rows.count()


def test_a_changed_file_is_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1000, 400):
        _data(spark, n).write.mode("overwrite").parquet(path)
        got = sequence_number(spark.read.parquet(path), ["t", "eid"])
        assert got.count() == n and got.agg(F.max("position")).first()[0] == n


def test_sequence_number_is_global_order(spark):
    df = _data(spark, 1000)
    got = sequence_number(df, ["t", "eid"]).select("eid", "position").collect()
    want = df.select("eid", F.row_number().over(Window.orderBy("t", "eid")).alias("position"))
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want.collect())


def test_five_hundred_chunks(spark):
    """Chunks follow the order of (key, order), border keys are found by two comparisons, and the plan names
    a bound a few times and not once a comparison."""
    from eventide.operators.scan import CHUNK, EDGE, chunked

    rows = [(0 if i % 3 == 0 else i % 700, i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, o long")
    tagged = chunked(df, ["k"], ["o"], 500)
    got = sorted((r["k"], r["o"], r[CHUNK], r[EDGE]) for r in tagged.collect())
    chunks = [c for _, _, c, _ in got]
    assert chunks == sorted(chunks) and max(chunks) > 250
    of_key = {}
    for k, _, c, _ in got:
        of_key.setdefault(k, set()).add(c)
    assert all(edge for k, _, _, edge in got if len(of_key[k]) > 1)
    assert len(of_key[0]) > 80  # a third of the rows
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 1_000_000
