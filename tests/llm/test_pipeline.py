"""The pipeline: order, columns, decisions, odd rows."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventide.llm import decontam, queries, secret_scan, simhash, spiece, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
needs_data = pytest.mark.skipif(not os.path.exists(SF) or not os.path.exists(queries.PIECE_MODEL), reason="no test data")


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_dedup", "decontamination", "secret_scan", "sentencepiece"]
    assert corpus_pipeline.ORACLE_SQL is None


@needs_data
def test_each_stage_decides(spark, tmp_path):
    """Every stage's output follows from the operator's result on that stage's input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, None, None, None), (90002, "", "en", "s", 0), (90002, "", "en", "s", 0), (None, "no id here at all", "en", "s", 17),
                                   (90003, 'say token = "abcdef0123456789" here', "en", "s", 36)], docs.schema)
    docs, sizes = docs.unionByName(extra), []
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        after = {r["doc_id"]: r["text"] for r in out.collect()}
        sizes.append(len(after))
        assert out.columns[:5] == COLUMNS
        if name == "toxicity":
            assert set(after) == {i for i, t in before.items() if toxicity.severity(t or "", model)[1] < toxicity.REJECT}
        elif name == "simhash_dedup":
            low = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
            assert set(after) == {i for i, c in low.items() if i is None or i == c}
            assert out.where("doc_id = 90001").count() == 1 and 90002 not in after
        elif name == "decontamination":
            leaks = {r["doc_id"] for r in decontam.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - leaks
        elif name == "secret_scan":
            assert set(after) == set(before) and after[90003] == 'say [SECRET]" here' and after[90001] is None
            assert out.where("doc_id = 90003").first()["n_chars"] == len(after[90003])
            assert not secret_scan.scan(out, model=[-1.0] * len(secret_scan.ALPHABET) ** 2).where(F.size("secrets") > 0).count()
        else:
            enc = spiece.Encoder(spiece.read_model(queries.PIECE_MODEL))
            assert after == before
            for r in out.collect():
                assert r["round_trip"] and (r["piece_ids"] is None if r["text"] is None else r["piece_ids"] == enc.encode([r["text"]])[0].tolist())
        docs = out
    assert sizes[0] > sizes[-1] > 0


@needs_data
def test_run_and_empty(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == COLUMNS + ["piece_ids", "n_pieces", "round_trip"] and out.count() > 0
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


@needs_data
def test_registered_once():
    import __spark_entry__

    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries() and set(queries.ORACLE) <= set(queries.QUERIES)


@needs_data
def test_one_row_of_every_group_stays(spark):
    """Rows that share an id, or have none, are documents of their own: brute force over random ids."""
    import random

    a, b = ("the first text about cats and dogs in the house " * 5).strip(), ("another story of ships and storms at sea " * 5).strip()
    rows = [(3, b), (5, a), (5, b), (7, a), (9, a)]
    got = corpus_pipeline.dedup_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(map(tuple, got)) == [(3, b), (5, a)]
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 9) for _ in range(60)) for _ in range(12)] + ["", None]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice(texts), "x") for _ in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.dedup_stage(spark, df, SF).collect()]
    prints = {t: simhash.fingerprint((t or "").encode()) for t in texts}
    near = {t: {u for u in texts if (prints[t] ^ prints[u]).bit_count() <= 4} for t in texts}
    classes = []
    for t in texts:
        joined = [c for c in classes if any(near[u] & {t} for u in c)]
        classes = [c for c in classes if c not in joined] + [set().union({t}, *joined)]
    present = {t for _, t, _ in rows}
    assert len(got) == sum(bool(c & present) for c in classes)
    for c in classes:
        ids = [i for i, t, _ in rows if t in c]
        kept = [i for i, t in got if t in c]
        if ids:
            assert kept == [min((i for i in ids if i is not None), default=None)]


@needs_data
def test_unnamed_leaks_go(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where(F.size(F.split("text", " ")) > 12).first()["text"]
    clean = "a clean text that has nothing to do with any of the questions in the benchmark at all"
    rows = [(None, item), (None, clean), (4, f"so {item} and so"), (4, clean), (6, None)]
    got = corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, clean), (4, clean), (6, None)], key=str)
