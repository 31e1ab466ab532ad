"""Exact top-k against all inner products."""

import numpy as np
from pyspark.sql import functions as F

from eventide.llm import pivots


def plain(rows, k, every=50):
    seen = {(i, tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q, a in seen:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in seen if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, k, every=50):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    df = df.where(pivots.usable(F.col("embedding"))).select("vec_id", pivots.quantise(F.col("embedding")).alias("embedding"))
    return sorted(map(tuple, pivots.top_k(df, df.where(F.col("vec_id") % every == 0), k).collect()))


def test_random_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(1 if i % 2 else 3).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 420)]  # a large group of copies: ties
    rows += [(500, None), (501, [1.0, None] + [0.0] * 6), (502, [float("nan")] * 8), (503, [float("inf")] * 8), (None, [1.0] * 8),
             (550, [1.0, 2.0]), (551, [2.0, 1.0]), (600, []), (601, []), (3, rows[3][1]), (1000, [1e6] * 8), (1001, [-1e6] * 8)]
    assert run(spark, rows, 5) == plain(rows, 5)


def test_fewer_candidates_and_none(spark):
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])], 5) == plain([(0, [1.0, 0.0]), (1, [0.5, 0.5])], 5)
    assert run(spark, [(0, [1.0])], 5) == []
    assert run(spark, [], 5) == []


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "ROW_BLOCK", 16)
    monkeypatch.setattr(pivots, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(120)]
    assert run(spark, rows, 3, every=10) == plain(rows, 3, every=10)


def test_bounds_stop_early():
    """Clustered vectors: the exact answer without computing all products."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 2000
    x = (centres[rng.integers(20, size=4000)] + rng.normal(size=(4000, 16)) * 20).astype(np.int64)
    table = pivots.choose_pivots(x[:500], 32)
    d = lambda v: np.sqrt(((v[:, None].astype(float) - table[None]) ** 2).sum(2))
    ids, q = np.arange(4000), x[:5]
    out, evaluated = pivots.search_block(ids[:5], q, d(q), ids, x, d(x), 5)
    for i, (_, got, score) in enumerate(out):
        s = x @ q[i]
        s[i] = -2 ** 62
        want = np.lexsort((ids, -s))[:5]
        assert got.tolist() == want.tolist() and score.tolist() == s[want].tolist()
    assert evaluated < 0.5 * 5 * 4000
