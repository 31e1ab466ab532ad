"""Exact top-k by inner product with pivot-table elimination.

Components are turned into integers.  For every vector the distances to a few
pivots are computed once.  By the triangle inequality the largest difference of
the pivot distances of query and candidate is a lower bound on their distance,
and so an upper bound on their inner product.  A block of queries meets a block
of candidates in one task; candidates are evaluated in bound order until no
bound can reach the k-th best score.  Blocks have a fixed size, so a task's
memory does not grow with the data.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.llm.common import cut

PIVOTS, PIVOT_SAMPLE = 32, 512
QUERY_BLOCK, ROW_BLOCK = 512, 8192
_STEP = 256


def quantise(vec: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vec: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first pivots: each is the sample row farthest from those chosen."""
    x = sample.astype(np.float64)
    far, chosen = np.full(len(x), np.inf), [0]
    while len(chosen) < min(count, len(x)):
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
        if far.max() == 0:
            break
        chosen.append(int(far.argmax()))
    return x[chosen]


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``x`` with ``q``."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if most < 2 ** 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def search_block(q_id, q, q_dist, x_id, x, x_dist, k: int):
    """(query, id, score) of the k best candidates of one block for each query, and
    the number of inner products computed."""
    out, evaluated = [], 0
    x2 = (x.astype(np.float64) ** 2).sum(1)
    for qi in range(len(q)):
        low = np.abs(x_dist - q_dist[qi]).max(axis=1) if x_dist.shape[1] else np.zeros(len(x))
        q2 = float((q[qi].astype(np.float64) ** 2).sum())
        # rounding of the distances may not hide a candidate: widen the bound
        bound = (x2 + q2 - low ** 2) / 2 + 1e-9 * (x2 + q2) + 1e-6
        bound[x_id == q_id[qi]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), _STEP):
            part = order[at:at + _STEP]
            part = part[bound[part] > -np.inf]
            if not len(part) or (len(scores) == k and bound[part[0]] < scores[-1]):
                break
            evaluated += len(part)
            ids = np.concatenate([ids, x_id[part]])
            scores = np.concatenate([scores, _products(x[part], q[qi])])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
        out.append((np.full(len(ids), q_id[qi]), ids, scores))
    return out, evaluated


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vec_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of every
    query over all rows of ``vectors`` but those with the query's id; ties go to the
    smaller id.

    Both inputs hold integer vectors (see :func:`quantise`).  Rows with a null id or a
    null vector take no part; exact repeats of a row count once; vectors are only
    compared with vectors of their length.  Fewer candidates: fewer rows; none: none.
    """
    def tidy(df):
        return cut(df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
                   .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"),
                           F.size(vec_col).alias("dim")).distinct())

    rows, asks = tidy(vectors), tidy(queries)
    # Pivots: from a bounded sample (PIVOT_SAMPLE rows of each length by hash order).
    pick = Window.partitionBy("dim").orderBy(F.xxhash64("id", "v"), "id")
    sample = (rows.withColumn("r", F.row_number().over(pick)).where(F.col("r") <= PIVOT_SAMPLE)
              .orderBy("dim", "r").limit(64 * PIVOT_SAMPLE).collect())
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    table = {d: choose_pivots(np.array(vs, np.int64).reshape(len(vs), d), pivots) for d, vs in by_dim.items()}

    def distances(batches):
        for pdf in batches:
            pdf["d"] = [np.sqrt(((table[n] - np.asarray(v, np.float64)) ** 2).sum(1)) if n in table
                        else np.empty(0) for v, n in zip(pdf["v"], pdf["dim"])]
            yield pdf

    schema = "id long, v array<long>, dim int, d array<double>"
    rows = rows.mapInPandas(distances, schema)
    asks = asks.mapInPandas(distances, schema)
    n_rows, n_asks = rows.select("id").count(), asks.select("id").count()
    row_blocks, ask_blocks = max(1, math.ceil(n_rows / ROW_BLOCK)), max(1, math.ceil(n_asks / QUERY_BLOCK))
    block = F.xxhash64("id", "v")
    # every block of queries meets every block of rows once
    rows = rows.withColumn("rb", F.pmod(block, F.lit(row_blocks))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0), F.lit(ask_blocks - 1)))).withColumn("qb", F.col("qb").cast("long"))
    asks = asks.withColumn("qb", F.pmod(block, F.lit(ask_blocks))).withColumn(
        "rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))).withColumn("rb", F.col("rb").cast("long"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts = [(np.empty(0, np.int64),) * 3]
        for dim in set(left["dim"]) & set(right["dim"]):
            a, b = left[left["dim"] == dim], right[right["dim"] == dim]
            q, x = (np.array(f["v"].tolist(), np.int64).reshape(len(f), dim) for f in (a, b))
            qd, xd = (np.array(f["d"].tolist(), np.float64).reshape(len(f), -1) for f in (a, b))
            parts += search_block(a["id"].to_numpy(), q, qd, b["id"].to_numpy(), x, xd, k)[0]
        return pd.DataFrame({n: np.concatenate([p[i] for p in parts])
                             for i, n in enumerate(("query_id", "vec_id", "score"))})

    found = (asks.groupBy("qb", "rb").cogroup(rows.groupBy("qb", "rb"))
             .applyInPandas(meet, "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
