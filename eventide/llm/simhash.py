"""SimHash near-duplicates with a generalised pigeonhole search.

The 64 bits of the fingerprint are grouped into partitions of correlated bits.
If the thresholds ``t_1 .. t_m`` of the partitions sum to ``d - m + 1``, two
fingerprints at ``d`` or fewer differing bits agree up to ``t_i`` bits in at
least one partition ``i`` (-1: the partition is not searched).  The number of
partitions and their unequal thresholds come from a dynamic programme over
estimated probe and candidate counts; the estimates use statistics of all
distinct fingerprints.  Candidates are verified on all 64 bits.

Copies collapse to one fingerprint before the search.  Fingerprints of a dense
bucket are first linked to the bucket's smallest member; pairs that are already
in one component are not compared again, so that a large group of near copies
costs about its size and not its square.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.common import arrow_batches, cut

BITS = 64
#: Relative cost of one shuffled probe row and of one compared candidate pair.
PROBE_COST, PAIR_COST = 1.0, 0.05
_CHUNK = 1 << 14


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """Unsigned SimHash of a UTF-8 text: words are runs of other than ASCII white
    space, A-Z in lower case; a bit is 1 if set in over half of the XXH64 values
    (seed 42) of all word shingles.  A text without words gives 0."""
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0] + [e + 1 for e in ends[:n - 1]]
    ends = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, (joined[a:b] for a, b in zip(starts, ends)),
                             repeat(42)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, _CHUNK):
        part = hashes[i:i + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4) -> DataFrame:
    """(id, fp): one row per input row; fp is the fingerprint as a signed long."""
    arrow_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            fps = pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fps], names=["id", "fp"])

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("id"), text.alias("t")).mapInArrow(run, f"id {kind}, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and the 64 x 64 counts of bits set together,
    summed over all rows (one bounded row per task, then 4096 sums)."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(x, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([total.ravel().astype(np.int64)], pa.list_(pa.int64()))],
            names=["n", "c"])

    rows = (fps.select("fp").mapInArrow(run, "n long, c array<long>")
            .select("n", F.posexplode("c").alias("at", "c"))
            .groupBy("at").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect())  # 4096 rows
    both, n = np.zeros(BITS * BITS), 0
    for r in rows:
        both[r["at"]], n = r["c"], r["n"]
    return n, both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """``m`` groups of nearly equal width; each grows by the bit that correlates
    most with the bits it already has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    left, groups = set(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        start = max(left, key=lambda b: (max((corr[b, c] for c in left if c != b), default=0), -b))
        group = [start]
        left.discard(start)
        while len(group) < width:
            best = max(left, key=lambda b: (sum(corr[b, c] for c in group), -b))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def ball(width: int, t: int) -> list[int]:
    """Masks (signed longs) of all keys within ``t`` bits of a key."""
    return [(m ^ 1 << 63) - (1 << 63) for m in (sum(1 << b for b in c) for k in range(t + 1) for c in combinations(range(width), k))]


def _ball_size(width: int, t: int) -> int:
    size, term = 0, 1
    for k in range(t + 1):
        size += term
        term = term * (width - k) // (k + 1)
    return size


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds that sum to ``total`` at the least cost (dynamic programme over
    partitions and the sum so far)."""
    best = {0: (0.0, [])}
    for cost in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (c, ts) in best.items():
            for t, more in cost.items():
                cand = (c + more, ts + [t])
                if s + t not in nxt or cand < nxt[s + t]:
                    nxt[s + t] = cand
        best = nxt
    return best[total]


def _within(rates: np.ndarray, t: int) -> float:
    """P(at most t of independent bits differ)."""
    dist = np.zeros(t + 2)
    dist[0] = 1
    for r in rates:
        dist[1:] = dist[1:] * (1 - r) + dist[:-1] * r
        dist[0] *= 1 - r
    return float(dist[:t + 1].sum())


def _key(group: list[int]) -> Column:
    bits = [F.shiftleft(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long")), j)
            for j, b in enumerate(group)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def plan(fps: DataFrame, distance: int) -> tuple[list[list[int]], list[int]]:
    """Bit groups and thresholds of the cheapest search over ``fps`` (distinct)."""
    n, both = bit_statistics(fps)
    if not n:
        return group_bits(0, both, distance + 1), [0] * (distance + 1)
    rate = 2 * (p := np.diag(both) / n) * (1 - p)
    options = {m: group_bits(n, both, m) for m in range(2, distance + 2)} or {1: [list(range(BITS))]}
    keys = [F.struct(F.lit(m * BITS + i).alias("part"), _key(g).alias("key"))
            for m, groups in options.items() for i, g in enumerate(groups)]
    same = {r["part"]: r["pairs"] for r in
            fps.select(F.explode(F.array(*keys)).alias("k")).groupBy("k.part", "k.key").count()
            .groupBy("part").agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    choices = []
    for m, groups in options.items():
        costs = []
        for i, g in enumerate(groups):
            pairs = n * n / 2
            skew = max(1.0, same.get(m * BITS + i, 0) / max(pairs * _within(rate[g], 0), 1.0))
            costs.append({-1: 0.0} | {
                t: PROBE_COST * n * _ball_size(len(g), t) + PAIR_COST * min(pairs, skew * pairs * _within(rate[g], t))
                for t in range(distance + 1) if _ball_size(len(g), t) <= 4096})
        try:
            choices.append((*allocate(costs, distance - m + 1), m))
        except KeyError:  # no allocation within the ball bound
            continue
    _, thresholds, m = min(choices)
    return options[m], thresholds


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): alternating large-star and
    small-star rounds until the edges no longer change; root is the smallest node.
    Each round is cut into the shared checkpoint folder."""
    e = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .where("a <> b").distinct())
    state = None
    while True:
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("s"))
            .select("s.a", "s.b").where("a <> b").distinct())
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                e.select("b", "b").distinct()).toDF("node", "root")
        state = tuple(now)


def links(fps: DataFrame, distance: int) -> DataFrame:
    """(a, b): links between distinct fingerprints at ``distance`` or fewer bits that
    give the same components as all such links."""
    groups, thresholds = plan(fps, distance)
    near = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance
    used = [(i, g, t) for i, (g, t) in enumerate(zip(groups, thresholds)) if t >= 0]
    own = cut(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("part"), _key(g).alias("key")) for i, g, _ in used])).alias("k"))
        .select("fp", "k.part", "k.key"))
    # 1. Link the members of a bucket to its smallest member: as many rows as members.
    first = own.groupBy("part", "key").agg(F.min("fp").alias("y"), F.count("*").alias("n")).where("n > 1")
    star = (own.withColumnRenamed("fp", "x").join(first, ["part", "key"]).where("x <> y").where(near)
            .select(F.col("x").alias("a"), F.col("y").alias("b")))
    star = cut(star.distinct())
    root = components(star)
    # 2. Compare only what is not yet in one component.  The component with most
    # members of a bucket is never compared with itself.
    def labelled(entries):
        return entries.join(root.withColumnsRenamed({"node": "fp"}), "fp", "left").select(
            "fp", "part", "key", F.coalesce("root", "fp").alias("c"))
    index = cut(labelled(own))
    if all(t == 0 for _, _, t in used):
        probes = index
    else:
        masks = {i: ball(len(g), t) for i, g, t in used}
        widest = F.array(*[F.when(F.col("part") == i, F.array(*[F.lit(m).cast("long") for m in ms]))
                           for i, ms in masks.items()])
        probes = index.select("fp", "part", "c", F.explode(F.transform(
            F.flatten(F.filter(widest, lambda a: a.isNotNull())), lambda m: m.bitwiseXOR(F.col("key")))).alias("key"))
    most = (index.groupBy("part", "key", "c").count().groupBy("part", "key")
            .agg(F.max_by("c", F.struct("count", "c")).alias("top")))
    index = index.join(most, ["part", "key"])
    side = index.select("part", "key", F.col("fp").alias("y"), F.col("c").alias("cy"), "top")
    rest, main = side.where("cy <> top").drop("top"), side.where("cy = top").drop("top")
    p = probes.join(most, ["part", "key"]).select("part", "key", F.col("fp").alias("x"), F.col("c").alias("cx"), "top")
    # every probe against the members outside the bucket's largest component, and
    # probes from outside it against its members
    found = [q.join(side, ["part", "key"]).where(near & (F.col("cx") != F.col("cy")))
             for q, side in ((p, rest), (p.where("cx <> top"), main))]
    return reduce(DataFrame.union, [f.select(F.col("x").alias("a"), F.col("y").alias("b")) for f in found]
                  + [star])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest id reachable over links of ``distance`` or fewer
    bits.  Null and empty texts have fingerprint zero and link like any other.
    Rows that repeat an id each give a row.  A row without id belongs to its
    component but never names it (component_id is null if no member has an id).
    Columns beside the two named ones are not read.  No rows: no rows.
    """
    fp = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = fp.groupBy("fp").agg(F.min("id").alias("first"))
    distinct = cut(distinct)
    root = components(links(distinct.select("fp"), distance))
    named = distinct.join(root.withColumnsRenamed({"node": "fp"}), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    low = named.groupBy("root").agg(F.min("first").alias("component_id"))
    names = named.join(low, "root").select("fp", "component_id")
    return fp.join(names, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
