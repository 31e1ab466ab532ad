"""Skew-safe sequential scans per key: running aggregates, lag and lead.

Many of the reference's keyed process functions are sequential per key (an
alert depends on the previous transaction, a match on the pending row, a
running count on every earlier row).  In batch form these are window
functions over ``partitionBy(key).orderBy(time)`` - which puts all rows of a
key into one task.  If one key holds a third of the data, one task would sort
a third of the data.

``keyed_scan`` computes the same values without that hot spot:

1. ``n - 1`` bounds of ``(key, order)`` are taken once from a bounded sample; a
   row's chunk is a plain column (a binary search over the bounds), so that a
   hot key is spread over several chunks, each holding a contiguous slice of
   the key's sequence, and every reader of the plan sees the same cut;
2. one shuffle on the chunk, whose number is its partition, then the window
   functions inside ``(chunk, key)`` - bounded work per task;
3. only a key that equals a bound's key can lie in two chunks.  The rows of
   those keys are summarised per ``(chunk, key)`` by a two-phase aggregate, and
   the summaries of earlier / later chunks of the same key are carried along;
4. that carry table has at most two rows per bound: a proven size, so it is
   broadcast;
5. combine: ``running = local (+) carry``, ``lag = local lag, or the previous
   chunk's last row for the first row of a chunk`` and symmetrically for lead.

Nothing is cached: a changed input is seen by the next query.

The result equals the plain window functions (tests check this) for any data
distribution.  ``order`` must be a list of ascending columns that is a total
order inside each key (add an id as the last tie-breaker).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = "_chunk"
#: True for rows whose key may lie in more than one chunk.
EDGE = "_edge"
#: Sampled rows per chunk that the bounds are taken from.
SAMPLE_PER_CHUNK = 32
_AGGS = {"count", "sum", "max", "min"}


def n_chunks_for(df: DataFrame, n: int | None = None) -> int:
    return int(n or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal(row, cols, types) -> Column:
    return F.struct(*[F.lit(row[c]).cast(t).alias(f"c{i}") for i, (c, t) in enumerate(zip(cols, types))])


def chunked(df: DataFrame, keys, order, n: int | None = None) -> DataFrame:
    """Tag rows with their chunk and whether their key may cross a chunk border.
    ``keys`` and ``order`` are column names; :func:`deal` then shuffles on the chunk.

    The bounds are quantiles of the ``SAMPLE_PER_CHUNK * n`` rows with the smallest
    hashes, so that the same rows always give the same cut."""
    n = n_chunks_for(df, n)
    cols = [*keys, *order]
    types = [df.schema[c].dataType for c in cols]
    m = SAMPLE_PER_CHUNK * n
    sample = []
    if n > 1:
        sample = (df.select(*cols).withColumn("_h", F.xxhash64(*cols)).orderBy("_h").limit(m)
                  .orderBy(*cols).drop("_h").collect())  # at most m rows
    bounds = []
    for i in range(1, n):
        if sample:
            row = sample[i * len(sample) // n]
            if not bounds or row != bounds[-1]:
                bounds.append(row)
    if not bounds:
        return df.withColumn(CHUNK, F.lit(0)).withColumn(EDGE, F.lit(False))
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
    ladder = F.array(*[_literal(b, cols, types) for b in bounds])
    top = 1 << (len(bounds).bit_length() - 1)
    steps = F.array(*[F.lit(top >> k) for k in range(top.bit_length())])
    # the number of bounds that are not above the row: a binary search in falling powers of two
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(ladder, F.least(at + step, F.lit(len(bounds))) - 1) <= row),
        at + step).otherwise(at))
    tagged = df.withColumn(CHUNK, below)
    # a key that reaches into another chunk is that of the bound below or above its row
    edge = F.lit(not keys)
    for bound in (F.get(ladder, F.col(CHUNK) - 1), F.get(ladder, F.col(CHUNK))) if keys else ():
        same = bound.isNotNull()
        for i, k in enumerate(keys):
            same = same & bound[f"c{i}"].eqNullSafe(F.col(k))
        edge = edge | same
    return tagged.withColumn(EDGE, edge)


def deal(tagged: DataFrame, n: int | None = None) -> DataFrame:
    """One shuffle that gives every chunk a task of its own (the chunk's number is its partition)."""
    return tagged.repartitionById(n_chunks_for(tagged, n), CHUNK)


def keyed_scan(df: DataFrame, keys, order, running: dict | None = None,
               lag: dict | None = None, lead: dict | None = None,
               n_chunks: int | None = None, keep_chunks: bool = False) -> DataFrame:
    """Add scan columns to ``df``.

    running: ``{out: (fn, expr, inclusive)}`` with fn in count/sum/max/min;
             ``inclusive=False`` aggregates strictly earlier rows of the key.
             ``count`` counts non-null values of ``expr``.
    lag / lead: ``{out: expr}`` value of the previous / next row of the key
             (null at the key's first / last row).
    keep_chunks: keep the chunk columns in the output.  A later scan over the
             same keys and order then reuses those chunks: no new sample, and
             since the output is still hash partitioned by the chunk, its
             windows need no exchange either.
    """
    keys = list(keys)
    running = dict(running or {})
    lag = dict(lag or {})
    lead = dict(lead or {})
    for fn, _, _ in running.values():
        if fn not in _AGGS:
            raise ValueError(f"unsupported running aggregate {fn!r}")

    # materialise inputs and order keys as plain columns
    order_cols = []
    base = df
    for i, o in enumerate(order):
        name = o if isinstance(o, str) else f"_o{i}"
        if not isinstance(o, str):
            base = base.withColumn(name, o)
        order_cols.append(name)
    ins = {}
    inputs = {**{o: e for o, (_, e, _) in running.items()}, **lag, **lead}
    for out, expr in inputs.items():
        if isinstance(expr, str) and expr in df.columns:
            ins[out] = expr                       # plain column: no copy in the cache
        else:
            ins[out] = f"_in_{out}"
            base = base.withColumn(ins[out], _as_col(expr))

    tagged = base if CHUNK in df.columns else chunked(base, keys, order_cols, n_chunks)
    c = base if CHUNK in df.columns else deal(tagged, n_chunks)
    part = [CHUNK, *keys]
    w = Window.partitionBy(*part).orderBy(*order_cols)
    unb = Window.unboundedPreceding

    # -- 2. local scan inside (chunk, key); first / last row flags
    local = c.withColumn("_first", F.lag(F.lit(1)).over(w).isNull()) \
             .withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    for out, (fn, _, inclusive) in running.items():
        frame = w.rowsBetween(unb, 0 if inclusive else -1)
        local = local.withColumn(f"_l_{out}", getattr(F, fn)(F.col(ins[out])).over(frame))
    for out in lag:
        local = local.withColumn(f"_l_{out}", F.lag(ins[out]).over(w))
    for out in lead:
        local = local.withColumn(f"_l_{out}", F.lead(ins[out]).over(w))

    # -- 3. per (chunk, key) summary of the keys that may cross a border
    at = F.struct(*[F.col(o) for o in order_cols])
    aggs = [getattr(F, fn)(F.col(ins[out])).alias(f"_s_{out}") for out, (fn, _, _) in running.items()]
    if lag:
        aggs.append(F.max_by(F.struct(*[F.col(ins[o]).alias(o) for o in lag]), at).alias("_s_last"))
    if lead:
        aggs.append(F.min_by(F.struct(*[F.col(ins[o]).alias(o) for o in lead]), at).alias("_s_first"))
    aggs.append(F.lit(1).alias("_one"))
    summary = tagged.filter(EDGE).groupBy(*part).agg(*aggs)

    bw = Window.partitionBy(*keys).orderBy(CHUNK) if keys else Window.orderBy(CHUNK)
    before = bw.rowsBetween(unb, -1)
    carry = summary.select(
        *part,
        F.lag(CHUNK).over(bw).isNotNull().alias("_has_prev"),
        F.lead(CHUNK).over(bw).isNotNull().alias("_has_next"),
        *[(F.sum if fn in ("count", "sum") else getattr(F, fn))(F.col(f"_s_{out}"))
          .over(before).alias(f"_c_{out}") for out, (fn, _, _) in running.items()],
        *([F.lag("_s_last").over(bw).alias("_c_last")] if lag else []),
        *([F.lead("_s_first").over(bw).alias("_c_first")] if lead else []),
    ).filter(F.col("_has_prev") | F.col("_has_next")) \
     .drop("_has_prev", "_has_next")
    # at most two rows per chunk boundary -> bounded by 2 * n_chunks
    carry = carry.select(*[F.col(p).alias(f"_k_{p}") for p in part],
                         *[c_ for c_ in carry.columns if c_ not in part])

    cond = [F.col(p).eqNullSafe(F.col(f"_k_{p}")) for p in part]
    j = local.join(F.broadcast(carry), on=cond, how="left")

    # -- 5. combine
    outs = []
    for out, (fn, _, _) in running.items():
        l_, k_ = F.col(f"_l_{out}"), F.col(f"_c_{out}")
        if fn in ("count", "sum"):
            val = F.coalesce(l_ + k_, l_, k_)
        elif fn == "max":
            val = F.greatest(l_, k_)
        else:
            val = F.least(l_, k_)
        outs.append(val.alias(out))
    for out in lag:
        outs.append(F.when(F.col("_first"), F.col("_c_last").getField(out))
                    .otherwise(F.col(f"_l_{out}")).alias(out))
    for out in lead:
        outs.append(F.when(F.col("_last"), F.col("_c_first").getField(out))
                    .otherwise(F.col(f"_l_{out}")).alias(out))
    keep = [c_ for c_ in df.columns
            if c_ not in running and c_ not in lag and c_ not in lead and c_ not in (CHUNK, EDGE)]
    if keep_chunks:
        keep += [CHUNK, EDGE]
    return j.select(*[F.col(k) for k in keep], *outs)


def running_count(df: DataFrame, keys, order, out: str = "running_count",
                  n_chunks: int | None = None) -> DataFrame:
    """AGG-1: per-key count of rows up to and including the current one."""
    return keyed_scan(df, keys, order, running={out: ("count", F.lit(1), True)},
                      n_chunks=n_chunks)


def sequence_number(df: DataFrame, order, out: str = "position",
                    n_chunks: int | None = None) -> DataFrame:
    """Global 1-based position in ``order`` without a single-task window."""
    return running_count(df, [], order, out, n_chunks)
