"""One-to-one matching of two keyed streams (JN-1, JN-2, JN-3, JN-5).

The reference keeps at most one pending row per key: a row of the other side
matches and clears it, a row of the same side overwrites it, and (JN-2) a
timer drops it after a timeout.  On a stream replayed in order this is the
*pairing rule*: a new island starts where the side repeats or (JN-2) the gap
to the previous row exceeds the timeout; inside an island rows 2k and 2k+1
(0-based) are a match; an island's odd last row is unmatched.

The rule runs as one skew-safe scan (a key may hold any share of the rows):
range-partitioned chunks, window functions inside (chunk, key), and a carry
table bounded by the number of chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scan import CHUNK, EDGE, chunked, deal


def pair_sequences(tagged: DataFrame, key: str, side: str, order, t_ms: str = "t_ms",
                   timeout_ms: int | None = None, carry=(), n_chunks: int | None = None) -> DataFrame:
    """Annotate each row with ``pos`` (0-based inside its island), the
    previous row's ``carry`` columns (``prev_<c>``), ``matched`` (second row
    of a pair) and ``unmatched_reason`` (null, ``superseded`` or ``timeout``;
    ``pending`` when there is no timeout).

    One skew-safe scan: inside a chunk the island start of a row is the last
    island break at or before it; only rows before the chunk's first local
    break need the carry - the previous chunk's last row (does the chunk's
    first row break?) and the last break of the earlier chunks.  Both come
    from two small windows over the per-chunk summary rows (at most two per
    chunk boundary, broadcast)."""
    order = list(order)
    c = tagged if CHUNK in tagged.columns else deal(chunked(tagged, [key], order, n_chunks), n_chunks)
    part = [CHUNK, key]
    w = Window.partitionBy(*part).orderBy(*order)
    unb = Window.unboundedPreceding

    def breaks(p_side, p_t, s_, t_):
        b_ = p_side.isNull() | (p_side == s_)
        if timeout_ms is not None:
            b_ = b_ | (t_ - p_t > F.lit(timeout_ms))
        return b_

    # -- local pass: index, neighbours, local island breaks (row 1 unknown)
    def local_pass(rows):
        out = (rows.withColumn("_li", F.row_number().over(w))
               .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
               .withColumn("_p_side", F.lag(side).over(w))
               .withColumn("_p_t", F.lag(t_ms).over(w))
               .withColumn("_n_side", F.lead(side).over(w))
               .withColumn("_n_t", F.lead(t_ms).over(w)))
        for col in carry:
            out = out.withColumn(f"_p_{col}", F.lag(col).over(w))
        out = out.withColumn("_new_l", F.when(F.col("_li") > 1, breaks(
            F.col("_p_side"), F.col("_p_t"), F.col(side), F.col(t_ms))))
        return out.withColumn("_ls", F.max(F.when(F.col("_new_l"), F.col("_li")))
                              .over(w.rowsBetween(unb, 0)))

    loc = local_pass(c)

    # -- per (chunk, key) summary of the keys that may cross a border, from their first and last rows
    last, first = F.col("_is_last"), F.col("_li") == 1
    summary = local_pass(c.filter(EDGE)).filter(first | last).groupBy(*part).agg(
        F.max(F.when(last, F.col("_li"))).alias("_m"),
        F.max(F.when(last, F.col("_ls"))).alias("_ls_c"),
        F.max(F.when(last, F.struct(F.col(side).alias("s"), F.col(t_ms).alias("t"),
                                    *[F.col(x).alias(x) for x in carry]))).alias("_last_row"),
        F.max(F.when(first, F.struct(F.col(side).alias("s"), F.col(t_ms).alias("t"))))
         .alias("_first_row"))
    bw = Window.partitionBy(key).orderBy(CHUNK)
    sc = (summary
          .withColumn("_cnt", F.coalesce(F.sum("_m").over(bw.rowsBetween(unb, -1)), F.lit(0)))
          .withColumn("_prev_last", F.lag("_last_row").over(bw))
          .withColumn("_next_first", F.lead("_first_row").over(bw))
          .withColumn("_has_next", F.lead(CHUNK).over(bw).isNotNull()))
    sc = sc.withColumn("_first_new", breaks(F.col("_prev_last.s"), F.col("_prev_last.t"),
                                            F.col("_first_row.s"), F.col("_first_row.t")))
    sc = sc.withColumn("_chunk_last_new", F.col("_cnt") + F.coalesce(
        F.col("_ls_c"), F.when(F.col("_first_new"), F.lit(1))))
    sc = sc.withColumn("_start_before", F.max("_chunk_last_new").over(bw.rowsBetween(unb, -1)))
    carry_t = sc.filter(F.col("_prev_last").isNotNull() | F.col("_has_next")).select(
        F.col(CHUNK).alias("_k_chunk"), F.col(key).alias("_k_key"), "_cnt", "_prev_last",
        "_next_first", "_first_new", "_start_before")
    # at most two rows per chunk boundary -> bounded by 2 * n_chunks
    j = loc.join(F.broadcast(carry_t), [F.col(CHUNK).eqNullSafe(F.col("_k_chunk")),
                                        F.col(key).eqNullSafe(F.col("_k_key"))], "left")

    # -- combine
    is_first = F.col("_li") == 1
    cnt = F.coalesce(F.col("_cnt"), F.lit(0))
    first_new = F.coalesce(F.col("_first_new"), F.lit(True))
    idx = F.col("_li") + cnt
    start = (F.when(F.col("_ls").isNotNull(), F.col("_ls") + cnt)
              .when(first_new, cnt + 1)
              .otherwise(F.col("_start_before")))
    pos = idx - start
    n_side = F.when(F.col("_is_last"), F.col("_next_first.s")).otherwise(F.col("_n_side"))
    n_t = F.when(F.col("_is_last"), F.col("_next_first.t")).otherwise(F.col("_n_t"))
    next_new = breaks(n_side, n_t, F.col(side), F.col(t_ms)) if timeout_ms is None else \
        (n_side.isNull() | (n_side == F.col(side)) | (n_t - F.col(t_ms) > F.lit(timeout_ms)))
    superseded = n_side.isNotNull() & (n_side == F.col(side))
    if timeout_ms is not None:
        superseded = superseded & (n_t - F.col(t_ms) <= F.lit(timeout_ms))
        other = F.lit("timeout")
    else:
        other = F.lit("pending")
    reason = F.when((pos % 2 == 0) & next_new,
                    F.when(superseded, F.lit("superseded")).otherwise(other))
    prev = [F.when(is_first, F.col(f"_prev_last.{x}")).otherwise(F.col(f"_p_{x}")).alias(f"prev_{x}")
            for x in carry]
    keep = [x for x in tagged.columns if x not in (CHUNK, EDGE)]
    return j.select(*keep, *prev, pos.alias("pos"), (pos % 2 == 1).alias("matched"),
                    reason.alias("unmatched_reason"))


def connect(a: DataFrame, b: DataFrame, side_a="ride", side_b="fare", side: str = "side") -> DataFrame:
    """JN-5: two heterogeneous keyed inputs as one tagged stream sharing
    per-key state (``unionByName`` with missing columns as nulls).  For two
    *streams* with their own watermarks Spark takes the minimum by default;
    ``spark.sql.streaming.multipleWatermarkPolicy=max`` lets the faster input
    advance it (WM-3)."""
    return a.withColumn(side, F.lit(side_a)).unionByName(
        b.withColumn(side, F.lit(side_b)), allowMissingColumns=True)


def as_pair(matched: DataFrame, left_cols, right_cols, left: str = "ride",
            right: str = "fare") -> DataFrame:
    """PRJ-5: matched rows as the nested pair ``struct(ride, fare)`` of the
    reference's RideAndFare / RideFare records."""
    return matched.select(F.struct(F.struct(*left_cols).alias(left),
                                   F.struct(*right_cols).alias(right)).alias("pair"))
