"""Top-N per window (TOP-1..3) and ride ordering (SRT-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .scan import sequence_number

# fixed values: report layout of the reference's top-N job
RULE = "===================================="
HEADER_LABEL = "时间: "
ENTRY_ID_LABEL = "  sensorId="
ENTRY_AVG_LABEL = "  平均值="


def top_n(means: DataFrame, n: int, value: str, key: str,
          window_cols=("window_start", "window_end"), exclude_last: bool = False,
          rank_col: str = "rank") -> DataFrame:
    """TOP-1 / TOP-2: the ``n`` highest values per window (ties by key).

    ``row_number() <= k`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle, so at most ``k`` rows per window and map task move.
    ``exclude_last`` reproduces the reference loop bound (``size() - 1``):
    a window with ``m`` entries yields ``min(n, m - 1)``; it needs only the top
    ``n + 1`` rows to know that.
    """
    w = Window.partitionBy(*window_cols).orderBy(F.col(value).desc(), F.col(key))
    k = n + 1 if exclude_last else n
    # BIGINT like SQL's row_number; the filter stays on the window value so the
    # planner still inserts the partial WindowGroupLimit
    ranked = means.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
    if exclude_last:
        m = F.count(F.lit(1)).over(Window.partitionBy(*window_cols))
        ranked = ranked.withColumn("_m", m) \
                       .filter(F.col(rank_col) <= F.least(F.lit(n), F.col("_m") - 1)) \
                       .drop("_m")
    return ranked.withColumn(rank_col, F.col(rank_col).cast("bigint"))


def fixed4(total, n):
    """Mean ``total / n`` rendered with 4 decimals, rounded half up by magnitude,
    from the total in units of 1e-8 as a decimal (identical text in every engine)."""
    size = F.round(F.abs(F.col(total).cast("decimal(28,8)")) / F.col(n), 4).cast("decimal(28,4)")
    sign = F.when((F.col(total) < 0) & (size > 0), "-").otherwise("")
    return F.concat(sign, size.cast("string"))


def top_n_report(means: DataFrame, n: int, key: str, window_end_ms: str = "window_end_ms",
                 value: str = "avg_value") -> DataFrame:
    """TOP-3: one text report per window, entries ranked from 0, headed by the
    window end in ms, with the reference's ``size() - 1`` loop bound."""
    w = Window.partitionBy(window_end_ms).orderBy(F.col(value).desc(), F.col(key))
    ranked = means.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n + 1)
    m = F.count(F.lit(1)).over(Window.partitionBy(window_end_ms))
    ranked = ranked.withColumn("_keep", F.col("_rn") <= F.least(F.lit(n), m - 1))
    line = F.concat(F.lit("No"), (F.col("_rn") - 1).cast("string"), F.lit(":"),
                    F.lit(ENTRY_ID_LABEL), F.col(key).cast("string"),
                    F.lit(ENTRY_AVG_LABEL), fixed4("total", "n"), F.lit("\n"))
    entries = F.collect_list(F.when(F.col("_keep"), F.struct(F.col("_rn").alias("r"),
                                                             line.alias("l"))))
    body = F.array_join(F.transform(F.array_sort(entries), lambda x: x["l"]), "")
    return ranked.groupBy(window_end_ms).agg(
        F.concat(F.lit("\n" + RULE + "\n" + HEADER_LABEL), F.col(window_end_ms).cast("string"),
                 F.lit("\n"), body, F.lit(RULE + "\n\n")).alias("report"))


def ride_order(rides: DataFrame, position: str = "position") -> DataFrame:
    """SRT-1: rides by event time, START before END at the same instant, ride
    id last; the global position comes from the skew-safe scan (no
    single-task window)."""
    order = [F.col("event_time"), (~F.col("is_start")).alias("_end_first"), F.col("ride_id")]
    return sequence_number(rides, order, out=position)
