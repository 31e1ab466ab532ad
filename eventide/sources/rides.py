"""Typed taxi ride and fare records derived from the stored order tables.

The reference's generators make every ride field a function of the ride id;
we do the same with fixed integer rules, so the END row of a ride can be built
without joining back to ``orders``:

* a ride is an order: START at ``o_orderdate``; END at the earliest
  ``l_shipdate`` of the order (orders without lines never end);
* a fare is a line item of the order, at ``l_shipdate``.

Coordinates are integer multiples of 1e-4 degrees turned into FLOAT through an
IEEE double division, which is exact to reproduce in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import load

# Fixed derivation rules (our own): value = base + (ride_id * multiplier) % span,
# in units of 1e-4 degree.  They spread points over a box slightly larger than
# the reference's NYC box, so that the geofence keeps only part of them.
COORD_RULES = {
    "start_lon": (-741000, 7919, 5000),
    "start_lat": (404500, 104729, 6000),
    "end_lon": (-741000, 15485863, 5000),
    "end_lat": (404500, 32452843, 6000),
}
DRIVER_BASE = 2013000000
N_DRIVERS = 200
N_TAXIS = 500


def coord(rule, key="ride_id"):
    base, mult, span = COORD_RULES[rule]
    e4 = F.lit(base) + (F.col(key) * F.lit(mult)) % F.lit(span)
    return (e4.cast("double") / F.lit(10000.0)).cast("float")


def with_ride_fields(df: DataFrame) -> DataFrame:
    return df.select(
        "ride_id", "is_start", "event_time",
        *[coord(c).alias(c) for c in COORD_RULES],
        (F.lit(1) + F.col("ride_id") % 4).cast("smallint").alias("passenger_cnt"),
        (F.lit(DRIVER_BASE) + (F.col("ride_id") * 7) % N_TAXIS).alias("taxi_id"),
        (F.lit(DRIVER_BASE) + F.col("ride_id") % N_DRIVERS).alias("driver_id"),
    )


def ride_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """START and END ride events (TAXI_RIDE schema).  Filtering on
    ``is_start`` prunes the END branch (and its line-item aggregation)."""
    starts = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ride_id"), F.lit(True).alias("is_start"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"))
    ends = (load(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("ride_id"))
            .agg(F.min("l_shipdate").cast("timestamp").alias("event_time"))
            .select("ride_id", F.lit(False).alias("is_start"), "event_time"))
    return with_ride_fields(starts.unionByName(ends))


def ride_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ride_events(spark, sf_dir).filter(F.col("is_start"))


def fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares (TAXI_FARE schema plus the line tie-breakers ``fare_line`` and
    ``fare_part``); several fares may share a ride id."""
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("ride_id"),
        (F.lit(DRIVER_BASE) + (F.col("l_orderkey") * 7) % N_TAXIS).alias("taxi_id"),
        (F.lit(DRIVER_BASE) + F.col("l_orderkey") % N_DRIVERS).alias("driver_id"),
        F.col("l_shipdate").cast("timestamp").alias("start_time"),
        F.when(F.col("l_returnflag") == "R", "CARD").otherwise("CASH").alias("payment_type"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("float").alias("tip"),
        F.col("l_tax").cast("float").alias("tolls"),
        F.col("l_extendedprice").cast("float").alias("total_fare"),
        F.col("l_linenumber").alias("fare_line"),
        F.col("l_partkey").alias("fare_part"),
    )
