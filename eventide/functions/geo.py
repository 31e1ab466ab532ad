"""Geographic helpers of the ride exercises as Spark column expressions.

Float/double rules follow the reference: coordinates are FLOAT, grid and box
constants DOUBLE; a float difference is taken in float before it is widened.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: NYC bounding box, grid steps and sizes, degree length
LON_EAST = -73.7
LON_WEST = -74.05
LAT_NORTH = 41.0
LAT_SOUTH = 40.5
DELTA_LON = 0.0014
DELTA_LAT = 0.00125
NUMBER_OF_GRID_X = 250
NUMBER_OF_GRID_Y = 400
DEG_LEN = 110.25


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def in_nyc(lon, lat) -> Column:
    """GEO-1: inclusive box test (float coordinate against double edges)."""
    lon, lat = _c(lon), _c(lat)
    return (lon >= F.lit(LON_WEST)) & (lon <= F.lit(LON_EAST)) & \
           (lat >= F.lit(LAT_SOUTH)) & (lat <= F.lit(LAT_NORTH))


def grid_x(lon) -> Column:
    return F.floor((F.lit(abs(LON_WEST)) - F.abs(_c(lon)).cast("double")) / F.lit(DELTA_LON)).cast("int")


def grid_y(lat) -> Column:
    return F.floor((F.lit(LAT_NORTH) - _c(lat).cast("double")) / F.lit(DELTA_LAT)).cast("int")


def cell_id(lon, lat) -> Column:
    """GEO-2: grid cell id of a point (x + 250 * y, origin north-west)."""
    return grid_x(lon) + grid_y(lat) * F.lit(NUMBER_OF_GRID_X)


def cell_center_lon(cell) -> Column:
    """GEO-4."""
    x = F.pmod(_c(cell), F.lit(NUMBER_OF_GRID_X))
    return (F.lit(abs(LON_WEST)) - x * F.lit(DELTA_LON) - F.lit(DELTA_LON) / 2).cast("float") \
        * F.lit(-1.0).cast("float")


def cell_center_lat(cell) -> Column:
    """GEO-4."""
    x = F.pmod(_c(cell), F.lit(NUMBER_OF_GRID_X))
    y = ((_c(cell) - x) / F.lit(NUMBER_OF_GRID_X)).cast("int")
    return (F.lit(LAT_NORTH) - y * F.lit(DELTA_LAT) - F.lit(DELTA_LAT) / 2).cast("float")


def euclidean_distance(lon1, lat1, lon2, lat2, radians: bool = False) -> Column:
    """GEO-5: ``110.25 * sqrt(dlat^2 + (dlon * cos(lat2))^2)``.  The reference
    feeds degrees to ``cos`` unconverted; ``radians=True`` converts first."""
    dlat = (_c(lat1) - _c(lat2)).cast("double")
    lat2d = _c(lat2).cast("double")
    cosv = F.cos(F.radians(lat2d)) if radians else F.cos(lat2d)
    dlon = (_c(lon1) - _c(lon2)).cast("double") * cosv
    return F.lit(DEG_LEN) * F.sqrt(dlat * dlat + dlon * dlon)


def distance_to_point(lon: float, lat: float) -> Column:
    """GEO-6: distance from the ride's current location (start for START
    events, end otherwise) to a point."""
    plon, plat = F.lit(lon).cast("float"), F.lit(lat).cast("float")
    return F.when(F.col("is_start"),
                  euclidean_distance(plon, plat, "start_lon", "start_lat")) \
            .otherwise(euclidean_distance(plon, plat, "end_lon", "end_lat"))


def direction_angle(start_lon, start_lat, dest_lon, dest_lat) -> Column:
    """GEO-7: ``(int) degrees(atan2(dlat, dlon * cos(startLat))) + 179``; the
    int cast truncates before the addition."""
    x = (_c(dest_lat) - _c(start_lat)).cast("double")
    y = (_c(dest_lon) - _c(start_lon)).cast("double") * F.cos(_c(start_lat).cast("double"))
    return F.degrees(F.atan2(x, y)).cast("int") + F.lit(179)


def path_cells(df, x1, y1, x2, y2, out: str = "cell_id"):
    """GEO-3: one row per grid cell crossed by the straight segment between
    two cells (``df`` keeps its other columns).

    Closed form per column, no loop: order the end points by x; with slope
    ``s`` and ``v(x) = (x - sx + 0.5) * s + sy - 0.5`` column ``x`` covers the
    rows ``a(x)..b(x)``::

        a = sy                               if x = sx
            max(sy, floor(v(x-1) + .05) + 1)  otherwise
        b = ey                               if x = ex
            max(a, floor(v(x) - .05) + 1)     otherwise

    Falling segments are mirrored about ``sy``.  For rising segments this is
    the reference's cell walk; for falling ones it ends on the end cell (the
    reference walk may overshoot, see the README).  Two ``explode(sequence)``
    steps over plain columns keep every expression in generated code.
    """
    x1, y1, x2, y2 = _c(x1), _c(y1), _c(x2), _c(y2)
    swap = x1 > x2
    d = df.withColumn("_sx", F.when(swap, x2).otherwise(x1)) \
          .withColumn("_sy", F.when(swap, y2).otherwise(y1)) \
          .withColumn("_ex", F.when(swap, x1).otherwise(x2)) \
          .withColumn("_ey0", F.when(swap, y1).otherwise(y2))
    d = d.withColumn("_fall", F.col("_ey0") < F.col("_sy")) \
         .withColumn("_ey", F.when(F.col("_fall"), F.col("_sy") * 2 - F.col("_ey0"))
                              .otherwise(F.col("_ey0")))
    d = d.withColumn("_s", (F.col("_ey") - F.col("_sy")).cast("double")
                     / ((F.col("_ex") - F.col("_sx")).cast("double") + F.lit(1e-8)))
    d = d.withColumn("_x", F.explode(F.sequence("_sx", "_ex")))

    def v(x):
        return (x - F.col("_sx") + F.lit(0.5)) * F.col("_s") + F.col("_sy") - F.lit(0.5)

    x = F.col("_x")
    d = d.withColumn("_a", F.when(x == F.col("_sx"), F.col("_sy")).otherwise(
        F.greatest(F.col("_sy"), (F.floor(v(x - 1) + F.lit(0.05)) + 1).cast("int"))))
    d = d.withColumn("_b", F.when(x == F.col("_ex"), F.col("_ey")).otherwise(
        F.greatest(F.col("_a"), (F.floor(v(x) - F.lit(0.05)) + 1).cast("int"))))
    d = d.withColumn("_y", F.explode(F.sequence("_a", "_b")))
    y = F.when(F.col("_fall"), F.col("_sy") * 2 - F.col("_y")).otherwise(F.col("_y"))
    d = d.withColumn(out, x + y * F.lit(NUMBER_OF_GRID_X))
    return d.drop("_sx", "_sy", "_ex", "_ey0", "_fall", "_ey", "_s", "_x", "_a", "_b", "_y")
