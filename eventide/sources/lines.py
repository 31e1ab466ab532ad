"""Delimited text lines <-> typed records (SRC-1..5, SNK-4).

Parsing is ``split`` + ``try_cast`` rather than a CSV reader so that the rule
is explicit and identical for files, sockets and in-table strings:

* a blank (whitespace-only) or null line is dropped;
* fields beyond the record's are not read (a trailing separator is allowed);
* a line with too few fields, or a field that does not convert, is
  quarantined: it is returned with ``_corrupt_record`` set to the raw line and
  all typed fields null;
* ``mode="FAILFAST"`` raises on the first quarantined line instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, _parse_datatype_string

from ..schemas import LINE_SCHEMAS


def _fields(schema: str):
    st = _parse_datatype_string(schema)
    return [(f.name, f.dataType) for f in st.fields]


def parse_lines(df: DataFrame, kind: str = "sensor", line_col: str = "value",
                sep: str = ",", keep: tuple = ()) -> DataFrame:
    """Typed records plus ``_corrupt_record`` (null for good lines)."""
    fields = _fields(LINE_SCHEMAS.get(kind, kind))
    line = F.col(line_col)
    parts = F.split(line, sep, -1)
    typed = []
    ok = F.size(parts) >= len(fields)  # further fields are not read
    for i, (name, dt) in enumerate(fields):
        raw = F.get(parts, i)
        if isinstance(dt, StringType):
            val = raw
        else:
            val = raw.try_cast(dt)
            ok = ok & val.isNotNull()
        typed.append((name, val))
    out = df.filter(~line.rlike(r"^\s*$"))
    return out.select(
        *keep,
        *[F.when(ok, v).alias(n) for n, v in typed],
        F.when(~ok, line).alias("_corrupt_record"),
    )


def split_quarantine(parsed: DataFrame):
    """(good records, quarantined lines)."""
    good = parsed.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    bad = parsed.filter(F.col("_corrupt_record").isNotNull())
    return good, bad


def failfast(parsed: DataFrame) -> DataFrame:
    """Raise at run time on the first malformed line.  The check sits in a
    filter predicate (evaluated for every row); a projected column that is
    dropped afterwards would be pruned and never raise."""
    bad = F.col("_corrupt_record")
    check = F.when(bad.isNotNull(), F.raise_error(F.concat(F.lit("malformed line: "), bad)))
    return parsed.filter(check.isNull()).drop("_corrupt_record")


def read_lines(spark: SparkSession, path: str, streaming: bool = False,
               fmt: str = "text", **options) -> DataFrame:
    """Unbounded (``streaming=True``) or bounded newline-delimited text.
    ``fmt`` may be ``text`` (files in a folder) or ``socket`` (host/port
    options); tests use files only."""
    reader = spark.readStream if streaming else spark.read
    r = reader.format(fmt)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path) if path else r.load()


def money_text(col):
    """Two-decimal rendering of a money value through integer cents, exact and
    identical in any engine (avoids engine-specific double printing)."""
    cents = F.round(F.abs(col) * 100).cast("bigint")
    sign = F.when((col < 0) & (cents > 0), "-").otherwise("")
    return F.concat(sign, F.floor(cents / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def _field(c):
    """A field as text; a null is an empty field, so that later ones keep their place."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def instant(c):
    """ISO instant; a fraction of a second is printed in milliseconds if there is one."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(c, "SSS")
    return F.concat(whole, F.when(part == "000", "").otherwise(F.concat(F.lit("."), part)), F.lit("Z"))


def render_lines(df: DataFrame, cols, sep: str = ",") -> DataFrame:
    """SNK-4: records to delimited lines (column ``value``)."""
    return df.select(F.concat_ws(sep, *[_field(c) for c in cols]).alias("value"))


def ride_line(df: DataFrame) -> DataFrame:
    """SNK-4 for rides: START/END flag, ISO instants, comma separated."""
    return df.select(F.concat_ws(
        ",", _field("ride_id"), F.when(F.col("is_start"), "START").otherwise("END"),
        _field(instant("event_time")), *[_field(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat",
                                             "passenger_cnt", "taxi_id", "driver_id")]
    ).alias("value"))
