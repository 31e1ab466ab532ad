"""Every registered query equals its DuckDB oracle on the smallest driver
tables (the driver repeats this at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from compare import TABLES, digest  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from eventide.plans.catalog import QUERIES  # noqa: E402  (the queries of the reference)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_end", "user_id", "tips"]
    assert df.count() > 0
