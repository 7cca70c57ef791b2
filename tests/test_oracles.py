"""Every registered query against its DuckDB oracle on the smallest driver
tables (row count, column names, order-insensitive values), and the entry
smoke check."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from airshed.sources.tables import TABLES, table_path
from tests.conftest import SF_SMALL

QUERIES = E.queries()
ORACLES = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, type(x).__name__ if not isinstance(x, (int, float)) else "num",
                  x if not isinstance(x, (int, float)) else float(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


def test_every_measurement_query_has_an_oracle():
    from airshed.catalog import QUERIES as measurements
    assert set(measurements) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["location", "date", "pollutant_type", "avg_level", "min_level", "max_level",
                          "measurement_count", "health_status"]
    assert df.count() > 0
