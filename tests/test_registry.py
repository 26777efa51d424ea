"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from plyspark.oracle import ORACLE_SQL
from plyspark.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ["customer", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime) and v.tzinfo is not None:
        return v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.count() > 0 and "game_id" in df.columns


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    res = con.execute(ORACLE_SQL[key])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _rows(df.columns, df.collect()) == _rows(o_cols, res.fetchall())
