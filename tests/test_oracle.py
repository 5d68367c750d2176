"""Every registered query against its independent DuckDB formulation (small scale)."""
import hashlib
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from parcelkit.fixtures import DRIVER_TABLES

SF = "/root/testdata/sf0.001"
KEYS = sorted(E._queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    return str(v)


def _digest(rows, cols):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(E.oracle_sql()) >= set(KEYS) - NO_ORACLE


NO_ORACLE = set()


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(E.oracle_sql()[key])
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(rows, cols) == _digest(orows, ocols)


def test_entry_runs_with_a_stable_schema(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "acct" in df.columns
    assert df.schema == E.queries()["residential_protest_analysis"](spark, "/root/testdata/sf0.01").schema
