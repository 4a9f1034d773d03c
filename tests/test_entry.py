"""Driver contract: entry runs, every query has the right shape, SQL twins agree at sf0.001."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as E

SQL_KEYS = sorted(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "risk_score" in df.columns


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for file in Path(sf_small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", [k for k in SQL_KEYS if not k.startswith("stream_")])
def test_oracle_agrees(spark, duck, sf_small, name):
    df = E.queries()[name](spark, sf_small)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = _rows(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
