"""Every query with SQL gives the same rows as the SQL on the smallest tables; every other query runs."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
CORE = [q for q in QUERIES if q.startswith("q_") or q in ("p1_found", "p1_orphan_report", "p5_found", "p6_found")]


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else f"{v:.6f}"
    return v if v is None else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(str(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck(small):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(small):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{small}/{f}'")
    return c


@pytest.mark.parametrize("name", CORE)
def test_query(spark, small, duck, name):
    got = QUERIES[name](spark, small)
    rows = rows_of(got.columns, got.collect())
    if name in ORACLES:
        want = duck.execute(ORACLES[name])
        assert rows == rows_of([d[0] for d in want.description], want.fetchall())
    assert len(got.columns) > 0


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() >= 0
    assert out.columns


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
