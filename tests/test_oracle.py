"""Every query with SQL against DuckDB on the same tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    return c


def plain(v):
    return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else None if v is None else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, con, name):
    d = entry.queries()[name](spark, data)
    cols = sorted(d.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in d.collect())
    cur = con.execute(SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())


def test_queries_have_unique_columns_and_entry_runs(spark):
    d = entry.entry(spark)
    assert d.columns == ["anio", "mes", "comprador_ruc", "n_cambio"]
