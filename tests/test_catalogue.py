"""Every catalogue query against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import pytest

from tests.conftest import DATA
from tidemark.plans import catalogue


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return f"{float(x):.6f}"
    return str(x)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    rows = df.collect()
    if name not in catalogue.ORACLE_SQL:
        assert rows
        return
    cur = duck.execute(catalogue.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(value(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    assert sorted(tuple(value(r[c]) for c in sorted(cols)) for r in rows) == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
