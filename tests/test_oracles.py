"""Every registered plan with SQL gives the rows that DuckDB gives for it."""

import os

import duckdb
import pytest

from relspark.plans.catalog import FLAGSHIP, ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


def shown(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else f"{v:.6g}"
    return str(v)


def compared(rows, columns):
    order = sorted(columns)
    return sorted(tuple(shown(r[list(columns).index(c)]) for c in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert compared([tuple(r) for r in df.collect()], df.columns) == compared(found.fetchall(), columns)


def test_flagship_is_registered():
    assert FLAGSHIP in QUERIES and FLAGSHIP in ORACLE_SQL


def test_entry_without_optional_packages():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
