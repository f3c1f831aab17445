"""Queries and their SQL over tables whose keys are beyond those of the small ones, and whose scores are tied."""

import math

import duckdb
from pyspark.sql import functions as F

from relspark.operators import statistics as st
from relspark.plans.catalog import ORACLE_SQL, QUERIES


def both(spark, folder, name, table, sql):
    """Rows of a query and of its SQL over one table that a DuckDB query gives."""
    con = duckdb.connect()
    con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    df = QUERIES[name](spark, str(folder))
    want = con.execute(ORACLE_SQL[name])
    order = [df.columns.index(d[0]) for d in want.description]
    return sorted((tuple(r[i] for i in order) for r in df.collect()), key=str), sorted(want.fetchall(), key=str)


def test_changes_where_shifted_keys_are_known(spark, tmp_path):
    sql = """SELECT k AS o_orderkey, CASE WHEN k % 4 > 0 THEN 'F' END AS o_orderstatus, CASE WHEN k % 7 = 0 THEN 'nan'::DOUBLE WHEN k % 5 > 0 THEN (k % 900000) / 4 END AS o_totalprice
        FROM (SELECT unnest(range(0, 1000)) AS k UNION ALL SELECT unnest(range(900000, 900700)) UNION ALL SELECT NULL)"""
    got, want = both(spark, tmp_path, "change_detect", "orders", sql)
    assert got == want and len(got) == 1701
    actions = dict(got)
    # 300 has no price, before and after; 350 meets a price that is not a number, 900's place is free.
    assert actions[900300] == "noop" and actions[900350] == "update" and actions[900900] == actions[None] == "insert"


def test_overlap_of_equal_means(spark, tmp_path):
    early, late = "TIMESTAMP '2024-01-05'", "TIMESTAMP '2024-01-25'"
    rows = [(u, early, v) for u in (1, 3) for v in (0.1, 0.2, 0.3)] + [(u, early, v) for u in (2, 4) for v in (0.3, 0.2, 0.1)]
    rows += [(5, early, v) for v in (0.3, 0.2, 0.1)] + [(5, late, v) for v in (0.1, 0.2, 0.3)] + [(6, late, 0.2), (7, early, "NULL"), (8, late, "'inf'::DOUBLE")]
    sql = f"SELECT * FROM (VALUES {', '.join(f'({u}::BIGINT, {t}, {v}::DOUBLE)' for u, t, v in rows)}) e(user_id, ts, value)"
    got, want = both(spark, tmp_path, "overlap_resolution", "events", sql)
    assert got == want
    assert [(r[0], r[1], r[3]) for r in sorted(got, key=lambda r: (r[1], r[3]))] == [*[(u, "left", u) for u in (1, 2, 3, 4, 5)], (7, "left", 6), (8, "right", 1), (6, "right", 2)]


def test_means_in_any_order(spark):
    values = {"a": [0.1, 0.2, 0.3, None], "b": [0.3, 0.2, 0.1], "c": [math.inf, 1.0], "d": [None], "e": [1e300, 1e300], "f": [-0.1, -0.2, -0.3]}
    df = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g string, v double")
    got = {r.g: r.m for r in df.groupBy("g").agg(st.steady_mean(F.col("v")).alias("m")).collect()}
    assert got == {"a": 0.2, "b": 0.2, "c": math.inf, "d": None, "e": 1e300, "f": -0.2}
