"""The keyset source over a database file: pages, pushed filters, and cursors that survive restarts."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from relspark.sources.keyset import KeysetSource, Page, Table

SCHEMA = "at string, hash string, size long, name string"


@pytest.fixture
def base(tmp_path, spark):
    spark.dataSource.register(KeysetSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    path = str(tmp_path / "t.sqlite")
    add(path, range(100))
    yield path
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def add(path, numbers):
    con = sqlite3.connect(path)
    con.execute('CREATE TABLE IF NOT EXISTS "items" (at TEXT, hash TEXT, size INTEGER, name TEXT, PRIMARY KEY (at, hash))')
    con.executemany("INSERT INTO items VALUES (?, ?, ?, ?)", [(f"2024-01-{n // 10 + 1:02d}", f"h{n:03d}", n if n % 7 else None, f"name {n} 100%") for n in numbers])
    con.commit()
    con.close()


def options(path, **more):
    return {"module": "sqlite3", "connect": path, "table": "items", "key": "at,hash", "page": "15"} | more


def test_pages_hold_every_row_once(spark, base):
    df = spark.read.format("keyset").schema(SCHEMA).options(**options(base)).load()
    assert df.rdd.getNumPartitions() == 7
    assert sorted(r.hash for r in df.collect()) == [f"h{n:03d}" for n in range(100)]
    even = spark.read.format("keyset").schema("hash string").options(**options(base, page="25")).load()
    assert even.rdd.getNumPartitions() == 4 and even.count() == 100


def test_filters_reach_the_database(spark, base):
    df = spark.read.format("keyset").schema(SCHEMA).options(**options(base)).load()
    some = df.where((F.col("at") >= "2024-01-04") & (F.col("size") < 60) & F.col("hash").isin("h031", "h045", "h059", "h061") & F.col("name").startswith("name") & (F.length("name") > 2))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert [r.hash for r in some.orderBy("hash").collect()] == ["h031", "h045", "h059"]
    assert "length(name" in plan and "(size" not in plan.split("BatchScan")[0] and "at#" not in plan.split("BatchScan")[0].split("Filter")[-1]
    assert some.rdd.getNumPartitions() == 1  # pages are those of the filtered rows
    assert df.where("name = 'name 3 100%'").count() == 1 and df.where("size is null").count() == 15


def test_what_cannot_be_decided_goes_back():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, Not
    from pyspark.sql.types import StructType

    t = Table({"module": "sqlite3", "connect": "", "table": "a.b", "key": "k"}, StructType.fromDDL("k long, s struct<x:int>"))
    kept = [EqualTo(("s", "x"), 1), Not(EqualTo(("k",), 1)), GreaterThan(("k",), 1.5), In(("k",), (None, 1))]
    assert list(t.push([*kept, EqualTo(("k",), 4)])) == kept
    assert t._where((3,), None) == (' WHERE "k" = ? AND ("k") > (?)', [4, 3]) and t.table == '"a"."b"'
    assert Page(None, (1,)) == Page(None, (1,))


def test_a_restart_reads_nothing_twice(spark, base, tmp_path):
    def drain():
        stream = spark.readStream.format("keyset").schema(SCHEMA).options(**options(base)).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination(120)
        rows = [r.hash for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).collect()]
        assert len(rows) == len(set(rows))
        return len(rows)

    assert drain() == 100
    assert drain() == 100  # nothing new, nothing again
    add(base, range(100, 137))
    assert drain() == 137
