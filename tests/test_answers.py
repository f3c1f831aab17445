"""Expiring answers over a table and over a stream, and the enrichment loop."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from relspark.streaming import answers

SCHEMA = "n long, k string, at timestamp, answer string"
START = datetime.datetime(2024, 1, 1)


def made(seed, count=300):
    rnd, at, rows = random.Random(seed), 0, []
    for n in range(count):
        at += rnd.choice([0, 0, 1, 3, 10, 40])
        rows.append((n, rnd.choice("abcd"), START + datetime.timedelta(seconds=at), rnd.choice([None, None, None, "", f"v{n}"])))
    return rows


def walked(rows, ttl, touch):
    """The cache as it is told: one event after the other."""
    held, out = {}, set()
    for n, k, at, answer in sorted(rows, key=lambda r: (r[1], r[2], r[3] is None, r[0])):
        if answer is not None:
            if answer:
                held[k] = (answer, at)
            continue
        value, since = held.get(k, (None, None))
        hit = value is not None and (at - since).total_seconds() < ttl
        if hit and touch:
            held[k] = (value, at)
        out.add((n, hit, value if hit else None))
    return out


@pytest.mark.parametrize("touch", [False, True])
def test_table(spark, touch):
    rows = made(1)
    got = answers.expiring_answers(spark.createDataFrame(rows, SCHEMA), "k", "at", "answer", 20, touch, "n").collect()
    assert {(r.n, r.hit, r.remembered) for r in got} == walked(rows, 20, touch)
    assert {r.hit for r in got} == {True, False}
    assert answers.expiring_answers(spark.createDataFrame([], SCHEMA), "k", "at", "answer", 20).count() == 0


def test_an_answer_ends_at_its_time_and_counts_at_its_own(spark):
    t = lambda s: START + datetime.timedelta(seconds=s)
    rows = [(1, "a", t(0), None), (2, "a", t(0), "x"), (3, "a", t(19), None), (4, "a", t(20), None), (5, "b", t(1), None), (6, None, t(0), "z"), (7, None, t(1), None)]
    plain = {r.n: r.remembered for r in answers.expiring_answers(spark.createDataFrame(rows, SCHEMA), "k", "at", "answer", 20, order="n").collect()}
    assert plain == {1: "x", 3: "x", 4: None, 5: None, 7: "z"}
    touched = {r.n: r.remembered for r in answers.expiring_answers(spark.createDataFrame(rows, SCHEMA), "k", "at", "answer", 20, True, "n").collect()}
    assert touched[4] == "x"


def test_stream_and_table_agree(spark, tmp_path):
    rows = made(2, 240)
    for k in range(4):
        spark.createDataFrame(rows[60 * k : 60 * (k + 1)], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        out = answers.expiring_answers_stream(stream, "k", "at", "answer", 20, True, "n")
        query = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination(240)
        assert query.exception() is None and len(query.recentProgress) >= 4
    finally:
        spark.conf.set(name, before)
    got = {(r.n, r.hit, r.remembered) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == walked(rows, 20, True)


def test_loop_asks_each_batch_once_and_ends(spark):
    pending = spark.createDataFrame([(n, f"t{n % 7}" if n % 10 else None, n % 2) for n in range(60)], "n int, title string, year int")
    known = spark.createDataFrame([("t0", 0, 100), ("t0", 1, 101)], "title string, year int, found int")
    asked = []

    def lookup(keys):
        rows = [tuple(r) for r in keys.collect()]
        asked.extend(rows)
        assert len(rows) <= 3
        return keys.where("title <> 't3'").withColumn("found", F.col("year") + 1)

    got = answers.enrich(pending, known, lookup, ["title", "year"], "n", most=3).collect()
    assert len(asked) == len(set(asked)) == 12 and len(got) == 60
    for r in got:
        want = (None, None) if r.title in (None, "t3") else (100 + r.year, "known") if r.title == "t0" else (r.year + 1, "lookup")
        assert (r.found, r.resolver) == want and (r.cycle is None) == (r.resolver is None)
    assert max(r.cycle or 0 for r in got) == 4
    one = answers.enrich(pending, known, lambda keys: keys.withColumn("found", F.lit(1)), ["title", "year"], "n", most=3, cycles=1)
    assert one.where("resolver = 'lookup'").select("title", "year").distinct().count() == 3
