"""Points of files: every rule on its own, ties, and what is refused."""

import pytest
from pyspark.sql import functions as F

from relspark.operators.selection import select_files

PARSED = "struct<title:string,year:int,seasons:array<int>,episodes:array<int>>"
ASKED = "struct<year:int,season_year:int,season:int,episode:int,absolute:int,relative:int>"
REQUEST = f"k int, release string, release_size long, release_parsed {PARSED}, asked {ASKED}, chosen_index int, chosen_name string"
FILE = f"k int, file_index int, name string, mime string, size long, parsed {PARSED}, title_ok boolean"
ANY = (None, None, None, None, None, None)


def chosen(spark, files, asked=ANY, release_parsed=None, chosen_index=None, chosen_name=None, check=True, release_size=100):
    request = [(1, "Show pack", release_size, release_parsed, asked, chosen_index, chosen_name)]
    rows = [(1, i, *f) for i, f in enumerate(files)]
    got = select_files(spark.createDataFrame(request, REQUEST), spark.createDataFrame(rows, FILE), "k", check).collect()
    assert len(got) == 1
    return got[0]


@pytest.mark.parametrize(
    ("name", "parsed", "asked", "score"),
    [
        ("a.mkv", ("t", None, None, None), ANY, 1500),
        ("a.Trailer.mkv", ("t", None, None, None), ANY, 1000),
        ("a", ("t", None, None, None), ANY, 500),
        ("a.mkv", ("t", 2001, [], []), (2001, None, None, None, None, None), 2000),
        ("a.mkv", ("t", 2001, [], []), (2001, 2001, None, None, None, None), 2750),
        ("a.mkv", ("t", None, [2], [3]), (None, None, 2, 3, None, None), 2250),
        ("a.mkv", ("t", None, [2], [3, 4]), (None, None, 2, 3, None, None), 1750),
        ("a.mkv", ("t", None, [1], [3]), (None, None, 2, 3, None, None), 1750),
        ("a.mkv", ("t", None, [1], [15]), (None, None, 2, 3, 15, None), 2250),
        ("a.mkv", ("t", None, [2], [9]), (None, None, 2, 3, None, None), 1500),
        ("a.mkv", ("t", None, [], []), (None, None, 2, 3, None, None), 500),
        ("a.mkv", ("t", None, [], []), (None, None, 0, 0, None, None), 1500),
        ("a.mkv", ("t", None, [], [15]), (None, None, 2, 3, 15, 7), 3000),
        ("a.mkv", ("t", None, [], [15, 16]), (None, None, 2, 3, 15, 7), 1500),
        ("a.mkv", ("t", None, [], [7]), (None, None, 2, 3, 15, 7), 2000),
        ("a.mkv", ("t", None, [], [7, 8]), (None, None, 2, 3, 15, 7), 1300),
        ("a.mkv", ("t", None, [], [3]), (None, None, 2, 3, 15, 7), 1300),
        ("a.mkv", ("t", None, [], [3, 4]), (None, None, 2, 3, 15, 7), 1100),
    ],
)
def test_each_rule(spark, name, parsed, asked, score):
    assert chosen(spark, [(name, None, 0, parsed, False)], asked).file_score == score


def test_title_size_and_choice(spark):
    p = ("t", None, None, None)
    assert chosen(spark, [("a.mkv", None, 50, p, True)]).file_score == 1625
    assert chosen(spark, [("a", None, 50, p, True)]).file_score == 525
    assert chosen(spark, [("a.mkv", None, 20, p, False), ("b.mkv", None, 40, p, None)], release_size=None).file_score == 1550
    assert chosen(spark, [("a.mkv", None, 0, p, False), ("b.mkv", None, 0, p, False)], chosen_index=1).file_index == 1
    assert chosen(spark, [("a.mkv", None, 0, p, False)], chosen_name="pack").file_score == 1525


def test_ties_refusals_and_lone_releases(spark):
    p = ("t", None, [2], [3])
    best = chosen(spark, [("x.nfo", None, 9, p, True), ("b.mkv", None, 5, p, True), ("c.mkv", None, 5, p, True), ("d.mkv", None, 99, None, True)])
    assert (best.file_index, best.name, best.refused) == (1, "b.mkv", None)
    lone = chosen(spark, [])
    assert (lone.file_index, lone.name, lone.size, lone.file_score, lone.refused) == (-1, "Show pack", 100, None, None)
    none = chosen(spark, [("x.txt", None, 9, p, True), ("y.mkv", "text/plain", 9, p, True), ("z.mkv", None, 9, None, True)])
    assert (none.file_index, none.refused) == (None, "no file")
    asked = (None, None, 2, 8, None, None)
    assert chosen(spark, [("a.mkv", None, 1, p, True)], asked, release_parsed=("t", None, [2], [])).refused == "other episode"
    assert chosen(spark, [("a.mkv", None, 1, ("t", None, [2], [8]), True)], asked, release_parsed=("t", None, [2], [1])).refused == "other episode"
    assert chosen(spark, [("a.mkv", None, 1, p, True)], asked).file_index == 0
    assert chosen(spark, [("a.mkv", None, 1, p, True)], asked, release_parsed=("t", None, [2], []), check=False).file_index == 0


def test_no_python_and_no_exchange_behind_the_join(spark):
    def nulls(schema):
        types = spark.createDataFrame([], schema).schema.fields
        return spark.range(5).select(*[(F.col("id") if f.name in ("k", "file_index") else F.lit(None)).cast(f.dataType).alias(f.name) for f in types])

    plan = select_files(nulls(REQUEST).hint("merge"), nulls(FILE), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" in plan and plan.count("Window") >= 2
    assert plan.count("Exchange hashpartitioning") == 2
