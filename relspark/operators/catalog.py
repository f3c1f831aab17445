"""Merged catalogues: eligibility, merge orders, offsets and capability unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def eligible(sources: DataFrame, search: bool, genre: str | None, skip: int, given: Sequence[str]) -> DataFrame:
    """Adds ``refused``: null, or why a catalogue can't take part. ``extras`` holds structs ``name, required, options``.

    A genre other than ``None`` needs a genre extra that lists it, lists a null (any genre), or lists nothing.
    """
    has = lambda n: F.exists("extras", lambda e: e["name"] == n)
    reasons = [F.when(~has("search"), "no search")] if search else []
    if genre is not None and genre != "None":
        admits = lambda o: o.isNull() | (F.size(o) == 0) | F.exists(o, lambda x: x.isNull() | (x == genre))
        reasons.append(F.when(~F.exists("extras", lambda e: (e["name"] == "genre") & admits(e["options"])), "genre not offered"))
    if skip:
        reasons.append(F.when(~has("skip"), "no paging"))
    missing = F.exists("extras", lambda e: e["required"] & ~e["name"].isin(*given) if given else e["required"])
    reasons.append(F.when(missing, "required extra missing"))
    return sources.withColumn("refused", F.coalesce(*reasons))


def merge_order(method: str, source: str, pos: str, rating: str = "rating", year: str = "year") -> list[Column]:
    """Sort columns of a merge method; unknown ratings last, an unknown year counts as 0."""
    behind = [F.col(source), F.col(pos)]
    known_year = F.coalesce(F.col(year).try_cast("int"), F.lit(0))
    return {
        "sequential": behind,
        "interleave": [F.row_number().over(Window.partitionBy(source).orderBy(pos)), F.col(source)],
        "rating": [F.col(rating).try_cast("double").desc_nulls_last(), *behind],
        "year_asc": [known_year.asc(), *behind],
        "year_desc": [known_year.desc(), *behind],
        "reverse": [F.col(source).desc(), F.col(pos).desc()],
    }[method]


def next_offsets(fetched: DataFrame, offsets: DataFrame, source: str) -> DataFrame:
    """Where each source continues: its old offset and the rows it gave, before any dedup."""
    given = fetched.groupBy(source).agg(F.count("*").alias("_n"))
    return offsets.join(given, source, "left").select(source, (F.col("offset") + F.coalesce("_n", F.lit(0))).alias("offset"))


def capability_union(resources: DataFrame, key: str) -> DataFrame:
    """Types and prefixes of each resource over all sources; one source without prefixes lifts the restriction."""
    free = F.bool_or(F.col("prefixes").isNull() | (F.size("prefixes") == 0))
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return resources.groupBy(key).agg(flat("types").alias("types"), F.when(~free, flat("prefixes")).alias("prefixes"))


def tiered_search(tiers: Sequence[DataFrame], key: str, by: Sequence[Column], n: int) -> DataFrame:
    """Hits of all tiers, each key once at its lowest tier, best ``n`` by tier and then the given order."""
    both = None
    for i, t in enumerate(tiers):
        t = t.withColumn("tier", F.lit(i))
        both = t if both is None else both.unionByName(t)
    once = both.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("tier"))).where("_n = 1").drop("_n")
    return once.orderBy("tier", *by).limit(n)


def postings(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Token index: one row for each word of a text and key."""
    return rows.select(key, F.explode(F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != ""))).alias("token"))
