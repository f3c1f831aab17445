"""Resolving identities in bulk: remembered answers, choices between readings, members of clusters, groups of sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import lookup_title
from .identity import candidate_rank

#: Counts and times that a condition of a group sees: previous rows, all rows, previous time, all time.
Condition = Callable[[Column, Column, Column, Column], Column]


def cache_key(media: Column, unit: Column, anime: Column, year: Column, titles: Column) -> Column:
    """Key of a remembered answer: kind, unit, normal or anime, year, and the distinct normal titles in order."""
    normal = F.array_sort(F.array_distinct(F.filter(F.transform(titles, lookup_title), lambda t: t != "")))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat_ws("␟", text(media), text(unit), F.when(anime, "anime").otherwise("normal"), text(F.nullif(year, F.lit(0))), F.array_join(normal, "|"))


def read_through(requests: DataFrame, cache: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Requests with their remembered answers, and the requests without one (null keys too)."""
    return requests.join(cache, key), requests.join(cache.select(key), key, "left_anti")


def series_identity(groups: DataFrame, mappings: DataFrame, candidates: DataFrame, noise: Callable[[Column], Column], trusted: str) -> DataFrame:
    """One identity for each group (``group_key, year_hint, season_bucket``): a mapping with a title, else the best reading.

    Mappings are keyed like groups and have ``canonical_title, canonical_year, mapping_source, mapping_confidence``.
    Candidates have ``group_key, title, year, bucket, source, confidence``; empty ones don't count. Groups with neither
    get nulls. ``mapping_hit`` is true even where the mapping's title is empty.
    """
    same = lambda df: F.concat_ws("␟", "group_key", F.coalesce(df["year_hint"].cast("string"), F.lit("")), F.coalesce(df["season_bucket"], F.lit("")))
    known = mappings.select(
        same(mappings).alias("_key"), F.lit(True).alias("_hit"), F.nullif(lookup_title(F.col("canonical_title")), F.lit("")).alias("_title"), F.col("canonical_year").alias("_year"),
        F.coalesce("mapping_source", F.lit("series_mapping")).alias("_source"), F.coalesce("mapping_confidence", F.lit("mapped")).alias("_confidence"),
    )
    title = F.col("title")
    rank = candidate_rank(title, F.col("source"), noise(title), trusted)
    read = candidates.where(F.coalesce(title, F.lit("")) != "")
    best = read.groupBy("group_key").agg(F.min(F.struct(rank.alias("rank"), "title", "year", "bucket", "source", "confidence")).alias("_b"))
    both = groups.withColumn("_key", same(groups)).join(known, "_key", "left").join(best, "group_key", "left")
    mapped = F.col("_title").isNotNull()
    pick = lambda ours, theirs: F.when(mapped, ours).otherwise(F.when(F.col("_b").isNotNull(), theirs))
    b = F.col("_b")
    return both.select(
        "group_key", pick(F.col("_title"), b["title"]).alias("title"), pick(F.coalesce("_year", "year_hint"), F.coalesce(b["year"], F.col("year_hint"))).alias("year"),
        pick(F.col("season_bucket"), F.coalesce(F.nullif(b["bucket"], F.lit("")), F.col("season_bucket"))).alias("season_bucket"),
        pick(F.col("_source"), b["source"]).alias("source"), pick(F.col("_confidence"), b["confidence"]).alias("confidence"), F.coalesce("_hit", F.lit(False)).alias("mapping_hit"),
    )


def compatible_members(members: DataFrame, cluster: str, year: Column, bucket: Column, cluster_year: Column, canonical_year: Column, cluster_bucket: Column) -> DataFrame:
    """Members of each cluster that its answer may speak for; all of them where none is compatible.

    Years known on both sides are at most one apart, seasons known on both sides are equal.
    """
    near = lambda other: F.coalesce(F.abs(year - other) <= 1, F.lit(True))
    same = F.coalesce((F.nullif(bucket, F.lit("")) == F.nullif(cluster_bucket, F.lit(""))), F.lit(True))
    marked = members.withColumn("_ok", near(cluster_year) & near(canonical_year) & same)
    return marked.withColumn("_any", F.max("_ok").over(Window.partitionBy(cluster))).where("_ok or not _any").drop("_ok", "_any")


def fetched_groups(rows: DataFrame, conditions: Sequence[Condition | None], sequential: bool, key: str = "request_id", group: str = "group_no", elapsed: str = "elapsed") -> DataFrame:
    """Rows of the groups of sources that a request comes to; the first condition that fails ends it.

    The first group always counts and holds rows without a group. Later groups in sequence count without a condition too,
    while parallel ones without a condition are passed over. Times add up in sequence; in parallel the longest counts.
    A condition may also look at the rows: ``_in`` marks those so far, ``_prev`` those of the group before.
    """
    number = F.coalesce(F.col(group), F.lit(0))
    size = lambda g: F.sum(F.when(number == g, 1).otherwise(0)).over(Window.partitionBy(key))
    time = lambda g: F.coalesce(F.max(F.when(number == g, F.col(elapsed))).over(Window.partitionBy(key)), F.lit(0))
    n = range(len(conditions))
    out = rows.withColumns({f"_n{g}": size(g) for g in n} | {f"_t{g}": time(g) for g in n})
    out = out.withColumns({"_going": F.lit(True), "_in": number == 0, "_prev": number == 0, "_pn": F.col("_n0"), "_an": F.col("_n0"), "_pt": F.col("_t0"), "_at": F.col("_t0")})
    for g in n[1:]:
        condition = conditions[g]
        if condition is None and not sequential:
            continue
        held = F.lit(True) if condition is None else F.coalesce(condition(F.col("_pn"), F.col("_an"), F.col("_pt"), F.col("_at")), F.lit(False))
        out = out.withColumn("_going", F.col("_going") & held)
        total = F.col("_at") + F.col(f"_t{g}") if sequential else F.greatest("_at", f"_t{g}")
        moved = lambda now, then: F.when(F.col("_going"), now).otherwise(F.col(then))
        out = out.withColumns({
            "_in": F.col("_in") | (F.col("_going") & (number == g)), "_prev": moved(number == g, "_prev"), "_pn": moved(F.col(f"_n{g}"), "_pn"), "_an": moved(F.col("_an") + F.col(f"_n{g}"), "_an"),
            "_pt": moved(F.col(f"_t{g}"), "_pt"), "_at": moved(total, "_at"),
        })
    return out.where("_in").select(*rows.columns)


def enrichment_cycle(pending: DataFrame, known: DataFrame, lookups: DataFrame, keys: Sequence[str], order: str, most: int = 10) -> DataFrame:
    """One cycle over pending rows: those whose keys are known, and the rows of the first ``most`` looked-up batches.

    Rows with equal keys are one batch; batches come in order of their first row. Adds ``resolver`` and the columns of the
    answers; rows left out stay pending for the next cycle.
    """
    keys = list(keys)
    hits = pending.join(known, keys).withColumn("resolver", F.lit("known"))
    rest = pending.join(known.select(*keys), keys, "left_anti")
    batches = rest.dropna(subset=keys[:1]).groupBy(*keys).agg(F.min(order).alias("_first")).orderBy("_first", *keys).limit(most).drop("_first")
    found = rest.join(batches.join(lookups, keys), keys).withColumn("resolver", F.lit("lookup"))
    return hits.unionByName(found)
