"""Aggregates behind the reports: usage and probe scores, stability, coverage, votes, comparisons."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Weights and gates of the scores (fixed values); the 95th percentile is in seconds.
PROBE = {"success": 0.40, "latency": 0.30, "volume": 0.20, "penalty": -0.10}
PROBE_GATES = {"success": 0.70, "p95": 6.0, "errors": 0.20, "score": 0.55}
USAGE = {"hits": 0.35, "seeders": 0.25, "recency": 0.20, "reliability": 0.20}
PENALTY = {"timeout": 0.45, "forbidden": 0.30, "ratelimit": 0.15, "hard": 0.10}
OWNER = {"success": 0.35, "nonempty": 0.25, "latency": 0.15, "stability": 0.15, "timeout": 0.10}


def share(condition: Column) -> Column:
    """Share of the rows for which the condition holds."""
    return F.avg(condition.cast("double"))


def normalised(value: Column, over: Sequence[str] = (), inverted: bool = False) -> Column:
    """Min-max scaled over the group (the whole table without keys); 1 where all values are equal.

    Use it on aggregated rows: without keys the window is one partition.
    """
    w = Window.partitionBy(*over)
    low, high = F.min(value).over(w), F.max(value).over(w)
    scaled = (value - low) / (high - low)
    return F.when(high <= low, F.lit(1.0)).otherwise(1 - scaled if inverted else scaled)


def scaled_by(rows: DataFrame, columns: dict[str, str], inverted: Sequence[str] = ()) -> DataFrame:
    """Min-max scaling of columns (name to new name) of a whole table through one aggregated row; 1 where all are equal."""
    ends = rows.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))])
    out = rows.join(F.broadcast(ends))
    for c, name in columns.items():
        low, high = F.col(f"_low_{c}"), F.col(f"_high_{c}")
        scaled = (F.col(c) - low) / (high - low)
        out = out.withColumn(name, F.when(high <= low, F.lit(1.0)).otherwise(1 - scaled if c in inverted else scaled))
    return out.drop(*ends.columns)


def probe_stats(probes: DataFrame, key: str, ok: Column, latency: str, items: str) -> DataFrame:
    """Per source: probes, success rate, error rate, interpolated 95th percentile of latency, mean items."""
    return probes.groupBy(key).agg(
        F.count("*").alias("n"), share(ok).alias("success"), share(~ok).alias("errors"), F.percentile(latency, 0.95).alias("p95"), F.avg(items).alias("mean_items")
    )


def probe_score(stats: DataFrame) -> DataFrame:
    """Adds ``score`` and ``included`` to rows of :func:`probe_stats` with latencies in seconds.

    Success, latency (min-max scaled over the sources, the fastest 1) and items (up to their 90th percentile) count for a
    source, errors against it; every part and the score are held between 0 and 1.
    """
    held = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    cap = stats.agg(F.percentile("mean_items", 0.9).alias("_cap"))
    rows = scaled_by(stats, {"p95": "_speed"}, inverted=["p95"]).join(F.broadcast(cap))
    volume = F.col("mean_items") / F.when(F.col("_cap") > 0, F.col("_cap")).otherwise(1.0)
    score = PROBE["success"] * held(F.col("success")) + PROBE["latency"] * held(F.col("_speed")) + PROBE["volume"] * held(volume) + PROBE["penalty"] * held(F.col("errors"))
    rows = rows.withColumn("score", held(score))
    gates = (F.col("success") >= PROBE_GATES["success"]) & (F.col("p95") <= PROBE_GATES["p95"]) & (F.col("errors") <= PROBE_GATES["errors"]) & (F.col("score") >= PROBE_GATES["score"])
    return rows.withColumn("included", gates).drop("_speed", "_cap")


def stability(rates: DataFrame, key: str, repeat: str, success: str, nonempty: str) -> DataFrame:
    """Per source: one less the weighted population deviations of the rates of its repeats, at least 0."""
    per = rates.groupBy(key, repeat).agg(F.avg(success).alias("s"), F.avg(nonempty).alias("e"))
    spread = lambda c: F.when(F.count("*") > 1, F.stddev_pop(c)).otherwise(0.0)
    return per.groupBy(key).agg(F.greatest(F.lit(0.0), 1 - (0.6 * spread("e") + 0.4 * spread("s"))).alias("stability"))


def truncated_p95(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """95th percentile of each group by index truncation of the sorted values, from a histogram of the distinct ones."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys)
    reached = F.sum("_n").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    asked = F.greatest(F.floor(F.sum("_n").over(w) * 0.95), F.lit(1))
    return counted.withColumn("_ok", reached >= asked).where("_ok").groupBy(*keys).agg(F.min(value).alias(name))


def mode_first(rows: DataFrame, keys: Sequence[str], value: str, pos: str) -> DataFrame:
    """Most frequent value of each group; of several the one seen first."""
    counted = rows.groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(pos).alias("_first"))
    return counted.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias(value), F.max("_n").alias("votes"))


def guarded_mode(rows: DataFrame, keys: Sequence[str], value: str, pos: str) -> DataFrame:
    """Like :func:`mode_first`, but null when more than two values stand and the winner has no majority."""
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(pos).alias("_first"))
    best = counted.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col("_first"))).alias("_v"), F.max("_n").alias("_m"), F.count("*").alias("_d"), F.sum("_n").alias("_t"))
    weak = (F.col("_d") > 2) & (F.col("_m") <= F.greatest(F.lit(2), F.floor(F.col("_t") / 2)))
    return best.select(*keys, F.when(~weak, F.col("_v")).alias(value))


def weighted_vote(votes: DataFrame, keys: Sequence[str], value: str, weight: str, noise: Column, top: int) -> DataFrame:
    """The best values by summed weight; ties by less noise, then by shorter text, then by the text."""
    summed = votes.groupBy(*keys, value).agg(F.sum(weight).alias("weight"))
    w = Window.partitionBy(*keys).orderBy(F.desc("weight"), noise, F.length(value), F.col(value))
    return summed.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def only_value(value: Column, fallback: Column) -> Column:
    """The group's value if it has exactly one, else the fallback."""
    return F.when(F.countDistinct(value) == 1, F.max(value)).otherwise(fallback)


def unique_pairs(rows: DataFrame, keys: Sequence[str], first: str, second: str) -> DataFrame:
    """Groups that know exactly one pair of ids, with the pair."""
    pair = F.struct(F.coalesce(F.col(first).cast("string"), F.lit("")), F.coalesce(F.col(second).cast("string"), F.lit("")))
    known = rows.where(F.col(first).isNotNull() | F.col(second).isNotNull())
    found = known.groupBy(*keys).agg(F.countDistinct(pair).alias("_n"), F.max(first).alias(first), F.max(second).alias(second))
    return found.where("_n = 1").drop("_n")


def slo_status(percent: Column, green: float = 80, amber: float = 60) -> Column:
    return F.when(percent >= green, "GREEN").when(percent >= amber, "AMBER").otherwise("RED")


def change_ratio(before: Column, after: Column) -> Column:
    """Members that came or went over the size of the larger set; 0 for two empty sets."""
    moved = F.size(F.array_except(before, after)) + F.size(F.array_except(after, before))
    most = F.greatest(F.size(F.array_distinct(before)), F.size(F.array_distinct(after)))
    return F.when(most > 0, moved / most).otherwise(0.0)


#: What a probed kind of content adds to the support of a source, the hit rate that it takes, the support that counts, and
#: words in a source's name that hint at a kind (fixed values).
SUPPORT = {"probe": 0.45, "rate": 0.05, "least": 0.40}
NAME_HINTS = {
    "anime": (0.55, ("anime", "nyaa", "subsplease", "bangumi", "tokyo", "dmhy", "mikan", "shana")),
    "movies": (0.25, ("yts", "movie", "dvdr", "bluray", "4k")),
    "series": (0.25, ("eztv", "series", "tv", "episode")),
}
KINDS = ("movies", "series", "anime")
#: What probes call the kinds (fixed values); each name that is probed counts by itself.
PROBED = {"movies": ("movies", "movie"), "series": ("series",), "anime": ("anime",)}


def named_usage(usage: DataFrame, known: DataFrame, name: str, key: str) -> DataFrame:
    """Usage rows (``name``) of known sources (``name, key``), whatever the case of the name; rows of unknown names are skipped.

    Of known names that differ in case only, the one that sorts last stands.
    """
    folded = known.groupBy(F.lower(name).alias("_low")).agg(F.max(F.struct(F.col(name).alias("known_name"), key)).alias("_k")).select("_low", "_k.*")
    return usage.withColumn("_low", F.lower(name)).join(folded, "_low").drop("_low")


def content_support(probes: DataFrame, source: str, service: str, kind: str, hit: Column, ok: Column, name: str) -> DataFrame:
    """Kinds of content that each source supports, and its state.

    Every service whose probes of a kind hit often enough adds to that kind, and so does the source's name; a source that
    reaches no kind counts for films and series. ``empty``: no service had items; ``degraded``: none succeeded half the time.
    A source's name is its most frequent one, of equally frequent ones the smallest; kinds are named in any case.
    """
    probes = probes.withColumn("_hit", (hit & ok).cast("double")).withColumn("_ok", ok.cast("double")).withColumn("_some", hit.cast("double"))
    per = probes.groupBy(source, service).agg(
        *[F.avg(F.when(F.lower(F.trim(F.col(kind))) == p, F.col("_hit"))).alias(f"_{p}") for ps in PROBED.values() for p in ps], F.avg("_ok").alias("_success"), F.avg("_some").alias("_filled")
    )
    counted = probes.groupBy(source, name).agg(F.count("*").alias("_n"))
    per = per.join(counted.groupBy(source).agg(F.min(F.struct(-F.col("_n"), F.col(name).alias("_name"))).alias("_first")), source)
    low = F.lower(F.min("_first._name"))
    hints = {k: F.when(functools.reduce(operator.or_, [low.contains(w) for w in words]), weight).otherwise(0.0) for k, (weight, words) in NAME_HINTS.items()}
    reached = lambda p: F.sum(F.when(F.col(f"_{p}") >= SUPPORT["rate"], SUPPORT["probe"]).otherwise(0.0))
    support = {k: sum((reached(p) for p in PROBED[k]), F.lit(0.0)) + hints[k] for k in KINDS}
    found = per.groupBy(source).agg(*[s.alias(k) for k, s in support.items()], F.max("_success").alias("_success"), F.max("_filled").alias("_filled"))
    kinds = F.array_compact(F.array(*[F.when(F.col(k) >= SUPPORT["least"], k) for k in KINDS]))
    status = F.when(F.col("_filled") == 0, "empty").when(F.col("_success") < 0.5, "degraded").otherwise("working")
    return found.withColumn("kinds", F.when(F.size(kinds) > 0, kinds).otherwise(F.array(F.lit("movies"), F.lit("series")))).withColumn("status", status).drop("_success", "_filled")


def sticky_owner(scores: DataFrame, key: str, owner: str, score: str, order: str, previous: str, margin: float) -> DataFrame:
    """Best owner of each key; the previous one stays while the best leads it by less than the margin."""
    w = Window.partitionBy(key).orderBy(F.desc(score), F.col(order))
    best = scores.withColumn("_n", F.row_number().over(w)).withColumn("_best", F.max(score).over(Window.partitionBy(key)))
    held = F.max(F.when((F.col(owner) == F.col(previous)) & (F.col("_best") - F.col(score) < margin), F.col(owner)))
    return best.groupBy(key).agg(F.coalesce(held, F.max(F.when(F.col("_n") == 1, F.col(owner)))).alias("owner"))


def steady_mean(value: Column) -> Column:
    """Mean of a double that does not depend on the order of its rows: values are added as whole billionths.

    Groups with a value that is not finite, or beyond nine billion, have the floating-point mean.
    """
    units = F.round(value * 1e9).try_cast("long").cast("decimal(20,0)")
    exact = F.try_divide(F.sum(units).cast("double"), F.count(units)) / 1e9
    return F.coalesce(F.when(F.count(units) == F.count(value), exact), F.avg(value))


def resolve_overlaps(left: DataFrame, right: DataFrame, key: str, score: str) -> DataFrame:
    """Two ranked lists without common members: a shared key goes to the list that scores it higher (left on ties)."""
    both = left.select(key, F.col(score).alias("l")).join(right.select(key, F.col(score).alias("r")), key, "full")
    side = F.when(F.col("r").isNull() | F.coalesce(F.col("l") >= F.col("r"), F.lit(False)), "left").otherwise("right")
    owned = both.select(key, side.alias("side"), F.greatest("l", "r").alias("score"))
    return owned.withColumn("place", F.row_number().over(Window.partitionBy("side").orderBy(F.desc("score"), F.col(key))))


def bounded_samples(rows: DataFrame, reason: str, by: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` examples of each reason."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(reason).orderBy(*by))).where(F.col("_n") <= n).drop("_n")
