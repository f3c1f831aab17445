"""Whether a result is what was asked for: title, year, season and episode; intake rules; choices of source lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim


def title_match(rows: DataFrame, title: str, wanted: str, threshold: float = 0.85, exact: bool = True) -> DataFrame:
    """Adds ``title_ok``: the best fuzzy score of the normalised title with any wanted title; missing titles never match.

    Distinct pairs are scored once and joined back, and equal normal forms need no score at all.
    """
    pairs = rows.select(title, F.explode(wanted).alias("_want")).where(F.col(title).isNotNull()).distinct()
    normal = pairs.withColumn("_a", sim.normalise_title(title)).withColumn("_b", sim.normalise_title("_want"))
    score = (sim.fuzzy_ratio if exact else sim.fuzzy_partial)("_a", "_b") / 100
    equal = normal.where("_a = _b").select(title, "_want", F.lit(True).alias("_ok"))
    rest = normal.where("_a <> _b").withColumn("_score", score).select(title, "_want", (F.col("_score") >= threshold).alias("_ok"))
    good = equal.union(rest).where("_ok").select(title, "_want").distinct()
    keyed = rows.withColumn("_key", F.xxhash64(title, wanted))
    hits = keyed.select("_key", title, F.explode(wanted).alias("_want")).distinct().join(good, [title, "_want"]).select("_key").distinct()
    return keyed.join(hits.withColumn("title_ok", F.lit(True)), "_key", "left").withColumn("title_ok", F.coalesce("title_ok", F.lit(False))).drop("_key")


def _lost_pairs(size: Column, threshold: float) -> Column:
    """Pairs of neighbouring characters that a text may lack in another whose ratio with it meets the threshold.

    Two are lost for each character that the other lacks, one for each that it has besides; the shorter the other text may
    be, the more.
    """
    other = F.ceil(size * F.lit(threshold / (2 - threshold)) - 1e-9)
    return F.floor(2 * size + other - F.lit(1.5 * threshold) * (size + other) + 1e-9).cast("int")


def _scarce(threshold: float) -> int:
    """The greatest length at which two texts that meet the threshold may share no pair of neighbours."""
    longest, n = 0, 1
    while n <= 4 * longest + 64:
        other = -int(-(n * threshold / (2 - threshold) - 1e-9) // 1)
        if n - 1 - int((2 * n + other - 1.5 * threshold * (n + other) + 1e-9) // 1) < 1:
            longest = n
        n += 1
    return longest


def fuzzy_join(left: DataFrame, right: DataFrame, threshold: float = 0.85) -> DataFrame:
    """``left, right, score``: all pairs of distinct texts of two one-column tables whose ratio is at least the threshold.

    Candidates come from an equi-join. Texts are bags of pairs of neighbouring characters, ordered by how many texts hold
    them; two texts that meet the threshold share one of the rarest pairs that each cannot lack. Texts so short that they
    might share none are joined on single characters. A pair that shares several is kept at the first one only, so nothing
    is made distinct afterwards. Nulls and empty texts match nothing. Thresholds of two thirds or less have no such bound
    and raise.
    """
    if not 2 / 3 < threshold <= 1:
        raise ValueError("the threshold must be above two thirds and at most 1")
    side = lambda df, n: df.select(F.col(df.columns[0]).alias("t")).where("t != ''").distinct().withColumn("side", F.lit(n))
    both = side(left, 0).unionByName(side(right, 1)).withColumn("size", F.length("t"))
    numbered = lambda g: F.transform(g, lambda x, i: F.concat(x, F.size(F.filter(F.slice(g, F.lit(1), i), lambda y: y == x)).cast("string")))
    pairs = F.when(F.col("size") > 1, F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda i: F.substring("t", i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    grams = both.withColumn("grams", pairs).withColumn("grams", numbered(F.col("grams")))
    held = grams.select("t", "side", "size", F.explode("grams").alias("gram"))
    ranked = held.join(held.groupBy("gram").agg(F.count("*").alias("n")), "gram").groupBy("t", "side", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    chosen = ranked.select("t", "side", "size", F.slice(F.col("grams.gram"), F.lit(1), _lost_pairs(F.col("size"), threshold) + 1).alias("keys"))
    short = _scarce(threshold)
    # The last place of a numbered pair is a digit, so three characters and more; single characters can't be taken for one.
    if short:
        most = int(short * (2 - threshold) / threshold + 1e-9)
        letters = both.where(F.col("size") <= most).select("t", "side", "size", F.array_remove(F.array_distinct(F.split("t", "")), "").alias("keys"))
        chosen = chosen.unionByName(letters).groupBy("t", "side", "size").agg(F.flatten(F.collect_list("keys")).alias("keys"))
    keyed = chosen.select("t", "side", "size", "keys", F.explode("keys").alias("key"))
    named = lambda n, name: keyed.where(F.col("side") == n).select("key", F.col("t").alias(name), F.col("size").alias(f"_{name}"), F.col("keys").alias(f"{name}_keys"))
    found = named(0, "left").join(named(1, "right"), "key")
    near = 2 * F.least("_left", "_right") >= F.lit(threshold - 1e-9) * (F.col("_left") + F.col("_right"))
    first = F.get(F.array_intersect("left_keys", "right_keys"), F.lit(0)) == F.col("key")
    scored = found.where(near & first).select("left", "right", (sim.fuzzy_ratio("left", "right") / 100).alias("score"))
    return scored.where(F.col("score") >= threshold - 1e-12)


def year_match(year: Column, start: Column, end: Column, tolerance: int = 1, strict: bool = False) -> Column:
    """Year inside a range of years with a tolerance; a missing year fails only strict rules."""
    inside = (year >= start - tolerance) & (year <= F.coalesce(end, start) + tolerance)
    return F.when(year.isNull(), F.lit(not strict)).otherwise(F.coalesce(inside, F.lit(True)))


def episode_match(seasons: Column, episodes: Column, season: Column, episode: Column, absolute: Column | None = None) -> Column:
    """Season and episode asked for are among those of the row; rows without them pass, and an absolute number may stand in
    for the episode when the row names no season or the first."""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    season_ok = ~some(seasons) | season.isNull() | F.coalesce(F.array_contains(seasons, season), F.lit(True))
    episode_ok = ~some(episodes) | episode.isNull() | F.coalesce(F.array_contains(episodes, episode), F.lit(True))
    if absolute is None:
        return season_ok & episode_ok
    free = ~some(seasons) | F.array_contains(seasons, F.lit(1))
    by_number = free & some(episodes) & F.coalesce(F.array_contains(episodes, absolute), F.lit(False))
    return (season_ok & episode_ok) | by_number


def intake_reason(name: Column, size: Column, terms: Sequence[tuple[str, Sequence[str]]], least: int, prefix: str | None = None) -> Column:
    """First reason to refuse an item: too small, a code prefix, a term of an ordered list of classes; null keeps it."""
    low = F.lower(name)
    reasons = [F.when(size < least, "too_small")]
    if prefix is not None:
        reasons.append(F.when(name.rlike(prefix), "code_prefix"))
    for reason, words in terms:
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w.lower())
        reasons.append(F.when(hit, reason))
    return F.coalesce(*reasons)


def identified(rows: DataFrame, class_column: str, needs_id: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Adds ``dropped``: classes that need an id, without any."""
    none = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in ids]).isNull()
    return rows.withColumn("dropped", F.col(class_column).isin(*needs_id) & none)


def allow_list(rows: DataFrame, key: str, score: str, eligible: Column, top: int, least: float, explore: float, seed: int) -> DataFrame:
    """Up to ``top`` sources: eligible ones with the score, then others by score, and a seeded exploration of the rest.

    Adds ``why``: core, backfill or explore. Exploration takes ``ceil(top * explore)`` sources, at least one, in order of a
    digest of seed and key. Both choices are top-n queries; no step sorts all sources in one task.
    """
    core = F.coalesce(eligible & (F.col(score) >= least), F.lit(False))
    first = rows.withColumn("_core", core).orderBy(F.desc("_core"), F.desc_nulls_last(score), key).limit(top)
    first = first.withColumn("why", F.when(F.col("_core"), "core").otherwise("backfill")).drop("_core")
    turn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    rest = rows.join(first.select(key), key, "left_anti").orderBy(turn, key).limit(max(1, -int(-top * explore // 1)))
    return first.unionByName(rest.withColumn("why", F.lit("explore")))


def fast_slow(rows: DataFrame, key: str, by: Sequence[str], fast: int = 8) -> DataFrame:
    """Adds ``lane``: fast for the first sources by the given columns, highest first, and slow for the rest."""
    first = rows.orderBy(*[F.desc_nulls_last(c) for c in by], key).limit(fast).select(key, F.lit("fast").alias("lane"))
    return rows.join(F.broadcast(first), key, "left").withColumn("lane", F.coalesce("lane", F.lit("slow")))


def low_value(titles: Column, members: Column, noise: Column) -> Column:
    """Why a cluster is not worth resolving, or null.

    ``titles`` are its normal titles, best first, and ``noise`` their noise scores; the first three that are not empty count.
    """
    pairs = F.slice(F.filter(F.arrays_zip(titles.alias("t"), noise.alias("n")), lambda p: p["t"] != ""), F.lit(1), F.lit(3))
    return (
        F.when(F.size(pairs) == 0, "no_clean_titles")
        .when(F.forall(pairs, lambda p: p["t"].rlike(r"^\d+( \d+)?$")), "cluster_numeric_only")
        .when(F.forall(pairs, lambda p: p["n"] >= 6), "cluster_noise_only")
        .when(members <= 0, "empty_cluster")
    )
