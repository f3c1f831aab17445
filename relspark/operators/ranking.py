"""Preference ranks, stable sorts, limits and winners; everything per request is a window on ``request_id``."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INFINITY = float("inf")


def rank_in(value: Column, preferred: Sequence[str]) -> Column:
    """Position in the preference list from 0; unlisted and null are infinitely far."""
    found = F.array_position(F.array(*[F.lit(p) for p in preferred]), value)
    return F.when(found > 0, (found - 1).cast("double")).otherwise(F.lit(INFINITY))


def rank_of_any(tags: Column, preferred: Sequence[str], absent: float = INFINITY) -> Column:
    """Best rank among the elements of an array; ``absent`` if none is preferred."""
    ranks = F.array_min(F.transform(tags, lambda t: rank_in(t, preferred)))
    return F.when(ranks < INFINITY, ranks).otherwise(F.lit(float(absent)))


def first_rule(rules: Sequence[Column]) -> Column:
    """Number of the first rule that holds, or null."""
    return F.coalesce(*[F.when(r, F.lit(i)) for i, r in enumerate(rules)]) if rules else F.lit(None).cast("int")


def rule_score(rules: Sequence[tuple[str | None, Column, float]], null_without_name: bool = False) -> tuple[Column, Column]:
    """Sum of the scores of the rules that hold, and the names that matched; optionally null if nothing named matched."""
    score: Column = F.lit(0.0)
    for _, hit, value in rules:
        score = score + F.when(hit, F.lit(float(value))).otherwise(F.lit(0.0))
    names = F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit, _ in rules if name is not None] or [F.lit(None).cast("string")]))
    return (F.when(F.size(names) > 0, score) if null_without_name else score), names


def order(criteria: Sequence[tuple[Column, str]], pos: str = "pos") -> list[Column]:
    """Sort columns of a stable sort: nulls as 0 in numbers, direction by criterion, ``pos`` last."""
    return [*(c.desc_nulls_last() if d == "desc" else c.asc_nulls_last() for c, d in criteria), F.col(pos).asc()]


#: Columns of the sort keys that are plain numbers or flags, unknown as 0 (fixed values).
_NUMBERS = {
    "size": "size", "bitrate": "bitrate", "seeders": "seeders", "age": "age_hours", "library": "library", "private": "private", "streamExpressionScore": "sel_score",
    "regexScore": "regex_score", "keyword": "keyword",
}
#: Columns of the sort keys that are ranked by a preference list, and of those that hold several values (fixed values).
_LISTED = {"encode": "encode", "resolution": "resolution", "quality": "quality", "streamType": "type", "addon": "source_id", "service": "service_id", "releaseGroup": "release_group"}
_TAGGED = {"visualTag": "tags", "audioTag": "audio_tags", "language": "languages"}
_PLACED = {"regexPatterns": "regex_index", "streamExpressionMatched": "sel_index"}


def sort_key(key: str, preferred: Sequence[str] | None = None) -> Column:
    """Value of a sort key, higher is better: numbers as they are, places in a preference list negated, unlisted lowest.

    A missing value of a listed attribute counts as ``Unknown``; without a list the key says nothing. The best of several
    values counts; languages without a listed one share the place behind the list, tags the lowest one.
    """
    lowest, nothing = F.lit(-INFINITY), F.lit(0.0)
    if key in _NUMBERS:
        return F.coalesce(F.col(_NUMBERS[key]).cast("double"), nothing)
    if key in _PLACED:
        return F.coalesce(-F.col(_PLACED[key]).cast("double"), lowest)
    if key == "cached":
        return F.when(F.coalesce(F.col("cached"), F.lit(True)), 1.0).otherwise(0.0)
    if key == "seadex":
        return F.when(F.coalesce("seadex_best", F.lit(False)), 2.0).when(F.coalesce("seadex", F.lit(False)), 1.0).otherwise(0.0)
    if preferred is None or (key == "releaseGroup" and not preferred):
        return nothing
    if key in _TAGGED:
        held = F.when(F.coalesce(F.size(_TAGGED[key]), F.lit(0)) > 0, F.col(_TAGGED[key])).otherwise(F.array(F.lit("Unknown")))
        return -rank_of_any(held, preferred, float(len(preferred)) if key == "language" else INFINITY)
    if key in _LISTED:
        value = F.col(_LISTED[key]) if key in ("streamType", "addon", "service") else F.coalesce(F.col(_LISTED[key]), F.lit("Unknown"))
        return -rank_in(F.lower(value), [p.lower() for p in preferred]) if key == "releaseGroup" else -rank_in(value, preferred)
    raise ValueError(f"unknown sort key {key}")


def sort_order(criteria: Sequence[tuple[str, str]], preferences: dict[str, Sequence[str]], pos: str = "pos") -> list[Column]:
    """Sort columns of criteria ``(key, asc or desc)``; of equal rows the earlier one comes first."""
    by = [sort_key(key, preferences.get(key)) for key, _ in criteria]
    return [*(c.asc() if d == "asc" else c.desc() for c, (_, d) in zip(by, criteria, strict=True)), F.col(pos).asc()]


def criteria_for(kind: str, criteria: dict[str, Sequence[tuple[str, str]]]) -> tuple[Sequence[tuple[str, str]], ...]:
    """Primary, cached and uncached criteria for a request of a kind: those of the kind where they are given, else the global ones."""
    name = {"movie": "movies", "series": "series", "anime": "anime"}.get(kind, "")
    pick = lambda own, fallback: (name and criteria.get(own)) or criteria.get(fallback) or ()
    return pick(name, "global"), pick(f"cached{name.capitalize()}", "cached"), pick(f"uncached{name.capitalize()}", "uncached")


def ranked(rows: DataFrame, keys: Sequence[str], by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Adds the row's place (from 1) within its keys."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))


def winner(rows: DataFrame, keys: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """The first row of every group."""
    return ranked(rows, keys, by, "_rank").where("_rank = 1").drop("_rank")


def split_order(bucket: Column, first: Sequence[tuple[Column, str]], second: Sequence[tuple[Column, str]], pos: str = "pos") -> list[Column]:
    """Rows of the bucket by ``first``, then all others by ``second``."""
    inside = F.coalesce(bucket, F.lit(False))
    a = [F.when(inside, c) for c, _ in first]
    b = [F.when(~inside, c) for c, _ in second]
    return [inside.desc(), *order(list(zip(a, (d for _, d in first), strict=True)) + list(zip(b, (d for _, d in second), strict=True)), pos)]


def top_per(rows: DataFrame, keys: Sequence[str], by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; the limiter with a single dimension."""
    return ranked(rows, keys, by, "_rank").where(F.col("_rank") <= n).drop("_rank")


def greedy_limit(rows: DataFrame, limits: dict[str, int], total: int | None = None, key: str = "request_id", by: str = "place", passthrough: str | None = None) -> DataFrame:
    """Walk every request in order, counting each limited dimension; a row goes when any counter is past its limit.

    Counters touched before the one that rejects stay raised: a dimension counts exactly the rows that all dimensions before
    it let through, so its counter is the row number among them. Null and NaN are not counted. Passthrough rows skip the
    dimensions, but the total, which ends the walk, counts them too. All windows share one shuffle, on ``key``.
    """
    in_order, kinds = F.col(by).asc_nulls_last(), dict(rows.dtypes)
    free = F.coalesce(F.col(passthrough), F.lit(False)) if passthrough else F.lit(False)
    out = rows.repartition(key).withColumn("_free", free)
    for d, most in limits.items():
        counted = ~F.col("_free") & F.col(d).isNotNull()
        if kinds[d] in ("float", "double"):
            counted = counted & ~F.isnan(d)
        n = F.row_number().over(Window.partitionBy(key, "_free", d).orderBy(in_order))
        out = out.withColumn("_n", F.when(counted, n)).where(F.col("_n").isNull() | (F.col("_n") <= most)).drop("_n")
    out = out.drop("_free")
    return out if total is None else top_per(out, [key], [in_order], total)


def interleave(rows: DataFrame, source: str, pos: str) -> list[Column]:
    """The i-th row of every source in turn."""
    return [F.row_number().over(Window.partitionBy(source).orderBy(pos)), F.col(source)]


def between(rows: DataFrame, key: str, by: Sequence[Column], start: int, end: int | None = None) -> DataFrame:
    """Rows from ``start`` up to ``end`` of each request; negative numbers count from the end."""
    w = Window.partitionBy(key)
    place, n = F.row_number().over(w.orderBy(*by)) - 1, F.count("*").over(w)
    at = lambda k: F.lit(k) if k >= 0 else F.greatest(n + k, F.lit(0))
    inside = (place >= at(start)) & (place < at(end) if end is not None else F.lit(True))
    return rows.withColumn("_in", inside).where("_in").drop("_in")


def shuffled(key: Column, seed: int) -> Column:
    """A reproducible random order."""
    return F.xxhash64(F.lit(seed), key)


def greedy_unique(rows: DataFrame, key_columns: Sequence[str], title: str | None, by: str, group: str | None = None) -> DataFrame:
    """First-wins dedup in which a row that goes leaves neither its keys nor its title behind.

    With one key and no title this is :func:`winner`; otherwise each group is walked in order by one task.
    """
    if title is None and len(key_columns) == 1:
        k = key_columns[0]
        firsts = winner(rows.where(F.col(k).isNotNull()), [*([group] if group else []), k], [F.col(by)])
        return firsts.unionByName(rows.where(F.col(k).isNull()))

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(by)
        keys: set = set()
        titles: set = set()
        kept = []
        for row in frame.to_dict("records"):
            own = {(c, row[c]) for c in key_columns if row[c] is not None and row[c] == row[c]}
            t = row[title] if title else None
            good = not (own & keys) and (t is None or t not in titles)
            if good:
                keys |= own
                titles |= {t} - {None}
            kept.append(good)
        return frame[kept]

    rows = rows if group else rows.withColumn("_all", F.lit(1))
    out = rows.groupBy(group or "_all").applyInPandas(walk, rows.schema)
    return out if group else out.drop("_all")


#: Rounds in which every row takes the least label among the rows it shares a key with; longer chains are finished pair by pair.
ROUNDS = 3


def _united(pairs: Column) -> Column:
    """Map from each label of the pairs to the least label connected with it."""
    empty = F.array().cast("array<struct<root:bigint,members:array<bigint>>>")

    def join(groups: Column, pair: Column) -> Column:
        touched = lambda g: F.array_contains(g["members"], pair["low"]) | F.array_contains(g["members"], pair["label"])
        mine = F.filter(groups, touched)
        members = F.array_union(F.flatten(F.transform(mine, lambda g: g["members"])), F.array(pair["low"], pair["label"]))
        return F.concat(F.filter(groups, lambda g: ~touched(g)), F.array(F.struct(F.array_min(members).alias("root"), members.alias("members"))))

    groups = F.aggregate(pairs, empty, join)
    return F.map_from_entries(F.flatten(F.transform(groups, lambda g: F.transform(g["members"], lambda m: F.struct(m, g["root"])))))


def duplicate_groups(rows: DataFrame, key: str, pos: str, keys_column: str) -> DataFrame:
    """Adds ``dup_group``: the smallest ``pos`` among rows of the request that are connected by shared keys.

    Rows with a key in common are joined transitively; rows without keys (an empty or null array, null keys) stand alone. Labels
    spread along shared keys in a fixed number of windows over the request, which are all sorted from one shuffle. Keys that
    still hold more than one label after that join those labels in pairs, which each request unites by itself; only chains
    longer than the rounds leave any.
    """
    given = F.array_compact(F.coalesce(keys_column, F.array().cast(rows.schema[keys_column].dataType)))
    each = rows.repartition(key).withColumn("_key", F.explode_outer(given)).withColumn("_label", F.col(pos).cast("long"))
    shared, row = Window.partitionBy(key, "_key"), Window.partitionBy(key, pos)
    for _ in range(ROUNDS):
        each = each.withColumn("_label", F.when(F.col("_key").isNull(), F.col("_label")).otherwise(F.min("_label").over(shared)))
        each = each.withColumn("_label", F.min("_label").over(row))
    low = F.when(F.col("_key").isNotNull(), F.min("_label").over(shared))
    each = each.withColumn("_low", low)
    pair = F.when(F.col("_low") < F.col("_label"), F.struct(F.col("_low").alias("low"), F.col("_label").alias("label")))
    open_ = each.where(pair.isNotNull()).groupBy(key).agg(F.collect_set(pair).alias("_pairs"))
    roots = open_.select(F.col(key).alias("_of"), _united(F.col("_pairs")).alias("_roots"))
    once = each.withColumn("_n", F.row_number().over(row.orderBy("_label"))).where("_n = 1")
    joined = once.join(roots, F.col(key).eqNullSafe(F.col("_of")), "left")
    return joined.select(*rows.columns, F.coalesce(F.col("_roots")[F.col("_label")], F.col("_label")).alias("dup_group"))


#: Types whose rows are told apart by whether their service holds them (fixed values).
DIVIDED = ("debrid", "usenet", "stremio-usenet")


def dedup_class() -> Column:
    """Class of a row inside a duplicate group: ``cached`` or ``uncached`` for a row with a service, else its type."""
    divided = F.col("type").isin(*DIVIDED) & F.col("service_id").isNotNull()
    return F.when(divided, F.when(F.coalesce("cached", F.lit(False)), "cached").otherwise("uncached")).otherwise(F.col("type"))


def _driven_out(keys: Sequence[str], mode: str) -> Column:
    """Whether a class of the group drives out the row, by its ``_class``."""
    has = lambda c, *more: F.max(F.coalesce(F.col("_class") == c, F.lit(False))).over(Window.partitionBy(*keys, *more))
    is_ = lambda c: F.coalesce(F.col("_class") == c, F.lit(False))
    if mode == "aggressive":
        return (has("cached") & (is_("uncached") | is_("p2p"))) | (has("p2p") & is_("uncached"))
    if mode == "conservative":
        return (is_("uncached") & has("cached", "service_id")) | (is_("p2p") & has("cached"))
    if mode == "keep_all":
        return F.lit(False)
    raise ValueError(f"unknown mode {mode}")


def dedup_mode(rows: DataFrame, keys: Sequence[str], mode: str) -> DataFrame:
    """Drop whole classes inside a duplicate group; classes other than cached, uncached and p2p always stay.

    ``aggressive``: cached rows drive out uncached and p2p ones, else p2p rows the uncached ones. ``conservative``: cached
    rows drive out p2p ones and the uncached ones of their own service. ``keep_all`` drops nothing.
    """
    return rows.withColumn("_class", dedup_class()).withColumn("_bad", _driven_out(keys, mode)).where("not _bad").drop("_bad", "_class")


def dedup_order(mode: str, services: Sequence[str], sources: Sequence[str], types: Sequence[str], pos: str = "pos") -> list[Column]:
    """Order in which rows of a class win under a mode. Unknown seeders count as 0, which makes the order total."""
    counted = F.col("_class").isin("p2p", "uncached")
    seeders = F.when(counted, F.coalesce("seeders", F.lit(0))).otherwise(0).desc()
    service, source, type_ = (rank_in(F.col(c), known) for c, known in (("service_id", services), ("source_id", sources), ("type", types)))
    return {
        "single_result": [service, seeders, source, type_, F.col(pos)],
        "per_service": [source, type_, seeders, F.col(pos)],
        "per_addon": [service, seeders, F.col(pos)],
    }[mode]


#: What one row stands for under each mode, besides its group and class (fixed values).
MODE_KEYS = {"single_result": (), "per_service": ("service_id",), "per_addon": ("source_id",)}
#: Modes of the classes where none is given (fixed values); a class without a mode stays, in the strict form it goes.
MODES = {"cached": "per_addon", "uncached": "per_addon", "p2p": "per_addon", "http": "disabled", "live": "disabled", "youtube": "disabled", "external": "disabled"}


def dedup_winners(
    rows: DataFrame, keys: Sequence[str], mode: str, services: Sequence[str] = (), sources: Sequence[str] = (), types: Sequence[str] = (), pos: str = "pos"
) -> DataFrame:
    """One row of each group and class under one mode; ``per_service`` over a row without a service is an error."""
    rows = rows.withColumn("_class", dedup_class())
    if mode == "per_service":
        rows = rows.withColumn("service_id", F.coalesce("service_id", F.raise_error(F.lit("per_service needs a service in every row")).cast("string")))
    return winner(rows, [*keys, "_class", *MODE_KEYS[mode]], dedup_order(mode, services, sources, types, pos)).drop("_class")


def deduplicate(
    rows: DataFrame, request: str, keys_column: str, multi_group: str = "aggressive", modes: dict[str, str] | None = None, services: Sequence[str] = (), sources: Sequence[str] = (),
    types: Sequence[str] = (), excluded: Column | None = None, passthrough: Column | None = None, strict: bool = False, pos: str = "pos",
) -> DataFrame:
    """The whole dedup of a request's rows: groups from shared keys, classes that drive out others, winners by mode.

    Rows of excluded sources always stay, yet take part in the groups and may win in them. Passthrough rows always stay and
    compete with no row. A class without a mode stays; with ``strict`` it goes. One shuffle on the request, then windows.
    """
    modes, false = MODES | (modes or {}), F.lit(False)
    flag = lambda c: false if c is None else F.coalesce(c, false)
    marked = duplicate_groups(rows.withColumns({"_free": flag(passthrough), "_out": flag(excluded)}), request, pos, keys_column)
    keys = [request, "dup_group"]
    marked = marked.withColumn("_class", F.when(~F.col("_free"), dedup_class())).withColumn("_bad", _driven_out(keys, multi_group))
    wins = false
    for name, more in MODE_KEYS.items():
        own = [c for c, m in modes.items() if m == name]
        place = F.row_number().over(Window.partitionBy(*keys, "_bad", "_class", *more).orderBy(*dedup_order(name, services, sources, types, pos)))
        marked = marked.withColumn(f"_{name}", place)
        wins = wins | (F.col("_class").isin(*own) & (F.col(f"_{name}") == 1) if own else false)
    idle = F.col("_class").isin(*[c for c, m in modes.items() if m == "disabled"])
    unlisted = false if strict else ~F.col("_class").isin(*modes)
    stays = F.col("_out") | F.col("_free") | (~F.col("_bad") & (flag(wins) | flag(idle) | flag(unlisted)))
    return marked.where(stays).select(*rows.columns)


def clones(rows: DataFrame, when: Column, **changed: Column) -> DataFrame:
    """Each row, and behind it a changed copy where ``when`` holds (``copy`` is 0 and 1)."""
    both = rows.withColumn("copy", F.explode(F.when(when, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return both.select(*[F.when(F.col("copy") == 1, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c) for c in both.columns])


def last_wins(left: DataFrame, right: DataFrame, key: str, pos: str) -> DataFrame:
    """Union by key: the row of ``right`` replaces that of ``left`` and stands at its place."""
    both = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))
    w = Window.partitionBy(key)
    first = F.min(F.struct("_side", pos)).over(w)
    place = F.row_number().over(w.orderBy(F.desc("_side"), F.desc(pos)))
    return both.withColumn("_first", first).withColumn("_n", place).where("_n = 1").withColumn("place", F.struct("_first._side", F.col("_first")[pos])).drop("_side", "_first", "_n")


