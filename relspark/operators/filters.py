"""Row predicates: one ordered decision per row, kept with its reason, and the statistics made from it."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def scalar(column: str) -> Column:
    """A missing scalar counts as the literal ``Unknown``."""
    return F.coalesce(F.col(column), F.lit(UNKNOWN))


def values(column: str) -> Column:
    """A missing or empty array counts as ``[Unknown]``."""
    return F.when(F.coalesce(F.size(column), F.lit(0)) > 0, F.col(column)).otherwise(F.array(F.lit(UNKNOWN)))


def _texts(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in items])


@dataclass(frozen=True)
class Range:
    """Bounds of a numeric rule; ``None`` is unbounded. ``on`` restricts the rule to rows of these types or classes.

    The classes ``cached`` and ``uncached`` are the debrid rows of that state; an unknown state is uncached.
    """

    low: float | None = None
    high: float | None = None
    on: tuple[str, ...] = ()

    def applies(self) -> Column:
        if not self.on:
            return F.lit(True)
        state = {"cached": True, "uncached": False}
        types = F.col("type").isin(*[t for t in self.on if t not in state])
        held = [(F.col("type") == "debrid") & (F.coalesce("cached", F.lit(False)) == state[t]) for t in self.on if t in state]
        return F.coalesce(functools.reduce(operator.or_, held, types), F.lit(False))

    @classmethod
    def normalised(cls, low: float | None, high: float | None, least: float, most: float, on: tuple[str, ...] = ()) -> Range | None:
        """A bound that is its default extreme is no bound, one beyond it is; two such bounds are no rule."""
        low, high = (None if low == least else low), (None if high == most else high)
        return None if low is None and high is None else cls(low, high, on)


@dataclass(frozen=True)
class KindRanges:
    """Ranges by kind of request; one that is not set leaves the rows to the next wider rule."""

    movies: Range | None = None
    series: Range | None = None
    anime: Range | None = None


def _kind_range(branch: str, own: KindRanges | None, general: KindRanges | None) -> Range | None:
    """The range that holds: of the resolution before the general one; for anime its own before that of series."""
    kinds = {"movies": ("movies",), "series": ("series",), "anime": ("anime", "series")}[branch]
    return next((r for kind in kinds for ranges in (own, general) if ranges and (r := getattr(ranges, kind))), None)


def outside_kind_range(column: str, by_resolution: dict[str, KindRanges], general: KindRanges | None, request_type: Column, is_anime: Column, zero: bool) -> Column:
    """Whether a row is outside the range of its resolution and the kind of its request.

    Films are requests of type ``movie``, anime among all others those so marked. A missing value is never outside; with
    ``zero`` unset (sizes) neither is 0, and a bound of 0 is none.
    """
    value = F.col(column) if zero else F.nullif(column, F.lit(0))
    film, anime = F.coalesce(request_type == "movie", F.lit(False)), F.coalesce(is_anime, F.lit(False))
    branches = {"movies": film, "anime": ~film & anime, "series": ~film & ~anime}
    resolution, out = F.coalesce("resolution", F.lit("")), F.lit(False)
    for own in (None, *by_resolution):
        here = resolution == own if own else ~resolution.isin(*by_resolution)
        for branch, holds in branches.items():
            r = _kind_range(branch, by_resolution.get(own), general)
            bounds = [(value < r.low) if r and r.low is not None and (r.low or zero) else None, (value > r.high) if r and r.high is not None and (r.high or zero) else None]
            for bound in filter(lambda b: b is not None, bounds):
                out = out | (here & holds & F.coalesce(bound, F.lit(False)))
    return out


@dataclass(frozen=True)
class Dimension:
    """Included, excluded and required values of one attribute."""

    included: tuple[str, ...] = ()
    excluded: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class CacheRule:
    """Removes rows of one cache state by source, service and type; ``all_of`` asks for every list, and an unset list never holds."""

    cached: bool
    sources: tuple[str, ...] = ()
    services: tuple[str, ...] = ()
    types: tuple[str, ...] = ()
    all_of: bool = False


@dataclass(frozen=True)
class Profile:
    """Declarative filter rules; the order of evaluation is that of :func:`decide`."""

    scalars: dict[str, Dimension] = field(default_factory=dict)
    arrays: dict[str, Dimension] = field(default_factory=dict)
    languages: Dimension = Dimension()
    groups: Dimension = Dimension()
    include_patterns: tuple[str, ...] = ()
    exclude_patterns: tuple[str, ...] = ()
    require_patterns: tuple[str, ...] = ()
    exclude_cached: bool = False
    exclude_uncached: bool = False
    cache_rules: tuple[CacheRule, ...] = ()
    exclude_season_packs: bool = False
    included_ranges: dict[str, Range] = field(default_factory=dict)
    required_ranges: dict[str, Range] = field(default_factory=dict)
    excluded_ranges: dict[str, Range] = field(default_factory=dict)
    size_by_resolution: dict[str, Range] = field(default_factory=dict)
    size: Range | None = None
    bitrate: Range | None = None
    #: Ranges by resolution and kind of request; rows then have ``request_type`` and ``is_anime``.
    kind_sizes: dict[str, KindRanges] = field(default_factory=dict)
    kind_size: KindRanges | None = None
    kind_bitrates: dict[str, KindRanges] = field(default_factory=dict)
    kind_bitrate: KindRanges | None = None


def _any(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.or_, conditions) if conditions else F.lit(False)


def _matches(patterns: Sequence[str], columns: Sequence[str]) -> Column:
    return _any([F.coalesce(F.col(c).rlike(p), F.lit(False)) for p in patterns for c in columns])


def _bounds(column: str, rule: Range, below: bool, missing: float | None) -> Column:
    """Outside the bounds (``below``), or past them on either side; a missing value counts as ``missing`` or never matches."""
    value = F.col(column) if missing is None else F.coalesce(F.col(column), F.lit(missing))
    low = [value < rule.low if below else value > rule.low] if rule.low is not None else []
    high = [F.col(column) > rule.high if below else value < rule.high] if rule.high is not None else []
    return rule.applies() & F.coalesce(_any(low + high), F.lit(False))


def cache_rule(rule: CacheRule) -> Column:
    lists = [(F.col(c).isin(*v) if v else None) for c, v in (("source_id", rule.sources), ("service_id", rule.services), ("type", rule.types))]
    if rule.all_of:
        hit = functools.reduce(operator.and_, lists) if all(x is not None for x in lists) else F.lit(False)
    else:
        hit = _any([x for x in lists if x is not None])
    return (F.col("cached") == rule.cached) & F.coalesce(hit, F.lit(False))


def ladder(p: Profile, text_columns: Sequence[str] = ("filename", "release_group")) -> list[tuple[str, str, Column]]:
    """Steps ``(verdict, reason, condition)`` in order; the first that holds decides."""
    steps: list[tuple[str, str, Column]] = []
    for name, d in p.scalars.items():
        if d.included:
            steps.append(("included", name, scalar(name).isin(*d.included)))
    for name, d in p.arrays.items():
        if d.included:
            steps.append(("included", name, F.arrays_overlap(values(name), _texts(d.included))))
    if p.languages.included:
        steps.append(("included", "languages", F.arrays_overlap(values("languages"), _texts(p.languages.included))))
    if p.groups.included:
        steps.append(("included", "release_group", F.lower(scalar("release_group")).isin(*[g.lower() for g in p.groups.included])))
    if p.include_patterns:
        steps.append(("included", "pattern", _matches(p.include_patterns, text_columns)))
    # An included range holds above its lower bound OR below its upper bound.
    steps += [("included", f"{c} range", _bounds(c, r, False, 0)) for c, r in p.included_ranges.items()]
    for name, d in p.scalars.items():
        if d.excluded:
            steps.append(("removed", f"excluded {name}", scalar(name).isin(*d.excluded)))
        if d.required:
            steps.append(("removed", f"required {name}", ~scalar(name).isin(*d.required)))
    for name, d in p.arrays.items():
        if d.excluded:
            steps.append(("removed", f"excluded {name}", F.arrays_overlap(values(name), _texts(d.excluded))))
        if d.required:
            steps.append(("removed", f"required {name}", ~F.arrays_overlap(values(name), _texts(d.required))))
    if p.languages.excluded:
        steps.append(("removed", "excluded languages", F.size(F.array_except(values("languages"), _texts(p.languages.excluded))) == 0))
    if p.languages.required:
        steps.append(("removed", "required languages", ~F.arrays_overlap(values("languages"), _texts(p.languages.required))))
    group = F.lower(scalar("release_group"))
    if p.groups.excluded:
        steps.append(("removed", "excluded release_group", group.isin(*[g.lower() for g in p.groups.excluded])))
    if p.groups.required:
        steps.append(("removed", "required release_group", ~group.isin(*[g.lower() for g in p.groups.required])))
    if p.exclude_cached:
        steps.append(("removed", "cached", F.col("cached").eqNullSafe(F.lit(True))))
    if p.exclude_uncached:
        steps.append(("removed", "uncached", F.col("cached").eqNullSafe(F.lit(False))))
    steps += [("removed", "cached rule" if r.cached else "uncached rule", F.coalesce(cache_rule(r), F.lit(False))) for r in p.cache_rules]
    if p.exclude_season_packs:
        steps.append(("removed", "season pack", (F.coalesce(F.size("seasons"), F.lit(0)) > 0) & (F.coalesce(F.size("episodes"), F.lit(0)) <= 0)))
    if p.exclude_patterns:
        steps.append(("removed", "excluded pattern", _matches(p.exclude_patterns, text_columns)))
    if p.require_patterns:
        steps.append(("removed", "required pattern", ~_matches(p.require_patterns, text_columns)))
    # A required range misses a lower bound when the value is missing (0), never an upper one.
    steps += [("removed", f"required {c} range", _bounds(c, r, True, 0)) for c, r in p.required_ranges.items()]
    # An excluded range removes above its lower bound OR below its upper bound.
    steps += [("removed", f"excluded {c} range", _bounds(c, r, False, 0)) for c, r in p.excluded_ranges.items()]
    own = [(scalar("resolution") == k) & _bounds("size", r, True, None) for k, r in p.size_by_resolution.items()]
    rest = [~scalar("resolution").isin(*p.size_by_resolution) & _bounds("size", p.size, True, None)] if p.size and p.size_by_resolution else [_bounds("size", p.size, True, None)] if p.size else []
    if own or rest:
        steps.append(("removed", "size range", _any(own + rest)))
    if p.bitrate:
        steps.append(("removed", "bitrate range", _bounds("bitrate", p.bitrate, True, None)))
    for column, by_resolution, general in (("size", p.kind_sizes, p.kind_size), ("bitrate", p.kind_bitrates, p.kind_bitrate)):
        if by_resolution or general:
            outside = outside_kind_range(column, by_resolution, general, F.col("request_type"), F.col("is_anime"), column == "bitrate")
            steps.append(("removed", f"{column} range", outside))
    return steps


#: Columns that patterns look at, those of them that the rows have (fixed values).
PATTERN_COLUMNS = ("filename", "folder_name", "indexer", "release_group")


def decide(rows: DataFrame, profile: Profile, passthrough: Column | None = None) -> DataFrame:
    """Adds ``keep`` and ``reason`` (null when nothing spoke) from one CASE over the ladder; passthrough rows stay first of all."""
    steps = [("included", "passthrough", passthrough)] if passthrough is not None else []
    reason: Column = F.lit(None).cast("string")
    texts = [c for c in PATTERN_COLUMNS if c in rows.columns]
    for verdict, name, condition in reversed(steps + ladder(profile, texts)):
        reason = F.when(condition, f"{verdict}: {name}").otherwise(reason)
    return rows.withColumn("reason", reason).withColumn("keep", F.coalesce(~F.col("reason").startswith("removed"), F.lit(True)))


def reason_statistics(decided: DataFrame, *keys: str) -> DataFrame:
    """Rows per key and reason, with one line of totals for each key."""
    return decided.where("reason is not null").rollup(*keys, "reason").agg(F.count("*").alias("n")).where(" and ".join(f"{k} is not null" for k in keys) or "true")


def synthetic_tags(tags: Column) -> Column:
    """``HDR+DV`` before the first of both, ``DV Only`` and ``HDR Only`` behind all."""
    hdr, dv = F.exists(tags, lambda t: t.startswith("HDR")), F.array_contains(tags, "DV")
    first = F.array_min(F.transform(tags, lambda t, i: F.when(t.startswith("HDR") | (t == "DV"), i)))
    both = F.concat(F.slice(tags, F.lit(1), first), F.array(F.lit("HDR+DV")), F.slice(tags, first + 1, F.size(tags)))
    return F.when(hdr & dv, both).when(dv, F.concat(tags, F.array(F.lit("DV Only")))).when(hdr, F.concat(tags, F.array(F.lit("HDR Only")))).otherwise(tags)


def release_survivors(rows: DataFrame, open_: Column, sources: Sequence[str] = ()) -> DataFrame:
    """Rows whose request's gate is open, rows that pass this stage unseen, and rows of sources that the gate does not watch.

    ``sources`` are the watched ones; none means all.
    """
    watched = F.col("source_id").isin(*sources) if sources else F.lit(True)
    free = F.lit(False)
    if "passthrough" in rows.columns:
        free = F.coalesce(F.col("passthrough")["all"] | F.array_contains(F.col("passthrough")["stages"], "digitalRelease"), F.lit(False))
    return rows.where(F.coalesce(open_, F.lit(False)) | free | ~F.coalesce(watched, F.lit(False)))


def release_gate(days_since: Column, enabled: Column, tolerance: int = 0) -> Column:
    """Request-level gate on a release day: missing day or disabled allows, within tolerance or past allows, future blocks."""
    return ~enabled | days_since.isNull() | (F.abs(days_since) <= tolerance) | (days_since >= 0)


def derived_bitrate(bitrate: Column, size: Column, folder_size: Column, runtime_minutes: Column, episodes: Column, season_pack: Column, season_episodes: Column) -> Column:
    """Missing bitrate from size over runtime; long episode lists and season packs share their size among the episodes."""
    per = F.when((episodes > 5) & folder_size.isNull(), size / episodes).when(season_pack, F.when(season_episodes > 0, size / season_episodes)).otherwise(size.cast("double"))
    return F.coalesce(bitrate, F.floor(per * 8 / (runtime_minutes * 60) + 0.5).cast("double"))


def message_class(message: Column) -> Column:
    """Error class of a log message."""
    m = F.lower(message)
    return F.when(m.contains("timeout") | m.contains("timed out"), "timeout").when(m.contains("403") | m.contains("forbidden"), "forbidden").when(m.contains("429") | m.rlike(r"\brate[ _-]?limit|too many requests"), "ratelimit").otherwise("hard")
