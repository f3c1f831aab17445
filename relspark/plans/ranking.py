"""Filtering, deduplicating, sorting and limiting the results of requests."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import filters as flt
from ..operators import ranking as rk
from .bridge import QUALITIES, RELEASES, RESOLUTIONS, SERVICES, TYPES, releases
from .registry import query

_P = flt.Profile(scalars={"resolution": flt.Dimension(excluded=("480p",)), "quality": flt.Dimension(excluded=("HDTV",))}, required_ranges={"seeders": flt.Range(low=5, on=("p2p",))})


def _case(value: str, preferred: tuple[str, ...]) -> str:
    """Rank of a value in DuckDB, unlisted last."""
    return "CASE " + " ".join(f"WHEN {value} = '{p}' THEN {i}" for i, p in enumerate(preferred)) + f" ELSE {len(preferred) + 100} END"


@query(f"""WITH {RELEASES}, kept AS (SELECT * FROM releases WHERE coalesce(resolution, 'Unknown') <> '480p' AND coalesce(quality, 'Unknown') <> 'HDTV'
    AND NOT (type = 'p2p' AND coalesce(seeders, 0) < 5)),
once AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_id, source_id ORDER BY {_case("service_id", SERVICES)}, coalesce(seeders, 0) DESC, pos) AS rn FROM kept) WHERE rn = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {_case("resolution", RESOLUTIONS)}, {_case("quality", QUALITIES)}, size DESC, pos) AS place FROM once)
SELECT request_id, CAST(place AS INT) AS place, id, source_id, resolution, quality, size FROM best WHERE place <= 3""")
def top_releases(spark, sf_dir):
    """Filter ladder, one row per source, preference sort, three best per request: one shuffle on ``request_id``."""
    kept = flt.decide(releases(spark, sf_dir), _P).where("keep")
    once = rk.winner(kept, ["request_id", "source_id"], [rk.rank_in(F.col("service_id"), SERVICES), F.coalesce("seeders", F.lit(0)).desc(), F.col("pos")])
    by = rk.order([(rk.rank_in(F.col("resolution"), RESOLUTIONS), "asc"), (rk.rank_in(F.col("quality"), QUALITIES), "asc"), (F.col("size"), "desc")])
    return rk.ranked(once, ["request_id"], by, "place").where("place <= 3").select("request_id", "place", "id", "source_id", "resolution", "quality", "size")


_FULL = flt.Profile(
    scalars={"resolution": flt.Dimension(excluded=("480p", "Unknown")), "quality": flt.Dimension(included=("BluRay REMUX",)), "type": flt.Dimension(required=("debrid", "p2p"))},
    arrays={"tags": flt.Dimension(excluded=("DV",))},
    groups=flt.Dimension(excluded=("BRAND1", "brand2")),
    exclude_patterns=("steel",),
    cache_rules=(flt.CacheRule(cached=False, sources=("src1", "src2")), flt.CacheRule(cached=True, sources=("src3",), services=("svc_a",), all_of=True)),
    required_ranges={"seeders": flt.Range(low=3, on=("p2p",)), "age_hours": flt.Range(high=40000)},
    excluded_ranges={},
    size_by_resolution={"2160p": flt.Range(low=1_000_000_000)},
    size=flt.Range(high=9_000_000_000),
)
_REASON = """CASE WHEN coalesce(quality, 'Unknown') = 'BluRay REMUX' THEN 'included: quality'
 WHEN coalesce(resolution, 'Unknown') IN ('480p', 'Unknown') THEN 'removed: excluded resolution'
 WHEN type NOT IN ('debrid', 'p2p') THEN 'removed: required type'
 WHEN list_contains(tags, 'DV') THEN 'removed: excluded tags'
 WHEN lower(release_group) IN ('brand1', 'brand2') THEN 'removed: excluded release_group'
 WHEN cached = false AND source_id IN ('src1', 'src2') THEN 'removed: uncached rule'
 WHEN cached = true AND source_id = 'src3' AND service_id = 'svc_a' AND false THEN 'removed: cached rule'
 WHEN filename LIKE '%steel%' THEN 'removed: excluded pattern'
 WHEN type = 'p2p' AND coalesce(seeders, 0) < 3 THEN 'removed: required seeders range'
 WHEN age_hours > 40000 THEN 'removed: required age_hours range'
 WHEN coalesce(resolution = '2160p' AND size < 1000000000, false) OR coalesce(coalesce(resolution, 'Unknown') <> '2160p' AND size > 9000000000, false) THEN 'removed: size range' END"""


@query(f"""WITH {RELEASES}, d AS (SELECT source_id, {_REASON} AS reason FROM releases),
s AS (SELECT source_id, reason, count(*) AS n FROM d WHERE reason IS NOT NULL GROUP BY ROLLUP (source_id, reason))
SELECT source_id, coalesce(reason, 'total') AS reason, CAST(n AS BIGINT) AS n FROM s WHERE source_id IS NOT NULL""")
def filter_reasons(spark, sf_dir):
    """Decisions of a full profile, counted by source with totals."""
    decided = flt.decide(releases(spark, sf_dir), _FULL)
    return flt.reason_statistics(decided, "source_id").select("source_id", F.coalesce("reason", F.lit("total")).alias("reason"), "n")


@query(f"""WITH {RELEASES} SELECT id, {_REASON} AS reason, coalesce(NOT starts_with({_REASON}, 'removed'), true) AS keep FROM releases""")
def filter_decisions(spark, sf_dir):
    """Keep flag and reason of every row."""
    return flt.decide(releases(spark, sf_dir), _FULL).select("id", "reason", "keep")


@query(f"""WITH {RELEASES} SELECT id, CASE WHEN list_contains(tags, 'HDR') AND list_contains(tags, 'DV') THEN 'HDR+DV,HDR,DV' WHEN list_contains(tags, 'DV') THEN 'DV,DV Only'
    WHEN list_contains(tags, 'HDR') THEN 'HDR,HDR Only' ELSE '' END AS all_tags FROM releases""")
def synthetic_tags(spark, sf_dir):
    """Tags with the derived ones."""
    return releases(spark, sf_dir).select("id", F.array_join(flt.synthetic_tags(F.col("tags")), ",").alias("all_tags"))


@query(f"""WITH {RELEASES} SELECT id, CAST(CASE WHEN seeders > 20 OR seeders < 3 THEN 1 ELSE 0 END AS INT) AS included,
    CAST(CASE WHEN coalesce(age_hours, 0) > 50000 OR coalesce(age_hours, 0) < 100 THEN 1 ELSE 0 END AS INT) AS excluded FROM releases WHERE type = 'p2p'""")
def range_rules(spark, sf_dir):
    """Included and excluded ranges hold above the lower OR below the upper bound, as they are defined."""
    rows = releases(spark, sf_dir).where("type = 'p2p'")
    inc = flt.decide(rows, flt.Profile(included_ranges={"seeders": flt.Range(20, 3)})).select("id", F.when(F.col("reason").isNotNull(), 1).otherwise(0).alias("included"), "age_hours")
    return flt.decide(inc.withColumn("type", F.lit("p2p")), flt.Profile(excluded_ranges={"age_hours": flt.Range(50000, 100)})).select("id", "included", F.when(F.col("keep"), 0).otherwise(1).alias("excluded"))


#: The class of a row, and rows that have one.
_CLASSED = f"""{RELEASES}, classed AS (
    SELECT *, CASE WHEN type IN ('debrid', 'usenet', 'stremio-usenet') AND service_id IS NOT NULL
        THEN CASE WHEN coalesce(cached, false) THEN 'cached' ELSE 'uncached' END ELSE type END AS class FROM releases)"""
SOURCES = ("src3", "src0", "src5", "src1")
_SEED = "CASE WHEN class IN ('p2p', 'uncached') THEN coalesce(seeders, 0) ELSE 0 END DESC"
_BY = {
    "single_result": f"{_case('service_id', SERVICES)}, {_SEED}, {_case('source_id', SOURCES)}, {_case('type', TYPES)}, pos",
    "per_service": f"{_case('source_id', SOURCES)}, {_case('type', TYPES)}, {_SEED}, pos",
    "per_addon": f"{_case('service_id', SERVICES)}, {_SEED}, pos",
}


def _winner_sql(keys: str, mode: str, where: str = "true") -> str:
    return f"""WITH {_CLASSED}, ranked AS (
    SELECT id, row_number() OVER (PARTITION BY {keys} ORDER BY {_BY[mode]}) AS place FROM classed WHERE {where})
SELECT id FROM ranked WHERE place = 1"""


@query(_winner_sql("request_id, title, class", "single_result"))
def dedup_single(spark, sf_dir):
    """One row of each group and class; seeders count for p2p and uncached rows only, in a total order."""
    return rk.dedup_winners(releases(spark, sf_dir), ["request_id", "title"], "single_result", SERVICES, SOURCES, TYPES).select("id")


@query(_winner_sql("request_id, title, class, service_id", "per_service", "service_id IS NOT NULL"))
def dedup_per_service(spark, sf_dir):
    """One row of each group, class and service, among rows that have a service."""
    rows = releases(spark, sf_dir).where("service_id is not null")
    return rk.dedup_winners(rows, ["request_id", "title"], "per_service", SERVICES, SOURCES, TYPES).select("id")


@query(_winner_sql("request_id, title, class, source_id", "per_addon"))
def dedup_per_source(spark, sf_dir):
    """One row of each group, class and source."""
    return rk.dedup_winners(releases(spark, sf_dir), ["request_id", "title"], "per_addon", SERVICES, SOURCES, TYPES).select("id")


_GROUP = f"""WITH {_CLASSED}, g AS (
    SELECT *, bool_or(class = 'cached') OVER w AS c, bool_or(class = 'p2p') OVER w AS p, bool_or(class = 'cached') OVER (w PARTITION BY request_id, title, service_id) AS s
    FROM classed WINDOW w AS (PARTITION BY request_id, title))
SELECT id FROM g WHERE """.replace("(w PARTITION BY request_id, title, service_id)", "(PARTITION BY request_id, title, service_id)")


@query(_GROUP + "NOT (c AND class IN ('uncached', 'p2p')) AND NOT (p AND class = 'uncached')")
def dedup_aggressive(spark, sf_dir):
    """Cached rows drive out uncached and p2p ones; without them p2p rows drive out uncached ones."""
    return rk.dedup_mode(releases(spark, sf_dir), ["request_id", "title"], "aggressive").select("id")


@query(_GROUP + "NOT (class = 'uncached' AND s) AND NOT (class = 'p2p' AND c)")
def dedup_conservative(spark, sf_dir):
    """Uncached rows go only where their own service has a cached one, p2p rows where anything is cached."""
    return rk.dedup_mode(releases(spark, sf_dir), ["request_id", "title"], "conservative").select("id")


_KEYS = """k AS (
    SELECT request_id, pos, 's' || source_id AS key FROM releases
    UNION ALL SELECT request_id, pos, 'z' || CAST(size // 1000000000 AS VARCHAR) || resolution FROM releases WHERE resolution IS NOT NULL)"""
_REACH = f"""{_KEYS}, reach(request_id, pos, to_pos) AS (
    SELECT request_id, pos, pos FROM releases
    UNION SELECT r.request_id, r.pos, b.pos FROM reach r
        JOIN k a ON a.request_id = r.request_id AND a.pos = r.to_pos JOIN k b ON b.request_id = a.request_id AND b.key = a.key)"""
_DRIVER_MODES = {"cached": "single_result", "uncached": "per_service", "p2p": "per_addon", "http": "disabled"}
_DRIVER = f"""WITH RECURSIVE {_CLASSED}, {_REACH},
groups AS (SELECT request_id, pos, min(to_pos) AS dup_group FROM reach GROUP BY request_id, pos),
grouped AS (
    SELECT c.* EXCLUDE (class), g.dup_group, source_id = 'src7' AS kept_out, quality = 'HDTV' AS free, CASE WHEN NOT coalesce(quality = 'HDTV', false) THEN class END AS class
    FROM classed c JOIN groups g USING (request_id, pos)),
present AS (
    SELECT *, coalesce(bool_or(class = 'cached') OVER w, false) AS c, coalesce(bool_or(class = 'p2p') OVER w, false) AS p
    FROM grouped WINDOW w AS (PARTITION BY request_id, dup_group)),
stays AS (SELECT * FROM present WHERE class IS NULL OR (NOT (c AND class IN ('uncached', 'p2p')) AND NOT (p AND class = 'uncached'))),
ranked AS (
    SELECT id, class, kept_out,
        row_number() OVER (PARTITION BY request_id, dup_group, class ORDER BY {_BY["single_result"]}) AS one,
        row_number() OVER (PARTITION BY request_id, dup_group, class, service_id ORDER BY {_BY["per_service"]}) AS each_service,
        row_number() OVER (PARTITION BY request_id, dup_group, class, source_id ORDER BY {_BY["per_addon"]}) AS each_source
    FROM stays)
SELECT id FROM ranked WHERE class IS NULL OR class = 'http' OR (class = 'cached' AND one = 1) OR (class = 'uncached' AND each_service = 1) OR (class = 'p2p' AND each_source = 1)
UNION SELECT id FROM grouped WHERE kept_out"""


def _shared_keys() -> F.Column:
    step = F.floor(F.col("size") / 1_000_000_000).cast("string")
    return F.array_compact(F.array(F.concat(F.lit("s"), "source_id"), F.concat(F.lit("z"), step, "resolution")))


@query(_DRIVER)
def dedup_driver(spark, sf_dir):
    """Groups from shared keys, classes that drive out others, a mode for each class, excluded sources, passthrough rows."""
    rows = releases(spark, sf_dir).withColumn("pos", F.col("pos").cast("long")).withColumn("keys", _shared_keys())
    kept = rk.deduplicate(rows, "request_id", "keys", "aggressive", _DRIVER_MODES, SERVICES, SOURCES, TYPES, F.col("source_id") == "src7", F.col("quality") == "HDTV")
    return kept.select("id")


@query(f"""WITH RECURSIVE {RELEASES}, {_REACH}
SELECT request_id, CAST(pos AS BIGINT) AS pos, CAST(min(to_pos) AS BIGINT) AS dup_group FROM reach GROUP BY request_id, pos""")
def dedup_components(spark, sf_dir):
    """Rows of a request that share any key, joined transitively."""
    rows = releases(spark, sf_dir).select("request_id", F.col("pos").cast("long").alias("pos"), _shared_keys().alias("keys"))
    return rk.duplicate_groups(rows, "request_id", "pos", "keys").select("request_id", "pos", "dup_group")


@query(f"""WITH {RELEASES} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY request_id, resolution ORDER BY size DESC, pos) AS rn FROM releases) WHERE rn <= 2""")
def limit_single_dim(spark, sf_dir):
    """Two rows of each resolution in a request."""
    return rk.top_per(releases(spark, sf_dir), ["request_id", "resolution"], [F.col("size").desc(), F.col("pos")], 2).select("id")


_WALK = f"""WITH RECURSIVE {RELEASES},
placed AS (
    SELECT request_id, id, source_id, resolution, type, row_number() OVER (PARTITION BY request_id ORDER BY size DESC, pos) AS place FROM releases),
walk AS (
    SELECT request_id, CAST(0 AS BIGINT) AS place, CAST('' AS VARCHAR) AS id, false AS good, CAST(0 AS BIGINT) AS passed, MAP {{'': CAST(0 AS BIGINT)}} AS seen
    FROM placed GROUP BY request_id
    UNION ALL
    SELECT request_id, place, id, reached = 4, passed + CASE WHEN reached = 4 THEN 1 ELSE 0 END,
        map_concat(seen, CASE WHEN reached >= 1 THEN MAP {{ka: na}} ELSE MAP {{'': CAST(0 AS BIGINT)}} END,
            CASE WHEN reached >= 2 AND kb IS NOT NULL THEN MAP {{coalesce(kb, ''): nb}} ELSE MAP {{'': CAST(0 AS BIGINT)}} END,
            CASE WHEN reached >= 3 THEN MAP {{kc: nc}} ELSE MAP {{'': CAST(0 AS BIGINT)}} END)
    FROM (SELECT *, CASE WHEN passed >= 8 THEN 0 WHEN na > 2 THEN 1 WHEN kb IS NOT NULL AND nb > 3 THEN 2 WHEN nc > 6 THEN 3 ELSE 4 END AS reached
        FROM (SELECT *, coalesce(seen[ka], 0) + 1 AS na, coalesce(seen[kb], 0) + 1 AS nb, coalesce(seen[kc], 0) + 1 AS nc
            FROM (SELECT p.request_id, p.place, p.id, w.passed, w.seen, 'a' || p.source_id AS ka, 'b' || p.resolution AS kb, 'c' || p.type AS kc
                FROM walk w JOIN placed p ON p.request_id = w.request_id AND p.place = w.place + 1))))
SELECT request_id, CAST(place AS INT) AS place, id FROM walk WHERE good"""


@query(_WALK)
def limit_greedy(spark, sf_dir):
    """Several limits at once, walked in order: counters raised before the one that rejects stay raised."""
    rows = rk.ranked(releases(spark, sf_dir).select("request_id", "pos", "id", "source_id", "resolution", "type", "size"), ["request_id"], [F.col("size").desc(), F.col("pos")], "place")
    return rk.greedy_limit(rows, {"source_id": 2, "resolution": 3, "type": 6}, total=8).select("request_id", "place", "id")


@query(f"""WITH {RELEASES} SELECT id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY CASE WHEN cached THEN 0 ELSE 1 END, CASE WHEN cached THEN {_case("resolution", RESOLUTIONS)} END NULLS LAST,
    CASE WHEN cached THEN -size END NULLS LAST, CASE WHEN NOT coalesce(cached, false) THEN -coalesce(seeders, 0) END NULLS LAST, pos) AS INT) AS place FROM releases""")
def split_sort(spark, sf_dir):
    """Cached rows by resolution and size, then all others by seeders."""
    by = rk.split_order(F.col("cached"), [(rk.rank_in(F.col("resolution"), RESOLUTIONS), "asc"), (F.col("size"), "desc")], [(F.coalesce("seeders", F.lit(0)), "desc")])
    return rk.ranked(releases(spark, sf_dir), ["request_id"], by, "place").select("id", "place")


@query(f"""WITH {RELEASES} SELECT id, CAST(CASE WHEN list_contains(tags, 'DV') THEN 0 WHEN list_contains(tags, 'HDR') THEN 1 ELSE -1 END AS INT) AS tag_rank,
    CAST(CASE WHEN quality = 'BluRay' THEN 0 WHEN quality = 'WEB-DL' THEN 1 ELSE -1 END AS INT) AS quality_rank FROM releases""")
def pref_rank_array(spark, sf_dir):
    """Preference ranks of an array and of a scalar; -1 stands for unlisted in the output."""
    shown = lambda r: F.when(r < rk.INFINITY, r).otherwise(-1).cast("int")
    return releases(spark, sf_dir).select("id", shown(rk.rank_of_any(F.col("tags"), ("DV", "HDR"))).alias("tag_rank"), shown(rk.rank_in(F.col("quality"), ("BluRay", "WEB-DL"))).alias("quality_rank"))


@query(f"""WITH {RELEASES} SELECT id, CAST(CASE WHEN filename LIKE '%widget%' THEN 0 WHEN filename LIKE '%bolt%' THEN 1 END AS INT) AS first_rule,
    CASE WHEN filename LIKE '%widget%' OR filename LIKE '%2160p%' THEN (CASE WHEN filename LIKE '%widget%' THEN 10.0 ELSE 0.0 END + CASE WHEN filename LIKE '%2160p%' THEN 5.5 ELSE 0.0 END + CASE WHEN filename LIKE '%blue%' THEN -3.0 ELSE 0.0 END)::DOUBLE END AS score,
    concat_ws(',', CASE WHEN filename LIKE '%widget%' THEN 'w' END, CASE WHEN filename LIKE '%2160p%' THEN 'uhd' END) AS names FROM releases""")
def rule_scores(spark, sf_dir):
    """First matching rule, summed scores (null unless a named rule matched) and matched names."""
    name = F.col("filename")
    score, names = rk.rule_score([("w", name.contains("widget"), 10), ("uhd", name.contains("2160p"), 5.5), (None, name.contains("blue"), -3)], null_without_name=True)
    return releases(spark, sf_dir).select("id", rk.first_rule([name.contains("widget"), name.contains("bolt")]).alias("first_rule"), score.alias("score"), F.array_join(names, ",").alias("names"))


@query(f"""WITH {RELEASES}, p AS (SELECT id, row_number() OVER (PARTITION BY request_id ORDER BY size DESC, pos) AS n, count(*) OVER (PARTITION BY request_id) AS c FROM releases) SELECT id FROM p WHERE n - 1 >= greatest(c - 4, 0) AND n - 1 < greatest(c - 1, 0)""")
def slice_negative(spark, sf_dir):
    """The fourth-last to the second-last row of each request."""
    return rk.between(releases(spark, sf_dir), "request_id", [F.col("size").desc(), F.col("pos")], -4, -1).select("id")


@query(f"""WITH {RELEASES} SELECT id, CAST(c AS INT) AS "copy", CASE WHEN c = 1 THEN 'external' ELSE type END AS type FROM releases, (VALUES (0), (1)) t(c) WHERE c = 0 OR type IN ('debrid', 'http')""")
def external_copies(spark, sf_dir):
    """A download row behind every playable row."""
    return rk.clones(releases(spark, sf_dir), F.col("type").isin("debrid", "http"), type=F.lit("external")).select("id", "copy", "type")


@query(f"""WITH {RELEASES}, o AS (SELECT * FROM releases WHERE season <= 3), n AS (SELECT * FROM releases WHERE season >= 3 AND season <= 4),
u AS (SELECT request_id, source_id, id, size, 0 AS side, pos FROM o UNION ALL SELECT request_id, source_id, id, size, 1, pos FROM n),
k AS (SELECT *, row_number() OVER (PARTITION BY request_id, source_id ORDER BY side DESC, pos DESC) AS rn FROM u) SELECT request_id, source_id, id, size FROM k WHERE rn = 1""")
def merge_last_wins(spark, sf_dir):
    """Union of two result lists by source: the last row wins."""
    rows = releases(spark, sf_dir).select("request_id", "source_id", "id", "size", "pos", "season", F.concat_ws("/", F.col("request_id").cast("string"), "source_id").alias("key"))
    return rk.last_wins(rows.where("season <= 3"), rows.where("season between 3 and 4"), "key", "pos").select("request_id", "source_id", "id", "size")


@query(f"""WITH {RELEASES}, m AS (SELECT request_id, max(score) AS top FROM (SELECT request_id, size / 1e9 AS score FROM releases) GROUP BY 1)
SELECT id, CAST(least(greatest(floor(size / 1e9 / top * 100 + 0.5), 0), 100) AS INT) AS relative_score FROM releases JOIN m USING (request_id)""")
def relative_scores(spark, sf_dir):
    """Score against the best one of the request, 0 to 100."""
    score = F.col("size") / 1e9
    top = F.max(score).over(Window.partitionBy("request_id"))
    return releases(spark, sf_dir).select("id", F.least(F.greatest(F.floor(score / top * 100 + 0.5), F.lit(0)), F.lit(100)).cast("int").alias("relative_score"))


@query(f"""WITH {RELEASES} SELECT id, round(CAST(floor(size * 8.0 / (100 * 60) + 0.5) AS DOUBLE), 3) AS bitrate FROM releases WHERE seeders IS NOT NULL""")
def bitrate_from_size(spark, sf_dir):
    """Missing bitrates derived from size and runtime."""
    none = F.lit(None).cast("double")
    rate = flt.derived_bitrate(none, F.col("size"), none, F.lit(100), F.lit(1), F.lit(False), F.lit(0))
    return releases(spark, sf_dir).where("seeders is not null").select("id", F.round(rate, 3).alias("bitrate"))
