"""Expression language, templates and scalar functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import formatting as fm
from ..functions import parsing as ps
from . import sel
from .bridge import RELEASES, releases
from .registry import query, table
from .template import Template


@query(f"""WITH {RELEASES}, c AS (SELECT *, count(*) FILTER (cached) OVER (PARTITION BY request_id) AS n FROM releases) SELECT id FROM c WHERE CASE WHEN n < 5 THEN cached = false ELSE resolution = '2160p' AND cached END""")
def sel_count_cond(spark, sf_dir):
    """A conditional on a count becomes one window."""
    return sel.select_rows(releases(spark, sf_dir), "count(cached(streams)) < 5 ? uncached(streams) : resolution(cached(streams), '2160p')").select("id")


@query(f"""WITH {RELEASES}, s AS (SELECT request_id, quantile_cont(size, 0.9) AS p90, median(seeders) FILTER (type = 'p2p') AS med, stddev_pop(size) AS sd, max(size) - min(size) AS rg, quantile_cont(size, 0.75) - quantile_cont(size, 0.25) AS iqr FROM releases GROUP BY 1)
SELECT request_id, round(p90, 3)::DOUBLE AS p90, coalesce(med, 0)::DOUBLE AS med, round(sd / 1e6, 3)::DOUBLE AS sd, rg::DOUBLE AS rg, round(iqr, 3)::DOUBLE AS iqr FROM s""")
def sel_percentile(spark, sf_dir):
    """Statistics over values of row-sets."""
    rows = releases(spark, sf_dir)
    value = lambda t: sel.compile_value(t, rows)
    got = rows.select("request_id", F.round(value("percentile(values(streams, 'size'), 90)"), 3).alias("p90"), value("median(values(type(streams, 'p2p'), 'seeders'))").alias("med"), F.round(value("stddev(values(streams, 'size')) / 1000000"), 3).alias("sd"), value("range(values(streams, 'size'))").alias("rg"), F.round(value("iqr(values(streams, 'size'))"), 3).alias("iqr"))
    return got.distinct()


@query(f"""WITH {RELEASES}, m AS (SELECT request_id, count(seeders) AS n, avg(seeders) AS m FROM releases GROUP BY 1), c AS (SELECT request_id, any_value(n) AS n, avg(power(seeders - m, 2)) AS m2, avg(power(seeders - m, 3)) AS m3, avg(power(seeders - m, 4)) AS m4 FROM releases JOIN m USING (request_id) GROUP BY 1)
SELECT request_id, round(CASE WHEN n >= 3 AND m2 > 0 THEN m3 / power(m2, 1.5) ELSE 0 END, 5)::DOUBLE AS skew, round(CASE WHEN n >= 4 AND m2 > 0 THEN m4 / (m2 * m2) - 3 ELSE 0 END, 5)::DOUBLE AS kurt FROM c""")
def sel_moments(spark, sf_dir):
    """Population skewness and excess kurtosis."""
    rows = releases(spark, sf_dir)
    return rows.select("request_id", F.round(sel.compile_value("skewness(values(streams, 'seeders'))", rows), 5).alias("skew"), F.round(sel.compile_value("kurtosis(values(streams, 'seeders'))", rows), 5).alias("kurt")).distinct()


@query(f"""WITH {RELEASES} SELECT id FROM releases WHERE (NOT coalesce(resolution, 'Unknown') IN ('480p', 'Unknown') AND coalesce(size, 0) >= 2 * power(1024, 3)) OR (coalesce(seeders, 0) >= 40)""")
def sel_negate_merge(spark, sf_dir):
    """Differences and unions of row-sets are masks."""
    return sel.select_rows(releases(spark, sf_dir), "merge(negate(resolution(streams, '480p', 'unknown'), size(streams, '2GB')), seeders(streams, 40))").select("id")


@query(f"""WITH {RELEASES}, p AS (SELECT id, row_number() OVER (PARTITION BY request_id ORDER BY pos) AS n FROM releases WHERE service_id = 'svc_a') SELECT id FROM p WHERE n BETWEEN 3 AND 5""")
def sel_slice(spark, sf_dir):
    """A slice of a row-set ranks the mask."""
    return sel.select_rows(releases(spark, sf_dir), "slice(service(streams, 'svc_a'), 2, 5)").select("id")


@query(f"""WITH {RELEASES}, a AS (SELECT * FROM releases WHERE NOT coalesce(type = 'http', false)), b AS (SELECT *, count(*) OVER (PARTITION BY request_id) AS n FROM a), c AS (SELECT * FROM b WHERE NOT (n > 20 AND coalesce(seeders, 0) <= 10)) SELECT id FROM c""")
def sel_sequential(spark, sf_dir):
    """Excluding rules in turn: each sees what the others left."""
    return sel.exclude_in_turn(releases(spark, sf_dir), ["type(streams, 'http')", "count(streams) > 20 ? negate(seeders(streams, 11), streams) : []"]).select("id")


_LINE = "CASE WHEN cached THEN '⚡' ELSE '⏳' END || ' ' || coalesce(upper(resolution), '') || ' ' || coalesce(quality, 'n/a') || chr(10) || CASE WHEN len(tags) > 0 THEN array_to_string(tags, ' | ') || chr(10) ELSE '' END || 'S' || lpad(CAST(season AS VARCHAR), 2, '0') || CASE WHEN seeders >= 30 THEN ' many' ELSE '' END"


@query(f"WITH {RELEASES} SELECT id, {_LINE} AS line FROM releases")
def template_render(spark, sf_dir):
    """A template with conditionals, lists and nested parts as one string column."""
    rows = releases(spark, sf_dir)
    t = Template({"service.cached": (F.col("cached"), "flag"), "stream.resolution": (F.col("resolution"), "text"), "stream.quality": (F.col("quality"), "text"), "stream.tags": (F.col("tags"), "list"), "stream.seeders": (F.col("seeders"), "number"), "stream.season": (F.lpad(F.col("season").cast("string"), 2, "0"), "text")})
    text = "{service.cached::istrue[\"⚡\"||\"⏳\"]} {stream.resolution::upper} {stream.quality::exists[\"{stream.quality}\"||\"n/a\"]}\n{stream.tags::exists[\"{stream.tags::join(' | ')}\"||\"{tools.removeLine}\"]}\nS{stream.season}{stream.seeders::>=30[\" many\"||\"\"]}"
    return rows.select("id", t.compile(text).alias("line"))


_TOK = r"(?:^|[\s\[(_\-.,])"


@query(rf"""WITH {RELEASES} SELECT id, CASE WHEN regexp_matches(filename, '(?i)(^|[\s\[(_.,-])(2160p|4k|uhd)([\s)\]_.,-]|$)') THEN '2160p' WHEN regexp_matches(filename, '(?i)(^|[\s\[(_.,-])1080p([\s)\]_.,-]|$)') THEN '1080p'
    WHEN regexp_matches(filename, '(?i)(^|[\s\[(_.,-])720p([\s)\]_.,-]|$)') THEN '720p' WHEN regexp_matches(filename, '(?i)(^|[\s\[(_.,-])480p([\s)\]_.,-]|$)') THEN '480p' END AS resolution, nullif(regexp_extract(filename, '-\s?([A-Za-z0-9]+)$', 1), '') AS grp,
    CAST(nullif(regexp_extract(filename, '\.((19|20)[0-9][0-9])\.', 1), '') AS INT) AS yr FROM releases""")
def token_enums(spark, sf_dir):
    """Names read back: first-match token, group and year."""
    name = F.col("filename")
    return releases(spark, sf_dir).select("id", ps.first_token(name, ps.RESOLUTION_TOKENS).alias("resolution"), ps.release_group(name).alias("grp"), ps.release_year(name, 2030).alias("yr"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(floor(l_quantity * CASE l_linenumber % 4 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 WHEN 2 THEN 1073741824 ELSE 1099511627776 END) AS BIGINT) AS size,
    CAST((l_linenumber * 3600 + floor(l_quantity) * 60 + 5) * 1000 AS BIGINT) AS ms, (l_quantity * CASE l_linenumber % 4 WHEN 0 THEN 1 WHEN 1 THEN 24 WHEN 2 THEN 1 / 60 ELSE 8760 END)::DOUBLE AS age, (l_quantity * CASE l_linenumber % 2 WHEN 0 THEN 1e6 ELSE 1e3 END)::DOUBLE AS rate FROM lineitem""")
def units_parse(spark, sf_dir):
    """Sizes, durations, ages and bitrates written as text and read back."""
    q, n = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber")
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), n % len(xs) + 1)
    size, age, rate = F.concat(q, F.lit(" "), pick("KB", "MB", "GiB", "TB")), F.concat(q, pick("h", "d", "m", "y")), F.concat(q, F.lit(" "), pick("Mbps", "kbps"))
    length = F.concat(n.cast("string"), F.lit("h "), q, F.lit("m 5s"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", ps.size_bytes(size).alias("size"), ps.duration_ms(length).alias("ms"), ps.age_hours(age).alias("age"), ps.bitrate_bps(rate).alias("rate"))


@query("""WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice * 1000) AS BIGINT) AS n FROM orders), u AS (SELECT *, CASE WHEN n >= 1e9 THEN 3 WHEN n >= 1e6 THEN 2 WHEN n >= 1e3 THEN 1 ELSE 0 END AS e FROM s)
SELECT o_orderkey, regexp_replace(regexp_replace(printf('%.2f', floor(n / power(1000, e) * 100 + 0.5) / 100), '0+$', ''), '\\.$', '') || ' ' || ['B', 'KB', 'MB', 'GB'][e + 1] AS size,
    CASE WHEN n // 3600000 > 0 THEN printf('%dh:%dm:%ds', n // 3600000, n // 60000 % 60, n // 1000 % 60) WHEN n // 1000 % 60 > 0 THEN printf('%dm:%ds', n // 60000, n // 1000 % 60) ELSE printf('%dm', n // 60000) END AS length FROM u""")
def format_numbers(spark, sf_dir):
    """Bytes and durations for people."""
    n = F.floor(F.col("o_totalprice") * 1000).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", fm.format_bytes(n).alias("size"), fm.format_duration(n).alias("length"))


_IDS = {
    0: ("'tt' || n || ':2:7'", "imdb", "'tt' || n", 2, 7), 1: ("'kitsu:' || n || ':12'", "kitsu", "n", None, 12), 2: ("'tmdb-' || n", "tmdb", "n", None, None), 3: ("'imdb' || n", "imdb", "'tt' || n", None, None),
    4: ("'anidb_id:' || n || ':3'", "anidb", "n", None, 3), 5: ("'ap' || n", "animeplanet", "n", None, None), 6: ("'acd:' || n", "animecountdown", "n", None, None), 7: ("'nm-a' || n", "notifymoe", "'a' || n", None, None),
    8: ("'simkl' || n", "simkl", "n", None, None), 9: ("'anisearch:' || n", "anisearch", "n", None, None), 10: ("'tvdb:' || n || ':1:2'", "tvdb", "n", 1, 2), 11: ("'tvdb:' || n || ':1'", None, "NULL", None, None),
    12: ("'mal' || n || ':9'", "mal", "n", None, 9), 13: ("'anilist-' || n", "anilist", "n", None, None), 14: ("'http://' || n", None, "NULL", None, None),
}
_ID_CASE = lambda k: "CASE page_id % 15 " + " ".join(f"WHEN {i} THEN {('NULL' if v[k] is None else repr(v[k])) if k in (1, 3, 4) else v[k]}" for i, v in _IDS.items()) + " END"


@query(f"""WITH p AS (SELECT page_id, CAST(page_id AS VARCHAR) AS n FROM pages)
SELECT page_id, {_ID_CASE(1)} AS kind, {_ID_CASE(2)} AS value, CAST({_ID_CASE(3)} AS INT) AS season, CAST({_ID_CASE(4)} AS INT) AS episode FROM p""")
def id_parse(spark, sf_dir):
    """Identifiers of all namespaces, with every separator."""
    rows = table(spark, sf_dir, "pages").selectExpr("page_id", "cast(page_id as string) AS n").selectExpr("page_id", f"{_ID_CASE(0)} AS t")
    return rows.select("page_id", ps.parse_id(F.col("t")).alias("i")).select("page_id", F.col("i.type").alias("kind"), "i.value", "i.season", "i.episode")


@query("""SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page, nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages""")
def extras_parse(spark, sf_dir):
    """Query strings as maps."""
    q = ps.query_map(F.regexp_extract("url", r"\?([^#]*)", 1))
    return table(spark, sf_dir, "pages").select("page_id", q["page"].alias("page"), q["ref"].alias("ref"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events""")
def props_json(spark, sf_dir):
    """A field of JSON text with a declared schema."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("""WITH s AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS seasons, min(l_linenumber) AS season, min(l_partkey % 30) AS a, max(l_partkey % 30) AS b, count(DISTINCT l_partkey % 30) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, CAST(CASE WHEN seasons = 1 THEN season END AS INT) AS season, CAST(CASE WHEN seasons = 1 THEN a END AS INT) AS "first", CAST(CASE WHEN seasons = 1 THEN b END AS INT) AS "last",
    CAST(CASE WHEN seasons = 1 THEN n ELSE 0 END AS INT) AS n, CASE WHEN seasons > 1 THEN 'season_pack' WHEN n = 1 THEN 'episode' WHEN n <= 10 THEN 'multi_episode' ELSE 'season_pack' END AS class FROM s""")
def episodes_json(spark, sf_dir):
    """Nested maps of seasons and episodes written as JSON and read back: several seasons name no episode."""
    per = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.collect_set((F.col("l_partkey") % 30).cast("string")).alias("eps"))
    season = F.struct(F.col("l_linenumber").cast("string").alias("s"), F.map_from_arrays("eps", F.transform("eps", lambda e: F.lit(""))).alias("e"))
    doc = per.groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.collect_list(season))).alias("json"))
    e = ps.episodes(F.col("json"))
    return doc.select("l_orderkey", e.alias("e")).select("l_orderkey", "e.season", "e.first", "e.last", "e.n", ps.content_class(F.col("e.n")).alias("class"))


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM conversations""")
def log_carry_forward(spark, sf_dir):
    """The last value seen goes forward to later lines."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.length("text")), ignorenulls=True).over(w).cast("long").alias("carried"))


@query(f"""WITH {RELEASES} SELECT id, season >= 4 AS late, 'S' || lpad(CAST(season AS VARCHAR), 2, '0') AS label, CASE WHEN season = 3 THEN '' WHEN season = 4 THEN 's104' ELSE 's' || lpad(CAST(season AS VARCHAR), 2, '0') END AS bucket FROM releases""")
def season_labels(spark, sf_dir):
    """Season labels and buckets, of unknown seasons and of three digits too."""
    season = F.col("season")
    bucket = ps.season_bucket(F.when(season == 4, season + 100).when(season != 3, season))
    return releases(spark, sf_dir).select("id", (season >= 4).alias("late"), fm.season_label(F.array("season")).alias("label"), bucket.alias("bucket"))


@query(f"""WITH {RELEASES}, m AS (SELECT id, pos, type = 'debrid' AND coalesce(cached, false) AS hit, type = 'p2p' AS p2p, count(*) OVER (PARTITION BY request_id) > 60 AS many, season FROM releases)
SELECT id, CASE WHEN p2p THEN false WHEN hit THEN true END AS all_stages, CASE WHEN p2p AND many THEN 'limit,dedup' WHEN p2p THEN 'limit,title' WHEN hit THEN '' END AS stages, coalesce(hit OR (p2p AND many), false) OR season = 1 AS passes_dedup FROM m""")
def sel_passthrough(spark, sf_dir):
    """Rows that expressions let through all or some stages; a conditional marks rows in the branch that it takes only."""
    rows = releases(spark, sf_dir)
    rows = sel.mark_passthrough(rows, "passthrough(cached(type(streams, 'debrid')))")
    rows = sel.mark_passthrough(rows, "merge(passthrough(type(streams, 'p2p'), 'limit'), count(streams) > 60 ? passthrough(type(streams, 'p2p'), 'dedup', 'limit') : passthrough(type(streams, 'p2p'), 'title'))")
    p = F.col("passthrough")
    return rows.select("id", p["all"].alias("all_stages"), F.array_join(p["stages"], ",").alias("stages"), sel.passes("dedup", p, F.col("season") == 1).alias("passes_dedup"))
