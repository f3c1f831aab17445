"""Reading rows of free text, merging files with folders, sort keys and short numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formatting as fm
from ..functions import parsing as ps
from ..functions import rows as rw
from ..operators import ranking as rk
from .bridge import QUALITIES, RELEASES, RESOLUTIONS, SERVICES, releases
from .registry import query, table

_GB = "cast(1 + size % 90 as {text})"
#: Free text as sources write it, made from the attributes that are read back.
_TEXT = "concat('Best pick\n', filename, '\n👤 ', cast(coalesce(seeders, 7) as {text}), ' 💾 ', " + _GB + ", ' GB 🌐 ', source_id, ' Index 🎬\n🇫🇷🇯🇵', CASE WHEN cached THEN ' 🇫🇷🇦🇶' ELSE '' END)"


@query(f"""WITH {RELEASES} SELECT id, filename AS name, coalesce(seeders, 7) AS found_seeders, (1 + size % 90) * 1073741824 AS bytes, source_id || ' Index' AS indexer,
    'French,Japanese,German' AS languages FROM releases""")
def row_parse(spark, sf_dir):
    """Name, seeders, size, indexer and languages of free text; a language counts once for each text that flags it."""
    rows = releases(spark, sf_dir).withColumn("text", F.expr(_TEXT.format(text="string")))
    text = F.col("text")
    languages = F.array_distinct(rw.flag_languages(text, F.lit("[x] 🇩🇪")))
    return rows.select("id", rw.file_name(F.lit(None).cast("string"), text).alias("name"), rw.marked_seeders(text).alias("found_seeders"), ps.size_bytes(text).alias("bytes"), rw.marked_indexer(text).alias("indexer"), F.array_join(languages, ",").alias("languages"))


_WORDS = ("TRUEFRENCH", "eng.subs", "Multi.German", "ita-kor", "none", "Latino", "ben.the.men")


@query(f"""WITH {RELEASES}, w AS (SELECT id, pos % 7 AS k FROM releases)
SELECT id, CASE k WHEN 0 THEN 'French' WHEN 1 THEN '' WHEN 2 THEN 'Multi,German' WHEN 3 THEN 'Italian,Korean' WHEN 4 THEN '' WHEN 5 THEN 'Latino' ELSE '' END AS languages FROM w""")
def name_languages(spark, sf_dir):
    """Languages that a name says; a word for subtitles says none."""
    word = F.element_at(F.array(*[F.lit(w) for w in _WORDS]), (F.col("pos") % 7 + 1).cast("int"))
    name = F.concat(F.lit("Cold.Gear.2019."), word, F.lit(".1080p"))
    return releases(spark, sf_dir).select("id", F.array_join(rw.name_languages(name), ",").alias("languages"))


_LISTS = "list_filter([CASE WHEN season % 3 = 0 THEN 'HDR' END, CASE WHEN season % 2 = 0 THEN 'DV' END, 'IMAX'], lambda x: x IS NOT NULL)"


@query(f"""WITH {RELEASES}, p AS (
    SELECT id, size, size * (season % 4) AS folder, CASE WHEN season <= 2 THEN [] WHEN season = 3 THEN [season, 9] ELSE [1, 2, 3, 4, 5, 6] END AS of_file, CASE WHEN season = 1 THEN NULL ELSE [season] END AS of_folder,
        {_LISTS} AS more, tags, title, filename FROM releases),
m AS (SELECT *, CASE WHEN len(of_file) > 0 THEN of_file WHEN len(of_folder) > 0 THEN of_folder END AS eps,
    CASE WHEN NOT (size > 0 AND abs(size - folder) / size < 0.05) THEN folder END AS folder_left FROM p)
SELECT id, array_to_string(eps, ',') AS episodes, CAST(folder_left AS BIGINT) AS folder_size,
    coalesce(len(eps) > 0 AND folder_left > 2 * size, false) OR coalesce(len(eps) > 5, false) AS season_pack,
    array_to_string(list_concat(more, list_filter(tags, lambda t: NOT list_contains(more, t))), ',') AS all_tags FROM m""")
def folder_merge(spark, sf_dir):
    """What a file and its folder say together: episodes, size, tags, and whether it is a pack."""
    season, size = F.col("season"), F.col("size")
    none = F.array().cast("array<int>")
    of_file = F.when(season <= 2, none).when(season == 3, F.array(season, F.lit(9))).otherwise(F.array(*[F.lit(k) for k in range(1, 7)]))
    of_folder = F.when(season != 1, F.array(season))
    more = F.array_compact(F.array(F.when(season % 3 == 0, "HDR"), F.when(season % 2 == 0, "DV"), F.lit("IMAX")))
    rows = releases(spark, sf_dir).withColumn("eps", rw.fallback(of_file, of_folder)).withColumn("folder", rw.folder_size(size * (season % 4), size))
    pack = rw.is_season_pack(F.lit(None).cast("boolean"), F.col("eps"), size, F.col("folder"))
    return rows.select("id", F.array_join(F.col("eps").cast("array<string>"), ",").alias("episodes"), F.col("folder").alias("folder_size"), pack.alias("season_pack"), F.array_join(rw.merged(more, F.col("tags")), ",").alias("all_tags"))


@query(f"""WITH {RELEASES}, e AS (SELECT id, season, CASE WHEN pos % 3 = 0 THEN [] ELSE [season] END AS ss, CASE WHEN seeders IS NULL THEN [] ELSE [seeders % 12] END AS es FROM releases)
SELECT id, len(ss) > 0 AND NOT list_contains(ss, 2) AND NOT (list_contains(ss, 1) AND list_contains(es, 9)) AS wrong_season,
    len(es) > 0 AND NOT list_contains(es, 7) AND NOT list_contains(es, 9) AND NOT list_contains(es, 3) AS wrong_episode FROM e""")
def wrong_file(spark, sf_dir):
    """Files of another season or episode than the asked one, with absolute and relative numbers."""
    none = F.array().cast("array<int>")
    seasons = F.when(F.col("pos") % 3 == 0, none).otherwise(F.array("season"))
    episodes = F.when(F.col("seeders").isNull(), none).otherwise(F.array(F.col("seeders") % 12))
    absolute = F.lit(9)
    return releases(spark, sf_dir).select("id", rw.wrong_season(seasons, episodes, F.lit(2), absolute).alias("wrong_season"), rw.wrong_episode(episodes, F.lit(7), [absolute, F.lit(3)]).alias("wrong_episode"))


_CRITERIA = {
    "global": [("cached", "desc"), ("resolution", "desc"), ("seeders", "desc")],
    "movies": [("visualTag", "desc"), ("quality", "desc"), ("releaseGroup", "desc"), ("size", "asc")],
    "series": [("language", "desc"), ("service", "desc"), ("streamType", "asc"), ("addon", "desc"), ("keyword", "desc"), ("regexPatterns", "desc"), ("age", "asc"), ("seadex", "desc")],
}
_PREFER = {"resolution": RESOLUTIONS, "quality": QUALITIES, "service": SERVICES, "visualTag": ("DV", "Unknown"), "releaseGroup": ("BRAND1", "brand2"), "language": ("en", "fr"), "streamType": ("http", "p2p"), "addon": ("src2", "src0")}


def _place(value: str, items, absent: str = "'-infinity'::DOUBLE") -> str:
    return "CASE " + " ".join(f"WHEN {value} = '{p}' THEN {-float(i)}::DOUBLE" for i, p in enumerate(items)) + f" ELSE {absent} END"


_BY_KIND = {
    "global": f"CASE WHEN coalesce(cached, true) THEN 1 ELSE 0 END DESC, {_place('coalesce(resolution, $$Unknown$$)'.replace('$$', chr(39)), RESOLUTIONS)} DESC, coalesce(seeders, 0) DESC, pos",
    "movies": f"CASE WHEN list_contains(tags, 'DV') THEN 0::DOUBLE WHEN len(tags) = 0 THEN -1::DOUBLE ELSE '-infinity'::DOUBLE END DESC, {_place('quality', QUALITIES)} DESC, {_place('lower(release_group)', ('brand1', 'brand2'))} DESC, size, pos",
    "series": f"CASE WHEN season % 2 = 0 THEN -1 ELSE -2 END DESC, {_place('service_id', SERVICES)} DESC, {_place('type', ('http', 'p2p'))}, {_place('source_id', ('src2', 'src0'))} DESC, CASE WHEN contains(filename, 'gear') THEN 1 ELSE 0 END DESC, CASE WHEN pos % 5 = 0 THEN -(pos % 3)::DOUBLE ELSE '-infinity'::DOUBLE END DESC, coalesce(age_hours, 0), CASE WHEN season = 1 THEN 2 WHEN season = 2 THEN 1 ELSE 0 END DESC, pos",
}
_PLACES = ", ".join(f"CAST(row_number() OVER (PARTITION BY request_id ORDER BY {by}) AS INT) AS {name}_place" for name, by in _BY_KIND.items())


@query(f"WITH {RELEASES} SELECT id, {_PLACES} FROM releases")
def sort_by_criteria(spark, sf_dir):
    """Sort keys of every kind under the criteria of three kinds of requests."""
    rows = releases(spark, sf_dir).withColumns(
        {
            "languages": F.when(F.col("season") % 2 == 0, F.array(F.lit("de"), F.lit("fr"))).otherwise(F.array().cast("array<string>")),
            "keyword": F.col("filename").contains("gear"),
            "regex_index": F.when(F.col("pos") % 5 == 0, F.col("pos") % 3),
            "seadex_best": F.col("season") == 1,
            "seadex": F.col("season") <= 2,
        }
    )
    for name, kind in (("global", "channel"), ("movies", "movie"), ("series", "series")):
        rows = rk.ranked(rows, ["request_id"], rk.sort_order(rk.criteria_for(kind, _CRITERIA)[0], _PREFER), f"{name}_place")
    return rows.select("id", *[f"{name}_place" for name in _BY_KIND])


def _smart_sql(n: str, k: int, units: list[str]) -> str:
    power = "CASE " + " ".join(f"WHEN {n} >= {float(k) ** i} THEN {i}" for i in range(len(units) - 1, 0, -1)) + " ELSE 0 END"
    raw = f"({n} / power({float(k)}, {power}))"
    cut = lambda d: f"regexp_replace(regexp_replace(printf('%.{d}f', floor({raw} * {10**d} + 0.5) / {10**d}), '0+$', ''), '\\.$', '')"
    return f"CASE WHEN {n} <= 0 THEN '0 {units[0]}' ELSE CASE WHEN {raw} >= 100 THEN printf('%.0f', floor({raw} + 0.5)) WHEN {raw} >= 10 THEN {cut(1)} ELSE {cut(2)} END || ' ' || {units!r}[{power} + 1] END"


@query(f"""WITH s AS (SELECT o_orderkey, CAST(floor(o_totalprice * power(10, o_orderkey % 6)) AS BIGINT) AS n FROM orders)
SELECT o_orderkey, {_smart_sql("n", 1000, ["B", "KB", "MB", "GB", "TB"])} AS size, {_smart_sql("n", 1024, ["B", "KiB", "MiB", "GiB", "TiB"])} AS size2, {_smart_sql("n", 1000, ["bps", "Kbps", "Mbps", "Gbps", "Tbps"])} AS rate FROM s""")
def smart_numbers(spark, sf_dir):
    """Sizes and bitrates in three figures."""
    n = F.floor(F.col("o_totalprice") * F.pow(F.lit(10.0), F.col("o_orderkey") % 6)).cast("long")
    return table(spark, sf_dir, "orders").select("o_orderkey", fm.smart_bytes(n).alias("size"), fm.smart_bytes(n, 1024).alias("size2"), fm.smart_bitrate(n).alias("rate"))
