"""Choice of a file for every request: customers stand for requests, their orders for the files."""

from __future__ import annotations

from pyspark.sql import functions as F

from relspark.operators import selection

from .registry import query, stated

_REQUESTS = """SELECT c_custkey AS request_id, concat('Release ', c_name) AS release, CASE WHEN c_custkey % 2 = 0 THEN 500000 ELSE 0 END AS release_size,
    c_custkey % 11 AS parsed_as, c_custkey % 6 AS release_episode, 1992 + c_custkey % 7 AS year, CASE WHEN c_custkey % 5 = 0 THEN 1992 + c_custkey % 6 END AS season_year,
    c_custkey % 4 AS season, c_custkey % 7 AS episode, CASE WHEN c_custkey % 3 = 0 THEN 7 + c_custkey % 5 END AS absolute, CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 9 END AS relative,
    c_custkey * 4 AS chosen_index, CASE WHEN c_nationkey = 3 THEN '001' END AS chosen_name FROM customer"""
_FILES = """SELECT o_custkey AS request_id, o_orderkey AS file_index, o_totalprice AS size, EXTRACT(YEAR FROM o_orderdate) AS file_year, o_orderstatus AS status, o_orderkey % 8 AS form,
    o_orderkey % 12 AS number, o_orderpriority = '5-LOW' AND o_orderkey % 3 = 0 AS unparsed, o_orderkey % 5 < 2 AS title_ok, CASE WHEN o_orderkey % 13 = 0 THEN 'video/mp4' WHEN o_orderkey % 17 = 0 THEN 'text/plain' END AS mime,
    concat('file', o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '.mkv' WHEN '2-HIGH' THEN '.Sample.mkv' WHEN '3-MEDIUM' THEN '.mp4' WHEN '4-NOT SPECIFIED' THEN '.nfo' ELSE '' END) AS name FROM orders"""


@query(f"""WITH r AS ({_REQUESTS}), f AS ({_FILES}),
n AS (SELECT *, CASE status WHEN 'O' THEN [1 + number % 3] WHEN 'P' THEN [1, 2] ELSE [] END AS seasons, CASE WHEN form = 0 THEN [] WHEN form < 5 THEN [number] ELSE [number, number + 1] END AS episodes,
    max(size) OVER (PARTITION BY request_id) AS largest FROM f),
a AS (SELECT r.request_id, r.release, r.release_size, n.file_index, n.name, n.size, n.unparsed, file_year, seasons, episodes, n.title_ok, chosen_index, chosen_name, year, season_year, season, episode, absolute, relative,
    coalesce(n.mime LIKE '%video%', false) OR regexp_matches(name, '\\.(mkv|mp4)$') AS video, coalesce(n.mime = 'text/plain', false) OR name LIKE '%.nfo' AS other_kind,
    CASE WHEN release_size > 0 THEN release_size ELSE largest END AS total, parsed_as > 0 AND episode > 0 AND release_episode > 0 AND release_episode NOT IN (episode, coalesce(absolute, 0), coalesce(relative, 0)) AS release_wrong,
    parsed_as > 0 AS release_known, episode > 0 AND len(episodes) > 0 AND NOT list_has_any(episodes, list_filter([episode, coalesce(absolute, 0), coalesce(relative, 0)], lambda x: x > 0)) AS wrong_e,
    season > 0 AND len(seasons) > 0 AND NOT list_contains(seasons, season) AND NOT (seasons = [1] AND absolute > 0 AND list_contains(episodes, absolute)) IS TRUE AS wrong_s
    FROM r LEFT JOIN n USING (request_id)),
p AS (SELECT *, CASE WHEN file_index IS NOT NULL AND NOT unparsed AND NOT other_kind THEN greatest(0,
    CASE WHEN name LIKE '%.Sample.%' THEN -500 ELSE 0 END + CASE WHEN video THEN 1000 ELSE 0 END + CASE WHEN file_year = year THEN 500 ELSE 0 END + CASE WHEN file_year = season_year THEN 750 ELSE 0 END
    + CASE WHEN wrong_s THEN 0 ELSE 500 END - CASE WHEN season > 0 AND len(seasons) = 0 THEN 500 ELSE 0 END - CASE WHEN len(episodes) = 0 AND (episode > 0 OR absolute > 0) THEN 500 ELSE 0 END
    + CASE WHEN wrong_e OR len(episodes) = 0 THEN 0 WHEN len(seasons) > 0 OR season = 0 OR episode = 0 OR absolute IS NULL THEN CASE WHEN len(episodes) = 1 THEN 750 ELSE 250 END
        WHEN len(episodes) = 1 THEN CASE episodes[1] WHEN absolute THEN 2000 WHEN nullif(relative, 0) THEN 1000 WHEN episode THEN 300 ELSE 0 END
        WHEN list_contains(episodes, absolute) THEN 500 WHEN relative > 0 AND list_contains(episodes, relative) THEN 300 WHEN list_contains(episodes, episode) THEN 100 ELSE 0 END
    + CASE WHEN video AND title_ok THEN 100 ELSE 0 END + CASE WHEN chosen_index = file_index THEN 25 ELSE 0 END + CASE WHEN contains(release, chosen_name) THEN 25 ELSE 0 END
    + CASE WHEN total > 0 THEN size::DOUBLE / total::DOUBLE * 50 ELSE 0 END) END AS score FROM a),
b AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC NULLS LAST, file_index) AS place FROM p),
d AS (SELECT *, CASE WHEN file_index IS NULL THEN NULL WHEN score IS NULL THEN 'no file' WHEN release_known AND (wrong_e OR release_wrong) THEN 'other episode' END AS refused FROM b WHERE place = 1)
SELECT request_id, CASE WHEN file_index IS NULL THEN -1 WHEN refused IS NULL THEN file_index END AS file_index, CASE WHEN file_index IS NULL THEN release WHEN refused IS NULL THEN name END AS name,
    CASE WHEN file_index IS NULL THEN release_size WHEN refused IS NULL THEN size END::DOUBLE AS size, round(CASE WHEN refused IS NULL THEN score END, 4)::DOUBLE AS file_score, refused FROM d""")
def file_selection(spark, sf_dir):
    """The file of each request by the whole table of points, a lone release, or why there is none."""
    asked = F.struct("year", "season_year", "season", "episode", "absolute", "relative")
    r = stated(spark, sf_dir, _REQUESTS, "customer")
    of_release = F.struct(F.lit("t").alias("title"), F.lit(None).cast("long").alias("year"), F.array().cast("array<bigint>").alias("seasons"), F.filter(F.array(F.col("release_episode").cast("long")), lambda e: e > 0).alias("episodes"))
    r = r.select("request_id", "release", "release_size", F.when(F.col("parsed_as") > 0, of_release).alias("release_parsed"), asked.alias("asked"), "chosen_index", "chosen_name")
    n = F.col("number").cast("long")
    none = F.array().cast("array<bigint>")
    one, two = F.lit(1).cast("long"), F.lit(2).cast("long")
    seasons = F.when(F.col("status") == "O", F.array(n % 3 + 1)).when(F.col("status") == "P", F.array(one, two)).otherwise(none)
    episodes = F.when(F.col("form") == 0, none).when(F.col("form") < 5, F.array(n)).otherwise(F.array(n, n + 1))
    parsed = F.struct(F.lit("t").alias("title"), F.col("file_year").alias("year"), seasons.alias("seasons"), episodes.alias("episodes"))
    f = stated(spark, sf_dir, _FILES, "orders")
    f = f.select("request_id", "file_index", "name", "mime", "size", F.when(~F.col("unparsed"), parsed).alias("parsed"), "title_ok")
    chosen = selection.select_files(r, f, "request_id")
    return chosen.withColumn("size", F.col("size").cast("double")).withColumn("file_score", F.round("file_score", 4))
