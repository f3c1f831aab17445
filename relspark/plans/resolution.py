"""Remembered answers, members of clusters, groups of sources under conditions, enrichment cycles, and forms of rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing as ps
from ..operators import filters as fl
from ..operators import resolution as rs
from ..sources import sinks
from . import sel
from .bridge import RELEASES, releases
from .registry import query, table


@query("""WITH q AS (SELECT o_orderkey, 'movie␟group␟' || CASE WHEN o_orderkey % 2 = 0 THEN 'anime' ELSE 'normal' END || '␟' || CASE WHEN o_orderkey % 3 > 0 THEN CAST(1990 + o_orderkey % 3 AS VARCHAR) ELSE '' END || '␟' || 'cold gear' || CASE WHEN o_custkey % 3 = 0 THEN '|part ' || CAST(10 + o_custkey % 20 AS VARCHAR) ELSE '' END AS cache_key FROM orders),
c AS (SELECT DISTINCT cache_key FROM q WHERE o_orderkey % 7 = 1)
SELECT o_orderkey, cache_key, c.cache_key IS NOT NULL AS hit FROM q LEFT JOIN c USING (cache_key)""")
def cache_hits(spark, sf_dir):
    """Requests that a remembered answer serves, and those that must be asked; the key holds all titles in one order."""
    n = F.col("o_orderkey")
    titles = F.array(F.lit("Cold.Gear"), F.when(F.col("o_custkey") % 3 == 0, F.concat(F.lit("Part_"), (10 + F.col("o_custkey") % 20).cast("string"))).otherwise(F.lit("")), F.lit("cold gear"))
    year = F.when(n % 3 > 0, 1990 + n % 3)
    key = rs.cache_key(F.lit("movie"), F.lit("group"), n % 2 == 0, year, titles)
    requests = table(spark, sf_dir, "orders").select("o_orderkey", key.alias("cache_key"))
    cache = requests.where(n % 7 == 1).select("cache_key").distinct()
    hits, misses = rs.read_through(requests, cache, "cache_key")
    return hits.withColumn("hit", F.lit(True)).unionByName(misses.withColumn("hit", F.lit(False))).select("o_orderkey", "cache_key", "hit")


@query("""WITH m AS (SELECT l_suppkey, l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 4 THEN CAST(year(l_shipdate) AS INT) END AS y, CASE l_linenumber % 3 WHEN 0 THEN 's01' WHEN 1 THEN 's02' ELSE '' END AS b,
    CASE WHEN l_suppkey % 4 > 0 THEN 1992 + l_suppkey % 3 END AS cy, CASE WHEN l_suppkey % 3 = 0 THEN 1993 END AS ky, CASE WHEN l_suppkey % 2 = 0 THEN 's02' ELSE '' END AS cb FROM lineitem),
k AS (SELECT *, (y IS NULL OR cy IS NULL OR abs(y - cy) <= 1) AND (y IS NULL OR ky IS NULL OR abs(y - ky) <= 1) AND (b = '' OR cb = '' OR b = cb) AS ok FROM m),
a AS (SELECT *, bool_or(ok) OVER (PARTITION BY l_suppkey) AS any_ok FROM k)
SELECT l_suppkey, l_orderkey, l_linenumber FROM a WHERE ok OR NOT any_ok""")
def cluster_members(spark, sf_dir):
    """Members of clusters near in year and of the same season, or all of a cluster without such members."""
    n, s = F.col("l_linenumber"), F.col("l_suppkey")
    year = F.when(n != 4, F.year("l_shipdate"))
    bucket = F.when(n % 3 == 0, "s01").when(n % 3 == 1, "s02").otherwise("")
    own, canonical = F.when(s % 4 > 0, 1992 + s % 3), F.when(s % 3 == 0, F.lit(1993))
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate")
    return rs.compatible_members(rows, "l_suppkey", year, bucket, own, canonical, F.when(s % 2 == 0, "s02").otherwise("")).select("l_suppkey", "l_orderkey", "l_linenumber")


_GROUP = "CASE season % 5 WHEN 4 THEN NULL ELSE season % 5 END"


@query(f"""WITH {RELEASES}, r AS (SELECT id, request_id, coalesce({_GROUP}, 0) AS g, 100 + pos * 10 AS t FROM releases),
s AS (SELECT request_id, count(*) FILTER (g = 0) AS n0, count(*) FILTER (g = 1) AS n1, count(*) FILTER (g = 2) AS n2, coalesce(max(t) FILTER (g = 0), 0) AS t0, coalesce(max(t) FILTER (g = 1), 0) AS t1, coalesce(max(t) FILTER (g = 2), 0) AS t2 FROM r GROUP BY 1),
q AS (SELECT *, n0 < 12 AS one, n0 < 12 AND n0 + n1 < 20 AND t0 + t1 < 900 AS two FROM s),
p AS (SELECT *, n0 < 20 AND greatest(t0, 0) < 450 AS far FROM s)
SELECT r.id, true AS sequential FROM r JOIN q USING (request_id) WHERE g = 0 OR (g = 1 AND one) OR (g = 2 AND two) OR (g = 3 AND two)
UNION ALL SELECT r.id, false FROM r JOIN p USING (request_id) WHERE g = 0 OR (g = 2 AND far) OR (g = 3 AND far AND n2 >= 2)""")
def group_fetch(spark, sf_dir):
    """Groups of sources that come in turn while a condition on what came before holds; in sequence and in parallel."""
    rows = releases(spark, sf_dir).withColumns({"group_no": F.expr(_GROUP), "elapsed": 100 + F.col("pos") * 10})
    said = lambda text: sel.group_condition(text, rows)
    in_turn = [None, said("count(totalStreams) < 12"), said("count(merge(totalStreams, previousStreams)) < 20 and totalTimeTaken < 900"), None]
    at_once = [None, None, said("count(totalStreams) < 20 and previousGroupTimeTaken < 450"), said("count(previousStreams) >= 2")]
    a, b = rs.fetched_groups(rows, in_turn, True), rs.fetched_groups(rows, at_once, False)
    return a.select("id", F.lit(True).alias("sequential")).unionByName(b.select("id", F.lit(False).alias("sequential")))


@query("""WITH p AS (SELECT o_orderkey, 'title ' || CAST(o_custkey % 40 AS VARCHAR) AS title, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE o_orderstatus = 'P'),
k AS (SELECT title, year, CAST(substr(title, 7) AS BIGINT) * 10 AS found FROM (SELECT DISTINCT title, year FROM p) WHERE CAST(substr(title, 7) AS INT) % 3 = 0),
b AS (SELECT title, year FROM p ANTI JOIN k USING (title, year) GROUP BY 1, 2 ORDER BY min(o_orderkey), title, year LIMIT 10)
SELECT o_orderkey, title, year, found, 'known' AS resolver FROM p JOIN k USING (title, year)
UNION ALL SELECT o_orderkey, title, year, CAST(substr(title, 7) AS BIGINT) * 10 + 1, 'lookup' FROM p JOIN b USING (title, year) WHERE CAST(substr(title, 7) AS INT) % 4 <> 2""")
def enrichment_cycle(spark, sf_dir):
    """One cycle: rows with a known answer, and the first ten batches of the others that a lookup answers."""
    number = F.substring("title", 7, 10).cast("long")
    pending = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", F.concat(F.lit("title "), (F.col("o_custkey") % 40).cast("string")).alias("title"), F.year("o_orderdate").alias("year"))
    distinct = pending.select("title", "year").distinct()
    known = distinct.where(number % 3 == 0).withColumn("found", number * 10)
    lookups = distinct.where(number % 4 != 2).withColumn("found", number * 10 + 1)
    return rs.enrichment_cycle(pending, known, lookups, ["title", "year"], "o_orderkey").select("o_orderkey", "title", "year", "found", "resolver")


@query(f"""WITH {RELEASES} SELECT id, CASE WHEN service_id = 'svc_a' AND pos % 3 = 0 THEN false ELSE service_id = 'svc_a' AND coalesce(cached, false) END AS cached,
    CASE WHEN pos % 11 = 0 THEN 'live' WHEN service_id IS NOT NULL AND pos % 5 = 0 THEN 'usenet' WHEN service_id IS NOT NULL THEN 'debrid' WHEN pos % 7 = 0 THEN 'http' WHEN type = 'p2p' THEN 'p2p' WHEN pos % 5 = 0 THEN 'stremio-usenet' ELSE 'archive' END AS type,
    CASE pos % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'forbidden' WHEN 2 THEN 'ratelimit' ELSE 'hard' END AS error FROM releases""")
def row_types(spark, sf_dir):
    """Service marks, types of raw rows, and classes of error messages."""
    pos, service = F.col("pos"), F.col("service_id")
    label = F.when(service == "svc_a", F.concat(F.lit("[SA"), F.when(pos % 3 == 0, " download]").when(F.coalesce("cached", F.lit(False)), "+]").otherwise("]"))).otherwise(F.lit("plain"))
    marked = ps.service_of(label, [("svc_a", "[SA")])
    some = lambda test: F.when(test, F.lit("x"))
    kind = ps.stream_type(service, pos % 11 == 0, some(pos % 5 == 0), some(F.col("type") == "p2p"), some(pos % 7 == 0), F.lit(None), F.lit(None))
    message = F.when(pos % 5 == 0, "Request TIMED OUT").when(pos % 5 == 1, "HTTP 403").when(pos % 5 == 2, "Too many requests").when(pos % 5 == 3, "separate failure").otherwise("boom")
    return releases(spark, sf_dir).select("id", F.coalesce(marked["cached"], F.lit(False)).alias("cached"), kind.alias("type"), fl.message_class(message).alias("error"))


@query(f"""WITH {RELEASES} SELECT id, array_to_string(list_filter([CASE WHEN pos % 4 > 0 THEN 'name:' || lower(regexp_replace(release_group, '[^A-Za-z0-9]', '', 'g')) || CAST(pos AS VARCHAR) END,
    CASE WHEN type = 'p2p' THEN 'hash:h' || CAST(request_id AS VARCHAR) || CASE WHEN pos % 2 = 0 THEN '3' ELSE '0' END END, CASE WHEN quality IS NOT NULL THEN 'attr:' || quality END], lambda x: x IS NOT NULL), ',') AS keys FROM releases""")
def dedup_keys(spark, sf_dir):
    """Keys under which rows are the same, from names, hashes with file numbers, and attributes."""
    pos = F.col("pos")
    name = F.when(pos % 4 > 0, F.concat("release_group", F.lit(" _"), pos.cast("string"), F.lit(".mkv"))).otherwise(F.lit("___.mkv"))
    info = F.when(F.col("type") == "p2p", F.concat(F.lit("h"), F.col("request_id").cast("string")))
    return releases(spark, sf_dir).select("id", F.array_join(ps.dedup_keys(name, info, F.when(pos % 2 == 0, F.lit(3)), F.col("quality")), ",").alias("keys"))


@query("""SELECT o_orderkey, NOT (o_orderkey % 3 > 0) OR o_orderstatus = 'P' OR d >= -2 AS release_ok FROM (SELECT *, date_diff('day', CAST(o_orderdate AS DATE), DATE '1995-06-17') AS d FROM orders)""")
def release_gates(spark, sf_dir):
    """Requests whose release day has come, within two days; unknown days and switched-off gates let all through."""
    days = F.when(F.col("o_orderstatus") != "P", ps.days_since(F.col("o_orderdate").cast("date"), F.lit("1995-06-17").cast("date")))
    return table(spark, sf_dir, "orders").select("o_orderkey", fl.release_gate(days, F.col("o_orderkey") % 3 > 0, 2).alias("release_ok"))


@query(f"""WITH {RELEASES} SELECT request_id, filename AS name, release_group AS description, CASE WHEN type IN ('debrid', 'http') THEN 'u/' || id END AS url, CASE WHEN type = 'p2p' THEN 'h' || id END AS info_hash,
    NULL::VARCHAR AS external_url, NULL::VARCHAR AS yt_id, concat_ws('|', source_id, coalesce(service_id, ''), coalesce(resolution, ''), coalesce(quality, ''), 'x') AS binge FROM releases""")
def client_projection(spark, sf_dir):
    """Rows as a player gets them, with the locator of their type alone; the size label of the group is cut here."""
    none = F.lit(None).cast("string")
    rows = releases(spark, sf_dir).withColumns({"url": F.concat(F.lit("u/"), "id"), "info_hash": F.concat(F.lit("h"), "id"), "external_url": none, "yt_id": none})
    out = sinks.client_rows(rows, F.col("filename"), F.col("release_group"))
    return out.withColumn("binge", F.concat(F.substring_index("binge_group", "|", 4), F.lit("|x"))).drop("binge_group")
