"""Crosswalks between identifiers, counts over tables, and labels, times and texts that stand for a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import formatting as fm
from ..functions import parsing as ps
from ..functions import rows as rw
from ..operators import identity as idt
from ..operators import maintenance as mt
from .registry import query, table

_KINDS = "CASE p_partkey % 5 WHEN 0 THEN 'TV' WHEN 1 THEN 'MOVIE' WHEN 2 THEN 'OVA' WHEN 3 THEN 'SPECIAL' ELSE 'UNKNOWN' END"


@query(f"""WITH m AS (SELECT p_partkey AS pos, 'tt' || CAST(p_partkey // 6 AS VARCHAR) AS imdb, CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_partkey // 4 AS VARCHAR) END AS tvdb,
    {_KINDS} AS kind, 1 + p_size % 3 AS season_a, CASE WHEN p_size % 4 <> 0 THEN p_size % 20 ELSE 1 END AS from_a, p_size % 3 AS season_b, p_partkey % 17 AS from_b, 'Second Season_' || CAST(p_size % 4 AS VARCHAR) AS synonym FROM part),
l AS (SELECT 'imdb' AS id_type, imdb AS id_value, * FROM m UNION ALL SELECT 'tvdb', tvdb, * FROM m WHERE tvdb IS NOT NULL UNION ALL SELECT 'mal', CAST(pos AS VARCHAR), * FROM m),
r AS (SELECT o_orderkey AS request, CASE o_orderkey % 3 WHEN 0 THEN 'imdb' WHEN 1 THEN 'tvdb' ELSE 'mal' END AS id_type,
    CASE o_orderkey % 3 WHEN 0 THEN 'tt' || CAST(o_custkey // 5 AS VARCHAR) ELSE CAST(o_custkey // 3 AS VARCHAR) END AS id_value,
    CASE WHEN o_orderkey % 11 > 0 THEN o_custkey % 5 END AS season, CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey % 25 END AS episode FROM orders),
j AS (SELECT *, kind = 'UNKNOWN' OR CASE WHEN season IS NULL THEN kind = 'MOVIE' WHEN season = 0 THEN kind IN ('SPECIAL', 'OVA', 'ONA') ELSE kind = 'TV' END AS fits FROM r LEFT JOIN l USING (id_type, id_value)),
f AS (SELECT *, bool_or(fits) OVER (PARTITION BY request) AS any_fit FROM j),
s AS (SELECT *, CASE WHEN season_a = season AND from_a <= episode THEN from_a END AS a, CASE WHEN id_type <> 'mal' AND season_b = season AND from_b <= episode THEN from_b END AS b FROM f WHERE fits OR NOT coalesce(any_fit, false)),
w AS (SELECT *, row_number() OVER (PARTITION BY request ORDER BY greatest(a, b) DESC NULLS LAST, CASE WHEN a >= coalesce(b, a) THEN 0 ELSE 1 END,
    CASE WHEN episode IS NOT NULL AND contains(lower(synonym), 'season_' || CAST(season AS VARCHAR)) THEN 0 ELSE 1 END, pos) AS n FROM s)
SELECT request, pos AS mapping, CAST(greatest(a, b) AS BIGINT) AS start FROM w WHERE n = 1""")
def id_crosswalk(spark, sf_dir):
    """Mapping of a title known by any kind of id: kinds that suit the season, then starts, synonyms and the first."""
    synonyms = F.expr("array(p_name, concat('Second Season_', cast(p_size % 4 as string)))")
    starts = F.expr(
        "array(named_struct('source', 0, 'season', cast(1 + p_size % 3 as bigint), 'episode', cast(CASE WHEN p_size % 4 <> 0 THEN p_size % 20 END as bigint)),"
        " named_struct('source', 1, 'season', cast(p_size % 3 as bigint), 'episode', cast(p_partkey % 17 as bigint)))"
    )
    ids = {"imdb": "concat('tt', cast(p_partkey div 6 as string))", "tvdb": "CASE WHEN p_partkey % 3 <> 0 THEN cast(p_partkey div 4 as string) END", "mal": "cast(p_partkey as string)"}
    mappings = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("mapping"), *[F.expr(e).alias(n) for n, e in ids.items()], F.expr(_KINDS).alias("kind"), starts.alias("starts"), synonyms.alias("synonyms"))
    requests = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS request",
        "CASE o_orderkey % 3 WHEN 0 THEN 'imdb' WHEN 1 THEN 'tvdb' ELSE 'mal' END AS id_type",
        "CASE o_orderkey % 3 WHEN 0 THEN concat('tt', cast(o_custkey div 5 as string)) ELSE cast(o_custkey div 3 as string) END AS id_value",
        "CASE WHEN o_orderkey % 11 > 0 THEN o_custkey % 5 END AS season",
        "CASE WHEN o_orderkey % 13 > 0 THEN o_orderkey % 25 END AS episode",
    )
    found = idt.crosswalk(requests, mappings, list(ids), "request", "mapping", listed=["imdb", "tvdb"])
    return found.select("request", "mapping", F.col("start").cast("long").alias("start"))


@query("""WITH k AS (SELECT o_orderkey AS key FROM orders WHERE o_orderstatus = 'P'),
c AS (SELECT 'orders' AS table_name, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT key FROM k) UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT key FROM k)
    UNION ALL SELECT 'nation', count(*) FROM nation WHERE n_nationkey IN (SELECT -key FROM k WHERE key > 0))
SELECT table_name, CAST(n AS BIGINT) AS row_count, CAST(CASE table_name WHEN 'orders' THEN trunc(900000 / 700.0 * n) WHEN 'lineitem' THEN 0 ELSE 0 END AS BIGINT) AS reclaimed FROM c""")
def promoted_counts(spark, sf_dir):
    """Rows of each table under a set of keys, and the bytes that deleting them would give back."""
    orders = table(spark, sf_dir, "orders")
    keys = orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("key"))
    sides = {"orders": orders.withColumnRenamed("o_orderkey", "key"), "lineitem": table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key"), "nation": table(spark, sf_dir, "nation").withColumn("key", -F.abs("n_nationkey") - 1)}
    stats = spark.createDataFrame([("orders", 700.0, 900000.0), ("lineitem", 0.0, 5.0)], "table_name string, estimated_rows double, total_bytes double")
    return mt.reclaimable(mt.counts_under(sides, keys, "key"), stats).select("table_name", "row_count", "reclaimed")


_BIN_SIZE = "CASE WHEN o_orderkey % 50 = 0 THEN (o_orderkey // 50 % 8) * 536870912 ELSE CAST(floor(o_totalprice * power(10, o_orderkey % 8)) AS BIGINT) END"


@query(f"""WITH s AS (SELECT o_orderkey, {_BIN_SIZE} AS n FROM orders), g AS (SELECT *, n / 1073741824.0 AS gb, floor(ln(n / 1073741824.0) / ln(1.5)) AS step FROM s WHERE n > 0 UNION ALL SELECT *, NULL, NULL FROM s WHERE n <= 0)
SELECT o_orderkey, CASE WHEN n = 0 THEN NULL WHEN gb >= 5 THEN CAST(CAST(floor(power(1.5, step)) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(floor(power(1.5, step + 1)) AS BIGINT) AS VARCHAR) || 'GB'
    WHEN n < 104857600 THEN '0-100MB' WHEN n > 104857600 AND n < 314572800 THEN '100-300MB' WHEN n > 314572800 AND n < 524288000 THEN '300-500MB' WHEN n > 524288000 AND gb < 1 THEN '500MB-1GB'
    WHEN gb > 1 AND gb < 2 THEN '1-2GB' WHEN gb > 2 AND gb < 3 THEN '2-3GB' WHEN gb > 3 AND gb < 4 THEN '3-4GB' WHEN gb > 4 THEN '4-5GB' ELSE '5GB+' END AS bin FROM g""")
def size_bins(spark, sf_dir):
    """Labels of sizes, with sizes on the borders of bins."""
    n = F.expr(_BIN_SIZE.replace("o_orderkey // 50", "o_orderkey div 50"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fm.size_bin(n).alias("bin"))


@query("""WITH e AS (SELECT event_id, date_trunc('second', ts) AS t, ts FROM events)
SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN epoch(t) WHEN 1 THEN epoch(t) WHEN 2 THEN epoch(t) - 9000 WHEN 3 THEN epoch(t) + 3600 ELSE 1700000000 END AS BIGINT) AS seconds,
    CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-02-01') AS INT) AS days, sha256(CAST(event_id AS VARCHAR) || ' é') AS text_hash FROM e""")
def times_and_hashes(spark, sf_dir):
    """Epochs of times in several forms, whole days up to a date, and hashes of texts."""
    text, k = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.col("event_id") % 5
    form = F.when(k == 0, F.concat(text, F.lit("Z"))).when(k == 1, F.concat(text, F.lit(".250Z"))).when(k == 2, F.concat(text, F.lit("+02:30"))).when(k == 3, F.concat(text, F.lit("-0100"))).otherwise(text)
    events = table(spark, sf_dir, "events")
    return events.select("event_id", ps.epoch_seconds(form, F.lit(1700000000)).alias("seconds"), ps.days_since(F.col("ts"), F.lit("2024-02-01")).alias("days"), ps.text_hash(F.concat(F.col("event_id").cast("string"), F.lit(" é"))).alias("text_hash"))


@query("""SELECT l_orderkey, l_linenumber, concat_ws(' ', nullif(l_returnflag, ''), 'k' || CAST(l_partkey AS VARCHAR), CASE WHEN l_linenumber <> 3 THEN CAST(CAST(year(l_shipdate) AS INT) AS VARCHAR) END,
    CASE WHEN l_linenumber <> 2 THEN 'season ' || CAST(l_linenumber AS VARCHAR) || ' s' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') END,
    'episode ' || CAST(l_suppkey % 12 AS VARCHAR) || ' e' || lpad(CAST(l_suppkey % 12 AS VARCHAR), 2, '0'),
    CASE WHEN l_suppkey % 3 > 0 THEN 'episode ' || CAST(l_suppkey % 12 + l_suppkey % 3 AS VARCHAR) || ' e' || lpad(CAST(l_suppkey % 12 + l_suppkey % 3 AS VARCHAR), 2, '0') END, 'pack') AS search_text FROM lineitem""")
def search_texts(spark, sf_dir):
    """The text under which a row is searched: names, ids, year, season, episodes and keys."""
    first = F.col("l_suppkey") % 12
    parts = [F.col("l_returnflag"), F.lit(""), F.concat(F.lit("k"), F.col("l_partkey").cast("string"))]
    season, year = F.when(F.col("l_linenumber") != 2, F.col("l_linenumber")), F.when(F.col("l_linenumber") != 3, F.year("l_shipdate"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ps.search_text(parts, year, season, first, first + F.col("l_suppkey") % 3, [F.lit(None).cast("string"), F.lit("pack")]).alias("search_text"))


_FILE = "concat('file', cast(p_partkey as {text}), CASE p_partkey % 8 WHEN 0 THEN '.mkv' WHEN 1 THEN '.srt' WHEN 2 THEN '.7z.001' WHEN 3 THEN '.MKV' WHEN 4 THEN '.m2ts' WHEN 5 THEN '.gif' WHEN 6 THEN 'mkv' ELSE '.nfo' END)"
_MIME = "CASE p_size % 4 WHEN 0 THEN 'video/mp4' WHEN 1 THEN 'text/plain' WHEN 2 THEN '' END"


@query(f"""WITH f AS (SELECT p_partkey, {_FILE.format(text="varchar")} AS name, {_MIME} AS mime FROM part)
SELECT p_partkey, coalesce(contains(mime, 'video'), false) OR regexp_matches(name, '\\.(mkv|m2ts|gif)$') AS video,
    coalesce(mime <> '' AND NOT contains(mime, 'video'), false) OR regexp_matches(name, '\\.(srt|gif|nfo|7z\\.[0-9]+)$') AS other FROM f""")
def media_files(spark, sf_dir):
    """Files that are videos, and files that are surely none; endings are compared as they are written."""
    files = table(spark, sf_dir, "part").select("p_partkey", F.expr(_FILE.format(text="string")).alias("name"), F.expr(_MIME).alias("mime"))
    return files.select("p_partkey", rw.is_video(F.col("name"), F.col("mime")).alias("video"), rw.is_not_video(F.col("name"), F.col("mime")).alias("other"))


_TITLE = "CASE WHEN l_linenumber % 3 = 0 THEN concat('12 ', lower(p_name)) WHEN l_linenumber % 3 = 1 THEN lower(p_name) ELSE lower(replace(p_brand, '#', '')) END"


@query(f"""WITH c AS (SELECT l_suppkey, {_TITLE} AS title, CASE WHEN l_linenumber % 2 = 0 THEN 'parser' ELSE 'rules' END AS source, p_size % 4 AS noise FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (SELECT *, len(string_split(title, ' ')) AS n FROM c),
r AS (SELECT *, noise - CASE WHEN starts_with(title, '12 ') THEN 1 ELSE 0 END + CASE WHEN source = 'parser' AND n <= 1 THEN 2 ELSE 0 END AS score FROM t),
w AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score, CASE WHEN source = 'parser' THEN 0 ELSE 1 END, -n, length(title), title) AS k FROM r)
SELECT l_suppkey, title, source, CAST(score AS INT) AS score FROM w WHERE k = 1""")
def title_candidates(spark, sf_dir):
    """The best of several readings of a title: least noise, the parser's before the rules', most words, shortest."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rows = line.join(part, line["l_partkey"] == part["p_partkey"]).select("l_suppkey", F.expr(_TITLE).alias("title"), F.when(F.col("l_linenumber") % 2 == 0, "parser").otherwise("rules").alias("source"), (F.col("p_size") % 4).alias("noise"))
    rank = idt.candidate_rank(F.col("title"), F.col("source"), F.col("noise"), "parser")
    best = rows.groupBy("l_suppkey").agg(F.min(F.struct(rank.alias("rank"), "title", "source")).alias("b"))
    return best.select("l_suppkey", "b.title", "b.source", F.col("b.rank.score").cast("int").alias("score"))
