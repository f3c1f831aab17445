"""Reports of batches and rows of many kinds of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import strategies as st
from ..operators import counters as ct
from ..operators import filters as flt
from . import sel
from .bridge import RELEASES, releases
from .registry import query, stated, table


@query("""WITH e AS (SELECT *, user_id % 5 AS total, CASE WHEN value < 10 THEN 'low' WHEN value > 90 THEN 'high' END AS reason FROM events),
s AS (SELECT total, count(*) AS n, round(sum(value), 4) AS seconds, count(DISTINCT user_id) AS batches FROM e GROUP BY 1),
b AS (SELECT total, user_id, reason, event_id, row_number() OVER (PARTITION BY user_id, reason ORDER BY event_id) AS place FROM e WHERE reason IS NOT NULL),
p AS (SELECT total, reason, event_id, row_number() OVER (PARTITION BY total, reason ORDER BY user_id, event_id) AS place FROM b WHERE place <= 3),
rows AS (SELECT total, 'rows' AS section, 'scanned' AS name, CAST(n AS BIGINT) AS n, '' AS shown FROM s UNION ALL SELECT total, 'rows', 'batches', batches, '' FROM s
    UNION ALL SELECT total, 'largest', 'rows', max(c), '' FROM (SELECT total, user_id, count(*) AS c FROM e GROUP BY 1, 2) GROUP BY 1
    UNION ALL SELECT total, 'timing', 'seconds', NULL, printf('%.2f', seconds) FROM s
    UNION ALL SELECT total, 'classes', event_type, count(*), '' FROM e GROUP BY 1, 3 UNION ALL SELECT total, 'reasons', reason, count(*), '' FROM e WHERE reason IS NOT NULL GROUP BY 1, 3
    UNION ALL SELECT total, 'samples', reason, count(*), string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY place) FROM p WHERE place <= 7 GROUP BY 1, 3)
SELECT * FROM rows""")
def counter_merge(spark, sf_dir):
    """Reports of each user merged into five: numbers, maxima, times, counters by class and reason, seven samples of a reason."""
    events = table(spark, sf_dir, "events").withColumn("total", F.col("user_id") % 5)
    reason = F.when(F.col("value") < 10, "low").when(F.col("value") > 90, "high")
    sample = F.struct(reason.alias("name"), F.col("event_id").alias("value"))
    batches = ct.counter(events, ["total", "user_id"], {"classes": F.col("event_type"), "reasons": reason}, {"scanned": F.lit(1), "seconds": F.col("value")}, {"samples": sample}, "event_id", 3)
    batches = batches.withColumn("largest", F.col("scanned"))
    merged = ct.merge_counters(batches, ["total"], ["scanned", "seconds"], ["classes", "reasons"], ["samples"], "user_id", 7, ["largest"])
    line = lambda section, name, n, shown=F.lit(""): F.struct(F.lit(section).alias("section"), name.alias("name"), n.cast("long").alias("n"), shown.alias("shown"))
    entries = lambda section: F.transform(F.map_entries(section), lambda e: line(section, e["key"], e["value"]))
    fixed = F.array(
        line("rows", F.lit("scanned"), F.col("scanned")), line("rows", F.lit("batches"), F.col("batches")), line("largest", F.lit("rows"), F.col("largest")),
        line("timing", F.lit("seconds"), F.lit(None), F.format_string("%.2f", F.round("seconds", 4))),
    )
    samples = F.transform(F.map_entries("samples"), lambda e: line("samples", e["key"], F.size(e["value"]), F.array_join(F.transform(e["value"], lambda v: v.cast("string")), ",")))
    return merged.select("total", F.inline(F.concat(fixed, entries("classes"), entries("reasons"), samples)))


@query(f"""WITH {RELEASES}, c AS (SELECT request_id, seeders % 7 AS v, pos, count(*) OVER (PARTITION BY request_id, seeders % 7 ORDER BY pos) AS seen FROM releases WHERE seeders IS NOT NULL AND type = 'p2p'),
f AS (SELECT request_id, min_by(v, pos) AS v FROM (SELECT *, max(seen) OVER (PARTITION BY request_id) AS most FROM c) WHERE seen = most GROUP BY 1)
SELECT DISTINCT r.request_id, CAST(coalesce(f.v, 0) AS DOUBLE) AS mode FROM releases r LEFT JOIN f USING (request_id)""")
def sel_mode(spark, sf_dir):
    """The value that first reaches the highest frequency, over some rows of a request."""
    rows = releases(spark, sf_dir).withColumn("seeders", F.col("seeders") % 7)
    return rows.select("request_id", sel.compile_value("mode(values(type(streams, 'p2p'), 'seeders'))", rows).alias("mode")).distinct()


_SOURCE = """SELECT l_orderkey * 10 + l_linenumber AS row_id, CASE WHEN l_suppkey % 8 = 7 THEN 'unlisted' ELSE concat('s', cast(l_suppkey % 8 as {text})) END AS source_id,
    CASE l_suppkey % 8 WHEN 3 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Yours' ELSE 'Cast' END WHEN 4 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Usenet box' ELSE 'Box' END
        WHEN 6 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'Instant' ELSE 'Slow' END ELSE CASE WHEN l_linenumber % 2 = 0 THEN '[SA+] 9 MB' ELSE 'plain 2 GB' END END AS name,
    CASE l_suppkey % 8
        WHEN 1 THEN concat('Folder ', cast(l_partkey % 1000 as {text}), '\n', p_name, '.2001.mkv\n👤 ', cast(l_linenumber as {text}), ' 💾 3 GB ⚙️ Index One')
        WHEN 2 THEN CASE WHEN l_linenumber = 5 THEN '🚫 Streams Found\n⚙️ Filtered' WHEN l_linenumber = 6 THEN 'Content Warning' WHEN l_linenumber = 4 THEN concat('📂 ', p_name, ' 2001 mkv\n💾 3 GB / 💾 4 GB\n🔗 Site A 👤 4')
            ELSE concat('📂 Pack ', cast(l_partkey as {text}), ' ┈➤ ', p_name, ' 2001 mkv\n💾 3 GB / 💾 40 GB\n🔗 Site A 👤 ', cast(l_linenumber as {text})) END
        WHEN 3 THEN CASE WHEN l_linenumber % 3 = 0 THEN 'Cast a file' ELSE concat('📦 5 GB\n', replace(p_name, ' ', '-\n'), '.mkv') END
        WHEN 6 THEN concat(p_name, '.2001.mkv\nSize: 3 GB | Age: ', cast(l_linenumber as {text}), 'd\nSource: Index Two', CASE WHEN l_linenumber = 3 THEN '\nClick play to start' ELSE '' END)
        ELSE CASE WHEN l_linenumber = 7 THEN 'Public rate-limit exceeded' ELSE concat('Best\n', p_name, '.2001.mkv 1h30m\n👥 12 💾 3 GB 🌐 Index Three 🎬') END END AS title,
    CASE WHEN l_suppkey % 8 = 1 THEN concat('https://h.x/resolve/svc/key/', md5(cast(l_partkey as {text})), '/name/', cast(l_linenumber as {text}), '/file.mkv')
        WHEN l_suppkey % 8 = 5 AND l_linenumber % 2 = 0 THEN concat('http://h.x/a-', md5(cast(l_partkey as {text})), substring(md5(cast(l_partkey as {text})), 1, 8), '/f.m3u8') END AS url,
    CASE WHEN l_suppkey % 8 = 0 THEN 'abc' END AS "infoHash", CASE WHEN l_suppkey % 8 = 4 THEN concat('g|', md5(cast(l_partkey as {text})), substring(md5(cast(l_partkey as {text})), 1, 8)) END AS binge_group,
    CASE WHEN l_suppkey % 8 = 0 AND l_linenumber = 1 THEN 2.6 END AS hint_size, CASE WHEN l_suppkey % 8 = 6 THEN l_linenumber - 2 END AS row_seeders, l_suppkey % 8 AS k, l_linenumber AS n, p_name, l_partkey
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
_STRATEGY = {"s0": "default", "s1": "first_line_folder", "s2": "arrow_folder", "s3": "boxed_lines", "s4": "store", "s5": "usenet", "s6": "labelled"}
_HASH = "md5(CAST(l_partkey AS VARCHAR)) || substring(md5(CAST(l_partkey AS VARCHAR)), 1, 8)"


@query(f"""WITH r AS ({_SOURCE.format(text="varchar").replace(chr(92) + "n", chr(10))}), g AS (SELECT *, CASE WHEN k = 2 AND n = 6 THEN 'Content Warning' WHEN k NOT IN (1, 2, 3, 6) AND n = 7 THEN 'Public rate limit exceeded' END AS failure FROM r WHERE NOT (k = 2 AND n = 5))
SELECT row_id, failure, CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 2 THEN replace(p_name, ' ', '.') || '.2001.mkv' WHEN k = 3 THEN CASE WHEN n % 3 > 0 THEN replace(p_name, ' ', '') || '.mkv' END
    WHEN k IN (1, 6) THEN p_name || '.2001.mkv' ELSE p_name || '.2001.mkv 1h30m' END AS filename,
    CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 1 THEN 'Folder ' || CAST(l_partkey % 1000 AS VARCHAR) WHEN k = 2 AND n <> 4 THEN 'Pack ' || CAST(l_partkey AS VARCHAR) END AS folder,
    CAST(CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 0 AND n = 1 THEN 3 WHEN k = 3 THEN CASE WHEN n % 3 > 0 THEN 5368709120 END ELSE 3221225472 END AS BIGINT) AS size,
    CAST(CASE WHEN failure IS NULL AND k = 2 THEN CASE WHEN n = 4 THEN 4294967296 ELSE 42949672960 END END AS BIGINT) AS folder_size,
    CASE WHEN failure IS NOT NULL OR k = 3 THEN NULL WHEN k = 1 THEN 'Index One' WHEN k = 2 THEN 'Site A' WHEN k = 6 THEN 'Index Two' ELSE 'Index Three' END AS indexer,
    CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 6 THEN 'svc_t' WHEN k NOT IN (3, 4) AND n % 2 = 0 THEN 'svc_a' END AS service,
    CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 6 THEN n % 2 = 0 OR n = 3 WHEN k NOT IN (3, 4) AND n % 2 = 0 THEN true END AS cached,
    CAST(CASE WHEN failure IS NULL AND k IN (0, 4, 5, 7) THEN 5400000 END AS BIGINT) AS duration,
    CASE WHEN failure IS NOT NULL THEN NULL WHEN k = 5 THEN 'usenet' WHEN k = 4 AND n % 2 = 0 THEN 'usenet' WHEN k = 6 OR (k NOT IN (3, 4) AND n % 2 = 0) THEN 'debrid' WHEN k = 1 THEN 'http' WHEN k = 0 THEN 'p2p' END AS type,
    CASE WHEN failure IS NULL THEN (k = 3 AND n % 2 = 0) OR (k = 6 AND n = 3) END AS library, CASE WHEN k = 6 THEN CAST(n * 24 AS DOUBLE) END AS age,
    CASE WHEN k = 3 AND n % 3 = 0 THEN CASE WHEN n % 2 = 0 THEN 'Yours' ELSE 'Cast' END || ' - Cast a file' END AS message,
    CASE WHEN k = 0 THEN 'abc' WHEN failure IS NOT NULL THEN NULL WHEN k = 4 AND n % 2 > 0 THEN {_HASH} WHEN k = 5 AND n % 2 = 0 THEN {_HASH} END AS info_hash,
    CAST(CASE WHEN failure IS NOT NULL OR k = 3 THEN NULL WHEN k = 1 THEN n WHEN k = 2 THEN n WHEN k = 6 THEN CASE WHEN n > 2 THEN n - 2 END ELSE 12 END AS INT) AS seeders,
    CAST(CASE WHEN k = 1 THEN n END AS INT) AS file_index FROM g""")
def source_rows(spark, sf_dir):
    """Raw rows of eight sources, seven of them of kinds of their own, in one plan."""
    raw = stated(spark, sf_dir, _SOURCE.format(text="string").replace('"infoHash"', "infoHash"), "lineitem", "part").drop("k", "n", "p_name", "l_partkey")
    sources = spark.createDataFrame(list(_STRATEGY.items()), "source_id string, strategy string")
    read = st.source_rows(raw, sources, [("svc_a", "[SA")], st.STRATEGIES | {"labelled": st.tagged("svc_t")})
    fields = ["failure", "filename", "folder", "size", "folder_size", "indexer", "duration", "type", "library", "age", "message", "info_hash", "seeders", "file_index"]
    return read.select("row_id", *fields, F.col("service.id").alias("service"), F.col("service.cached").alias("cached"))


@query(f"""WITH {RELEASES}, r AS (SELECT *, CASE request_id % 3 WHEN 0 THEN 'movie' ELSE 'series' END AS kind, request_id % 4 = 1 AS anime, CASE WHEN pos % 9 > 0 THEN size * 8 // 5400 END AS rate FROM releases),
o AS (SELECT *, CASE WHEN kind = 'movie' THEN CASE WHEN resolution = '2160p' THEN size < 4000000000 WHEN resolution = '720p' THEN size > 6000000000 ELSE size < 2000000000 END
        WHEN anime THEN CASE WHEN resolution = '2160p' THEN size > 7000000000 ELSE size > 5000000000 END ELSE CASE WHEN resolution = '720p' THEN size < 1500000000 ELSE size < 3000000000 END END AS by_size,
    coalesce(CASE WHEN kind = 'movie' THEN false WHEN anime THEN rate < 3000000 ELSE resolution = '1080p' AND rate > 9000000 END, false) AS by_rate,
    coalesce((type = 'p2p' AND coalesce(seeders, 0) < 10) OR (type = 'debrid' AND coalesce(cached, false) AND coalesce(seeders, 0) < 20), false) AS by_seeders FROM r)
SELECT id, CASE WHEN by_seeders THEN 'removed: required seeders range' WHEN coalesce(by_size, false) THEN 'removed: size range' WHEN by_rate THEN 'removed: bitrate range' END AS reason,
    NOT (source_id IN ('src1', 'src2') AND request_id % 5 = 0) AS survives FROM o""")
def kind_ranges(spark, sf_dir):
    """Ranges by class, by resolution and by kind of request; and rows that a closed release gate leaves, those of sources it does not watch."""
    r, k = flt.Range, flt.KindRanges
    rows = releases(spark, sf_dir).withColumns({"request_type": F.when(F.col("request_id") % 3 == 0, "movie").otherwise("series"), "is_anime": F.col("request_id") % 4 == 1, "bitrate": F.when(F.col("pos") % 9 > 0, F.expr("size * 8 div 5400"))})
    sizes = {"2160p": k(movies=r(low=4e9), anime=r(high=7e9)), "720p": k(movies=r(high=6e9), series=r(low=1.5e9))}
    profile = flt.Profile(
        required_ranges={"seeders": r(low=10, on=("p2p",))}, kind_sizes=sizes, kind_size=k(movies=r(low=2e9), series=r(low=3e9), anime=r(high=5e9)),
        kind_bitrates={"1080p": k(series=r(high=9e6))}, kind_bitrate=k(anime=r(low=3e6)),
    )
    cached = flt.Profile(required_ranges={"seeders": r(low=20, on=("cached",))})
    marked = flt.decide(rows, profile).withColumn("one", F.col("reason")).drop("reason", "keep")
    both = flt.decide(marked, cached).withColumn("reason", F.coalesce("reason", "one"))
    left = flt.release_survivors(both, F.col("request_id") % 5 != 0, ["src1", "src2"]).select("id", F.lit(True).alias("_left"))
    return both.join(left, "id", "left").select("id", "reason", F.coalesce("_left", F.lit(False)).alias("survives"))
