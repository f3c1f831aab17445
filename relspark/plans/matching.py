"""Matching results with requests, intake rules and choices of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing as ps
from ..operators import matching as mc
from ..operators import statistics as st
from .bridge import RELEASES, releases
from .registry import query, table


@query(f"WITH {RELEASES} SELECT id, CASE WHEN resolution IS NULL THEN true ELSE year >= 1998 - 1 AND year <= 1999 + 1 END AS loose, CASE WHEN resolution IS NULL THEN false ELSE year >= 1998 - 1 AND year <= 1999 + 1 END AS strict FROM releases")
def year_rules(spark, sf_dir):
    """Year ranges with tolerance; a missing year fails strict rules only."""
    year = F.when(F.col("resolution").isNotNull(), F.col("year"))
    ok = lambda strict: mc.year_match(year, F.lit(1998), F.lit(1999), 1, strict)
    return releases(spark, sf_dir).select("id", ok(False).alias("loose"), ok(True).alias("strict"))


@query(f"""WITH {RELEASES}, e AS (SELECT id, CASE WHEN season <= 5 THEN [season] ELSE [] END AS s, CASE WHEN seeders IS NULL THEN [] ELSE [seeders % 12, seeders % 12 + 1] END AS p FROM releases)
SELECT id, (len(s) = 0 OR list_contains(s, 2)) AND (len(p) = 0 OR list_contains(p, 7)) OR ((len(s) = 0 OR list_contains(s, 1)) AND len(p) > 0 AND list_contains(p, 9)) AS ok FROM e""")
def episode_rules(spark, sf_dir):
    """Season and episode with an absolute number as stand-in."""
    none = F.array().cast("array<int>")
    seasons = F.when(F.col("season") <= 5, F.array("season")).otherwise(none)
    episodes = F.when(F.col("seeders").isNull(), none).otherwise(F.array(F.col("seeders") % 12, F.col("seeders") % 12 + 1))
    return releases(spark, sf_dir).select("id", mc.episode_match(seasons, episodes, F.lit(2), F.lit(7), F.lit(9)).alias("ok"))


@query(f"""WITH {RELEASES} SELECT coalesce(CASE WHEN size < 1000000000 THEN 'too_small' END, CASE WHEN regexp_matches(title, '^blue') THEN 'code_prefix' END, CASE WHEN contains(title, 'gear') THEN 'parts' END, CASE WHEN contains(title, 'ring') OR contains(title, 'bolt') THEN 'hardware' END, 'kept') AS reason, CAST(count(*) AS BIGINT) AS n FROM releases GROUP BY 1""")
def intake_filter(spark, sf_dir):
    """Ordered intake reasons, counted."""
    reason = mc.intake_reason(F.col("title"), F.col("size"), [("parts", ["gear"]), ("hardware", ["ring", "bolt"])], 1_000_000_000, "^blue")
    return releases(spark, sf_dir).groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus IN ('F', 'P') AND coalesce(nullif(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END END, '')) IS NULL AS dropped FROM orders")
def id_required(spark, sf_dir):
    """Classes that need an id and have none."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(k % 3 == 0, "").when(k % 2 == 0, F.col("o_orderpriority")).alias("imdb"))
    return mc.identified(rows, "o_orderstatus", ["F", "P"], ["imdb"]).select("o_orderkey", "dropped")


@query("""WITH s AS (SELECT user_id, round(avg(value), 6) AS score, count(*) AS samples, round(avg(length(props)), 6) AS quality FROM events GROUP BY 1)
SELECT user_id, CASE WHEN row_number() OVER (ORDER BY score DESC, samples DESC, quality DESC, user_id) <= 8 THEN 'fast' ELSE 'slow' END AS lane FROM s""")
def fast_slow_split(spark, sf_dir):
    """Eight best sources by score, samples and quality of their rows."""
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.avg("value"), 6).alias("score"), F.count("*").alias("samples"), F.round(F.avg(F.length("props")), 6).alias("quality"))
    return mc.fast_slow(s, "user_id", ["score", "samples", "quality"]).select("user_id", "lane")


@query("""WITH s AS (SELECT user_id, round(avg(value) / 100, 6) AS score, avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) < 0.25 AS eligible FROM events GROUP BY 1),
c AS (SELECT *, coalesce(eligible AND score >= 0.4, false) AS core FROM s), r AS (SELECT *, row_number() OVER (ORDER BY core DESC, score DESC NULLS LAST, user_id) AS place FROM c),
e AS (SELECT user_id, row_number() OVER (ORDER BY md5('7:' || CAST(user_id AS VARCHAR)), user_id) AS turn FROM r WHERE place > 20)
SELECT user_id, CASE WHEN core THEN 'core' ELSE 'backfill' END AS why FROM r WHERE place <= 20 UNION ALL SELECT user_id, 'explore' FROM e WHERE turn <= 2""")
def allow_list(spark, sf_dir):
    """Core sources, backfill and seeded exploration."""
    s = table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(F.avg("value") / 100, 6).alias("score"), st.share(F.col("event_type") == "error").alias("errors"))
    return mc.allow_list(s, "user_id", "score", F.col("errors") < 0.25, 20, 0.4, 0.1, 7).select("user_id", "why")


_HEAVY, _LIGHT = ("widget", "bolt"), ("small", "red")
_NOISE = " + ".join(f"{n} * len(list_filter(string_split(x, ' '), lambda w: w IN {words}))" for n, words in ((3, _HEAVY), (1, _LIGHT)))


@query(f"""WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN ['', ''] WHEN p_partkey % 5 = 0 THEN ['2019 07', '', '12'] WHEN p_partkey % 3 = 0 THEN [p_name || ' widget bolt', ''] ELSE [p_name, '2019'] END AS ts, p_size % 4 - 1 AS members FROM part),
k AS (SELECT p_partkey, members, list_filter(ts, lambda x: x <> '')[1:3] AS ts FROM c)
SELECT p_partkey, CASE WHEN len(ts) = 0 THEN 'no_clean_titles' WHEN len(list_filter(ts, lambda x: NOT regexp_full_match(x, '[0-9]+( [0-9]+)?'))) = 0 THEN 'cluster_numeric_only'
    WHEN len(list_filter(ts, lambda x: {_NOISE} < 6)) = 0 THEN 'cluster_noise_only' WHEN members <= 0 THEN 'empty_cluster' END AS reason FROM k""")
def low_value_clusters(spark, sf_dir):
    """Clusters that are not worth resolving: no titles, numbers, noise, no members."""
    k, name = F.col("p_partkey"), F.col("p_name")
    lit = lambda *xs: F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    titles = F.when(k % 7 == 0, lit("", "")).when(k % 5 == 0, lit("2019 07", "", "12")).when(k % 3 == 0, lit(F.concat(name, F.lit(" widget bolt")), "")).otherwise(lit(name, "2019"))
    rows = table(spark, sf_dir, "part").select("p_partkey", titles.alias("titles"), (F.col("p_size") % 4 - 1).alias("members"))
    noise = F.transform("titles", lambda t: ps.noise(t, _HEAVY, _LIGHT))
    return rows.select("p_partkey", mc.low_value(F.col("titles"), F.col("members"), noise).alias("reason"))
