"""Scores, coverage, votes and summaries over logs and catalogues."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import statistics as st
from .bridge import RELEASES, releases
from .registry import query, table

_ERR = "CASE WHEN value < 20 THEN 'timeout' WHEN value < 40 THEN 'forbidden' WHEN value < 60 THEN 'ratelimit' ELSE 'hard' END"


@query(f"""WITH u AS (SELECT user_id AS source, count(*) AS hits, avg(coalesce(value, 0)) AS seeders, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') AS days FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type <> 'error' GROUP BY 1),
e AS (SELECT user_id AS source, {_ERR} AS k FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND event_type = 'error'),
p AS (SELECT source, (0.45 * count(*) FILTER (k = 'timeout') + 0.30 * count(*) FILTER (k = 'forbidden') + 0.15 * count(*) FILTER (k = 'ratelimit') + 0.10 * count(*) FILTER (k = 'hard')) / count(*) AS penalty FROM e GROUP BY 1),
m AS (SELECT min(hits) AS h0, max(hits) AS h1, min(seeders) AS s0, max(seeders) AS s1, min(days) AS d0, max(days) AS d1 FROM u)
SELECT source, CAST(hits AS BIGINT) AS hits, round(0.35 * CASE WHEN h1 <= h0 THEN 1 ELSE (hits - h0) / (h1 - h0) END + 0.25 * CASE WHEN s1 <= s0 THEN 1 ELSE (seeders - s0) / (s1 - s0) END
    + 0.20 * CASE WHEN d1 <= d0 THEN 1 ELSE 1 - (days - d0) / (d1 - d0) END + 0.20 * (1 - coalesce(penalty, 0)), 6)::DOUBLE AS score FROM u LEFT JOIN p USING (source), m""")
def usage_scores(spark, sf_dir):
    """Usage in a rolling window, min-max scaled, less a penalty for the kinds of errors."""
    recent = table(spark, sf_dir, "events").where("ts >= timestamp_ntz'2024-01-10 00:00:00'")
    used = recent.where("event_type <> 'error'").groupBy(F.col("user_id").alias("source")).agg(
        F.count("*").alias("hits"), F.avg(F.coalesce("value", F.lit(0.0))).alias("seeders"), F.datediff(F.lit("2024-01-31"), F.max("ts").cast("date")).alias("days")
    )
    kind = F.expr(_ERR)
    penalty = sum((w * F.count_if(kind == k) for k, w in st.PENALTY.items()), F.lit(0.0)) / F.count("*")
    failed = recent.where("event_type = 'error'").groupBy(F.col("user_id").alias("source")).agg(penalty.alias("penalty"))
    rows = used.join(failed, "source", "left").withColumn("reliability", 1 - F.coalesce("penalty", F.lit(0.0)))
    rows = st.scaled_by(rows, {"hits": "h", "seeders": "s", "days": "d"}, inverted=["days"])
    w = st.USAGE
    score = w["hits"] * F.col("h") + w["seeders"] * F.col("s") + w["recency"] * F.col("d") + w["reliability"] * F.col("reliability")
    return rows.select("source", "hits", F.round(score, 6).alias("score"))


@query("""WITH p AS (SELECT user_id AS source, count(*) AS n, avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) AS success, quantile_cont(value / 25, 0.95) AS p95, avg(length(props)) AS mean_items FROM events GROUP BY 1),
c AS (SELECT min(p95) AS low, max(p95) AS high, quantile_cont(mean_items, 0.9) AS cap FROM p),
s AS (SELECT *, greatest(least(0.4 * success + 0.3 * CASE WHEN high = low THEN 1 ELSE 1 - (p95 - low) / (high - low) END + 0.2 * greatest(least(mean_items / cap, 1), 0) - 0.1 * (1 - success), 1), 0) AS score FROM p, c)
SELECT source, CAST(n AS BIGINT) AS n, round(success, 6) AS success, round(p95, 4) AS p95, round(mean_items, 6) AS mean_items, round(score, 6) AS score,
    success >= 0.7 AND p95 <= 6 AND 1 - success <= 0.2 AND score >= 0.55 AS included FROM s""")
def probe_scores(spark, sf_dir):
    """Probe statistics per source with exact interpolated percentiles, scaled latency, capped volume and inclusion gates."""
    probes = table(spark, sf_dir, "events").withColumn("items", F.length("props")).withColumn("seconds", F.col("value") / 25)
    rows = st.probe_score(st.probe_stats(probes, "user_id", F.col("event_type") != "error", "seconds", "items"))
    return rows.select(F.col("user_id").alias("source"), "n", *[F.round(c, d).alias(c) for c, d in (("success", 6), ("p95", 4), ("mean_items", 6), ("score", 6))], "included")


@query("""WITH r AS (SELECT user_id AS source, CAST(ts AS DATE) AS d, avg(CASE WHEN event_type <> 'error' THEN 1.0 ELSE 0.0 END) AS s, avg(CASE WHEN value > 20 THEN 1.0 ELSE 0.0 END) AS e FROM events GROUP BY 1, 2)
SELECT source, round(greatest(0, 1 - (0.6 * CASE WHEN count(*) > 1 THEN stddev_pop(e) ELSE 0 END + 0.4 * CASE WHEN count(*) > 1 THEN stddev_pop(s) ELSE 0 END)), 6)::DOUBLE AS stability FROM r GROUP BY 1""")
def probe_stability(spark, sf_dir):
    """Two-level aggregate: rates per day, then their spread."""
    rates = table(spark, sf_dir, "events").select(F.col("user_id").alias("source"), F.to_date("ts").alias("d"), (F.col("event_type") != "error").cast("double").alias("s"), (F.col("value") > 20).cast("double").alias("e"))
    return st.stability(rates, "source", "d", "s", "e").select("source", F.round("stability", 6).alias("stability"))


@query("""SELECT event_type, CAST(count(*) AS BIGINT) AS n, round(median(value), 6) AS median_s, (list_sort(list(value)))[greatest(CAST(floor(count(*) * 0.95) AS INT), 1)] AS p95_s,
    CAST(count(*) FILTER (value = 0) AS BIGINT) AS zero, CAST(count(*) FILTER (value > 100) AS BIGINT) AS slow FROM events WHERE value IS NOT NULL GROUP BY 1""")
def request_summary(spark, sf_dir):
    """Median, truncated-index percentile and conditional counts."""
    rows = table(spark, sf_dir, "events").where("value is not null")
    counts = rows.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.median("value"), 6).alias("median_s"), F.count_if(F.col("value") == 0).alias("zero"), F.count_if(F.col("value") > 100).alias("slow"))
    return counts.join(st.truncated_p95(rows, ["event_type"], "value", "p95_s"), "event_type")


@query("""WITH a AS (SELECT event_type, median(value) AS m, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1), b AS (SELECT event_type, median(value) AS m, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT event_type, round(b.m - a.m, 6) AS median_delta, CAST(b.n - a.n AS BIGINT) AS n_delta FROM a FULL JOIN b USING (event_type)""")
def run_comparison(spark, sf_dir):
    """Differences between two runs; null where a run has no rows."""
    side = lambda c, s: table(spark, sf_dir, "events").where(c).groupBy("event_type").agg(F.median("value").alias(f"m{s}"), F.count("*").alias(f"n{s}"))
    both = side("ts < timestamp_ntz'2024-01-15 00:00:00'", 0).join(side("ts >= timestamp_ntz'2024-01-15 00:00:00'", 1), "event_type", "full")
    return both.select("event_type", F.round(F.col("m1") - F.col("m0"), 6).alias("median_delta"), (F.col("n1") - F.col("n0")).alias("n_delta"))


@query("""WITH c AS (SELECT lang, count(*) AS total, count(l.doc_id) AS known FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY GROUPING SETS ((lang), ()))
SELECT coalesce(lang, 'all') AS class, CAST(total AS BIGINT) AS total, CAST(known AS BIGINT) AS known, round(100.0 * known / total, 2)::DOUBLE AS percent,
    CASE WHEN round(100.0 * known / total, 2) >= 80 THEN 'GREEN' WHEN round(100.0 * known / total, 2) >= 60 THEN 'AMBER' ELSE 'RED' END AS status FROM c""")
def coverage_slo(spark, sf_dir):
    """Coverage per class and overall in one pass, with its traffic light."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    c = rows.groupingSets([["lang"], []], "lang").agg(F.count("*").alias("total"), F.count("hit").alias("known"))
    percent = F.round(100.0 * F.col("known") / F.col("total"), 2)
    return c.select(F.coalesce("lang", F.lit("all")).alias("class"), "total", "known", percent.alias("percent"), st.slo_status(percent).alias("status"))


@query("""WITH k AS (SELECT o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'i' || CAST(o_custkey % 3 AS VARCHAR) END AS imdb, CASE WHEN o_orderkey % 5 = 0 THEN 't' || CAST(o_custkey % 3 AS VARCHAR) END AS tmdb FROM orders)
SELECT o_custkey, max(imdb) AS imdb, max(tmdb) AS tmdb FROM k WHERE imdb IS NOT NULL OR tmdb IS NOT NULL GROUP BY 1 HAVING count(DISTINCT coalesce(imdb, '') || '/' || coalesce(tmdb, '')) = 1""")
def unique_pair_groups(spark, sf_dir):
    """Groups that know one pair of ids only."""
    return st.unique_pairs(_identified(spark, sf_dir), ["o_custkey"], "imdb", "tmdb")


def _identified(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "CASE WHEN o_orderkey % 7 = 0 THEN 'i' || cast(o_custkey % 3 as string) END AS imdb", "CASE WHEN o_orderkey % 5 = 0 THEN 't' || cast(o_custkey % 3 as string) END AS tmdb")


@query("""WITH k AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'i' || CAST(o_custkey % 3 AS VARCHAR) END AS imdb, CASE WHEN o_orderkey % 5 = 0 THEN 't' || CAST(o_custkey % 3 AS VARCHAR) END AS tmdb FROM orders),
u AS (SELECT o_custkey, max(imdb) AS gi, max(tmdb) AS gt FROM k WHERE imdb IS NOT NULL OR tmdb IS NOT NULL GROUP BY 1 HAVING count(DISTINCT coalesce(imdb, '') || '/' || coalesce(tmdb, '')) = 1)
SELECT o_orderkey, coalesce(imdb, gi) AS imdb, coalesce(tmdb, gt) AS tmdb FROM k JOIN u USING (o_custkey) WHERE imdb IS NULL AND tmdb IS NULL""")
def propagate_ids(spark, sf_dir):
    """Unresolved rows inherit the only pair of their group."""
    rows = _identified(spark, sf_dir)
    pairs = st.unique_pairs(rows, ["o_custkey"], "imdb", "tmdb").toDF("o_custkey", "gi", "gt")
    open_ = rows.where("imdb is null and tmdb is null").join(pairs, "o_custkey")
    return open_.select("o_orderkey", F.coalesce("imdb", "gi").alias("imdb"), F.coalesce("tmdb", "gt").alias("tmdb"))


@query("""SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN max(o_orderstatus) ELSE 'mixed' END AS status, coalesce(max(nullif(o_orderpriority, '')), 'none') AS priority FROM orders GROUP BY 1""")
def only_value_or_key(spark, sf_dir):
    """The single value of a group, else a derived one; first non-empty across columns."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(st.only_value(F.col("o_orderstatus"), F.lit("mixed")).alias("status"), F.coalesce(F.max(F.nullif(F.col("o_orderpriority"), F.lit(""))), F.lit("none")).alias("priority"))


@query("""WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n, min(o_orderkey) AS f FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, f) AS rn FROM c)
SELECT o_custkey, o_orderpriority, CAST(n AS BIGINT) AS votes FROM r WHERE rn = 1""")
def mode_first_seen(spark, sf_dir):
    """Most frequent value, of several the one seen first."""
    return st.mode_first(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("""WITH y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INT) AS yr, count(*) AS n, min(l_orderkey) AS f FROM lineitem GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, f) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS d, sum(n) OVER (PARTITION BY l_suppkey) AS t FROM y)
SELECT l_suppkey, CASE WHEN NOT (d > 2 AND n <= greatest(2, floor(t / 2))) THEN yr END AS yr FROM b WHERE rn = 1""")
def guarded_year(spark, sf_dir):
    """The year of a cluster, unless more than two stand without a majority."""
    return st.guarded_mode(table(spark, sf_dir, "lineitem").withColumn("yr", F.year("l_shipdate")), ["l_suppkey"], "yr", "l_orderkey")


@query("""WITH v AS (SELECT l_suppkey, p_name AS title, 3 AS w FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 2 UNION ALL SELECT l_suppkey, p_brand, 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber > 2),
s AS (SELECT l_suppkey, title, sum(w) AS weight FROM v GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY weight DESC, CASE WHEN title LIKE '%#%' THEN 1 ELSE 0 END, length(title), title) AS place FROM s)
SELECT l_suppkey, title, CAST(weight AS BIGINT) AS weight, CAST(place AS INT) AS place FROM r WHERE place <= 6""")
def weighted_titles(spark, sf_dir):
    """Weighted vote for titles with ties by noise, length and text."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    votes = rows.select("l_suppkey", F.when(F.col("l_linenumber") <= 2, F.col("p_name")).otherwise(F.col("p_brand")).alias("title"), F.when(F.col("l_linenumber") <= 2, 3).otherwise(1).alias("w"))
    return st.weighted_vote(votes, ["l_suppkey"], "title", "w", F.when(F.col("title").contains("#"), 1).otherwise(0), 6)


@query("""WITH h AS (SELECT user_id % 20 AS k, 'o' || CAST(user_id % 3 AS VARCHAR) AS owner, avg(value) AS score FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1, 2), p AS (SELECT user_id % 20 AS k, 'o' || CAST(min(user_id) % 3 AS VARCHAR) AS prev FROM events GROUP BY 1),
j AS (SELECT *, max(score) OVER (PARTITION BY k) AS best, row_number() OVER (PARTITION BY k ORDER BY score DESC, owner) AS rn FROM h JOIN p USING (k))
SELECT k AS "key", coalesce(max(CASE WHEN owner = prev AND best - score < 2 THEN owner END), max(CASE WHEN rn = 1 THEN owner END)) AS owner FROM j GROUP BY 1""")
def hysteresis_owner(spark, sf_dir):
    """Best owner of a key, sticky below a margin."""
    events = table(spark, sf_dir, "events").withColumn("key", F.col("user_id") % 20)
    now = events.where("ts >= timestamp_ntz'2024-01-15 00:00:00'").groupBy("key", F.concat(F.lit("o"), (F.col("user_id") % 3).cast("string")).alias("owner")).agg(F.avg("value").alias("score"))
    before = events.groupBy("key").agg(F.concat(F.lit("o"), (F.min("user_id") % 3).cast("string")).alias("previous"))
    return st.sticky_owner(now.join(before, "key"), "key", "owner", "score", "owner", "previous", 2.0)


_UNITS = "TRY_CAST(round(value * 1e9) AS BIGINT)"
_MEAN = f"coalesce(CASE WHEN count({_UNITS}) = count(value) THEN CAST(sum({_UNITS}) AS DOUBLE) / count(value) / 1e9 END, avg(value))"


@query(f"""WITH a AS (SELECT user_id, {_MEAN} AS s FROM events WHERE ts < TIMESTAMP '2024-01-12' GROUP BY 1), b AS (SELECT user_id, {_MEAN} AS s FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1),
o AS (SELECT user_id, CASE WHEN b.s IS NULL OR a.s >= b.s THEN 'left' ELSE 'right' END AS side, greatest(coalesce(a.s, b.s), coalesce(b.s, a.s)) AS score FROM a FULL JOIN b USING (user_id))
SELECT user_id, side, round(score, 6) AS score, CAST(row_number() OVER (PARTITION BY side ORDER BY score DESC, user_id) AS INT) AS place FROM o""")
def overlap_resolution(spark, sf_dir):
    """Two ranked lists made disjoint; equal means are ties, in whatever order their values were added."""
    events = table(spark, sf_dir, "events")
    side = lambda c: events.where(c).groupBy("user_id").agg(st.steady_mean(F.col("value")).alias("score"))
    found = st.resolve_overlaps(side("ts < timestamp_ntz'2024-01-12 00:00:00'"), side("ts >= timestamp_ntz'2024-01-20 00:00:00'"), "user_id", "score")
    return found.withColumn("score", F.round("score", 6))


@query("""WITH a AS (SELECT user_id % 10 AS k, list(DISTINCT event_type || CAST(CAST(value AS INT) % 5 AS VARCHAR)) AS s FROM events WHERE ts < TIMESTAMP '2024-01-02' AND value IS NOT NULL GROUP BY 1), b AS (SELECT user_id % 10 AS k, list(DISTINCT event_type || CAST(CAST(value AS INT) % 5 AS VARCHAR)) AS s FROM events WHERE ts >= TIMESTAMP '2024-01-29' AND value IS NOT NULL GROUP BY 1)
SELECT k, round((len(a.s) + len(b.s) - 2 * len(list_intersect(a.s, b.s))) / greatest(len(a.s), len(b.s)), 6) AS ratio FROM a JOIN b USING (k)""")
def membership_change(spark, sf_dir):
    """Members that came or went over the size of the larger set."""
    rows = table(spark, sf_dir, "events").where("value is not null").withColumn("k", F.col("user_id") % 10).withColumn("m", F.concat("event_type", (F.bround("value").cast("int") % 5).cast("string")))
    side = lambda c, n: rows.where(c).groupBy("k").agg(F.collect_set("m").alias(n))
    both = side("ts < timestamp_ntz'2024-01-02 00:00:00'", "a").join(side("ts >= timestamp_ntz'2024-01-29 00:00:00'", "b"), "k")
    return both.select("k", F.round(st.change_ratio(F.col("a"), F.col("b")), 6).alias("ratio"))


@query("""SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS a_qty, max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS n_qty, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS r_qty FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NOT NULL GROUP BY 1""")
def conditional_pivot(spark, sf_dir):
    """Left-join chain pivoted by conditional maxima."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").where("l_orderkey is not null")
    return rows.groupBy("l_orderkey").agg(*[F.max(F.when(F.col("l_returnflag") == f, F.col("l_quantity"))).alias(f"{f.lower()}_qty") for f in "ANR"])


@query("""WITH a AS (SELECT doc_id, toxic = 1 AS x, quality = 0 AS y FROM labels) SELECT CAST(count(*) FILTER (x AND y) AS BIGINT) AS both_reject, CAST(count(*) FILTER (x AND NOT y) AS BIGINT) AS only_a, CAST(count(*) FILTER (NOT x AND y) AS BIGINT) AS only_b, CAST(count(*) FILTER (NOT x AND NOT y) AS BIGINT) AS neither FROM a""")
def confusion_counts(spark, sf_dir):
    """Agreement of two classifiers."""
    x, y = F.col("toxic") == 1, F.col("quality") == 0
    return table(spark, sf_dir, "labels").agg(F.count_if(x & y).alias("both_reject"), F.count_if(x & ~y).alias("only_a"), F.count_if(~x & y).alias("only_b"), F.count_if(~x & ~y).alias("neither"))


@query(f"WITH {RELEASES}, b AS (SELECT *, row_number() OVER (PARTITION BY resolution ORDER BY size DESC, request_id, pos) AS rn FROM releases WHERE resolution IS NOT NULL) SELECT resolution, id FROM b WHERE rn <= 3")
def bounded_samples(spark, sf_dir):
    """Three examples of each reason."""
    return st.bounded_samples(releases(spark, sf_dir).where("resolution is not null"), "resolution", [F.col("size").desc(), F.col("request_id"), F.col("pos")], 3).select("resolution", "id")


_KIND = "CASE event_type WHEN 'view' THEN 'movies' WHEN 'click' THEN 'series' WHEN 'signup' THEN 'anime' WHEN 'purchase' THEN 'Movie' ELSE 'other' END"
_PROVIDER = "CASE user_id % 4 WHEN 0 THEN 'Tokyo' WHEN 1 THEN 'EzTV' WHEN 2 THEN 'Plain' ELSE 'Movie4K' END || ' ' || user_id % 40"


@query(f"""WITH e AS (SELECT user_id % 40 AS source, user_id // 40 % 2 AS service, {_KIND} AS kind, {_PROVIDER.replace("user_id % 40", "CAST(user_id % 40 AS VARCHAR)")} AS name,
    coalesce(value > CASE user_id % 5 WHEN 0 THEN 1000 ELSE 110 END, false) AS hit, coalesce(value > 15 + user_id % 40, false) AS ok FROM events),
p AS (SELECT source, service, kind, avg(CASE WHEN hit AND ok THEN 1.0 ELSE 0.0 END) AS rate FROM e GROUP BY ALL),
s AS (SELECT source, max(success) AS success, max(filled) AS filled, lower(min(name)) AS name FROM (SELECT source, service, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) AS success, avg(CASE WHEN hit THEN 1.0 ELSE 0.0 END) AS filled, min(name) AS name FROM e GROUP BY ALL) GROUP BY 1),
c AS (SELECT source, success, filled,
    0.45 * (SELECT count(*) FROM p WHERE p.source = s.source AND lower(kind) IN ('movies', 'movie') AND rate >= 0.05) + CASE WHEN regexp_matches(name, 'yts|movie|dvdr|bluray|4k') THEN 0.25 ELSE 0 END AS movies,
    0.45 * (SELECT count(*) FROM p WHERE p.source = s.source AND kind = 'series' AND rate >= 0.05) + CASE WHEN regexp_matches(name, 'eztv|series|tv|episode') THEN 0.25 ELSE 0 END AS series,
    0.45 * (SELECT count(*) FROM p WHERE p.source = s.source AND kind = 'anime' AND rate >= 0.05) + CASE WHEN regexp_matches(name, 'anime|nyaa|subsplease|bangumi|tokyo|dmhy|mikan|shana') THEN 0.55 ELSE 0 END AS anime FROM s)
SELECT source, round(movies, 6)::DOUBLE AS movies, round(series, 6)::DOUBLE AS series, round(anime, 6)::DOUBLE AS anime,
    coalesce(nullif(concat_ws(',', CASE WHEN movies >= 0.4 THEN 'movies' END, CASE WHEN series >= 0.4 THEN 'series' END, CASE WHEN anime >= 0.4 THEN 'anime' END), ''), 'movies,series') AS kinds,
    CASE WHEN filled = 0 THEN 'empty' WHEN success < 0.5 THEN 'degraded' ELSE 'working' END AS status FROM c""")
def content_support(spark, sf_dir):
    """Kinds of content that a source supports, by probes of its services and by its name, and its state."""
    k = F.col("user_id")
    name = F.concat(F.when(k % 4 == 0, "Tokyo").when(k % 4 == 1, "EzTV").when(k % 4 == 2, "Plain").otherwise("Movie4K"), F.lit(" "), (k % 40).cast("string"))
    probes = table(spark, sf_dir, "events").select((k % 40).alias("source"), (F.floor(k / 40) % 2).alias("service"), F.expr(_KIND).alias("kind"), name.alias("name"), k.alias("k"), "value")
    hit = F.coalesce(F.col("value") > F.when(F.col("k") % 5 == 0, 1000).otherwise(110), F.lit(False))
    ok = F.coalesce(F.col("value") > 15 + F.col("k") % 40, F.lit(False))
    found = st.content_support(probes, "source", "service", "kind", hit, ok, "name")
    return found.select("source", *[F.round(c, 6).alias(c) for c in st.KINDS], F.array_join("kinds", ",").alias("kinds"), "status")


@query("""WITH u AS (SELECT CASE l_linenumber % 3 WHEN 0 THEN upper(s_name) WHEN 1 THEN lower(s_name) ELSE s_name || 'x' END AS tracker, l_quantity AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT s_name AS known_name, s_suppkey, CAST(count(*) AS BIGINT) AS uses, sum(n) AS total FROM u JOIN supplier ON lower(s_name) = lower(tracker) GROUP BY 1, 2""")
def name_join(spark, sf_dir):
    """Usage of known names in any case; other names are skipped."""
    suppliers = table(spark, sf_dir, "supplier")
    line = table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    k = F.col("l_linenumber") % 3
    usage = line.select(F.when(k == 0, F.upper("s_name")).when(k == 1, F.lower("s_name")).otherwise(F.concat("s_name", F.lit("x"))).alias("name"), F.col("l_quantity").alias("n"))
    found = st.named_usage(usage, suppliers.select(F.col("s_name").alias("name"), "s_suppkey"), "name", "s_suppkey")
    return found.groupBy("known_name", "s_suppkey").agg(F.count("*").alias("uses"), F.sum("n").alias("total"))


@query("""WITH s AS (SELECT l_orderkey, l_linenumber AS season, count(*) AS eps FROM lineitem GROUP BY 1, 2) SELECT l_orderkey, CAST(season AS INT) AS season, CAST(coalesce(sum(eps) OVER (PARTITION BY l_orderkey ORDER BY season ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
    CAST(lead(season) OVER (PARTITION BY l_orderkey ORDER BY season) AS INT) AS next_season FROM s""")
def absolute_offset(spark, sf_dir):
    """Episodes before a season, and the season that follows."""
    s = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", F.col("l_linenumber").alias("season")).agg(F.count("*").alias("eps"))
    w = Window.partitionBy("l_orderkey").orderBy("season")
    return s.select("l_orderkey", "season", F.coalesce(F.sum("eps").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.lead("season").over(w).alias("next_season"))
