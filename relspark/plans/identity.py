"""Looking up, propagating and choosing identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing as ps
from ..operators import identity as idt
from .bridge import RELEASES, releases
from .registry import query, table


@query("""SELECT o_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR), ',' ORDER BY l_linenumber, l_partkey) AS files, CAST(count(*) AS BIGINT) AS n FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def files_grouped(spark, sf_dir):
    """Children of wanted keys as ordered arrays."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    found = idt.grouped_children(orders, table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", ["l_linenumber", "l_partkey"])
    return found.select("o_orderkey", F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["l_linenumber"].cast("string"), c["l_partkey"].cast("string"))), ",").alias("files"), F.size("children").cast("long").alias("n"))


@query("""WITH v AS (SELECT p_name AS title, p_partkey AS variant, p_size % 10 AS vy, p_retailprice AS evidence FROM part), q AS (SELECT p_partkey AS probe, p_name AS title, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 10 END AS yr FROM part),
r AS (SELECT probe, variant, row_number() OVER (PARTITION BY probe ORDER BY evidence DESC, variant) AS rn FROM q JOIN v USING (title) WHERE yr IS NULL OR vy IS NULL OR yr = vy) SELECT probe, variant FROM r WHERE rn = 1""")
def variant_lookup(spark, sf_dir):
    """One variant of a title for each probe: equal or unknown year, strongest evidence."""
    part = table(spark, sf_dir, "part")
    probes = part.select(F.col("p_partkey").alias("probe"), F.col("p_name").alias("title"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey") % 10).alias("yr"))
    # The strongest variant of a title and year is the only one that can win: at most ten a title meet the probes.
    variants = part.groupBy(F.col("p_name").alias("title"), (F.col("p_size") % 10).alias("vy")).agg(F.max(F.struct(F.col("p_retailprice").alias("evidence"), (-F.col("p_partkey")).alias("n"))).alias("b"))
    variants = variants.select("title", "vy", "b.evidence", (-F.col("b.n")).alias("variant"))
    return idt.best_match(probes, variants, ["title"], "probe", "yr", "vy", [F.desc("evidence"), F.col("variant")]).select("probe", "variant")


_PREFIX = """v AS (SELECT p_name AS variant, max(p_retailprice) AS evidence FROM part GROUP BY 1), q AS (SELECT p_partkey AS probe, p_name || ' season ' || CAST(p_size AS VARCHAR) AS title FROM part),
f AS (SELECT probe, array_to_string(w[1:len(w) - k], ' ') AS prefix FROM (SELECT probe, string_split(title, ' ') AS w FROM q), unnest(range(1, 4)) u(k) WHERE len(w) - k >= 1),
m AS (SELECT probe, variant, prefix, row_number() OVER (PARTITION BY probe ORDER BY length(prefix) DESC, evidence DESC, variant) AS rn FROM f JOIN v ON starts_with(variant, prefix) WHERE length(prefix) >= 3)"""


@query(f"WITH {_PREFIX} SELECT probe, variant, prefix FROM m WHERE rn = 1")
def prefix_lookup(spark, sf_dir):
    """Progressive prefixes of a title, longest first."""
    part = table(spark, sf_dir, "part")
    probes = part.selectExpr("p_partkey AS probe", "concat(p_name, ' season ', cast(p_size as string)) AS title")
    variants = part.groupBy(F.col("p_name").alias("variant")).agg(F.max("p_retailprice").alias("evidence"))
    return idt.prefix_match(probes, variants, "probe", "title", "variant", [F.desc("evidence"), F.col("variant")]).select("probe", "variant", "prefix")


@query("""WITH q AS (SELECT o_orderkey AS probe, o_custkey % 200 AS k, CAST(year(o_orderdate) AS INT) AS yr FROM orders), t AS (SELECT p_partkey % 200 AS k, 1995 + p_size % 8 AS ty, p_partkey AS cand FROM part),
a AS (SELECT probe, 0 AS tier, min(cand) AS cand FROM q JOIN t USING (k) WHERE yr = ty GROUP BY 1), b AS (SELECT probe, 1 AS tier, min(cand) AS cand FROM q JOIN t USING (k) WHERE abs(yr - ty) <= 1 GROUP BY 1), c AS (SELECT probe, 2 AS tier, min(cand) AS cand FROM q JOIN t USING (k) GROUP BY 1),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c) SELECT probe, CAST(min(tier) AS INT) AS tier, min_by(cand, tier) AS candidate FROM u GROUP BY 1""")
def cascade_match(spark, sf_dir):
    """Exact year, then a year of tolerance, then any: the first tier with an answer."""
    q = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("probe"), (F.col("o_custkey") % 200).alias("k"), F.year("o_orderdate").alias("yr"))
    t = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 200).alias("k"), (1995 + F.col("p_size") % 8).alias("ty")).agg(F.min("p_partkey").alias("cand"))
    gap = F.abs(F.col("yr") - F.col("ty"))
    # One join gives all tiers: the smallest candidate of each probe and tier, then the lowest tier.
    tier = F.when(gap == 0, 0).when(gap <= 1, 1).otherwise(2)
    per = q.join(t, "k").groupBy("probe").agg(F.min(F.struct(tier.alias("tier"), F.col("cand"))).alias("m"))
    return per.select("probe", F.col("m.tier").alias("tier"), F.col("m.cand").alias("candidate"))


@query(f"""WITH {RELEASES}, q AS (SELECT DISTINCT request_id, season AS asked FROM releases),
m AS (SELECT DISTINCT request_id, season AS start FROM releases WHERE season % 2 = 0),
j AS (SELECT request_id, asked, max(start) FILTER (start <= asked) AS last_start, min(start) AS first_start FROM q LEFT JOIN m USING (request_id) GROUP BY 1, 2)
SELECT request_id, CAST(asked AS INT) AS asked, CAST(last_start AS INT) AS start, CAST(coalesce(last_start, first_start) AS INT) AS chosen, last_start IS NOT NULL AS matched FROM j""")
def asof_mapping(spark, sf_dir):
    """The greatest start that is not behind the asked episode, and the first mapping where there is none."""
    rows = releases(spark, sf_dir)
    q = rows.select("request_id", F.col("season").alias("asked")).distinct()
    m = rows.where("season % 2 = 0").select("request_id", F.col("season").alias("start")).distinct()
    chosen = idt.latest_start(q, m, ["request_id"], "asked", "start", fallback=True)
    return chosen.select("request_id", "asked", F.when(F.col("matched"), F.col("start")).alias("start"), F.col("start").alias("chosen"), "matched")


@query("""WITH a AS (SELECT o_custkey AS k, CAST(min(year(o_orderdate)) AS INT) AS s, CAST(max(year(o_orderdate)) AS INT) AS e FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, CAST(min(year(o_orderdate)) AS INT) AS s, CAST(max(year(o_orderdate)) AS INT) AS e FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT k, a.s AS a_start, a.e AS a_end, b.s AS b_start, b.e AS b_end FROM a JOIN b USING (k) WHERE a.s - 1 <= b.e AND a.e + 1 >= b.s""")
def year_overlap(spark, sf_dir):
    """Year ranges that meet within a year."""
    side = lambda s, n: table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.min(F.year("o_orderdate")).alias(f"{n}_start"), F.max(F.year("o_orderdate")).alias(f"{n}_end"))
    both = side("F", "a").join(side("O", "b"), "k")
    return both.where(idt.overlapping(F.col("a_start"), F.col("a_end"), F.col("b_start"), F.col("b_end"), 1))


@query("""WITH r AS (SELECT page_id, url AS id, 'stream' AS resource, CASE WHEN page_id % 2 = 0 THEN 'movie' ELSE 'series' END AS type FROM pages),
c(source, resource, type, prefixes) AS (VALUES ('a', 'stream', 'movie', ['http://']), ('b', 'stream', 'series', ['https://m.', 'http://']), ('c', 'stream', 'movie', NULL), ('d', 'meta', 'movie', NULL))
SELECT page_id, source FROM r JOIN c USING (resource, type) WHERE prefixes IS NULL OR len(list_filter(prefixes, lambda p: starts_with(id, p))) > 0""")
def capability_routing(spark, sf_dir):
    """Sources that can answer a request: resource, type and id prefix; no prefixes match all."""
    requests = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("id"), F.lit("stream").alias("resource"), F.when(F.col("page_id") % 2 == 0, "movie").otherwise("series").alias("type"))
    capabilities = spark.createDataFrame(
        [("a", "stream", "movie", ["http://"]), ("b", "stream", "series", ["https://m.", "http://"]), ("c", "stream", "movie", None), ("d", "meta", "movie", None)], "source string, resource string, type string, prefixes array<string>"
    )
    return idt.capable(requests, capabilities).select("page_id", "source")


@query(f"""WITH {RELEASES}, t AS (SELECT id, request_id, release_group, id LIKE '%-7' AS h FROM releases), m AS (SELECT *, max(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY request_id) AS a FROM t)
SELECT id, CASE WHEN a = 1 THEN h ELSE release_group IN ('Brand1', 'Brand2') END AS tagged FROM m""")
def two_step_tags(spark, sf_dir):
    """Hash tags, or group tags in requests without any."""
    rows = releases(spark, sf_dir).select("id", "request_id", "release_group")
    hashes = rows.where(F.col("id").endswith("-7")).select(F.col("id").alias("hash"))
    groups = spark.createDataFrame([("Brand1",), ("Brand2",)], "group string")
    return idt.two_step_tags(rows, hashes, groups, "request_id", "id", "release_group").select("id", "tagged")


@query("""WITH c AS (SELECT DISTINCT l_orderkey AS probe, p_partkey AS cand, (p_size % 30 + 70) / 100.0 AS sim, CASE WHEN p_size % 5 = 0 THEN NULL ELSE abs(p_size % 4 - 1) END AS gap, p_retailprice / 100 AS pop FROM lineitem JOIN part ON l_partkey = p_partkey),
s AS (SELECT *, 300 * sim + CASE WHEN gap = 0 THEN 120 WHEN gap = 1 THEN 40 WHEN gap IS NOT NULL THEN -70 ELSE 0 END + least(pop, 50) AS score FROM c), r AS (SELECT *, row_number() OVER w AS rn, first_value(cand) OVER w AS top FROM s WINDOW w AS (PARTITION BY probe ORDER BY score DESC, cand)),
x AS (SELECT *, max(CASE WHEN cand <> top THEN score END) OVER (PARTITION BY probe) AS second FROM r)
SELECT probe, cand, round(score, 4)::DOUBLE AS score, CASE WHEN coalesce(second >= score - 25, false) THEN 'ambiguous' WHEN sim < 0.74 THEN 'ambiguous'
    WHEN gap IS NULL THEN CASE WHEN sim < 0.92 THEN 'strong' ELSE 'exact' END WHEN gap = 0 THEN 'exact' WHEN gap = 1 AND sim >= 0.92 THEN 'strong' ELSE 'ambiguous' END AS status FROM x WHERE rn = 1""")
def candidate_decision(spark, sf_dir):
    """Top candidate against its runner-up."""
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("probe"), "l_partkey").distinct().join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    c = c.select("probe", F.col("p_partkey").alias("cand"), ((F.col("p_size") % 30 + 70) / 100.0).alias("sim"), F.when(F.col("p_size") % 5 != 0, F.abs(F.col("p_size") % 4 - 1)).alias("gap"), (F.col("p_retailprice") / 100).alias("pop"))
    best = idt.decide_candidate(c, "probe", F.col("sim"), F.col("gap"), F.col("pop"), "cand")
    return best.select("probe", "cand", F.round("score", 4).alias("score"), "status")


@query("""WITH f AS (SELECT l_orderkey AS k, l_linenumber AS file_index, l_partkey, CASE WHEN l_returnflag = 'A' THEN -500 ELSE 0 END + CASE WHEN l_linestatus = 'O' THEN 1000 ELSE 0 END + 50 * l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey) AS s FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(greatest(s, 0), 6) DESC, file_index, l_partkey) AS rn FROM f) SELECT k, file_index, l_partkey, round(round(greatest(s, 0), 6), 4)::DOUBLE AS file_score FROM r WHERE rn = 1""")
def best_file(spark, sf_dir):
    """Additive score of files, best one of each torrent."""
    from pyspark.sql import Window

    share = F.col("l_extendedprice") / F.sum("l_extendedprice").over(Window.partitionBy("l_orderkey"))
    files = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct("l_linenumber", "l_partkey").alias("file"), "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", share.alias("share"))
    score = F.when(F.col("l_returnflag") == "A", -500).otherwise(0) + F.when(F.col("l_linestatus") == "O", 1000).otherwise(0) + 50 * F.col("share")
    best = idt.best_file(files, "k", F.round(score, 6), "file")
    return best.select("k", F.col("l_linenumber").alias("file_index"), "l_partkey", F.round("file_score", 4).alias("file_score"))


@query("""WITH k AS (SELECT c_custkey FROM customer), a AS (SELECT o_custkey AS c_custkey, max(o_orderpriority) AS title, list_sort(list(DISTINCT o_orderstatus)) AS names FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS c_custkey, min(o_orderpriority) AS title, list_sort(list(DISTINCT o_orderpriority)) AS names FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT c_custkey, coalesce(a.title, b.title) AS title, array_to_string(list_concat(coalesce(a.names, []), coalesce(b.names, [])), ',') AS names FROM k LEFT JOIN a USING (c_custkey) LEFT JOIN b USING (c_custkey)""")
def metadata_merge(spark, sf_dir):
    """Providers in order: first value stands, names are concatenated."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    a = orders.where("o_orderstatus = 'F'").groupBy("c_custkey").agg(F.max("o_orderpriority").alias("title"), F.array_sort(F.collect_set("o_orderstatus")).alias("names"))
    b = orders.where("o_orderstatus = 'O'").groupBy("c_custkey").agg(F.min("o_orderpriority").alias("title"), F.array_sort(F.collect_set("o_orderpriority")).alias("names"))
    merged = idt.merged_metadata(table(spark, sf_dir, "customer").select("c_custkey"), [a, b], "c_custkey", ["title"], ["names"])
    return merged.select("c_custkey", "title", F.array_join("names", ",").alias("names"))


@query("""WITH d AS (SELECT p_partkey, p_name || '  Part.' || CAST(p_size AS VARCHAR) || ' [x] é Мир a b c d e f g h i j k' AS t FROM part),
n AS (SELECT p_partkey, list_filter(string_split(trim(regexp_replace(regexp_replace(lower(t), '[._\\-]+', ' ', 'g'), '[^\\p{L}\\p{N} ]+', '', 'g')), ' '), lambda w: w <> '') AS w FROM d)
SELECT p_partkey, array_to_string(w[1:12], ' ') AS title_key, array_to_string(list_filter(w, lambda x: length(x) > 1)[1:12], ' ') AS lookup_title,
    'movie' || '␟' || array_to_string(w[1:12], ' ') || '␟' AS movie_key FROM n""")
def title_keys(spark, sf_dir):
    """Normal forms and composite keys of titles in any script."""
    t = F.concat("p_name", F.lit("  Part."), F.col("p_size").cast("string"), F.lit(" [x] é Мир a b c d e f g h i j k"))
    return table(spark, sf_dir, "part").select("p_partkey", ps.title_key(t).alias("title_key"), ps.lookup_title(t).alias("lookup_title"), ps.compound_key(F.lit("movie"), ps.title_key(t), F.lit(None)).alias("movie_key"))


@query("""WITH n AS (SELECT DISTINCT p_name || ' ' || p_brand || ' ' || p_type AS x FROM part), w AS (SELECT x, list_distinct(string_split(x, ' ')) AS ws FROM n),
j AS (SELECT a.x AS a, b.x AS b, len(list_intersect(a.ws, b.ws)) / len(list_distinct(list_concat(a.ws, b.ws))) AS score FROM w a JOIN w b ON a.x < b.x)
SELECT a, b, round(score, 6)::DOUBLE AS score FROM j WHERE score >= 0.6""")
def jaccard_pairs(spark, sf_dir):
    """Distinct titles whose words reach a similarity of 0.6: pairs share a word of both prefixes, rarest words first."""
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("x")).distinct()
    return idt.similar_titles(names, "x", 0.6).withColumn("score", F.round("score", 6))


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphans(spark, sf_dir):
    """Parents without children."""
    return table(spark, sf_dir, "orders").select("o_orderkey").join(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def semi_overlay(spark, sf_dir):
    """Rows whose key is in another relation."""
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(rich, "o_custkey", "left_semi").select("o_orderkey", "o_totalprice")


@query("""WITH r AS (SELECT l_suppkey, l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_suppkey) AS n, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey, l_linenumber, l_quantity) AS rn FROM lineitem) SELECT l_suppkey, l_orderkey, l_partkey, CAST(n AS BIGINT) AS n FROM r WHERE rn = 1""")
def rep_row_per_group(spark, sf_dir):
    """One representative of each cluster, with the cluster's size: an aggregate with a partial maximum, not a sort."""
    best = F.max_by(F.struct("l_orderkey", "l_partkey"), F.struct("l_extendedprice", -F.col("l_orderkey"), -F.col("l_partkey"), -F.col("l_linenumber"), -F.col("l_quantity")))
    g = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(best.alias("b"), F.count("*").alias("n"))
    return g.select("l_suppkey", "b.l_orderkey", "b.l_partkey", "n")
