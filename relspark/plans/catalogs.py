"""Merged catalogues over parts and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import catalog as cat
from ..operators import ranking as rk
from .registry import query, table


def _items(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_size").alias("page"), F.col("p_brand").alias("source"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("title"), F.when(F.col("p_partkey") % 7 == 0, "n/a").otherwise(F.round("p_retailprice", 2).cast("string")).alias("rating"), F.when(F.col("p_partkey") % 5 != 0, (1990 + F.col("p_partkey") % 30).cast("string")).alias("year"))


_ITEMS = "i AS (SELECT p_size AS page, p_brand AS source, p_partkey AS pos, p_name AS title, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE round(p_retailprice, 2) END AS rating, CASE WHEN p_partkey % 5 <> 0 THEN 1990 + p_partkey % 30 ELSE 0 END AS yr FROM part)"


@query(f"WITH {_ITEMS} SELECT page, pos, CAST(row_number() OVER (PARTITION BY page ORDER BY n, source) AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY page, source ORDER BY pos) AS n FROM i)")
def interleave(spark, sf_dir):
    """The i-th item of every source in turn, page by page."""
    turn = _items(spark, sf_dir).withColumn("n", F.row_number().over(Window.partitionBy("page", "source").orderBy("pos")))
    return rk.ranked(turn, ["page"], [F.col("n"), F.col("source")], "place").select("page", "pos", "place")


@query(f"""WITH {_ITEMS} SELECT page, pos, CAST(row_number() OVER (PARTITION BY page ORDER BY rating DESC NULLS LAST, source, pos) AS INT) AS by_rating, CAST(row_number() OVER (PARTITION BY page ORDER BY yr, source, pos) AS INT) AS by_year,
    CAST(row_number() OVER (PARTITION BY page ORDER BY yr DESC, source, pos) AS INT) AS by_year_desc, CAST(row_number() OVER (PARTITION BY page ORDER BY source DESC, pos DESC) AS INT) AS reversed FROM i""")
def merged_catalog_sort(spark, sf_dir):
    """Merge methods of a catalogue."""
    items = _items(spark, sf_dir)
    for name, method in (("by_rating", "rating"), ("by_year", "year_asc"), ("by_year_desc", "year_desc"), ("reversed", "reverse")):
        items = rk.ranked(items, ["page"], cat.merge_order(method, "source", "pos"), name)
    return items.select("page", "pos", "by_rating", "by_year", "by_year_desc", "reversed")


@query(f"WITH {_ITEMS} SELECT page, pos FROM (SELECT *, row_number() OVER (PARTITION BY page, title ORDER BY pos) AS rn FROM i) WHERE rn = 1")
def catalog_dedup_id(spark, sf_dir):
    """First item of each title in a page."""
    return rk.greedy_unique(_items(spark, sf_dir), ["title"], None, "pos", group="page").select("page", "pos")


@query(f"""WITH RECURSIVE {_ITEMS.replace("ELSE 0 END AS yr", "END AS yr")},
placed AS (SELECT page, pos, 's' || source AS ka, 'y' || CAST(yr AS VARCHAR) AS kb, 't' || title AS kt, row_number() OVER (PARTITION BY page ORDER BY pos) AS place FROM i),
walk AS (
    SELECT page, CAST(0 AS BIGINT) AS place, CAST(0 AS BIGINT) AS pos, false AS good, CAST([] AS VARCHAR[]) AS seen FROM placed GROUP BY page
    UNION ALL
    SELECT page, place, pos, good, CASE WHEN good THEN list_concat(seen, own) ELSE seen END
    FROM (SELECT *, NOT list_has_any(seen, own) AS good
        FROM (SELECT p.page, p.place, CAST(p.pos AS BIGINT) AS pos, w.seen, list_filter([p.ka, p.kb, p.kt], lambda x: x IS NOT NULL) AS own
            FROM walk w JOIN placed p ON p.page = w.page AND p.place = w.place + 1)))
SELECT page, pos FROM walk WHERE good""")
def catalog_dedup_greedy(spark, sf_dir):
    """Ids or titles: only items that stay leave their ids and titles behind."""
    return rk.greedy_unique(_items(spark, sf_dir), ["source", "year"], "title", "pos", group="page").select("page", "pos")


@query(f"WITH {_ITEMS}, o AS (SELECT DISTINCT source, length(source) * 10 AS off FROM i), g AS (SELECT source, count(*) AS n FROM i WHERE page <= 10 GROUP BY 1) SELECT source, CAST(off + coalesce(n, 0) AS BIGINT) AS \"offset\" FROM o LEFT JOIN g USING (source)")
def next_offsets(spark, sf_dir):
    """Where each source goes on."""
    items = _items(spark, sf_dir)
    offsets = items.select("source").distinct().withColumn("offset", (F.length("source") * 10).cast("long"))
    return cat.next_offsets(items.where("page <= 10"), offsets, "source")


@query("""WITH r AS (SELECT p_type AS resource, p_brand AS t, CASE WHEN p_type = 'PROMO' AND p_partkey % 50 = 0 THEN NULL ELSE substr(p_name, 1, 2) END AS p FROM part)
SELECT resource, array_to_string(list_sort(list(DISTINCT t)), ',') AS types, CASE WHEN count(p) = count(*) THEN array_to_string(list_sort(list(DISTINCT p)), ',') END AS prefixes FROM r GROUP BY 1""")
def capability_union(spark, sf_dir):
    """Union of capabilities; one unrestricted source lifts the prefixes."""
    p = table(spark, sf_dir, "part")
    free = (F.col("p_type") == "PROMO") & (F.col("p_partkey") % 50 == 0)
    rows = p.select(F.col("p_type").alias("resource"), F.array("p_brand").alias("types"), F.when(~free, F.array(F.substring("p_name", 1, 2))).alias("prefixes"))
    return cat.capability_union(rows, "resource").select("resource", F.array_join("types", ",").alias("types"), F.array_join("prefixes", ",").alias("prefixes"))


@query("""SELECT p_partkey AS source,
    CASE WHEN i % 2 = 0 THEN 'no search' WHEN i % 3 = 0 THEN 'genre not offered' WHEN i = 7 THEN 'genre not offered' WHEN i = 5 THEN 'required extra missing' END AS refused,
    CASE WHEN i % 2 = 0 THEN 'no search' WHEN i = 5 THEN 'required extra missing' END AS refused_for_any
FROM (SELECT p_partkey, 1 + p_size % 11 AS i FROM part)""")
def catalog_eligibility(spark, sf_dir):
    """Why a catalogue can't take part: a genre extra without options, or with a null among them, admits every genre."""
    i = 1 + F.col("p_size") % 11
    extra = lambda name, required, options: F.struct(F.lit(name).alias("name"), required.alias("required"), options.alias("options"))
    none, nothing = F.array().cast("array<string>"), F.array().cast("array<struct<name:string,required:boolean,options:array<string>>>")
    options = F.when(i == 1, F.array(F.lit("Drama"))).when(i == 7, F.array(F.lit("Comedy"))).when(i == 11, F.array(F.lit("Comedy"), F.lit(None).cast("string"))).otherwise(none)
    extras = F.concat(
        F.when(i % 2 != 0, F.array(extra("search", F.lit(False), none))).otherwise(nothing),
        F.when(i % 3 != 0, F.array(extra("genre", F.lit(False), options))).otherwise(nothing),
        F.array(extra("region", i == 5, none)),
    )
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source"), extras.alias("extras"))
    first = cat.eligible(rows, True, "Drama", 0, ["search", "genre"])
    return cat.eligible(first.withColumnRenamed("refused", "given"), True, "None", 0, ["search", "genre"]).select("source", F.col("given").alias("refused"), F.col("refused").alias("refused_for_any"))


@query("""WITH p AS (SELECT p_partkey AS k, unnest(list_distinct(list_filter(regexp_split_to_array(lower(p_name), '[^a-z0-9]+'), lambda w: w <> ''))) AS token FROM part), t AS (SELECT p_partkey AS k, 0 AS tier FROM part WHERE p_name = 'red widget' UNION ALL SELECT p_partkey, 1 FROM part WHERE starts_with(p_name, 'red') UNION ALL SELECT k, 2 FROM p WHERE token = 'widget')
SELECT k, CAST(min(tier) AS INT) AS tier FROM t GROUP BY 1 ORDER BY 2, 1 LIMIT 50""")
def tiered_search(spark, sf_dir):
    """Exact title, then prefix, then token postings; the first fifty."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_name")
    tokens = cat.postings(p, "k", "p_name").where("token = 'widget'").select("k")
    return cat.tiered_search([p.where("p_name = 'red widget'").select("k"), p.where(F.col("p_name").startswith("red")).select("k"), tokens], "k", [F.col("k")], 50)
