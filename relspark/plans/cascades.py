"""Titles found by any of their names, by canonical families, and by likeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..operators import cascade as cs
from ..operators import identity as idt
from ..operators import matching as mc
from .registry import query, stated, table

_NUMERALS = "('1', 'i'), ('2', 'ii'), ('3', 'iii'), ('4', 'iv'), ('5', 'v'), ('6', 'vi'), ('7', 'vii'), ('8', 'viii'), ('9', 'ix'), ('10', 'x'), ('11', 'xi'), ('12', 'xii'), ('13', 'xiii'), ('14', 'xiv'), ('15', 'xv'), ('16', 'xvi'), ('17', 'xvii'), ('18', 'xviii'), ('19', 'xix'), ('20', 'xx'), ('21', 'xxi')"

# Films of one in five parts; the phase that knows a name depends on the part, so each phase decides for some probes.
_FILMS = """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 > 0 THEN concat('tt', cast(p_partkey as {text})) END AS imdb_id, concat(p_name, ' ', cast(p_size % 12 as {text})) AS title,
    CASE WHEN p_partkey % 2 = 0 THEN concat(p_name, ' ', lower(p_type)) ELSE '' END AS original_title, 1990 + p_size % 20 AS year,
    CASE WHEN p_partkey % 4 = 0 THEN 1960 + p_size % 20 END AS secondary_year, CASE WHEN p_partkey % 7 > 0 THEN floor(p_retailprice / 100) END AS popularity FROM part WHERE p_partkey % 5 = 0"""
_OTHERS = """SELECT p_partkey {back} AS id, concat(lower(p_brand), ' ', p_name) AS title FROM part WHERE p_partkey % 5 = {rest}"""
_PROBES = """SELECT l_orderkey * 10 + l_linenumber AS probe, CASE l_linenumber % 4 WHEN 0 THEN concat(p_name, ' ', CASE p_size % 12 WHEN 2 THEN 'ii' WHEN 4 THEN 'iv' WHEN 9 THEN 'ix' ELSE cast(p_size % 12 as {text}) END)
    WHEN 1 THEN concat(p_name, ' ', lower(p_type)) WHEN 2 THEN concat(lower(p_brand), ' ', p_name) ELSE p_name END AS title,
    CASE WHEN l_linenumber % 3 = 0 THEN 0 WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 20 THEN 1960 + p_size % 20 ELSE 1990 + p_size % 20 + cast(l_quantity as int) % 4 - 1 END AS year FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query(f"""WITH films AS ({_FILMS.format(text="varchar")}), alternatives AS ({_OTHERS.format(back="- 1", rest=1)}), translations AS ({_OTHERS.format(back="- 2", rest=2)}),
names AS (SELECT title AS name, 0 AS phase, * EXCLUDE (title) FROM films UNION ALL SELECT original_title, 1, * EXCLUDE (title) FROM films WHERE original_title <> ''
    UNION ALL SELECT a.title, 2, f.* EXCLUDE (title) FROM alternatives a JOIN films f USING (id) UNION ALL SELECT t.title, 3, f.* EXCLUDE (title) FROM translations t JOIN films f USING (id)),
probes AS ({_PROBES.format(text="varchar")}), r(arabic, roman) AS (VALUES {_NUMERALS}), swaps AS (SELECT arabic AS x, roman AS y FROM r UNION ALL SELECT roman, arabic FROM r),
distinct_titles AS (SELECT DISTINCT title FROM probes),
forms AS (SELECT title, title AS form FROM distinct_titles UNION SELECT title, replace(title, x, y) FROM distinct_titles, swaps WHERE contains(title, x)),
found AS (SELECT probe, phase, popularity, id, imdb_id, n.year FROM probes p JOIN forms f USING (title) JOIN names n ON n.name = f.form
    WHERE p.year IS NULL OR p.year = 0 OR n.year BETWEEN p.year - 1 AND p.year + 1 OR n.secondary_year = p.year),
best AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY phase, popularity DESC NULLS LAST, id) AS n FROM found)
SELECT probe, id, imdb_id, CAST(year AS INT) AS matched_year, CASE phase WHEN 0 THEN 'main' WHEN 1 THEN 'original' WHEN 2 THEN 'alternative' ELSE 'translated' END AS phase FROM best WHERE n = 1""")
def title_cascade(spark, sf_dir):
    """Films by main, original, alternative and translated titles, in forms with exchanged numbers, near their year."""
    films = stated(spark, sf_dir, _FILMS.format(text="string"), "part")
    others = [stated(spark, sf_dir, _OTHERS.format(back=f"- {k}", rest=k), "part") for k in (1, 2)]
    probes = stated(spark, sf_dir, _PROBES.format(text="string"), "lineitem", "part")
    found = cs.title_cascade(probes, cs.title_index(films, *others), "probe", "title", "year")
    return found.withColumn("matched_year", F.col("matched_year").cast("int"))


_VARIANTS = """SELECT CASE WHEN p_partkey % 3 = 0 THEN 'movie' ELSE 'series' END AS media_kind, CASE WHEN p_partkey % 4 = 0 THEN concat(p_name, ' the series') ELSE p_name END AS normalized_title,
    CASE WHEN p_partkey % 3 = 0 OR p_size % 2 = 0 THEN '' ELSE concat('s0', cast(1 + p_size % 3 as {text})) END AS season_bucket, CASE WHEN p_partkey % 5 > 0 THEN 1990 + p_size % 10 END AS year_hint,
    p_size % 9 AS evidence, p_partkey % 400 AS family_key FROM part"""
_FAMILIES = "SELECT s_suppkey AS family_key, s_nationkey AS family_evidence, CASE WHEN s_suppkey % 4 > 0 THEN s_suppkey * 7 END AS tmdb_id FROM supplier"
_ASKED = """SELECT o_orderkey AS probe, CASE WHEN o_orderkey % 4 = 0 THEN concat(p_name, ' the series of ', lower(p_type)) WHEN o_orderkey % 4 = 1 THEN concat(p_name, ' again') ELSE p_name END AS title,
    CASE WHEN o_orderkey % 3 = 0 THEN 1990 + p_size % 10 WHEN o_orderkey % 3 = 1 THEN 0 ELSE 1950 END AS year, CASE o_orderkey % 5 WHEN 0 THEN 'movie' WHEN 1 THEN 'anime_pack' WHEN 2 THEN 'unknown_video' ELSE 'episode' END AS content_class,
    CASE WHEN o_orderkey % 7 > 3 THEN 1 + p_size % 3 END AS season FROM orders JOIN part ON o_custkey = p_partkey"""


@query(f"""WITH v AS ({_VARIANTS.format(text="varchar")}), f AS ({_FAMILIES}), k AS (SELECT * FROM v JOIN f USING (family_key)),
q AS (SELECT *, CASE WHEN content_class IN ('anime_pack', 'episode') THEN 'series' ELSE 'movie' END AS media_kind, CASE WHEN season IS NULL THEN '' ELSE 's0' || CAST(season AS VARCHAR) END AS season_bucket FROM ({_ASKED}) a),
w AS (SELECT probe, media_kind, season_bucket, string_split(title, ' ') AS ws FROM q WHERE media_kind = 'series'),
forms AS (SELECT DISTINCT probe, media_kind, season_bucket, k AS dropped, array_to_string(ws[1:len(ws) - k], ' ') AS prefix FROM w, unnest([1, 2, 3]) u(k) WHERE len(ws) > k),
vocabulary AS (SELECT DISTINCT media_kind, season_bucket, prefix FROM forms WHERE length(prefix) >= 3),
begun AS (SELECT p.media_kind, p.season_bucket, p.prefix, family_key, tmdb_id, evidence, family_evidence FROM vocabulary p JOIN k ON k.media_kind = p.media_kind AND k.season_bucket = p.season_bucket AND starts_with(normalized_title, prefix) WHERE tmdb_id IS NOT NULL),
c AS (SELECT probe, family_key, tmdb_id, evidence, family_evidence, CASE WHEN q.year = 0 OR year_hint IS NULL OR year_hint = q.year THEN 0 ELSE 1 END AS tier FROM q JOIN k ON k.media_kind = q.media_kind AND k.season_bucket = q.season_bucket AND normalized_title = title
    UNION ALL SELECT probe, family_key, tmdb_id, evidence, family_evidence, 1 + dropped FROM forms JOIN begun USING (media_kind, season_bucket, prefix)),
b AS (SELECT *, row_number() OVER (PARTITION BY probe ORDER BY tier, evidence DESC, family_evidence DESC, family_key) AS n FROM c)
SELECT probe, family_key, tmdb_id, CASE tier WHEN 0 THEN 'exact' WHEN 1 THEN 'no_year' ELSE 'prefix' END AS how FROM b WHERE n = 1""")
def canonical_families(spark, sf_dir):
    """Families by kind, title and season: near the year, in any year, then series by beginnings of the title."""
    variants, families = stated(spark, sf_dir, _VARIANTS.format(text="string"), "part"), stated(spark, sf_dir, _FAMILIES, "supplier")
    found = idt.canonical_lookup(stated(spark, sf_dir, _ASKED, "orders", "part"), variants, families)
    return found.select("probe", "family_key", "tmdb_id", "how")


def _common(a: str, b: str) -> str:
    """DuckDB text for the length of the longest common subsequence, cell by cell."""
    return f"""list_reduce(list_transform(range(1, len({a}) + 1), lambda i: [i]), lambda row, x: list_reduce(list_transform(range(1, len({b}) + 1), lambda j: [j]),
    lambda line, y: list_append(line, CASE WHEN {a}[x[1]] = {b}[y[1]] THEN row[y[1]] + 1 ELSE greatest(line[-1], row[y[1] + 1]) END), [0::BIGINT]), list_transform(range(0, len({b}) + 1), lambda j: 0::BIGINT))[-1]"""


_LEFT = "SELECT DISTINCT CASE p_partkey % 3 WHEN 0 THEN replace(p_name, 'e', '') WHEN 1 THEN concat(p_name, 's') ELSE concat(substring(p_name, 1, 3), 'x', substring(p_name, 5, 20)) END AS t FROM part"


@query(f"""WITH l AS ({_LEFT}), r AS (SELECT DISTINCT p_name AS t FROM part), c AS (SELECT l.t AS a, r.t AS b, {_common("l.t", "r.t")} AS n FROM l JOIN r ON 2 * least(len(l.t), len(r.t)) >= 0.8 * (len(l.t) + len(r.t)))
SELECT a AS "left", b AS "right", round(2.0 * n / (len(a) + len(b)), 6) AS score FROM c WHERE 2 * n >= 0.8 * (len(a) + len(b)) - 1e-9""")
def fuzzy_titles(spark, sf_dir):
    """Names with typing errors and all names that are alike, found by shared pairs of neighbouring letters."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("t"))
    return mc.fuzzy_join(stated(spark, sf_dir, _LEFT, "part"), names, 0.8).withColumn("score", F.round("score", 6))


@query(f"""WITH p AS (SELECT DISTINCT p_name FROM part), n AS (SELECT p_name, replace(p_name, ' ', '') AS a FROM p), w AS (SELECT p_name, a, unnest([replace(a, 'g', ''), 'the' || a || 'show', substr(a, 1, 4)]) AS b FROM n),
x AS (SELECT p_name, 2.0 * {_common("a", "b")} / (len(a) + len(b)) AS s FROM w), e AS (SELECT p_name, max(s) >= 0.85 AS exact_ok FROM x GROUP BY 1)
SELECT p_partkey, exact_ok, true AS partial_ok FROM part JOIN e USING (p_name)""")
def title_match(spark, sf_dir):
    """Fuzzy match of each title with three wanted ones, whole and by the best stretch."""
    name = F.col("p_name")
    near = F.replace(F.replace(name, F.lit("g"), F.lit("")), F.lit(" "), F.lit("."))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("title"), F.array(near, F.concat(F.lit("The "), name, F.lit(" Show")), F.substring(F.replace(name, F.lit(" "), F.lit("")), 1, 4)).alias("wanted"))
    exact = mc.title_match(rows, "title", "wanted").withColumnRenamed("title_ok", "exact_ok")
    return mc.title_match(exact, "title", "wanted", exact=False).select("p_partkey", "exact_ok", F.col("title_ok").alias("partial_ok"))


@query("""WITH t AS (SELECT c_custkey, c_name || CASE c_custkey % 4 WHEN 0 THEN ' Über & Straße' WHEN 1 THEN '.Ca-fé_2+' WHEN 2 THEN ' [x] (y).MKV' ELSE '' END AS t FROM customer)
SELECT c_custkey, 'customer' || substr(t, 10, 9) || CASE c_custkey % 4 WHEN 0 THEN 'ueberandstrasse' WHEN 1 THEN 'cafe2+' WHEN 2 THEN 'xymkv' ELSE '' END AS normal,
    'customer' || substr(t, 10, 9) || CASE c_custkey % 4 WHEN 0 THEN ' ueber and strasse' WHEN 1 THEN ' ca fe 2+' WHEN 2 THEN ' x y mkv' ELSE '' END AS clean,
    lower(substr(t, 1, 18)) || CASE c_custkey % 4 WHEN 0 THEN ' über & straße' WHEN 1 THEN ' ca fé 2+' ELSE '' END AS compatible FROM t""")
def normal_forms(spark, sf_dir):
    """Comparable, word by word and compatible forms of names."""
    k = F.col("c_custkey") % 4
    text = F.concat("c_name", F.when(k == 0, " Über & Straße").when(k == 1, ".Ca-fé_2+").when(k == 2, " [x] (y).MKV").otherwise(""))
    return table(spark, sf_dir, "customer").select("c_custkey", sim.normalise_title(text).alias("normal"), sim.clean_title(text).alias("clean"), sim.compatible_form(text).alias("compatible"))
