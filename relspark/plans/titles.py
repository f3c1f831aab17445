"""Titles of films and series: release names, comparable and Latin forms, variants, and which reading of a group stands."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import parsing as ps
from ..functions import titles as tt
from ..operators import resolution as rs
from .registry import query, table

_RAW = """CASE p_partkey % 10 WHEN 0 THEN concat(replace(p_name, ' ', '.'), '.2009.1080p.x264-GRP.mkv') WHEN 1 THEN concat('[Group] ', p_name, ' (1999) [720p]')
    WHEN 2 THEN concat('www.site', cast(p_size as {text}), '.com - ', p_name, ' 2012 tt1234567 tmdb-', cast(p_partkey as {text})) WHEN 3 THEN concat(p_name, ' AKA Other Name 2001')
    WHEN 4 THEN 'abcdefghijklmnopqrstuvwx' WHEN 5 THEN concat('S.W.A.T.', replace(p_name, ' ', '.'), '.2017.WEB') WHEN 6 THEN concat(p_name, ' no year here')
    WHEN 7 THEN concat('1984_', p_name) WHEN 8 THEN '  ...  ' ELSE concat(p_name, ' (AKA Mr. X) 2003') END"""


@query("""WITH p AS (SELECT p_partkey, p_name AS n, p_partkey % 10 AS k FROM part)
SELECT p_partkey, CASE WHEN k IN (0, 1, 2) THEN n WHEN k = 3 THEN n || ' AKA Other Name' WHEN k = 5 THEN 'S.W.A.T. ' || n WHEN k = 7 THEN n WHEN k = 9 THEN n || ' (AKA Mr X)' END AS title,
    CAST(CASE k WHEN 0 THEN 2009 WHEN 1 THEN 1999 WHEN 2 THEN 2012 WHEN 3 THEN 2001 WHEN 5 THEN 2017 WHEN 7 THEN 1984 WHEN 9 THEN 2003 END AS INT) AS year,
    CASE WHEN k IN (0, 1, 2, 7) THEN n WHEN k = 5 THEN 'S.W.A.T. ' || n WHEN k = 3 THEN n || ' AKA Other Name,' || n || ',Other Name' WHEN k = 9 THEN n || ' (AKA Mr X),' || n || ',Mr X' END AS titles,
    CASE WHEN k = 2 THEN 'tt1234567' END AS imdb_id, CASE WHEN k = 2 THEN CAST(p_partkey AS BIGINT) END AS tmdb_id FROM p""")
def release_titles(spark, sf_dir):
    """Title, year, other titles and ids that release names of ten forms say."""
    raw = F.expr(_RAW.format(text="string"))
    said = table(spark, sf_dir, "part").select("p_partkey", tt.release_title(raw).alias("said"))
    return said.select("p_partkey", "said.title", "said.year", F.array_join("said.titles", ",").alias("titles"), "said.imdb_id", "said.tmdb_id")


_FILM = "CASE WHEN p_size % 7 = 0 THEN cast(p_partkey as {text}) ELSE concat('The ', p_name, ' & Größe of Ärger_', cast(p_size as {text}), ' à É: an Ōra') END"


@query(f"""WITH f AS (SELECT p_partkey, p_size, {_FILM.format(text="varchar")} AS t FROM part),
w AS (SELECT *, string_split_regex(lower(replace(replace(t, 'ö', 'oe'), 'Ä', 'Ae')), '[^\\p{{L}}\\p{{N}}]+') AS ws FROM f),
g AS (SELECT *, replace(t, 'ß', 'ss') AS u FROM w)
SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN t ELSE strip_accents(array_to_string(list_filter(list_transform(ws, lambda x: replace(x, 'ß', 'ss')), lambda x: x NOT IN ('a', 'an', 'the', 'and', 'or', 'of', 'à', '')), '')) END AS form FROM g""")
def movie_titles(spark, sf_dir):
    """Comparable forms of films' titles."""
    return table(spark, sf_dir, "part").select("p_partkey", tt.movie_title(F.expr(_FILM.format(text="string"))).alias("form"))


@query("""SELECT p_partkey, p_name || ' Zhizn Sch' || CAST(p_size AS VARCHAR) || ' Ob''jekt eto my' AS latin, p_size % 2 = 0 AS cyrillic FROM part""")
def latin_titles(spark, sf_dir):
    """Russian titles in Latin letters, and which titles have Cyrillic ones."""
    russian = F.concat("p_name", F.lit(" Жизнь".rstrip("ь") + " Щ"), F.col("p_size").cast("string"), F.lit(" Объект".replace("ек", "jек") + " это мы"))
    plain = F.concat("p_name", F.lit(" Zhizn Sch"), F.col("p_size").cast("string"), F.lit(" Ob'jekt eto my"))
    shown = F.when(F.col("p_size") % 2 == 0, russian).otherwise(plain)
    return table(spark, sf_dir, "part").select("p_partkey", tt.latin(shown).alias("latin"), ps.in_script(shown).alias("cyrillic"))


_NUMERALS = "('1', 'i'), ('2', 'ii'), ('3', 'iii'), ('4', 'iv'), ('5', 'v'), ('6', 'vi'), ('7', 'vii'), ('8', 'viii'), ('9', 'ix'), ('10', 'x'), ('11', 'xi'), ('12', 'xii'), ('13', 'xiii'), ('14', 'xiv'), ('15', 'xv'), ('16', 'xvi'), ('17', 'xvii'), ('18', 'xviii'), ('19', 'xix'), ('20', 'xx'), ('21', 'xxi')"


@query(f"""WITH p AS (SELECT p_partkey, p_size, p_name AS n, p_size % 4 AS k FROM part),
r(arabic, roman) AS (VALUES {_NUMERALS}), swaps AS (SELECT arabic AS x, roman AS y FROM r UNION ALL SELECT roman, arabic FROM r),
numbered AS (SELECT p_partkey, n || ' xi ' || CAST(p_size AS VARCHAR) AS t FROM p), forms AS (SELECT p_partkey, t FROM numbered UNION SELECT p_partkey, replace(t, x, y) FROM numbered, swaps WHERE contains(t, x)),
v AS (SELECT p_partkey, string_agg(t, ',' ORDER BY t) AS variants FROM forms GROUP BY 1)
SELECT p_partkey, CASE k WHEN 3 THEN n || ' aka other' ELSE n END AS cut,
    CASE WHEN p_size % 3 = 0 THEN n ELSE n || ' ' || CAST(p_size AS VARCHAR) END AS refined, variants FROM p JOIN v USING (p_partkey)""")
def title_forms(spark, sf_dir):
    """Titles cut at AKA, slashes and brackets, without season numbers and dropped words, and with Roman numbers."""
    name, k = F.col("p_name"), F.col("p_size") % 4
    long_ = F.when(k == 0, F.concat(name, F.lit(" / other"))).when(k == 1, F.concat(name, F.lit(" (uncut)"))).when(k == 2, F.concat(name, F.lit(" aka other"))).otherwise(F.concat(name, F.lit(" aka other")))
    asked = F.when(k == 3, F.array(F.lit("x aka y"))).otherwise(F.array(F.lit("x")))
    numbered = F.concat(name, F.lit(" uncensored "), F.col("p_size").cast("string"))
    season = F.when(F.col("p_size") % 3 == 0, F.col("p_size")).otherwise(F.lit(-1))
    return table(spark, sf_dir, "part").select(
        "p_partkey", ps.preprocessed(long_, asked).alias("cut"), ps.refined_series_title(numbered, season, ["uncensored"]).alias("refined"),
        F.array_join(F.array_sort(ps.roman_variants(F.concat(name, F.lit(" xi "), F.col("p_size").cast("string")))), ",").alias("variants"),
    )


_SCORES = {"2160p": 1.0, "1080p": 0.8, "720p": 0.5}
_FACTORS = {"episode": 0.9, "season_pack": 0.7}


@query("""WITH p AS (SELECT p_partkey, p_size, p_type, p_brand, CASE p_size % 4 WHEN 0 THEN '2160p' WHEN 1 THEN '1080p' WHEN 2 THEN '720p' END AS res, CASE p_size % 3 WHEN 0 THEN 'episode' WHEN 1 THEN 'season_pack' ELSE 'movie' END AS kind FROM part)
SELECT p_partkey, round(least(1.0, CASE res WHEN '2160p' THEN 1.0 WHEN '1080p' THEN 0.8 WHEN '720p' THEN 0.5 ELSE 0.1 END::DOUBLE * CASE kind WHEN 'episode' THEN 0.9 WHEN 'season_pack' THEN 0.7 ELSE 1.0 END::DOUBLE + CASE WHEN p_partkey % 5 > 0 THEN 0.1 ELSE 0 END::DOUBLE), 6) AS score,
    p_size % 6 IN (1, 2) AS anime, CASE p_size % 6 WHEN 0 THEN 'German' WHEN 1 THEN 'Japanese' ELSE 'xx' END AS language, CAST(CASE p_size % 3 WHEN 0 THEN 1999 WHEN 1 THEN 2004 ELSE 0 END AS INT) AS year FROM p""")
def name_tables(spark, sf_dir):
    """Scores, patterns and names by small tables: resolution and class, anime groups, languages, years of ranges."""
    size = F.col("p_size")
    resolution = F.when(size % 4 == 0, "2160p").when(size % 4 == 1, "1080p").when(size % 4 == 2, "720p")
    kind = F.when(size % 3 == 0, "episode").when(size % 3 == 1, "season_pack").otherwise("movie")
    name = F.when(size % 6 == 1, "[SubsPlease] x").when(size % 6 == 2, "x - 07 (1080p)").when(size % 6 != 3, "plain name")
    code = F.when(size % 6 == 0, " DE ").when(size % 6 == 1, "ja").otherwise("xx")
    years = F.when(size % 3 == 0, "1999-2004").when(size % 3 == 1, "since 2004").otherwise("soon")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.round(ps.media_score(F.col("p_partkey") % 5, resolution, kind, _SCORES, _FACTORS), 6).alias("score"), ps.any_pattern(name, [r"^\[SubsPlease\]", r" - \d{2} "]).alias("anime"),
        ps.mapped(code, {"de": "German", "ja": "Japanese"}).alias("language"), ps.leading_year(years).alias("year"),
    )


@query("""WITH g AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 > 0 THEN 2000 + s_suppkey % 10 END AS year, CASE WHEN s_suppkey % 3 = 0 THEN 's02' ELSE '' END AS bucket FROM supplier),
m AS (SELECT k, 'canon name ' || CAST(k + 100 AS VARCHAR) AS title FROM g WHERE k % 5 = 0 AND k % 2 = 0),
c AS (SELECT k, 'alpha beta' AS title, 'parser' AS source, 1 AS noise FROM g WHERE k % 5 IN (0, 1) UNION ALL SELECT k, 'gamma', 'parser', 0 FROM g WHERE k % 5 = 1 UNION ALL SELECT k, 'plain words here', 'rules', 1 FROM g WHERE k % 5 <> 4),
r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY noise + CASE WHEN title = 'gamma' THEN 2 ELSE 0 END, source) AS n FROM c)
SELECT g.k AS group_key, coalesce(m.title, r.title) AS title, CAST(CASE WHEN m.k IS NOT NULL THEN 1990 WHEN r.k IS NULL THEN NULL ELSE g.year END AS INT) AS year, CASE WHEN m.k IS NULL AND r.k IS NULL THEN NULL ELSE g.bucket END AS bucket,
    CASE WHEN m.k IS NOT NULL THEN 'series_mapping' ELSE r.source END AS source, CASE WHEN m.k IS NOT NULL THEN 'mapped' WHEN r.k IS NOT NULL THEN CASE r.source WHEN 'parser' THEN 'parsed' ELSE 'weak' END END AS confidence, g.k % 5 = 0 AS mapping_hit
FROM g LEFT JOIN m USING (k) LEFT JOIN r ON r.k = g.k AND r.n = 1""")
def series_identity(spark, sf_dir):
    """A mapping's title, or the best of the readings; mappings with an empty title leave the choice to the readings."""
    k = F.col("group_key")
    groups = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("group_key")).withColumns({"year_hint": F.when(k % 4 > 0, 2000 + k % 10), "season_bucket": F.when(k % 3 == 0, "s02").otherwise("")})
    name = F.when(k % 2 == 0, F.concat(F.lit("Canon_Name."), (k + 100).cast("string"))).otherwise(F.lit(" - "))
    none = F.lit(None).cast("string")
    mappings = groups.where(k % 5 == 0).withColumns({"canonical_title": name, "canonical_year": F.lit(1990), "mapping_source": none, "mapping_confidence": none})
    reading = lambda title, source, sure: F.struct(F.lit(title).alias("title"), F.lit(source).alias("source"), F.lit(sure).alias("confidence"))
    readings = F.array_compact(F.array(
        F.when((k % 5).isin(0, 1), reading("alpha beta", "parser", "parsed")), F.when(k % 5 == 1, reading("gamma", "parser", "parsed")),
        F.when(k % 5 != 4, reading("plain words here", "rules", "weak")), reading("", "rules", "weak"),
    ))
    candidates = groups.select("group_key", F.explode(readings).alias("r")).select("group_key", "r.*", F.lit(None).cast("int").alias("year"), F.lit("").alias("bucket"))
    found = rs.series_identity(groups, mappings, candidates, lambda t: F.when(t == "gamma", 0).otherwise(1), "parser")
    return found.select("group_key", "title", F.col("year").cast("int").alias("year"), F.col("season_bucket").alias("bucket"), "source", "confidence", "mapping_hit")
