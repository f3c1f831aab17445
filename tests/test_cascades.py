"""Title cascade, canonical families, fuzzy joins and bit-parallel subsequences against plain loops and literal rows."""

import random

import pytest
from pyspark.sql import functions as F

from relspark.functions import parsing as ps
from relspark.functions import similarity as sim
from relspark.operators import cascade, identity, matching


def plain_ratio(a, b):
    if not a and not b:
        return 100.0
    previous = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
        previous = row
    return 200.0 * previous[-1] / (len(a) + len(b))


def plain_partial(a, b):
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    return max(plain_ratio(short, long[k : k + len(short)]) for k in range(len(long) - len(short) + 1))


def test_subsequences_in_words_of_bits():
    rnd = random.Random(1)
    text = lambda: "".join(rnd.choices("abcé中𝔘", k=rnd.choice([0, 1, 3, 20, 63, 64, 65, 127, 128, 129])))
    a, b = [text() for _ in range(150)], [text() for _ in range(150)]
    assert sim.ratios(a, b).tolist() == pytest.approx([plain_ratio(x, y) for x, y in zip(a, b, strict=True)])
    assert sim.partial_ratios(a[:50], b[:50]).tolist() == pytest.approx([plain_partial(x, y) for x, y in zip(a[:50], b[:50], strict=True)])
    assert sim.ratios([], []).tolist() == sim.partial_ratios([], []).tolist() == []


def test_scores_of_nulls_and_batches(spark):
    rows = [("abc", "abd"), (None, "x"), ("", ""), ("x", None), ("", "x")]
    got = spark.createDataFrame(rows, "a string, b string").select(sim.fuzzy_ratio("a", "b"), sim.fuzzy_partial("a", "b")).collect()
    assert [tuple(r) for r in got] == [(pytest.approx(200 / 3), pytest.approx(200 / 3)), (None, None), (100.0, 100.0), (None, None), (0.0, 0.0)]


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.85, 1.0])
def test_fuzzy_join_misses_nothing(spark, threshold):
    rnd = random.Random(int(threshold * 100))
    base = ["".join(rnd.choices("abcd ", k=rnd.choice([1, 2, 3, 4, 5, 8, 15, 30]))) for _ in range(40)] + ["aaaaaaaa", "aaaaaaa", "a", "ab", "ba"]

    def typo(t):
        t = list(t)
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(t))
            t[at : at + rnd.randint(0, 1)] = rnd.choices("abcdx", k=rnd.randint(0, 1))
        return "".join(t)

    left, right = [typo(rnd.choice(base)) for _ in range(120)] + [None, ""], base + [None, "", base[0]]
    one = lambda ts, n: spark.createDataFrame([(t,) for t in ts], f"{n} string")
    got = [(r["left"], r["right"], round(r.score, 9)) for r in matching.fuzzy_join(one(left, "x"), one(right, "y"), threshold).collect()]
    want = {(a, b, round(plain_ratio(a, b) / 100, 9)) for a in left if a for b in right if b if plain_ratio(a, b) / 100 >= threshold - 1e-12}
    assert len(got) == len(set(got)) and set(got) == want


def test_fuzzy_join_has_no_cross_product_and_bounds_its_threshold(spark):
    t = spark.createDataFrame([("abc",)], "t string")
    plan = matching.fuzzy_join(t, t)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    for threshold in (0.5, 2 / 3, 1.1):
        with pytest.raises(ValueError):
            matching.fuzzy_join(t, t, threshold)


def test_numbers_are_exchanged_anywhere(spark):
    forms = lambda t: set(spark.range(1).select(ps.roman_variants(F.lit(t)).alias("v")).first().v)
    # Every number in its own form, inside words and longer numbers too.
    assert forms("rocky 2") == {"rocky 2", "rocky ii"}
    assert forms("rocky ii") == {"rocky ii", "rocky 11", "rocky 2"}
    assert forms("part 12") == {"part 12", "part i2", "part 1ii", "part xii"}
    assert "saw 9" in forms("saw ix") and "f21" in forms("fxxi") and forms("none") == {"none"}


FILM = "id long, imdb_id string, title string, original_title string, year int, secondary_year int, popularity double"


def films(spark):
    rows = [
        (1, "tt1", "rocky ii", "", 1979, None, 5.0), (2, "tt2", "rocky 2", "", 2010, 1979, 9.0), (3, None, "other", "rocky 2", 1979, None, 99.0),
        (4, "tt4", "solaris", "solyaris", 1972, None, 1.0), (5, "tt5", "solyaris", None, 2002, None, None), (6, "tt6", "twin", "", None, None, 2.0), (7, "tt7", "twin", "", 1990, None, 2.0),
    ]
    alternatives = spark.createDataFrame([(4, "planet of thought"), (99, "unknown id"), (4, "")], "id long, title string")
    translations = spark.createDataFrame([(5, "planet of thought"), (5, "sol")], "id long, title string")
    return cascade.title_index(spark.createDataFrame(rows, FILM), alternatives, translations)


def test_cascade_by_phase_popularity_and_year(spark):
    probes = [
        ("main", "rocky 2", None, (2, "main")),  # both forms of the number; the more popular film
        ("main near", "rocky ii", 1980, (1, "main")),  # one year off; 2's secondary year is not within one
        ("secondary", "rocky 2", 1979, (2, "main")),  # year and secondary year both fit: popularity decides
        ("original", "solyaris", 1972, (4, "original")),  # the main title of that name is of another year
        ("unknown popularity", "solyaris", 0, (5, "main")),  # year 0 is no year; an earlier phase wins without popularity
        ("alternative", "planet of thought", None, (4, "alternative")),
        ("translated", "planet of thought", 2003, (5, "translated")),
        ("ties", "twin", None, (6, "main")),
        ("no year known", "twin", 1991, (7, "main")),
        ("nothing", "unknown id", None, None), ("empty", "", None, None), ("null", None, None, None),
    ]
    df = spark.createDataFrame([p[:3] for p in probes], "probe string, title string, year int")
    got = {r.probe: (r.id, r.phase) for r in cascade.title_cascade(df, films(spark), "probe", "title", "year").collect()}
    assert got == {p: want for p, _, _, want in probes if want}


def test_first_reading_that_finds_anything_wins(spark):
    rows = [("a", 0, "nowhere", None), ("a", 1, "sol", None), ("a", 2, "twin", None), ("b", 0, "twin", 1950), ("b", 1, "solaris", 1972)]
    df = spark.createDataFrame(rows, "probe string, reading int, title string, year int")
    got = {r.probe: (r.id, r.phase, r.reading) for r in cascade.title_cascade(df, films(spark), "probe", "title", "year", "reading").collect()}
    assert got == {"a": (5, "translated", 1), "b": (4, "main", 1)}


def test_season_buckets(spark):
    rows = [(None,), (0,), (7,), (12,), (104,)]
    got = spark.createDataFrame(rows, "s int").select(ps.season_bucket(F.col("s")).alias("b")).collect()
    assert [r.b for r in got] == ["", "s00", "s07", "s12", "s104"]


def test_prefixes_leave_out_one_to_three_words(spark):
    forms = lambda t: spark.range(1).select(identity.prefixes(F.lit(t)).alias("p")).first().p
    assert forms("one two three four five") == ["one two three four", "one two three", "one two"]
    assert forms("one two") == ["one"] and forms("single") == [] and forms("") == [] and forms("ab c") == [] and forms("a  b cd") == ["a b"]


def test_canonical_lookup(spark):
    variants = [
        ("series", "the show", "", 2000, 5, 1), ("series", "the show", "", None, 3, 2), ("series", "the show", "s02", 2000, 1, 3), ("movie", "the show", "", 2000, 9, 4),
        ("series", "the show must", "", None, 7, 5), ("series", "theory of all", "", None, 99, 6), ("movie", "the end", "", 1999, 1, 4),
    ]
    families = [(1, 10, None), (2, 20, 7), (3, 1, 8), (4, 1, 9), (5, 2, 11), (6, 1, None)]
    v = spark.createDataFrame(variants, "media_kind string, normalized_title string, season_bucket string, year_hint int, evidence int, family_key long")
    f = spark.createDataFrame(families, "family_key long, family_evidence int, tmdb_id long")
    probes = [
        ("year", "the show", 2000, "episode", None, (1, "exact")), ("other year", "the show", 1990, "episode", None, (2, "exact")), ("season", "the show", 1, "anime_pack", 2, (3, "no_year")),
        ("movie", "the show", None, "unknown_video", None, (4, "exact")), ("prefix", "the show must go", 0, "season_pack", None, (5, "prefix")),
        ("without id", "the end is near", None, "episode", None, (5, "prefix")),  # "the" begins more titles; those without a TMDB id don't count
        ("movies try no prefix", "the show must go", None, "movie", None, None), ("one word", "theory", None, "episode", None, None), ("empty", "", None, "episode", None, None),
    ]
    df = spark.createDataFrame([p[:5] for p in probes], "probe string, title string, year int, content_class string, season int")
    got = {r.probe: (r.family_key, r.how) for r in identity.canonical_lookup(df, v, f).collect()}
    assert got == {p[0]: p[5] for p in probes if p[5]}


def test_crosswalk_start_without_an_episode_is_the_first(spark):
    rows = [(1, "tt1", "TV", [(0, 2, None)], []), (2, "tt1", "TV", [(0, 2, 9)], [])]
    mappings = spark.createDataFrame(rows, "mapping int, imdb string, kind string, starts array<struct<source:int,season:int,episode:int>>, synonyms array<string>")
    asked = spark.createDataFrame([("a", "imdb", "tt1", 2, 5), ("b", "imdb", "tt1", 2, 12)], "request string, id_type string, id_value string, season int, episode int")
    got = {r.request: (r.mapping, r.start) for r in identity.crosswalk(asked, mappings, ["imdb"], "request", "mapping", ["imdb"]).collect()}
    assert got == {"a": (1, 1), "b": (2, 9)}


def most_joined(df):
    """The most rows that a join of the plan gives."""
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        below = [node.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [node.plan()] if "QueryStage" in kind else [node.children().apply(i) for i in range(node.children().size())]
        if "Join" in kind:
            found.append(node.metrics().apply("numOutputRows").value())
        for x in below:
            walk(x)

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def test_families_of_a_title_that_very_many_share(spark):
    n = 300
    v = spark.range(n).selectExpr("'series' AS media_kind", "'the show' AS normalized_title", "'' AS season_bucket", "cast(2000 + id % 2 as int) AS year_hint", "cast(id % 7 as int) AS evidence", "id AS family_key")
    f = spark.range(n).selectExpr("id AS family_key", "1 AS family_evidence", "id AS tmdb_id")
    probes = spark.range(n).selectExpr("id AS probe", "CASE WHEN id % 3 = 0 THEN 'the show must' ELSE 'the show' END AS title", "cast(2000 + id % 3 as int) AS year", "'episode' AS content_class", "cast(null as int) AS season")
    found = identity.canonical_lookup(probes, v, f)
    # The most evidence is 6: of families 6, 13, 20, ...; those of even numbers are of 2000.
    want = {0: (6, "prefix"), 1: (13, "exact"), 2: (6, "no_year")}
    assert most_joined(found) <= n
    assert {r.probe: (r.family_key, r.how) for r in found.collect()} == {i: want[i % 3] for i in range(n)}


def test_cascade_of_a_title_that_very_many_share(spark):
    n = 300
    index = spark.range(n).selectExpr("'rocky ii' AS title", "1 AS phase", "id", "cast(id as string) AS imdb_id", "cast(2000 + id % 2 as int) AS year", "cast(null as int) AS secondary_year", "double(id % 7) AS popularity")
    probes = spark.range(n).selectExpr("id AS probe", "'rocky 2' AS title", "cast(1998 + id % 3 as int) AS year")
    found = cascade.title_cascade(probes, index, "probe", "title", "year")
    assert most_joined(found) <= n
    assert {r.probe: (r.id, r.matched_year) for r in found.collect()} == {i: (6, 2000) for i in range(n) if i % 3}
