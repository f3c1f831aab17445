"""Joins that find the identity of a title, and joins with ranges, capabilities and orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import season_bucket


def grouped_children(parents: DataFrame, children: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Each parent with its children as an array of structs in order of the fields."""
    arrays = children.join(parents.select(key), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("children"))
    return parents.join(arrays, key)


def best_match(probes: DataFrame, variants: DataFrame, on: Sequence[str], probe: str, year: str | None, variant_year: str | None, by: Sequence[Column]) -> DataFrame:
    """One variant per probe: equal keys, equal or unknown year when the probe has one, then the given order."""
    joined = probes.join(variants, list(on))
    if year and variant_year:
        joined = joined.where(F.col(year).isNull() | F.col(variant_year).isNull() | (F.col(year) == F.col(variant_year)))
    w = Window.partitionBy(probe).orderBy(*by)
    return joined.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def prefixes(text: Column, drop: int = 3, least: int = 3) -> Column:
    """Forms of a text without its last one to ``drop`` words, longest first; never the whole text, nor under ``least`` characters."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    forms = F.transform(F.sequence(F.lit(1), F.greatest(F.least(F.lit(drop), F.size(words) - 1), F.lit(1))), lambda k: F.array_join(F.slice(words, F.lit(1), F.greatest(F.size(words) - k, F.lit(0))), " "))
    return F.filter(forms, lambda p: F.length(p) >= least)


def prefix_match(probes: DataFrame, variants: DataFrame, probe: str, title: str, variant: str, by: Sequence[Column], on: Sequence[str] = (), least: int = 3) -> DataFrame:
    """The best variant that begins with a form of the probe's title and agrees in the columns ``on``, longest form first.

    Every distinct form finds its one best variant first: each variant is spread over those of its own beginnings that are
    as long as a form with the same first ``least`` characters, so all joins are on equal text, and a common first word is
    no hot key of candidates.
    """
    on = list(on)
    head = lambda c: F.substring(c, 1, least).alias("_head")
    forms = probes.select(probe, *on, F.explode(prefixes(F.col(title), least=least)).alias("prefix"))
    wanted = forms.select(*on, "prefix").distinct()
    lengths = wanted.groupBy(*on, head("prefix")).agg(F.collect_set(F.length("prefix")).alias("_lengths"))
    spread = variants.withColumn("_head", head(F.col(variant))).join(lengths, [*on, "_head"])
    spread = spread.withColumn("_n", F.explode("_lengths")).where(F.col("_n") <= F.length(variant))
    spread = spread.withColumn("prefix", F.expr(f"substring({variant}, 1, _n)")).drop("_n", "_lengths", "_head").join(wanted, [*on, "prefix"], "left_semi")
    best = spread.withColumn("_n", F.row_number().over(Window.partitionBy(*on, "prefix").orderBy(*by))).where("_n = 1").drop("_n")
    found = forms.join(best, [*on, "prefix"]).drop(*on)
    longest = found.withColumn("_n", F.row_number().over(Window.partitionBy(probe).orderBy(F.length("prefix").desc()))).where("_n = 1").drop("_n")
    return probes.join(longest, probe)


def media_kind(content_class: Column) -> Column:
    """``series`` for episodes, packs and their anime forms, ``movie`` for all else."""
    return F.when(content_class.isin("episode", "multi_episode", "season_pack", "anime_episode", "anime_pack"), "series").otherwise("movie")


def canonical_lookup(probes: DataFrame, variants: DataFrame, families: DataFrame) -> DataFrame:
    """The family of every probe (``probe, title, year, content_class, season``) that has one, with ``how``.

    Variants have ``media_kind, normalized_title, season_bucket, year_hint, evidence, family_key``; families ``family_key,
    family_evidence, tmdb_id`` and more. A variant must agree in kind, title and season. Those with an equal or unknown year
    come first (``exact``; without a year all of them), then any year (``no_year``); series then try beginnings of the title,
    longest first, among families with a TMDB id (``prefix``). More evidence of the variant, then of the family, stands;
    of equal ones the smallest family key. Variants that agree in all that is asked for are one row, the strongest, before
    they meet anything, and each distinct question is answered once, so a title that very many share multiplies nothing.
    """
    place = ["media_kind", "season_bucket"]
    on = [*place, "normalized_title"]
    asked = probes.where(F.col("title") != "").select(
        "probe", F.col("title").alias("normalized_title"), F.coalesce("year", F.lit(0)).alias("_year"), media_kind(F.col("content_class")).alias("media_kind"), season_bucket(F.col("season")).alias("season_bucket"),
    )
    known = variants.join(families, "family_key")
    strength = [F.coalesce(-F.col(c).cast("double"), F.lit(float("inf"))).alias(f"_{c}") for c in ("evidence", "family_evidence")]
    names = ["family_key", *[c for c in families.columns if c != "family_key"]]
    strongest = F.min(F.struct(*strength, *[F.col(c).alias(f"_of_{c}") for c in names])).alias("_s")
    rank = lambda tier, short: F.struct(tier.alias("tier"), short.alias("short"), "_s")
    fits = (F.col("_year") == 0) | F.col("year_hint").isNull() | (F.col("year_hint") == F.col("_year"))
    exact = F.when(F.col("_s").isNotNull(), rank(F.when(fits, 0).otherwise(1), F.lit(0)))
    # The series flag is summed up with the rest so that no filter on it separates the plans of this table's uses.
    settled = asked.select(*on, "_year").distinct().join(known.groupBy(*on, "year_hint").agg(strongest), on, "left")
    settled = settled.groupBy(*on, "_year").agg(F.min(exact).alias("_b"), F.bool_or(F.col("media_kind") == "series").alias("_series"))
    open_ = settled.where("_b is null and _series").drop("_b", "_series")
    wanted = open_.select(F.struct(*on).alias("_asked"), *place, F.col("normalized_title").alias("title")).distinct()
    begun = known.where("tmdb_id is not null").groupBy(*on).agg(strongest)
    found = prefix_match(wanted, begun, "_asked", "title", "normalized_title", [F.col("_s")], place)
    found = found.select("_asked.*", rank(F.lit(2), -F.length("prefix")).alias("_b"))
    answers = settled.where("_b is not null").drop("_series").unionByName(open_.join(found, on))
    best = asked.join(answers, [*on, "_year"]).select("probe", "_b").repartition("probe").groupBy("probe").agg(F.min("_b").alias("_b"))
    how = F.when(F.col("_b.tier") == 0, "exact").when(F.col("_b.tier") == 1, "no_year").otherwise("prefix")
    return best.select("probe", *[F.col("_b._s")[f"_of_{c}"].alias(c) for c in names], how.alias("how"))


def similar_titles(names: DataFrame, column: str, threshold: float) -> DataFrame:
    """Pairs ``a < b`` of distinct titles with ``score``, their word similarity, at least ``threshold``.

    Words are ordered by how many titles hold them. Two titles that similar share one of their ``n - ceil(t * n) + 1``
    rarest words, and the shorter has at least ``t`` times the words of the longer.
    """
    words = names.select(F.col(column).alias("t"), F.array_distinct(F.filter(F.split(column, " "), lambda w: w != "")).alias("ws")).where("size(ws) > 0")
    held = words.select("t", F.explode("ws").alias("w"))
    ordered = held.join(held.groupBy("w").agg(F.count("*").alias("n")), "w").groupBy("t").agg(F.array_sort(F.collect_list(F.struct("n", "w"))).alias("s"))
    size = F.size("s")
    prefix = F.slice("s", F.lit(1), size - F.ceil(size * F.lit(threshold) - 1e-9).cast("int") + 1)
    probes = ordered.select("t", F.transform("s", lambda x: x["w"]).alias("ws"), F.explode(F.transform(prefix, lambda x: x["w"])).alias("w"))
    side = lambda n: probes.select("w", F.col("t").alias(n), F.col("ws").alias(f"_{n}"))
    short, long_ = F.least(F.size("_a"), F.size("_b")), F.greatest(F.size("_a"), F.size("_b"))
    pairs = side("a").join(side("b"), "w").where((F.col("a") < F.col("b")) & (short >= long_ * F.lit(threshold) - 1e-9)).drop("w").dropDuplicates(["a", "b"])
    score = F.size(F.array_intersect("_a", "_b")) / F.size(F.array_union("_a", "_b"))
    return pairs.select("a", "b", score.alias("score")).where(F.col("score") >= threshold)


def cascade(tiers: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows of the first tier that knows the key; adds ``tier`` from 0."""
    both = None
    for i, t in enumerate(tiers):
        t = t.withColumn("tier", F.lit(i))
        both = t if both is None else both.unionByName(t, allowMissingColumns=True)
    w = Window.partitionBy(key)
    return both.withColumn("_t", F.min("tier").over(w)).where("tier = _t").drop("_t")


def latest_start(probes: DataFrame, mappings: DataFrame, on: Sequence[str], at: str, start: str, values: Sequence[str] = (), fallback: bool = False) -> DataFrame:
    """As-of pick: probes with the mapping of the greatest start that is not behind them, ``matched`` where there is one.

    A probe before all starts stays, with nulls, or with the key's first mapping where ``fallback`` is set. Both sides are
    sorted together once, so a key with many probes and mappings never multiplies them.
    """
    side = lambda df, n, p, m: df.select(*on, F.col(at if n else start).alias("_at"), F.lit(n).alias("_side"), p.alias("_p"), m.alias("_m"))
    mapping = F.struct(start, *values)
    both = side(mappings, 0, F.lit(None), mapping).unionByName(side(probes, 1, F.struct(*probes.columns), F.lit(None)))
    w = Window.partitionBy(*on).orderBy("_at", "_side", "_m")
    found = both.withColumn("_last", F.last("_m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = found.withColumn("_first", F.min("_m").over(Window.partitionBy(*on))).where("_side = 1")
    chosen = F.coalesce("_last", "_first") if fallback else F.col("_last")
    return found.withColumn("_c", chosen).select("_p.*", *[F.col("_c")[c].alias(c) for c in (start, *values)], F.col("_last").isNotNull().alias("matched"))


def overlapping(a_start: Column, a_end: Column, b_start: Column, b_end: Column, tolerance: int = 0) -> Column:
    """Whether two intervals meet, with a tolerance."""
    return (a_start - tolerance <= b_end) & (a_end + tolerance >= b_start)


def capable(requests: DataFrame, capabilities: DataFrame, id_column: str = "id") -> DataFrame:
    """Sources for each request: resource and type agree, and the id has one of the source's prefixes (none: any id).

    Spark broadcasts the capabilities if they are as small as a registry of sources is.
    """
    fits = F.col("prefixes").isNull() | (F.size("prefixes") == 0) | F.exists("prefixes", lambda p: F.col(id_column).startswith(p))
    return requests.join(capabilities, ["resource", "type"]).where(fits)


def two_step_tags(rows: DataFrame, hashes: DataFrame, groups: DataFrame, request: str, hash_column: str, group_column: str) -> DataFrame:
    """Tag by hash; only in requests without any hash match, tag by release group."""
    by_hash = rows.join(hashes.select(F.col("hash").alias(hash_column), F.lit(True).alias("_h")).distinct(), hash_column, "left")
    both = by_hash.join(groups.select(F.col("group").alias(group_column), F.lit(True).alias("_g")).distinct(), group_column, "left")
    any_hash = F.max(F.coalesce(F.col("_h"), F.lit(False))).over(Window.partitionBy(request))
    tagged = F.when(any_hash, F.coalesce("_h", F.lit(False))).otherwise(F.coalesce("_g", F.lit(False)))
    return both.withColumn("tagged", tagged).drop("_h", "_g")


def decide_candidate(candidates: DataFrame, probe: str, similarity: Column, year_gap: Column, popularity: Column, candidate: str) -> DataFrame:
    """Best candidate of each probe by weighted score, with ``status``.

    Ambiguous: another candidate at most 25 below, similarity under 0.74, or years apart (one year needs 0.92). Strong: one
    year apart, or an unknown year and similarity under 0.92. Exact: all else.
    """
    year = F.when(year_gap == 0, 120).when(year_gap == 1, 40).when(year_gap.isNotNull(), -70).otherwise(0)
    scored = candidates.withColumn("score", 300 * similarity + year + F.least(popularity, F.lit(50.0)))
    w = Window.partitionBy(probe).orderBy(F.desc("score"), F.col(candidate))
    top = scored.withColumn("_n", F.row_number().over(w)).withColumn("_top", F.first(candidate).over(w))
    second = F.max(F.when(F.col(candidate) != F.col("_top"), F.col("score"))).over(Window.partitionBy(probe))
    best = top.withColumn("_second", second).where("_n = 1")
    off = (year_gap > 1) | ((year_gap == 1) & (similarity < 0.92))
    unclear = (F.col("_second") >= F.col("score") - 25) | (similarity < 0.74) | off
    weaker = (year_gap == 1) | (year_gap.isNull() & (similarity < 0.92))
    status = F.when(F.coalesce(unclear, F.lit(False)), "ambiguous").when(F.coalesce(weaker, F.lit(False)), "strong").otherwise("exact")
    return best.withColumn("status", status).drop("_n", "_top", "_second")


def merged_metadata(keys: DataFrame, providers: Sequence[DataFrame], key: str, first_wins: Sequence[str], lists: Sequence[str]) -> DataFrame:
    """Providers joined in order: the first value stands, list columns are concatenated without repeats."""
    out = keys
    for i, p in enumerate(providers):
        out = out.join(p.select(key, *[F.col(c).alias(f"{c}_{i}") for c in (*first_wins, *lists)]), key, "left")
    n = range(len(providers))
    empty = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    return out.select(key, *[F.coalesce(*[F.col(f"{c}_{i}") for i in n]).alias(c) for c in first_wins], *[F.array_distinct(F.concat(*[empty(f"{c}_{i}") for i in n])).alias(c) for c in lists])


def best_file(files: DataFrame, key: str, score: Column, index: str = "file_index") -> DataFrame:
    """The file with the highest score, not below 0; the first one on ties."""
    w = Window.partitionBy(key).orderBy(F.desc("file_score"), F.col(index))
    return files.withColumn("file_score", F.greatest(score, F.lit(0.0))).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def crosswalk(requests: DataFrame, mappings: DataFrame, ids: Sequence[str], request: str, order: str, listed: Sequence[str]) -> DataFrame:
    """One mapping for each request (``id_type, id_value, season, episode``), looked up by whatever kind of id it has.

    Mappings have one column for each kind of id, ``kind``, ``starts`` (source, season, episode) and ``synonyms``. Kinds
    that do not suit the season go, unless none would stay. The greatest start not behind the episode wins (``start``; of
    equal ones the first source, whose source 1 counts for ``listed`` ids only), then a synonym that names the season, then
    the first mapping by ``order``. Requests without a mapping stay, with nulls.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("id_type"), F.col(i).cast("string").alias("id_value")) for i in ids]))
    long_ = mappings.withColumn("_id", pairs).select("_id.*", *[c for c in mappings.columns if c not in ids]).where("id_value is not null")
    found = requests.join(long_, ["id_type", "id_value"], "left")
    season, episode, kind = F.col("season"), F.col("episode"), F.col("kind")
    fits = (kind == "UNKNOWN") | F.when(season.isNull(), kind == "MOVIE").when(season == 0, kind.isin("SPECIAL", "OVA", "ONA")).otherwise(kind == "TV")
    w = Window.partitionBy(request)
    found = found.withColumn("_fits", F.coalesce(fits, F.lit(False))).withColumn("_any", F.max("_fits").over(w)).where("_fits or not _any")
    # A start that names no episode begins with the first.
    starts = F.transform("starts", lambda s: F.struct(s["source"].alias("source"), s["season"].alias("season"), F.coalesce(s["episode"], F.lit(1)).alias("episode")))
    valid = F.filter(starts, lambda s: (s["season"] == season) & (s["episode"] <= episode) & ((s["source"] == 0) | F.col("id_type").isin(*listed)))
    best = F.array_max(F.transform(valid, lambda s: F.struct(s["episode"].alias("episode"), (-s["source"]).alias("source"))))
    pattern = F.concat(F.lit(r"(?i)season[\s_-]*"), season.cast("string"))
    named = F.coalesce(episode.isNotNull() & F.exists("synonyms", lambda s: F.regexp_like(s, pattern)), F.lit(False))
    ranked = found.withColumn("_best", best).withColumn("_named", named)
    ranked = ranked.withColumn("_n", F.row_number().over(w.orderBy(F.col("_best").desc_nulls_last(), F.col("_named").desc(), order))).where("_n = 1")
    return ranked.withColumn("start", F.col("_best.episode")).drop("_n", "_any", "_fits", "_best", "_named")


def candidate_rank(title: Column, source: Column, noise: Column, trusted: str) -> Column:
    """Rank of one reading of a title; the least is best.

    A leading number before other words takes one from the noise, a single word of the trusted source adds two.
    """
    words = F.filter(F.split(title, r"\s+"), lambda w: w != "")
    n = F.size(words)
    number = F.coalesce(F.try_element_at(words, F.lit(1)).rlike(r"^\d+$"), F.lit(False)) & (n >= 2)
    score = noise - F.when(number, 1).otherwise(0) + F.when((source == trusted) & (n <= 1), 2).otherwise(0)
    return F.struct(score.alias("score"), F.when(source == trusted, 0).otherwise(1).alias("source"), (-n).alias("words"), F.length(title).alias("length"))
