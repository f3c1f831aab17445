"""License scans as an exact set-similarity join, in DataFrame operations only.

Text blocks are overlapping windows of words; a block has a template's label if it holds at least ``THRESHOLD`` of the
template's distinct words. Words are ordered by how many documents of the whole corpus hold them, rarest first; a block
and a template that overlap enough must share a word of both prefixes in that order, be long enough, and leave enough
words after the shared position. Pairs that pass the three filters are verified on the full sets.
"""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Base phrases and their labels (fixed values).
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))
#: Templates of the similarity join: label and words; none is longer than STRIDE words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.9
WINDOW = 192
STRIDE = 96
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words in order, A-Z in lower case; null text has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK), "")


def _literal(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def _stands_at(phrase: tuple[str, ...]):
    return lambda i: functools.reduce(operator.and_, [F.coalesce(F.get("words", i + k) == w, F.lit(False)) for k, w in enumerate(phrase)])


def _places() -> Column:
    """Start positions of all base phrases, phrase by phrase; only texts with its first and last word are looked at."""
    found = []
    for phrase, _ in PHRASES:
        at = F.filter(F.sequence(F.lit(0), F.size("words") - 1), _stands_at(phrase))
        found.append(F.when(F.array_contains("words", phrase[0]) & F.array_contains("words", phrase[-1]), at).otherwise(F.array().cast("array<int>")))
    return F.array(*found)


def scan(documents: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` of every text.

    ``score`` is 1 with a base phrase, else the greatest containment of a template that meets the threshold, else 0.
    Null and empty texts have no words, labels or places. Rows that repeat an id are told apart by their text; whole
    copies of a row get the same result each, an empty table stays empty, and other columns are not read. Templates are a
    bounded parameter, so their index is broadcast.
    """
    sets = [(label, sorted(set(text.split()))) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    least = min(math.ceil(threshold * len(ws) - 1e-9) for _, ws in sets)
    docs = documents.select("doc_id", F.xxhash64(F.col("doc_id"), F.col("text")).alias("row"), words_of(F.col("text")).alias("words"))
    docs = docs.withColumn("held", F.array_intersect("words", _literal(vocabulary)))
    # Texts are read and cut into words once; what is written holds the template words of every block, not the texts.
    starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(STRIDE))
    blocks = F.transform(starts, lambda s: F.array_intersect(F.slice("words", s, F.lit(WINDOW)), _literal(vocabulary)))
    blocks = F.when(F.size("held") >= least, F.filter(blocks, lambda own: F.size(own) >= least)).otherwise(F.array().cast("array<array<string>>"))
    digest = materialize(docs.select("doc_id", "row", F.size("words").cast("long").alias("n_words"), _places().alias("places"), "held", blocks.alias("blocks")), "licenses")
    counted = digest.select(F.explode("held").alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (frequency.get(w, 0), w)))}
    needed, index = {}, []
    for k, (label, ws) in enumerate(sets):
        ranks = sorted(order[w] for w in ws)
        needed[k] = (label, ranks, math.ceil(threshold * len(ws) - 1e-9))
        index += [(r, k, i) for i, r in enumerate(ranks[: len(ranks) - needed[k][2] + 1])]
    first_words = [w for w in vocabulary if order[w] in {r for r, _, _ in index}]
    spark = documents.sparkSession
    prefixes = spark.createDataFrame(index, "rank int, template int, at int")
    facts = spark.createDataFrame([(k, label, ranks, need) for k, (label, ranks, need) in needed.items()], "template int, label string, ranks array<int>, need int")

    near = digest.where(F.arrays_overlap("held", _literal(first_words)))
    rank_of = F.create_map(*[F.lit(x) for w, r in order.items() for x in (w, r)])
    blocks = near.select("doc_id", "row", F.explode("blocks").alias("words")).where(F.arrays_overlap("words", _literal(first_words)))
    blocks = blocks.select("doc_id", "row", F.array_sort(F.transform("words", lambda w: rank_of[w])).alias("own"))
    # The shortest overlap asked for bounds the block's prefix.
    probes = blocks.select("doc_id", "row", "own", F.posexplode(F.slice("own", F.lit(1), F.size("own") - least + 1)).alias("own_at", "rank"))
    pairs = probes.join(F.broadcast(prefixes), "rank").join(F.broadcast(facts), "template")
    rest = F.least(F.size("ranks") - F.col("at"), F.size("own") - F.col("own_at"))
    pairs = pairs.where((F.size("own") >= F.col("need")) & (rest >= F.col("need") - F.least("at", "own_at")))
    overlap = F.size(F.array_intersect("own", "ranks"))
    pairs = pairs.withColumn("overlap", overlap).where("overlap >= need")
    labelled = pairs.groupBy("doc_id", "row").agg(F.collect_set("label").alias("found"), F.max(F.col("overlap") / F.size("ranks")).alias("best"))

    base = F.filter(F.array(*[F.when(F.size(F.get("places", F.lit(k))) > 0, label) for k, (_, label) in enumerate(PHRASES)]), lambda x: x.isNotNull())
    flat = F.flatten("places")
    based = digest.select(
        "doc_id", "row", "n_words", F.size(flat).cast("long").alias("n_base"), F.array_min(flat).cast("long").alias("first_word"), F.array_max(flat).cast("long").alias("last_word"), base.alias("base")
    )
    labelled = labelled.withColumnRenamed("doc_id", "its_id").withColumnRenamed("row", "its_row")
    joined = based.join(labelled, (F.col("row") == F.col("its_row")) & F.col("doc_id").eqNullSafe(F.col("its_id")), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all ``documents``."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same rows by plain comparison of every window with every template."""
    listed = ", ".join(f"('{label}', {sorted(set(text.split()))!r})" for label, text in TEMPLATES)
    places = " UNION ALL ".join(
        f"SELECT rid, '{label}' AS label, i - 1 AS pos FROM w, unnest(range(1, len(words) + 1)) u(i) WHERE " + " AND ".join(f"words[i + {k}] = '{word}'" for k, word in enumerate(phrase))
        for phrase, label in PHRASES
    )
    return f"""
WITH w AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
t(label, ws) AS (VALUES {listed}),
b AS (SELECT rid, list_distinct(words[s:s + {WINDOW - 1}]) AS own FROM w, unnest(range(1, greatest(len(words), 1) + 1, {STRIDE})) u(s)),
m AS (SELECT rid, label, len(list_intersect(own, ws)) / len(ws) AS share FROM b, t WHERE len(list_intersect(own, ws)) >= ceil({THRESHOLD} * len(ws) - 1e-9)),
p AS ({places}),
pb AS (SELECT rid, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY rid),
l AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT rid, label FROM p UNION SELECT rid, label FROM m) GROUP BY rid),
s AS (SELECT rid, max(share) AS best FROM m GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
    coalesce(pb.labels, '') AS base_labels, coalesce(l.labels, '') AS labels, CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM w LEFT JOIN pb USING (rid) LEFT JOIN l USING (rid) LEFT JOIN s USING (rid)
"""


ORACLE_SQL = _oracle()
