"""Source divergence audit: how far the term distributions of the sources of a language lie apart.

Every task counts the terms of its texts by (language, source, term) before anything is shuffled. Each kept term then becomes
one wide row: an array of its counts over all sources of its language. Higher-order functions turn that array into smoothed
probabilities and into the contributions of all pairs of sources, which are summed on the map side, so what is shuffled is
a partial sum for each pair and task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

#: Documents of a language that a term needs, what is added to each count, the unit of a probability, and ranks of part ``term``.
LEAST_DOCUMENTS, SMOOTHING, UNIT, TOP = 30, 5, 1_000_000_000, 50
#: Counts that a task remembers before it hands them on, and bytes of a text that are cut into terms at a time.
MEMORY, PIECE = 200_000, 1 << 20
#: A-Z in lower case, all that ends a term as a blank; bytes of other characters stay as they are.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def _pieces(text: str) -> Iterator[list[bytes]]:
    """Terms in order, a bounded number of bytes at a time."""
    data, at = text.encode("utf-8", "replace").translate(_TERMS), 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def made() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in groups.items():
            names = [pa.array([x], pa.string()).take(pa.array([0] * len(n), pa.int32())) for x in (lang, source)]
            term, each = pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64())
            held = pa.array([docs[t] for t in n], pa.int64())
            yield pa.RecordBatch.from_arrays([*names, term, each, held], names=["lang", "source", "term", "n", "docs"])
        groups.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for words in _pieces(text):
                n.update(words)
                seen.update(words)
            docs.update(seen)
        if sum(len(n) for n, _ in groups.values()) > MEMORY:
            yield from made()
    yield from made()


def count_terms(documents: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term, and the documents that hold it."""
    each = documents.select("lang", "source", "text").mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return each.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _probability(count: Column, total: Column, kept: Column, smoothing: int, unit: int) -> Column:
    """``1 + floor(unit * (count + smoothing) / (total + smoothing * kept))`` in integers of any size."""
    share = F.lit(unit).cast("decimal(10,0)") * (count + F.lit(smoothing)).cast("decimal(20,0)")
    return F.call_function("div", share, (total + F.lit(smoothing) * kept).cast("decimal(20,0)")) + F.lit(1)


def term_vectors(documents: DataFrame, least_documents: int, smoothing: int, unit: int) -> tuple[DataFrame, DataFrame]:
    """One row for each kept term of a language, and one for each language.

    The first has ``lang, term, counts, p, q`` and the language's ``sources``; ``counts`` and ``p`` run along the sources.
    The second has ``lang, sources``, in UTF-8 order. A term's row is as wide as its language has sources.
    """
    cells = F.collect_list(F.struct("source", "n")).alias("cells")
    wide = count_terms(documents).groupBy("lang", "term").agg(F.sum("docs").alias("docs"), cells)
    kept = materialize(wide.where(F.col("docs") >= least_documents).select("lang", "term", "cells"), "terms")
    totals = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = documents.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").na.fill(0, ["total"])
    frames = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("source", "total"))).alias("groups"), F.sum("total").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("kept"))
    # Written, so that Spark knows how small it is before it chooses the join.
    frames = materialize(frames.join(sizes, "lang", "left"), "frames")

    own = kept.join(frames, "lang").withColumn("own", F.map_from_entries("cells"))
    counts = F.transform("groups", lambda g: F.coalesce(F.col("own")[g["source"]], F.lit(0)))
    own = own.select("lang", "term", "groups", "total", "kept", counts.alias("counts"))
    p = F.transform(F.arrays_zip("groups", "counts"), lambda x: _probability(x["counts"], x["groups"]["total"], F.col("kept"), smoothing, unit))
    every = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    q = _probability(every, F.col("total"), F.col("kept"), smoothing, unit)
    return own.select("lang", "term", F.col("groups.source").alias("sources"), "counts", p.alias("p"), q.alias("q")), frames.select("lang", F.col("groups.source").alias("sources"))


def _pairs(vectors: DataFrame, languages: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for all ordered pairs of different sources of a language."""
    first = vectors.where(F.size("p") > 1).select("lang", "p", F.posexplode("p").alias("i", "x"))
    each = F.transform(F.slice("p", F.col("i") + 2, F.size("p")), lambda y, k: F.struct((F.col("i") + 1 + k).alias("j"), F.abs(F.col("x") - y).alias("f")))
    added = first.select("lang", "i", F.inline(each))
    # Languages without kept terms still have their pairs, at no distance.
    places = F.sequence(F.lit(0), F.size("sources") - 1)
    none = languages.where(F.size("sources") > 1).select("lang", "sources", F.explode(places).alias("i"))
    none = none.select("lang", "i", F.explode(F.slice(places, F.col("i") + 2, F.size("sources"))).alias("j"), F.lit(0).cast("long").alias("f"))
    summed = added.unionByName(none).groupBy("lang", "i", "j").agg(F.sum("f").alias("value")).join(languages, "lang")
    a, b = F.get("sources", F.col("i")), F.get("sources", F.col("j"))
    ends = F.array(F.struct(a.alias("source"), b.alias("item")), F.struct(b.alias("source"), a.alias("item")))
    return summed.select("lang", F.inline(ends), "value")


def _typical(vectors: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for the terms that a source has and holds more often than its language does."""
    each = vectors.select("lang", "term", "q", F.inline(F.arrays_zip("sources", "counts", "p")))
    return each.where("counts > 0 AND p > q").select("lang", F.col("sources").alias("source"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))


def audit(documents: DataFrame, least_documents: int = LEAST_DOCUMENTS, smoothing: int = SMOOTHING, unit: int = UNIT, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances between sources, and the terms that mark a source.

    Part ``pair`` has every other source of the language with the summed difference of probabilities over the language's
    kept terms (0 without any). Part ``term`` has the ``top`` terms whose probability in the source exceeds that in the
    language most. Ranks count from 1 for each source and part, greatest value first, ties by UTF-8 order of the item.

    Null text, lang and source are empty strings. Every row is a document of its own, repeated rows and ids too; texts are
    counted whole; other columns and ``doc_id`` are not read. A source alone in its language has no pairs; an empty table
    gives no rows.
    """
    blank = F.lit("")
    rows = documents.select(*[F.coalesce(F.col(c).cast("string"), blank).alias(c) for c in ("lang", "source", "text")])
    vectors, languages = term_vectors(rows, least_documents, smoothing, unit)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(vectors, languages).withColumn("rank", F.row_number().over(order))
    # Spark keeps only the first ranks of each task before it shuffles for the window.
    terms = _typical(vectors).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(pairs, "pair").unionByName(part(terms, "term"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: every pair of sources of a language, and the 50 most typical terms of each source."""
    return audit(table(spark, sf_dir, "documents"))


#: The same by one row for each group and kept term.
ORACLE_SQL = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
c AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, k.n AS every FROM g JOIN k USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS MATERIALIZED (SELECT c.lang, c.source, c.term, c.n,
    1 + CAST({UNIT} AS HUGEINT) * (c.n + {SMOOTHING}) // (s.n + {SMOOTHING} * v.v) AS p,
    1 + CAST({UNIT} AS HUGEINT) * (c.every + {SMOOTHING}) // (v.n + {SMOOTHING} * v.v) AS q
    FROM c JOIN s ON s.lang = c.lang AND s.source = c.source JOIN v ON v.lang = c.lang),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
u AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u) WHERE part = 'pair' OR rank <= {TOP}"""
