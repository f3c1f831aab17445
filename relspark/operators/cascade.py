"""Finding films and series by any of their titles: an index of titles by phase, probed by one equi-join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import roman_variants

#: Phases in order: a title of an earlier one stands before any of a later one.
PHASES = ("main", "original", "alternative", "translated")


def title_index(titles: DataFrame, alternatives: DataFrame | None = None, translations: DataFrame | None = None) -> DataFrame:
    """``title, phase, id, imdb_id, year, secondary_year, popularity``: one row for each title that an id is known by.

    ``titles`` has ``id, imdb_id, title, original_title, year, secondary_year, popularity`` and one row for each id (series
    leave ``secondary_year`` null); the others have ``id, title``, and ids that ``titles`` lacks are left out. Write the index
    once, bucketed by ``title`` where it is large: every probe joins on that column alone.
    """
    facts = [F.col(c) for c in ("id", "imdb_id", "year", "secondary_year", "popularity")]
    own = F.array(F.struct(F.lit(0).alias("phase"), F.col("title").alias("title")), F.struct(F.lit(1).alias("phase"), F.col("original_title").alias("title")))
    out = titles.select(F.inline(own), *facts)
    known = titles.select(*facts)
    for phase, more in ((2, alternatives), (3, translations)):
        if more is not None:
            out = out.unionByName(more.select("id", "title").join(known, "id").withColumn("phase", F.lit(phase)))
    return out.where("title != ''").select("title", "phase", "id", "imdb_id", "year", "secondary_year", "popularity")


def _year_fits(wanted: Column) -> Column:
    """No year (or 0) is wanted, or it is at most one from the year, or it is the secondary year."""
    near = (F.abs(F.col("year") - wanted) <= 1) | (F.col("secondary_year") == wanted)
    return F.coalesce(wanted, F.lit(0)).eqNullSafe(F.lit(0)) | F.coalesce(near, F.lit(False))


def title_cascade(probes: DataFrame, index: DataFrame, probe: str, title: str, year: str | None = None, reading: str | None = None) -> DataFrame:
    """``probe, id, imdb_id, matched_year, phase`` of the best title of every probe that has one.

    All forms of the probe's title with Roman and Arabic numbers exchanged are looked up at once. The earliest phase wins, in
    it the most popular title, of equally popular ones the smallest id; unknown popularity is the least. Probes with several
    readings have one row for each, and the first ``reading`` that finds anything wins before the phase counts. Null and
    empty titles find nothing. Each distinct title and year is looked up once, and of the index's rows that agree in title
    and years only the best one, so a form that very many titles share multiplies nothing.
    """
    order = [F.col(reading).alias("_reading")] if reading else []
    wanted = F.coalesce(F.col(year).cast("int"), F.lit(0)) if year else F.lit(0)
    asked = probes.where(F.col(title) != "").select(F.col(probe).alias("_probe"), *order, wanted.alias("_year"), F.col(title).alias("_title"))
    least_popular = F.coalesce(-F.col("popularity").cast("double"), F.lit(float("inf")))
    rank = F.struct("phase", least_popular.alias("_less"), "id", "imdb_id", F.col("year").alias("matched_year"))
    best = index.groupBy("title", "year", "secondary_year").agg(F.min(rank).alias("_b"))
    # The hash is never null; it reads all columns so that the questions and the join share one scan of the probes and its shuffles.
    questions = asked.groupBy("_title", "_year").agg(F.max(F.xxhash64(*asked.columns)).alias("_any")).where("_any is not null")
    forms = questions.select("_title", "_year", F.explode(roman_variants(F.col("_title"))).alias("title"))
    answers = forms.join(best, "title").where(_year_fits(F.col("_year"))).groupBy("_title", "_year").agg(F.min("_b").alias("_b"))
    found = asked.join(answers, ["_title", "_year"]).select("_probe", F.struct(*(["_reading"] if reading else []), "_b").alias("_r"))
    best = found.repartition("_probe").groupBy("_probe").agg(F.min("_r").alias("_r"))
    shown = F.element_at(F.array(*[F.lit(p) for p in PHASES]), F.col("_r._b.phase") + 1).alias("phase")
    more = [F.col("_r._reading").alias(reading)] if reading else []
    return best.select(F.col("_probe").alias(probe), "_r._b.id", "_r._b.imdb_id", "_r._b.matched_year", shown, *more)
