"""Which file of a release is played: an additive score of every file, the best one of each request, and a last check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relspark.functions import rows as rw

#: Points of a file (fixed values); pairs are for a single episode and for several.
POINTS = {"sample": -500, "video": 1000, "year": 500, "season_year": 750, "season": 500, "no_season": -500, "no_episode": -500, "title": 100, "size": 50, "chosen": 25}
ABSOLUTE, RELATIVE, REGULAR, PLAIN = (2000, 500), (1000, 300), (300, 100), (750, 250)
#: Words in names of files that only show a part (fixed values).
SHOWN_PARTS = ("sample", "trailer", "preview")


def _asked(name: str) -> Column:
    """A number of the request; 0 is none."""
    return F.nullif(F.col(f"asked.{name}"), F.lit(0))


def _yes(condition: Column, points: int) -> Column:
    return F.when(condition, points).otherwise(0)


def _wrong_episode(parsed: str) -> Column:
    return rw.wrong_episode(F.col(f"{parsed}.episodes"), _asked("episode"), [_asked("absolute"), _asked("relative")])


def episode_points() -> Column:
    """Points for the episodes in a file's name, 0 if none of them is asked for.

    A name without a season, asked for by season, episode and absolute number, is worth what the first of its numbers is
    that it holds: absolute, relative, regular. Any other name is worth what it holds, one episode more than several.
    """
    episodes = F.col("parsed.episodes")
    n = F.coalesce(F.size(episodes), F.lit(0))
    worth = lambda points: F.when(n == 1, points[0]).when(n > 1, points[1]).otherwise(0)
    holds = lambda name: F.coalesce(F.array_contains(episodes, _asked(name)), F.lit(False))
    numbered = F.when(holds("absolute"), worth(ABSOLUTE)).when(holds("relative"), worth(RELATIVE)).when(holds("episode"), worth(REGULAR)).otherwise(0)
    bare = (F.coalesce(F.size("parsed.seasons"), F.lit(0)) == 0) & _asked("season").isNotNull() & _asked("absolute").isNotNull() & _asked("episode").isNotNull()
    return F.when(_wrong_episode("parsed"), 0).when(bare, numbered).otherwise(worth(PLAIN))


def file_points(total: Column) -> Column:
    """Score of a file among those of its request, whose sizes are shares of ``total``; not below 0."""
    video = rw.is_video(F.col("name"), F.col("mime"))
    year = F.nullif(F.col("parsed.year"), F.lit(0))
    stands = lambda name: F.coalesce(F.size(f"parsed.{name}"), F.lit(0)) > 0
    wrong_season = rw.wrong_season(F.col("parsed.seasons"), F.col("parsed.episodes"), _asked("season"), _asked("absolute"))
    number = F.coalesce(_asked("episode"), _asked("absolute")).isNotNull()
    title = (F.col("parsed.title") != "") & video & F.coalesce(F.col("title_ok"), F.lit(False))
    points = [
        _yes(F.lower("name").rlike("|".join(SHOWN_PARTS)), POINTS["sample"]),
        _yes(video, POINTS["video"]),
        _yes(_asked("year") == year, POINTS["year"]),
        _yes(_asked("season_year") == year, POINTS["season_year"]),
        _yes(~wrong_season, POINTS["season"]),
        _yes(~stands("seasons") & _asked("season").isNotNull(), POINTS["no_season"]),
        episode_points(),
        _yes(~stands("episodes") & number, POINTS["no_episode"]),
        _yes(title, POINTS["title"]),
        _yes(F.col("chosen_index") == F.col("file_index"), POINTS["chosen"]),
        _yes((F.col("chosen_name") != "") & F.contains("release", F.col("chosen_name")), POINTS["chosen"]),
    ]
    share = F.when(total > 0, F.coalesce(F.col("size"), F.lit(0)).cast("double") / total.cast("double") * POINTS["size"]).otherwise(0.0)
    return F.greatest(sum(points, F.lit(0)) + share, F.lit(0.0))


def select_files(requests: DataFrame, files: DataFrame, key: str, check: bool = True) -> DataFrame:
    """One row for each request: ``file_index, name, size, file_score, refused``.

    Requests have ``key, release, release_size, release_parsed, asked, chosen_index, chosen_name``; files have ``key,
    file_index, name, mime, size, parsed, title_ok`` (say, of ``matching.title_match``). ``parsed`` is a struct of title,
    year, seasons and episodes; ``asked`` one of year, season_year, season, episode, absolute and relative, where 0 and null
    are no number. The best score wins, then the smaller index; files of other kinds and unparsed names have no score.
    A request without files gets its release as file -1; one whose files have no score (``no file``), or whose best file or
    release holds other episodes (``other episode``, only if ``check`` and both are parsed), gets none.

    The shuffle by the key of both sides serves the join, the greatest size and the rank.
    """
    w = Window.partitionBy(key)
    rows = requests.join(files, key, "left")
    total = F.coalesce(F.nullif("release_size", F.lit(0)).cast("double"), F.max(F.col("size").cast("double")).over(w))
    counts = F.col("file_index").isNotNull() & F.col("parsed").isNotNull() & ~rw.is_not_video(F.col("name"), F.col("mime"))
    scored = rows.withColumn("_total", total).withColumn("file_score", F.when(counts, file_points(F.col("_total"))))
    best = scored.withColumn("_n", F.row_number().over(w.orderBy(F.col("file_score").desc_nulls_last(), "file_index"))).where("_n = 1")
    none = F.col("file_index").isNull()
    refused = F.when(~none & F.col("file_score").isNull(), "no file")
    if check:
        other = F.col("release_parsed").isNotNull() & (_wrong_episode("parsed") | _wrong_episode("release_parsed"))
        refused = refused.when(~none & other, "other episode")
    best = best.withColumn("refused", refused)
    kept = lambda column, alone: F.when(none, alone).when(F.col("refused").isNull(), F.col(column)).alias(column)
    return best.select(key, kept("file_index", F.lit(-1)), kept("name", F.col("release")), kept("size", F.col("release_size")), kept("file_score", F.lit(None)), "refused")
