"""Sinks: client records, search records, ranked CSV, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.formatting import size_bin


def client_rows(rows: DataFrame, name: Column, description: Column) -> DataFrame:
    """What a player gets: only the locator of the row's type, and the group key of rows that may follow each other."""
    kind = F.col("type")
    only = lambda c, *types: F.when(kind.isin(*types), F.col(c)).alias(c)
    group = F.concat_ws("|", F.col("source_id"), F.coalesce("service_id", F.lit("")), F.coalesce("resolution", F.lit("")), F.coalesce("quality", F.lit("")), size_bin(F.col("size")))
    return rows.select("request_id", name.alias("name"), description.alias("description"), only("url", "debrid", "http", "usenet", "live"), only("info_hash", "p2p"), only("external_url", "external"), only("yt_id", "youtube"), group.alias("binge_group"))


def search_rows(rows: DataFrame, fields: Sequence[str], required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required fields, every missing field as null; and how many rows were dropped, in one row."""
    full = rows.select(*[F.col(f) if f in rows.columns else F.lit(None).cast("string").alias(f) for f in fields])
    has = F.lit(True)
    for f in required:
        has = has & F.col(f).isNotNull()
    return full.where(has), full.agg(F.count_if(~has).alias("dropped"))


def link_rows(rows: DataFrame) -> DataFrame:
    """Rows that a browser can open."""
    return rows.where(F.col("url").isNotNull()).select("request_id", F.col("id"), "url", F.concat_ws(" ", "resolution", "quality", "release_group").alias("title"))


def ranked_csv(rows: DataFrame, path: str, decimals: dict[str, int], by: Sequence[Column]) -> None:
    """A ranked report with fixed decimals in one file; reports hold a row per source."""
    shown = [F.format_string(f"%.{decimals[c]}f", F.col(c)).alias(c) if c in decimals else F.col(c) for c in rows.columns]
    rows.orderBy(*by).coalesce(1).select(*shown).write.mode("overwrite").option("header", True).csv(path)


def allow_list(rows: DataFrame, key: str, path: str) -> None:
    """The chosen keys as one JSON array."""
    rows.agg(F.array_sort(F.collect_list(key)).alias(key)).coalesce(1).write.mode("overwrite").json(path)


def json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
