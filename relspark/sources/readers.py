"""Scans: result, catalogue and log files with explicit schemas, and the contracts that the engine checks on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

STREAM = (
    "request_id long, source_id string, url string, externalUrl string, ytId string, nzbUrl string, infoHash string, fileIdx int, name string, title string, description string,"
    "sources array<string>, behaviorHints struct<filename:string, videoSize:long, bingeGroup:string, notWebReady:boolean, proxyHeaders:map<string,map<string,string>>>"
)
META_PREVIEW = "id string, type string, name string, poster string, description string, releaseInfo string, imdbRating string, genres array<string>"
META = "id string, type string, name string, videos array<struct<id:string, title:string, season:int, episode:int, released:string, streams:array<struct<url:string, infoHash:string>>>>"
SUBTITLE = "id string, url string, lang string"
ADDON = "transportUrl string, manifest struct<id:string, name:string, version:string>"
MANIFEST = (
    "id string, name string, types array<string>, idPrefixes array<string>, resources array<struct<name:string, types:array<string>, idPrefixes:array<string>>>,"
    "catalogs array<struct<type:string, id:string, name:string, extra:array<struct<name:string, isRequired:boolean, options:array<string>>>>>"
)
PROBE = "provider string, indexer string, imdb_id string, media_type string, slot string, category string, repeat_id string, http_status int, items int, elapsed_ms int, error string, timestamp_utc string"


class AllRowsInvalid(ValueError):
    """A source gave rows, and none of them is valid."""


def json_rows(spark: SparkSession, path: str | Sequence[str], schema: str, valid: Column | None = None, multi_line: bool = False, keep_bad: bool = False) -> DataFrame:
    """Rows of JSON files under a schema; broken rows are dropped (or kept with their text in ``_corrupt_record``).

    Raises :class:`AllRowsInvalid` if there are rows but no valid one; the check reads at most until the first valid row.
    """
    full = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField(CORRUPT, T.StringType())])
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multi_line).json(paths)
    good = F.col(CORRUPT).isNull() & (F.coalesce(valid, F.lit(False)) if valid is not None else F.lit(True))
    marked = rows.withColumn("_good", good)
    if not marked.where("_good").take(1) and rows.take(1):
        raise AllRowsInvalid(f"no valid row in {', '.join(paths)}")
    return marked.drop("_good") if keep_bad else marked.where("_good").drop("_good", CORRUPT)


def streams(spark: SparkSession, path: str) -> DataFrame:
    """Raw result rows; a row needs something that can be opened."""
    return json_rows(spark, path, STREAM, F.coalesce("url", "externalUrl", "ytId", "nzbUrl", "infoHash").isNotNull())


def catalog_items(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, META_PREVIEW, F.col("id").isNotNull() & F.col("type").isNotNull())


def videos(spark: SparkSession, path: str) -> DataFrame:
    """One row for each video of each item."""
    return json_rows(spark, path, META, F.col("id").isNotNull()).select("id", "type", "name", F.explode_outer("videos").alias("video"))


def subtitles(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Subtitles of all capable sources, one behind the other."""
    return json_rows(spark, paths, SUBTITLE, F.col("url").isNotNull())


def addons(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, ADDON, F.col("transportUrl").isNotNull())


def capabilities(spark: SparkSession, path: str) -> DataFrame:
    """Resources of each manifest with the types and prefixes that hold for them."""
    m = json_rows(spark, path, MANIFEST, F.col("id").isNotNull()).select("id", "types", "idPrefixes", F.explode("resources").alias("r"))
    return m.select(F.col("id").alias("source"), F.col("r.name").alias("resource"), F.coalesce("r.types", "types").alias("types"), F.coalesce("r.idPrefixes", "idPrefixes").alias("prefixes"))


def probe_log(spark: SparkSession, path: str) -> DataFrame:
    """A JSONL log; malformed lines are skipped."""
    return spark.read.schema(PROBE).option("mode", "DROPMALFORMED").json(path)


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def text_log(spark: SparkSession, path: str, pattern: str, fields: Sequence[str], carry: Sequence[str] = (), since: Column | None = None) -> DataFrame:
    """Fields of log lines by one pattern; ``carry`` names fields whose last value goes forward to later lines of the file.

    Lines keep their order by file and offset: files are read whole-line in order inside a split, and the split's start
    orders the splits.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    got = lines.select("file", "block", "line", *[F.nullif(F.regexp_extract("value", pattern, i + 1), F.lit("")).alias(f) for i, f in enumerate(fields)])
    w = Window.partitionBy("file").orderBy("block", "line").rowsBetween(Window.unboundedPreceding, 0)
    for c in carry:
        got = got.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return got if since is None else got.where(since)


def rules(spark: SparkSession, path: str) -> DataFrame:
    """Rule lists in either form: an array of rules, or an object with ``values``; any other form is an error."""
    rule = "struct<name:string, pattern:string, score:double>"
    text = spark.read.option("wholetext", True).text(path)
    listed, wrapped = F.from_json("value", f"array<{rule}>"), F.from_json("value", f"struct<values:array<{rule}>>")["values"]
    found = F.when(F.trim("value").startswith("["), listed).otherwise(wrapped)
    return text.select(F.explode(F.coalesce(found, F.raise_error(F.lit("a rule list is an array, or an object with values")).cast(f"array<{rule}>"))).alias("r")).select("r.*")


def overridden(rule_rows: DataFrame, overrides: DataFrame) -> DataFrame:
    """Rules with their overrides by pattern, else by name: renamed, rescored, or dropped when disabled.

    A rule has one override at most: the one of its pattern before the one of its name, of repeated keys the smallest.
    """
    first = overrides.groupBy("key").agg(F.min(F.struct("name", "score", "disabled")).alias("o"))
    by = lambda c, n: first.select(F.col("key").alias(c), F.col("o").alias(n))
    o = F.coalesce("_by_pattern", "_by_name")
    joined = rule_rows.join(by("pattern", "_by_pattern"), "pattern", "left").join(by("name", "_by_name"), "name", "left").where(~F.coalesce(o["disabled"], F.lit(False)))
    return joined.select(F.coalesce(o["name"], "name").alias("name"), "pattern", F.coalesce(o["score"], "score").alias("score"))


def jdbc(spark: SparkSession, url: str, query: str, key: str, low: int, high: int, splits: int) -> DataFrame:
    """A table of a database, read by ranges of a key so that every executor pulls its own part."""
    return spark.read.format("jdbc").options(url=url, dbtable=f"({query}) q", partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=splits, fetchsize=10_000).load()


def wanted(spark: SparkSession, keys: Sequence, kind: str = "long") -> DataFrame:
    """An inline relation of keys."""
    return spark.createDataFrame([(k,) for k in keys], f"key {kind}")


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The latest dated snapshot ``root/date=YYYY-MM-DD`` of a reference dataset; only its files are read."""
    rows = spark.read.parquet(root)
    last = rows.agg(F.max("date")).first()[0]
    return rows.where(F.col("date") == F.lit(last))
