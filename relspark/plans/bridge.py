"""The ``releases`` view: one row per result of a request, made from ``lineitem`` and ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .registry import table

#: Preference order of the closed vocabularies used by the plans (best first).
RESOLUTIONS = ("2160p", "1080p", "720p", "480p")
QUALITIES = ("BluRay REMUX", "BluRay", "WEB-DL", "WEBRip", "HDTV")
SERVICES = ("svc_r", "svc_a")
TYPES = ("debrid", "p2p", "http")
_ORDER = "l_orderkey l_linenumber l_suppkey l_extendedprice l_quantity l_discount l_tax l_shipdate l_returnflag l_linestatus".split()

_FIELDS = {
    "request_id": "l_partkey",
    "pos": "pos",
    "id": "concat(cast(l_partkey as {text}), '-', cast(pos as {text}))",
    "source_id": "concat('src', cast(l_suppkey % 8 as {text}))",
    "service_id": "CASE l_returnflag WHEN 'A' THEN 'svc_a' WHEN 'R' THEN 'svc_r' END",
    "cached": "CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'F' END",
    "type": "CASE WHEN l_returnflag <> 'N' THEN 'debrid' WHEN l_linenumber % 2 = 0 THEN 'p2p' ELSE 'http' END",
    "size": "cast(floor(l_extendedprice * 100000) as bigint)",
    "seeders": "CASE WHEN l_returnflag = 'N' AND l_linenumber % 2 = 1 THEN NULL ELSE cast(floor(l_quantity) as int) END",
    "age_hours": "CASE WHEN l_discount < 0.01 THEN NULL ELSE cast({days} * 24 as int) END",
    "resolution": "CASE WHEN p_size % 17 = 0 THEN NULL WHEN p_size < 10 THEN '480p' WHEN p_size < 20 THEN '720p' WHEN p_size < 35 THEN '1080p' ELSE '2160p' END",
    "quality": "CASE p_type WHEN 'LARGE' THEN 'BluRay REMUX' WHEN 'STANDARD' THEN 'BluRay' WHEN 'PROMO' THEN 'WEB-DL' WHEN 'MEDIUM' THEN 'WEBRip' WHEN 'SMALL' THEN 'HDTV' END",
    "release_group": "replace(p_brand, '#', '')",
    "year": "cast(year(l_shipdate) as int)",
    "tag_hdr": "l_discount >= 0.05",
    "tag_dv": "l_tax >= 0.04",
    "season": "l_linenumber",
    "title": "p_name",
}
_NAME = "concat(replace(title, ' ', '.'), '.', cast(year as {text}), '.', coalesce(resolution, ''), '.', coalesce(quality, ''), '-', release_group)"


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with ``request_id, pos`` and the attributes that the operators work on; one shuffle, on ``request_id``.

    ``part`` is joined by whatever side Spark measures as small enough to broadcast.
    """
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    rows = line.join(part, line["l_partkey"] == part["p_partkey"])
    rows = rows.withColumn("pos", F.row_number().over(Window.partitionBy("l_partkey").orderBy(*_ORDER)))
    days = "datediff(date'2002-01-01', l_shipdate)"
    rows = rows.selectExpr(*[f"{e.format(text='string', days=days)} AS {n}" for n, e in _FIELDS.items()])
    tags = F.array_compact(F.array(F.when(F.col("tag_hdr"), "HDR"), F.when(F.col("tag_dv"), "DV")))
    return rows.withColumn("tags", tags).drop("tag_hdr", "tag_dv").withColumn("filename", F.expr(_NAME.format(text="string")))


_DUCK_DAYS = "date_diff('day', cast(l_shipdate as date), date '2002-01-01')"
_DUCK_FIELDS = ", ".join(f'{e.format(text="varchar", days=_DUCK_DAYS)} AS "{n}"' for n, e in _FIELDS.items())
#: The same view for DuckDB, as the head of a WITH clause.
RELEASES = f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {", ".join(_ORDER)}) AS pos
    FROM lineitem JOIN part ON l_partkey = p_partkey),
fields AS (SELECT {_DUCK_FIELDS} FROM numbered),
releases AS (SELECT *, list_filter([CASE WHEN tag_hdr THEN 'HDR' END, CASE WHEN tag_dv THEN 'DV' END], lambda x: x IS NOT NULL) AS tags,
    {_NAME.format(text="varchar")} AS filename FROM fields)"""
