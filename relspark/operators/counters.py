"""Reports of batches that add up: numbers, counters by name, and samples that each name keeps a few of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def counter(rows: DataFrame, keys: Sequence[str], names: dict[str, Column], sums: dict[str, Column], samples: dict[str, Column] | None = None, order: str | None = None, most: int = 20) -> DataFrame:
    """A report for each key: summed numbers, ``map<name, count>`` for each counter, ``map<name, array>`` for each kind of sample.

    A counter's column says the name that a row counts under, a sample's column is a struct ``name, value``; null counts
    nowhere. Each name keeps its first ``most`` samples by ``order``.
    """
    out = rows.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in sums.items()], F.count("*").alias("_rows"))
    for name, column in names.items():
        each = rows.select(*keys, column.alias("_k")).where("_k is not null").groupBy(*keys, "_k").agg(F.count("*").alias("_n"))
        out = _attached(out, each, keys, name, "map<string,bigint>")
    for name, column in (samples or {}).items():
        each = rows.select(*keys, F.col(order).alias("_order"), column["name"].alias("_k"), column["value"].alias("_v")).where("_k is not null")
        place = F.row_number().over(Window.partitionBy(*keys, "_k").orderBy("_order", "_v"))
        few = each.withColumn("_p", place).where(F.col("_p") <= most)
        few = few.groupBy(*keys, "_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_v"))), lambda x: x["_v"]).alias("_n"))
        out = _attached(out, few, keys, name, f"map<string,array<{each.schema['_v'].dataType.simpleString()}>>")
    return out.drop("_rows")


def _attached(reports: DataFrame, each: DataFrame, keys: Sequence[str], name: str, kind: str) -> DataFrame:
    """Reports with one more map, made of rows ``_k, _n`` of each key; empty where there are none."""
    maps = each.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_k", "_n")))).alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = reports.join(maps, same, "left").drop(*[f"_{k}" for k in keys])
    return joined.withColumn(name, F.coalesce(name, F.create_map().cast(kind)))


def merge_counters(
    reports: DataFrame, keys: Sequence[str], sums: Sequence[str], names: Sequence[str], samples: Sequence[str] = (), order: str | None = None, most: int = 20, maxima: Sequence[str] = ()
) -> DataFrame:
    """One report for each key out of the reports of its batches.

    Numbers of ``sums`` add up and those of ``maxima`` give the greatest; nulls count as 0. Counters hold every name of any
    batch with the sum of its counts. Of each name the samples of earlier batches (by ``order``) come first, ``most`` in all.
    Every map is spread and summed before it is shuffled, so a key with very many batches sends one row for each name and task.
    """
    number = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = reports.groupBy(*keys).agg(*[F.sum(number(c)).alias(c) for c in sums], *[F.max(number(c)).alias(c) for c in maxima], F.count("*").alias("batches"))
    for name in names:
        each = reports.select(*keys, F.explode(name).alias("_k", "_c")).groupBy(*keys, "_k").agg(F.sum(F.coalesce("_c", F.lit(0))).alias("_n"))
        out = _attached(out, each, keys, name, reports.schema[name].dataType.simpleString())
    for name in samples:
        each = reports.select(*keys, F.col(order).alias("_order"), F.explode(name).alias("_k", "_vs")).select(*keys, "_order", "_k", F.posexplode("_vs").alias("_at", "_v"))
        # Spark keeps the first places of every task before it shuffles for the window.
        few = each.withColumn("_p", F.row_number().over(Window.partitionBy(*keys, "_k").orderBy("_order", "_at"))).where(F.col("_p") <= most)
        few = few.groupBy(*keys, "_k").agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_v"))), lambda x: x["_v"]).alias("_n"))
        out = _attached(out, few, keys, name, reports.schema[name].dataType.simpleString())
    return out
