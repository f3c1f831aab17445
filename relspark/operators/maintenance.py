"""Keeping tables current on plain files: upserts as joins, change detection, retention, versioned cut-over."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import exists, replace_file


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; columns that ``new`` lacks become null.

    Of rows of ``new`` that repeat a key the last one by ``order`` stands (by all its columns where no order is given).
    """
    by = [F.col(c).desc_nulls_last() for c in order or [c for c in new.columns if c not in key]]
    if by:
        new = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*by))).where("_n = 1").drop("_n")
    else:
        new = new.dropDuplicates(list(key))
    kept = old.join(new.select(*key), list(key), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True).select(*old.columns)


def accumulate(old: DataFrame, delta: DataFrame, key: Sequence[str], evidence: str, at: str, values: Sequence[str]) -> DataFrame:
    """Evidence adds up, a new value stands over an old one unless it is null, the later time stays."""
    both = old.withColumn("_new", F.lit(0)).unionByName(delta.withColumn("_new", F.lit(1)))
    latest = [F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.struct("_new", at))).alias(v) for v in values]
    return both.groupBy(*key).agg(*latest, F.sum(evidence).alias(evidence), F.max(at).alias(at))


def insert_absent(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key ``old`` lacks."""
    return new.join(old.select(*key), list(key), "left_anti")


def fill_only(old: DataFrame, staged: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Nulls are filled from the staged row; nothing that is known changes. ``filled`` counts the columns that gained."""
    joined = old.join(staged.select(key, *[F.col(c).alias(f"_{c}") for c in columns]), key, "left")
    gained = sum((F.when(F.col(c).isNull() & F.col(f"_{c}").isNotNull(), 1).otherwise(0) for c in columns), F.lit(0))
    return joined.withColumn("filled", gained).select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else c for c in old.columns], "filled")


def changes(old: DataFrame, new: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """``insert``, ``update`` or ``noop`` for each new row, by null-safe comparison."""
    was = old.select(key, F.lit(True).alias("_had"), *[F.col(c).alias(f"_{c}") for c in compare])
    same = F.lit(True)
    for c in compare:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    action = F.when(F.col("_had").isNull(), "insert").when(same, "noop").otherwise("update")
    return new.join(was, key, "left").withColumn("action", action).select(*new.columns, "action")


def page_after(rows: DataFrame, order: Sequence[str], after: Sequence[Column], n: int) -> DataFrame:
    """Keyset page: the next ``n`` rows behind a cursor."""
    return rows.where(F.struct(*order) > F.struct(*[a.alias(o) for o, a in zip(order, after, strict=True)])).orderBy(*order).limit(n)


def doomed(rows: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that stay and rows that go."""
    gone = F.coalesce(condition, F.lit(False))
    return rows.where(~gone), rows.where(gone)


def prune(rows: DataFrame, condition: Column, undrained: DataFrame) -> DataFrame:
    """Rows that stay once all that must be drained first is gone; raises while ``undrained`` has a row."""
    if not undrained.isEmpty():
        raise ValueError("rows that are not drained yet block pruning")
    return doomed(rows, condition)[0]


def run_phases(spark: SparkSession, root: str, phases: Sequence[tuple[str, Callable[[dict[str, DataFrame]], DataFrame]]]) -> dict[str, int]:
    """A job of phases that can be resumed: each writes its own folder, and a phase written whole is not run again.

    A phase gets the tables of the phases before it by name. A folder without Spark's mark of success is what a lost run
    left, and is written anew. Returns the rows of every phase.
    """
    tables: dict[str, DataFrame] = {}
    for name, phase in phases:
        if not exists(spark, f"{root}/{name}/_SUCCESS"):
            phase(tables).write.mode("overwrite").parquet(f"{root}/{name}")
        tables[name] = spark.read.parquet(f"{root}/{name}")
    return {name: df.count() for name, df in tables.items()}


def salvage(old: DataFrame, live: DataFrame, key: str, casts: dict[str, tuple[str, object]]) -> DataFrame:
    """Readable rows that the live table lacks, every column cast or defaulted."""
    lost = old.join(live.select(key), key, "left_anti")
    return lost.select(key, *[F.coalesce(F.col(c).try_cast(t), F.lit(d).cast(t)).alias(c) for c, (t, d) in casts.items()])


def latest_slice(rows: DataFrame, at: str, cursor: Column, minutes: int, before: Column) -> DataFrame:
    """Rows behind the cursor, up to the earlier of one slice later and the bound."""
    return rows.where((F.col(at) > cursor) & (F.col(at) <= F.least(cursor + F.make_dt_interval(mins=F.lit(minutes)), before)))


def publish(df: DataFrame, root: str, version: str, checks: dict[str, Column]) -> dict[str, int]:
    """Write a version, assert its contract, and only then point ``CURRENT`` at it.

    The pointer is replaced by one rename that overwrites, so there is a current version at every moment; a failed check
    leaves the old version current. Returns the number of rows that break each check.
    """
    spark = df.sparkSession
    path = f"{root}/{version}"
    df.write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    row = written.agg(F.count("*").alias("rows"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()]).first()
    broken = {n: row[n] for n in checks}
    if row["rows"] == 0 or any(broken.values()):
        raise ValueError(f"version {version} breaks its contract: {broken or 'no rows'}")
    replace_file(spark, f"{root}/CURRENT", version, version)
    return broken


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that ``CURRENT`` points at."""
    version = spark.read.text(f"{root}/CURRENT").first()[0]
    return spark.read.parquet(f"{root}/{version}")


def session_counter(events: DataFrame, keys: Sequence[str], at: str, cooldown_seconds: int, threshold: int) -> DataFrame:
    """Events at which a counter per key fires: gaps beyond the cooldown restart it at 1, firing resets it to 0.

    Sessions are cut by the gap (a window); inside a session the counter fires at every ``threshold``-th event, so the
    walk needs no sequential state.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    gap = F.col(at).cast("timestamp").cast("double") - F.lag(at).over(w).cast("timestamp").cast("double")
    cut = events.withColumn("_s", F.sum(F.when(gap <= cooldown_seconds, 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    n = F.row_number().over(Window.partitionBy(*keys, "_s").orderBy(at))
    return cut.withColumn("count", (n - 1) % threshold + 1).withColumn("fires", F.col("count") == threshold).drop("_s")


def early_exit(batches: DataFrame, key: str, order: str, condition: Column) -> DataFrame:
    """Batches up to the first one after which the condition (over running totals) holds."""
    w = Window.partitionBy(key).orderBy(order)
    done = F.max(condition.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return batches.withColumn("_done", F.coalesce(done, F.lit(0))).where("_done = 0").drop("_done")


def counts_under(tables: dict[str, DataFrame], keys: DataFrame, key: str) -> DataFrame:
    """``table_name, row_count`` of the rows of each table under the keys, 0 where there are none; a repeated key counts once."""
    out = None
    for name, rows in tables.items():
        n = rows.join(keys, key, "left_semi").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        out = n if out is None else out.unionByName(n)
    return out


def reclaimable(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """Counts with ``reclaimed``, the bytes of so many mean rows; 0 for tables without statistics."""
    known = (F.col("estimated_rows") > 0) & (F.col("total_bytes") > 0) & (F.col("row_count") > 0)
    size = (F.col("total_bytes") / F.col("estimated_rows") * F.col("row_count")).cast("long")
    return counts.join(stats, "table_name", "left").withColumn("reclaimed", F.when(known, size).otherwise(F.lit(0).cast("long"))).drop("estimated_rows", "total_bytes")
