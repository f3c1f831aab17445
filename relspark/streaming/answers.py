"""Answers that are remembered for a time: over a table by windows, over a stream by state that expires.

Events have a key, a time, and either an answer or none; an event without an answer asks. An ask is a hit while the last answer
of its key is younger than its time to live; with ``touch`` every hit begins that time anew. Empty answers are not remembered.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.shared import delete, shared_dir


def expiring_answers(events: DataFrame, key: str, at: str, answer: str, ttl_seconds: float, touch: bool = False, order: str | None = None) -> DataFrame:
    """Asks (events without ``answer``) with ``hit`` and ``remembered``.

    An answer counts from its own time on, before asks of the same time; ``order`` breaks further ties. Empty text is no
    answer and no ask. An answer given while an older one lives replaces it.
    """
    known = events.where(F.col(answer).isNull() | (F.col(answer).cast("string") != ""))
    given = F.col(answer).isNotNull()
    by = Window.partitionBy(key).orderBy(at, F.when(given, 0).otherwise(1), *([order] if order else []))
    seconds = F.col(at).cast("timestamp").cast("double")
    since = F.sum(given.cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    marked = known.withColumn("_s", seconds).withColumn("_gap", F.col("_s") - F.lag("_s").over(by)).withColumn("_since", since)
    own = Window.partitionBy(key, "_since").orderBy(at, F.when(given, 0).otherwise(1), *([order] if order else [])).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_value", F.first(answer).over(own))
    age = F.max(F.when(given, 0.0).otherwise(F.col("_gap"))).over(own) if touch else F.col("_s") - F.first("_s").over(own)
    marked = marked.withColumn("hit", (F.col("_since") > 0) & (age < ttl_seconds)).where(~given)
    return marked.select(*events.columns, "hit", F.when(F.col("hit"), F.col("_value")).alias("remembered"))


class _Answers(StatefulProcessor):
    """One answer and the second it ends for each key; a timer drops it when the watermark has passed that second."""

    def __init__(self, at: str, answer: str, order: str | None, kind: str, ttl: float, touch: bool, columns: list[str]):
        self.at, self.answer, self.order, self.kind, self.ttl, self.touch, self.columns = at, answer, order, kind, ttl, touch, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", f"answer {self.kind}, ends double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        batch = pd.concat(list(rows))
        held = self.held.get() if self.held.exists() else None
        before = held
        given = batch[self.answer].notna()
        batch = batch.assign(_ask=~given).sort_values([self.at, "_ask", *([self.order] if self.order else [])], kind="stable")
        out = []
        for row in batch.to_dict("records"):
            now = row[self.at].timestamp()
            if not row["_ask"]:
                if row[self.answer] != "":
                    held = (row[self.answer], now + self.ttl)
                continue
            hit = held is not None and now < held[1]
            if hit and self.touch:
                held = (held[0], now + self.ttl)
            out.append({**{c: row[c] for c in self.columns}, "hit": hit, "remembered": held[0] if hit else None})
        if held is not None and held != before:
            self.held.update(held)
            self.handle.registerTimer(int(held[1] * 1000) + 1)
        yield pd.DataFrame(out, columns=[*self.columns, "hit", "remembered"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # An answer that was renewed since has a later timer of its own.
        if self.held.exists() and self.held.get()[1] * 1000 < expiredTimerInfo.getExpiryTimeInMs():
            self.held.clear()
        yield pd.DataFrame()

    def close(self) -> None:
        """State is Spark's."""


def expiring_answers_stream(events: DataFrame, key: str, at: str, answer: str, ttl_seconds: float, touch: bool = False, order: str | None = None, late: str = "1 minute") -> DataFrame:
    """:func:`expiring_answers` over a stream whose events arrive in order of time, but for ``late``.

    State is one answer for each key with a living answer, whatever the number of events. The session's state store must be
    the one on RocksDB.
    """
    kind = events.schema[answer].dataType.simpleString()
    columns = events.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema) + f", hit boolean, remembered {kind}"
    processor = _Answers(at, answer, order, kind, ttl_seconds, touch, columns)
    return events.withWatermark(at, late).groupBy(key).transformWithStateInPandas(processor, schema, "append", "eventTime")


def enrich(pending: DataFrame, known: DataFrame, lookup: Callable[[DataFrame], DataFrame], keys: Sequence[str], order: str, most: int = 10, cycles: int | None = None) -> DataFrame:
    """All pending rows with the answers for their keys, ``resolver`` (known, lookup) and the ``cycle`` that brought them.

    Rows with equal keys are one batch. Each cycle takes the first ``most`` batches, by their first row, that nothing is
    remembered for, asks ``lookup`` (keys in, answers out) and writes back what it says; a batch without an answer is
    remembered as asked, so it does not hold up the others. The loop ends when a cycle has nothing to ask, or after
    ``cycles``. Rows without an answer, and those with a null first key, have nulls. Cycles write to the shared folder, where
    only the result stays.
    """
    spark, keys, written = pending.sparkSession, list(keys), []
    values = [c for c in known.columns if c not in keys]

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        written.append(path)
        return spark.read.schema(df.schema).parquet(path)

    first = F.lit(1).alias("cycle")
    answers = known.select(*keys, *values, F.lit("known").alias("resolver"), first)
    batches = kept(pending.dropna(subset=keys[:1]).groupBy(*keys).agg(F.min(order).alias("_first")), "batches")
    cycle = 0
    while cycles is None or cycle < cycles:
        cycle += 1
        asked = kept(batches.join(answers.select(*keys), keys, "left_anti").orderBy("_first", *keys).limit(most).drop("_first"), "asked")
        if asked.isEmpty():
            break
        said = asked.join(lookup(asked).select(*keys, *values, F.lit("lookup").alias("resolver")), keys, "left")
        answers = answers.unionByName(kept(said.withColumn("cycle", F.lit(cycle)), "answers"))
    out = kept(pending.join(answers, keys, "left").withColumn("cycle", F.when(F.col("resolver").isNotNull(), F.col("cycle"))), "enriched")
    for path in written[:-1]:
        delete(spark, path)
    return out
