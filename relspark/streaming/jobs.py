"""Structured Streaming: micro-batch upserts, drained slices and the session counter."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.maintenance import upsert


def upsert_stream(stream: DataFrame, root: str, key: Sequence[str], checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Apply every micro-batch to the table of versions under ``root``: version N + 1 is version N with the batch.

    A batch writes its own version folder and overwrites it when replayed, so applying it twice changes nothing.
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = prepare(batch) if prepare else batch
        # The last row of a key within the batch stands.
        rows = upsert(spark.read.parquet(f"{root}/v{number}"), new, key) if number else new
        rows.write.mode("overwrite").parquet(f"{root}/v{number + 1}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sliced_counts(events: DataFrame, at: str, minutes: int = 30, late: str = "10 minutes", *keys: str) -> DataFrame:
    """Tumbling slices with a watermark: each slice closes once later events have passed it."""
    return events.withWatermark(at, late).groupBy(F.window(at, f"{minutes} minutes").alias("slice"), *keys).agg(F.count("*").alias("n"))


def rolling_counts(events: DataFrame, at: str, days: int, *keys: str) -> DataFrame:
    """Sliding lookback of some days, moved daily."""
    return events.withWatermark(at, "1 day").groupBy(F.window(at, f"{days} days", "1 day").alias("lookback"), *keys).agg(F.count("*").alias("n"))


def counter_stream(events: DataFrame, keys: Sequence[str], at: str, cooldown_ms: int, threshold: int) -> DataFrame:
    """Session counter with state: a gap beyond the cooldown restarts it at 1, reaching the threshold fires and resets it.

    State is one count and one time for each key, and goes when the cooldown has passed the watermark.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        count, last = state.get if state.exists else (0, None)
        rows = pd.concat(list(batches)).sort_values(at)
        out = []
        for t in rows[at]:
            ms = int(t.timestamp() * 1000)
            count = 1 if last is None or ms - last > cooldown_ms else count + 1
            fires = count == threshold
            out.append((*key, t, count, fires))
            count, last = (0 if fires else count), ms
        state.update((count, last))
        state.setTimeoutTimestamp(max(last + cooldown_ms + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[*keys, at, "count", "fires"])

    kinds = ", ".join(f"{k} {events.schema[k].dataType.simpleString()}" for k in keys)
    timed = events.withWatermark(at, f"{cooldown_ms} milliseconds").groupBy(*keys)
    return timed.applyInPandasWithState(step, f"{kinds}, {at} timestamp, count int, fires boolean", "count int, last long", "append", GroupStateTimeout.EventTimeTimeout)
