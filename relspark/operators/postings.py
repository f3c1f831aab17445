"""A token index that is kept current: every batch of changes is a segment, reads merge segments, compaction rewrites them.

A segment holds the postings of the texts that a batch brought, and the keys that it touched. A posting counts as long as no
later segment touched its key, so a batch never reads or rewrites what stands already: its cost follows the batch. A manifest
that is replaced by one rename says which segments count; a batch that is lost half-way has written what no manifest names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import delete, exists, replace_file


def tokens(text: Column) -> Column:
    """Distinct words of letters and digits, in lower case; none of a null text."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def live_postings(postings: DataFrame, touched: DataFrame) -> DataFrame:
    """``token, key`` of the postings (``token, key, segment``) whose key no later segment touched (``key, segment``)."""
    last = touched.groupBy("key").agg(F.max("segment").alias("_last"))
    return postings.join(last, "key", "left").where(F.coalesce(F.col("_last") <= F.col("segment"), F.lit(True))).select("token", "key")


class PostingIndex:
    """Segments under a folder. One writer at a time; a read sees the manifest that stood when it began."""

    def __init__(self, spark: SparkSession, root: str, key: str = "long"):
        """``key`` is the type of the keys that the index will hold."""
        self.spark, self.root, self.kind = spark, root.rstrip("/"), key

    def segments(self) -> list[str]:
        """Folders of the segments that count, oldest first."""
        if not exists(self.spark, f"{self.root}/MANIFEST"):
            return []
        return json.loads(self.spark.read.option("wholetext", True).text(f"{self.root}/MANIFEST").first()[0])

    def _commit(self, segments: Sequence[str]) -> None:
        replace_file(self.spark, f"{self.root}/MANIFEST", json.dumps(list(segments)), uuid.uuid4().hex)

    def _write(self, postings: DataFrame, touched: DataFrame | None) -> str:
        name = f"s-{uuid.uuid4().hex}"
        # Sorted by token, so that a search reads the row groups of its words; ranges take the key too, so that a word
        # that very many texts hold is no single task.
        postings.repartitionByRange("token", "key").sortWithinPartitions("token", "key").write.parquet(f"{self.root}/{name}/postings")
        if touched is not None:
            touched.write.parquet(f"{self.root}/{name}/touched")
        return name

    def _read(self, part: str, schema: str) -> DataFrame:
        """That part of all segments, with the number of the segment."""
        out = self.spark.createDataFrame([], f"{schema}, segment int")
        for n, name in enumerate(self.segments()):
            if exists(self.spark, f"{self.root}/{name}/{part}"):
                out = out.unionByName(self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{part}").withColumn("segment", F.lit(n)))
        return out

    def apply(self, changes: DataFrame) -> None:
        """Add a segment for ``key, text, order``: a null text deletes the key, any other replaces what it had.

        Of changes that repeat a key the last by ``order`` stands; without that column, the greatest text, and a text before
        a deletion. Changes with a null key are left out; a batch without changes adds an empty segment.
        """
        by = F.struct(F.col("order"), F.col("text")) if "order" in changes.columns else F.struct("text")
        last = changes.where("key is not null").groupBy(F.col("key").cast(self.kind).alias("key")).agg(F.max(by).alias("_c"))
        postings = last.select("key", F.explode(tokens(F.col("_c.text"))).alias("token")).select("token", "key")
        before = self.segments()
        name = self._write(postings, last.select("key"))
        self._commit([*before, name])

    def live(self) -> DataFrame:
        """``token, key`` as they stand now."""
        return live_postings(self._read("postings", f"token string, key {self.kind}"), self._read("touched", f"key {self.kind}"))

    def search(self, words: Sequence[str], beginnings: Sequence[str] = ()) -> DataFrame:
        """Keys whose text holds all of the words, and a word with each of the beginnings."""
        asked = sorted({w.lower() for w in words}), sorted({b.lower() for b in beginnings})
        if not asked[0] and not asked[1]:
            return self.live().select("key").limit(0)
        some = F.col("token").isin(asked[0]) if asked[0] else F.lit(False)
        for b in asked[1]:
            some = some | F.col("token").startswith(b)
        postings = self._read("postings", f"token string, key {self.kind}").where(some)
        found = live_postings(postings, self._read("touched", f"key {self.kind}"))
        held = [F.max(F.when(F.col("token") == w, 1).otherwise(0)) for w in asked[0]] + [F.max(F.when(F.col("token").startswith(b), 1).otherwise(0)) for b in asked[1]]
        return found.groupBy("key").agg(sum(held, F.lit(0)).alias("_n")).where(F.col("_n") == len(held)).select("key")

    def compact(self) -> None:
        """Rewrite all segments as one without touched keys, name it in the manifest, then delete the old ones.

        Reads that began before must have ended.
        """
        old = self.segments()
        if not old:
            return
        name = self._write(self.live(), None)
        self._commit([name])
        for folder in old:
            delete(self.spark, f"{self.root}/{folder}")
