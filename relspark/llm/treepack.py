"""First-fit decreasing packing of token runs, in randomised groups of documents.

A document's leading runs of full sequence length are sequences of their own. What is left of each document, shorter than a
sequence, is dealt at random into groups of bounded size, which are packed independently of each other: longest first, each
into the first sequence with room, found in a tournament tree over the room that sequences have left. Sequences that stay
open are then filled up from the emptiest one, whose runs are cut where that is needed; the one that remains is cut into
powers of two, which are not padded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table, texts
from .packing import END, ByteEncoder

CAPACITY = 1024
#: Documents in a group, about: the ids of a group (less than 4 * CAPACITY bytes for each document) are in memory together.
GROUP = 2048
#: Rows of a batch that leaves the tokenising task.
BATCH = 4096

#: Place of a run: item, first token in the item, tokens.
Run = tuple[int, int, int]


class Tournament:
    """Room left in sequences 0, 1, ...; each node of the tree holds the greatest room below it."""

    def __init__(self, sequences: int, capacity: int):
        self.leaves = 1 << max(0, sequences - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def take(self, length: int) -> int:
        """The first sequence with room for ``length``, whose room shrinks by it."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            at += room[at] < length
        sequence = at - self.leaves
        room[at] -= length
        while at > 1:
            at //= 2
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
        return sequence


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[list[Run]]:
    """Sequences of whole runs; equal lengths keep their order. Lengths are 1 to ``capacity``."""
    tree, sequences = Tournament(len(lengths), capacity), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        at = tree.take(lengths[k])
        if at == len(sequences):
            sequences.append([])
        sequences[at].append((k, 0, lengths[k]))
    return sequences


def fill_up(sequences: list[list[Run]], capacity: int = CAPACITY) -> list[list[Run]]:
    """No padding is left: the fullest open sequence is filled from the emptiest, cutting a run where it does not fit whole.

    Each filled sequence costs at most one cut. The last open one is cut into sequences of 2**k tokens.
    """
    size = lambda runs: sum(n for _, _, n in runs)
    done = [s for s in sequences if size(s) == capacity]
    open_ = sorted((s for s in sequences if size(s) < capacity), key=size)  # emptiest first
    low, high = 0, len(open_) - 1
    while low < high:
        room = capacity - size(open_[high])
        while room and open_[low]:
            item, at, n = open_[low].pop()
            open_[high].append((item, at, min(n, room)))
            if n > room:
                open_[low].append((item, at + room, n - room))
            room -= min(n, room)
        if room:
            low += 1
        else:
            done.append(open_[high])
            high -= 1
    rest = open_[low] if low <= high else []
    left = size(rest)
    while left:
        room, part = 1 << (left.bit_length() - 1), []
        left -= room
        while room:
            item, at, n = rest.pop()
            part.append((item, at, min(n, room)))
            if n > room:
                rest.append((item, at + room, n - room))
            room -= min(n, room)
        done.append(part)
    return done


_RUNS = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, sequence_id long, deal int, ids binary"


def _runs(json_path: str, ranks_path: str, capacity: int):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    names = [c.split()[0] for c in _RUNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ByteEncoder(json_path, ranks_path), np.array([END], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        # What is dealt at random is written before it is shuffled, so a task that runs again deals nothing twice.
        deal, numbered, rows = np.random.default_rng([12, task]), 0, []

        def made() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                for at in range(0, n - capacity + 1, capacity):
                    rows.append((doc, at, capacity, n, zlib.crc32(ids[4 * at : 4 * (at + capacity)]), 2 * (task << 32 | numbered), None, None))
                    numbered += 1
                    if len(rows) == BATCH:
                        yield made()
                        rows.clear()
                if n % capacity:
                    at = n - n % capacity
                    rows.append((doc, at, n - at, n, None, None, int(deal.integers(1 << 31)), ids[4 * at :]))
            if len(rows) >= BATCH:
                yield made()
                rows.clear()
        if rows:
            yield made()

    return run


def runs_of(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Full runs, which have a sequence of their own, and the rest of each document with its ids and a random number."""
    run = _runs(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _RUNS)


def _packed(capacity: int):
    """One group: runs of its documents in sequences without padding."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("doc_id", "ascending"), ("deal", "ascending")])
        doc, start, tokens, ids = (group.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        rows, base = [], group.column("part")[0].as_py() << 32
        for k, sequence in enumerate(fill_up(first_fit_decreasing(group.column("length").to_pylist(), capacity), capacity)):
            offset = 0
            for item, at, n in sequence:
                rows.append((doc[item], start[item] + at, n, zlib.crc32(ids[item][4 * at : 4 * (at + n)]), tokens[item], 2 * (base | k) + 1, offset))
                offset += n
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(documents: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` for every piece of every document.

    Groups are as many as ``group`` documents each need, so a group's size does not grow with the table. In a group, every
    sequence holds ``capacity`` tokens, but for the last of them, which hold powers of two: nothing is padded.
    Null and empty texts are their end token. Rows that repeat an id are documents of their own and cannot be told apart
    in the result but by their pieces; null ids stay null. Long texts are encoded whole; an empty table stays empty; other
    columns are not read.
    """
    runs = materialize(runs_of(documents, capacity), "runs")
    rest = runs.where("ids IS NOT NULL")
    groups = max(1, -(-rest.count() // group))
    dealt = rest.select("doc_id", "start", "length", "doc_tokens", "deal", "ids", F.expr(f"cast(deal % {groups} as long)").alias("part"))
    packed = dealt.groupBy("part").applyInArrow(_packed(capacity), _PIECES)
    full = runs.where("ids IS NULL").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)


def op12_tree_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 1024 tokens or a power of two."""
    return pack(table(spark, sf_dir, "documents"))
