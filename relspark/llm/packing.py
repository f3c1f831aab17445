"""Best-fit packing of tokenised documents into sequences by bin completion.

Documents are tokenised once on the executors. What the search needs is the number of pieces of each length, at most
``CAPACITY`` numbers however many documents there are. Branch-and-bound over that histogram enumerates undominated
fillings around the largest piece, prunes by the waste that the incumbent still allows, and starts from the best-fit
solution. Its answer is a list of patterns with multiplicities; the executors turn a piece's rank within its length into
a sequence and an offset.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import materialize, parts, table, texts

CAPACITY = 2048
#: Token that ends every document.
END = 0
#: Chunks that a worker remembers before it starts anew.
MEMORY = 200_000
#: Fillings that the search may try beyond the first descent, and steps that it may take in all to find them: its only bounds.
NODES, WORK = 8_000, 500_000
#: Fillings kept around one piece, and steps taken to find them, in the first pass; each further pass has twice and four times
#: as many, until a pass leaves nothing out.
WIDTH, STEPS = 4, 400
_SPECIAL = "<|endoftext|>"


class ByteEncoder(dict):
    """Chunk between blanks (with its leading blank) -> token ids as little-endian bytes.

    A single blank before a visible character always opens a token, so texts without runs of white space are encoded
    chunk by chunk from memory; any other text is encoded whole. The ids are those of the ``tokenizers`` file; its
    vocabulary is read as ranks, and a text that names the special token goes through ``tokenizers`` itself.
    """

    def __init__(self, json_path: str, ranks_path: str, memory: int = MEMORY):
        super().__init__()
        import re

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.slow, self.memory = json_path, None, memory
        self.run_of_blanks = re.compile(r"\s\s").search

    def __missing__(self, chunk: str) -> bytes:
        self[chunk] = got = np.array(self.fast.encode_ordinary(chunk), "<u4").tobytes()
        return got

    def ids(self, text: str) -> bytes:
        if _SPECIAL in text:
            self.slow = self.slow or Tokenizer.from_file(self.json_path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not text or self.run_of_blanks(text):
            return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()
        if len(self) > self.memory:
            self.clear()
        first, *rest = text.split(" ")
        return b"".join([self[first], *map(self.__getitem__, [" " + c for c in rest])]) if first else b"".join(map(self.__getitem__, [" " + c for c in rest]))


def _pieces(json_path: str, ranks_path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteEncoder(json_path, ranks_path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
                ids = encoder.ids(text) + end
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                rows += [(doc, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def tokenize(documents: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document: ``doc_id, piece, start, length, ids_crc32``; null text is empty and still ends with a token.

    Long texts are encoded whole and then cut; repeated rows give their pieces each, an empty table stays empty, and other
    columns are not read.
    """
    run = _pieces(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), capacity)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


Pattern = tuple[tuple[int, ...], int]
#: Lengths of a sequence in falling order, each with how often it occurs.
Filling = tuple[tuple[int, int], ...]


class _Histogram:
    """Pieces left of each length, and the lengths that are left as bits of an integer."""

    def __init__(self, counts: dict[int, int]):
        self.n = dict(counts)
        self.bits = sum(1 << k for k, c in counts.items() if c > 0)

    def take(self, filling: Iterable[tuple[int, int]], times: int) -> None:
        for x, many in filling:
            self.n[x] = self.n.get(x, 0) - times * many
            self.bits = self.bits | 1 << x if self.n[x] else self.bits & ~(1 << x)

    def below(self, limit: int) -> int:
        """The largest length left that is at most ``limit``; 0 if none."""
        return (self.bits & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 and self.bits & ((1 << (limit + 1)) - 1) else 0


def _fillings(left: _Histogram, room: int, most_waste: int, width: int, steps: int) -> tuple[list[Filling], bool, int]:
    """Undominated fillings of ``room``, least waste first, whether these are all that can matter, and the steps taken.

    Lengths are decided in falling order, each with how often it is taken, so the recursion is as deep as a filling has
    different lengths. One piece that fills the room dominates all else; a filling into which a piece left over would still
    fit is dominated by the one that takes it, and so never listed. Fillings that waste more than ``most_waste`` cannot lead
    below the incumbent.
    """
    best: list[tuple[int, Filling]] = [_largest_first(left, room)]
    budget, whole, used = steps, True, {}

    def extend(room: int, top: int) -> bool:
        nonlocal budget, whole
        x = left.below(min(room, top))
        while x:
            for many in range(min(left.n[x], room // x), 0, -1):
                if budget <= 0:
                    whole = False
                    return False
                budget -= 1
                used[x] = many
                perfect = extend(room - many * x, x - 1)
                if not perfect:
                    del used[x]
                else:
                    return True
            x = left.below(x - 1)
        # A longer piece that was passed over may still fit: then this filling is dominated.
        fits = left.below(room)
        while fits and left.n[fits] <= used.get(fits, 0):
            fits = left.below(fits - 1)
        if not fits:
            best.append((room, tuple(used.items())))
        return room == 0

    perfect = extend(room, room)
    size = lambda f: sum(many for _, many in f)
    best.sort(key=lambda b: (b[0], size(b[1]), [(-x, -many) for x, many in b[1]]))
    good = [c for w, c in dict.fromkeys(best) if w <= most_waste]
    return good[:width] or [best[0][1]], perfect or (whole and len(good) <= width), steps - budget


def _largest_first(left: _Histogram, room: int) -> tuple[int, Filling]:
    """The room that is left, and the filling, if always the largest piece that fits is taken."""
    chosen: list[tuple[int, int]] = []
    x = left.below(room)
    while x:
        many = min(left.n[x], room // x)
        chosen.append((x, many))
        room -= many * x
        x = left.below(min(room, x - 1))
    return room, tuple(chosen)


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """The incumbent: pieces in falling order, each into the fullest sequence that still has room for it.

    Sequences with the same content are one entry, so the work follows the number of lengths and not of pieces.
    """
    rooms: dict[int, list[Pattern]] = {capacity: [((), sum(counts.values()))]}
    for x in sorted((k for k, c in counts.items() if c > 0), reverse=True):
        rest = counts[x]
        for room in sorted(r for r in rooms if r >= x):
            # A sequence that takes the piece is then the fullest one, so it takes as many as fit.
            each = room // x
            entries = rooms.pop(room)
            while entries and rest:
                content, times = entries.pop()
                full = min(times, rest // each)
                if full:
                    rooms.setdefault(room - each * x, []).append(((*content, *(x,) * each), full))
                    rest -= full * each
                    times -= full
                if times and 0 < rest < each:
                    rooms.setdefault(room - rest * x, []).append(((*content, *(x,) * rest), 1))
                    rest, times = 0, times - 1
                if times:
                    entries.append((content, times))
            if entries:
                rooms.setdefault(room, []).extend(entries)
            if not rest:
                break
    return [(content, times) for entries in rooms.values() for content, times in entries if content]


def complete(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, work: int = WORK) -> list[Pattern]:
    """Patterns ``(lengths, times)`` that hold all pieces in as few sequences as the search finds.

    Depth-first branch-and-bound: each level fills sequences around the largest piece left, as often as the filling can be
    repeated, or once, after which the same piece may be filled again in any way. A branch ends when its waste exceeds what a
    solution better than the incumbent may waste. Passes grow broader until one has left nothing out, the lower bound (tokens
    over capacity, rounded up) is reached, or ``nodes`` fillings have been tried, not counting those that a pass keeps before
    it first goes back, or ``work`` steps have been taken after a first descent. Lengths outside 1..capacity raise.
    """
    counts = {int(k): int(v) for k, v in counts.items() if v > 0}
    if not counts:
        return []
    if min(counts) < 1 or max(counts) > capacity:
        raise ValueError("lengths must be between 1 and the capacity")
    best = best_fit(counts, capacity)
    width, steps, left = WIDTH, STEPS, [nodes, work]
    while sum(t for _, t in best) > lower_bound(counts, capacity) and min(left) > 0:
        best, whole = _search(counts, capacity, best, left, width, steps)
        if whole:
            break
        width, steps = 2 * width, 4 * steps
    return best


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Sequences that no packing can do without."""
    return -(-sum(k * v for k, v in counts.items()) // capacity)


def _search(counts: dict[int, int], capacity: int, best: list[Pattern], left: list[int], width: int, steps: int) -> tuple[list[Pattern], bool]:
    """One pass: the best patterns, and whether no filling that matters was left out; lowers the nodes and steps ``left``."""
    total, bound = sum(k * v for k, v in counts.items()), lower_bound(counts, capacity)
    size = sum(t for _, t in best)
    rest, path, waste = _Histogram(counts), [], 0
    stack: list[list] = []
    first_descent = whole = True

    def open_() -> None:
        nonlocal whole
        first = rest.below(capacity)
        rest.take([(first, 1)], 1)
        found, all_, taken = _fillings(rest, capacity - first, (size - 1) * capacity - total - waste, width, steps)
        rest.take([(first, 1)], -1)
        left[1] -= taken
        whole = whole and all_
        joined = [((first, 1 + f[0][1]), *f[1:]) if f and f[0][0] == first else ((first, 1), *f) for f in found]
        # A filling is tried as often as it can be repeated, then once.
        stack.append([(f, many) for f in reversed(joined) for many in (False, True)])

    open_()
    while stack and size > bound and left[0] > 0 and (first_descent or left[1] > 0):
        if not stack[-1]:
            first_descent = False
            stack.pop()
            if path:
                filling, times, lost = path.pop()
                rest.take(filling, -times)
                waste -= lost
            continue
        filling, many = stack[-1].pop()
        most = min(rest.n[x] // n for x, n in filling)
        if not many and most == 1:
            continue
        times = most if many else 1
        lost = (capacity - sum(x * n for x, n in filling)) * times
        # The last sequence may stay open: its waste is no loss against the rounded bound.
        pruned = waste + lost > (size - 1) * capacity - total and sum(rest.n[x] for x, _ in filling) > times * sum(n for _, n in filling)
        left[0] -= pruned or not first_descent
        if pruned:
            continue
        rest.take(filling, times)
        path.append((filling, times, lost))
        waste += lost
        if rest.bits:
            open_()
            continue
        found = sum(t for _, t, _ in path)
        if found < size:
            best, size = [(tuple(x for x, n in f for _ in range(n)), t) for f, t, _ in path], found
        stack.append([])
    return best, whole and not stack


def _assigner(patterns: list[Pattern]):
    """Looks up (length, rank) among the runs of slots that the patterns give each length."""
    used: dict[int, int] = {}
    keys, sequences, offsets, base = [], [], [], 0
    for lengths, times in patterns:
        at = 0
        for x in lengths:
            keys.append(x << 44 | used.get(x, 0))
            used[x] = used.get(x, 0) + times
            sequences.append(base)
            offsets.append(at)
            at += x
        base += times
    order = np.argsort(np.array(keys, np.int64))
    key, sequence, offset = (np.array(x, np.int64)[order] for x in (keys, sequences, offsets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = (np.asarray(batch.column("length")) << 44) | np.asarray(batch.column("rank"))
            at = np.searchsorted(key, want, "right") - 1
            made = [pa.array(sequence[at] + want - key[at]), pa.array(offset[at])]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``doc_id``, ``piece`` and ``length``.

    The rank of a piece within its length is its number within (length, salt) plus the pieces of lower salts, so a length
    that a third of all pieces share is ranked by many tasks. An empty table stays empty; repeated rows are packed as
    often as they occur.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(4 * parts(spark))).cast("int"))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    below = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0))).drop("n")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = salted.withColumn("own", F.row_number().over(within) - 1).join(starts, ["length", "salt"])
    ranked = ranked.select(*pieces.columns, (F.col("own") + F.col("before")).cast("long").alias("rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_assigner(complete(counts, capacity)), schema)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 2048 tokens."""
    return packing_stage(spark, table(spark, sf_dir, "documents"), sf_dir)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset; nulls, repeated rows and empty tables as for :func:`tokenize`."""
    return pack(materialize(tokenize(docs), "pieces"))
