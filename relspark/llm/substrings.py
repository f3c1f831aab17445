"""Suffix-array dedup: bytes covered by a long string that also starts in an earlier document are removed.

1. Documents are dealt into packs by a hash of their id. In every window of ``LENGTH`` bytes the ``K``-gram with the
   smallest hash is an anchor, so equal windows have equal anchors. Each pack sends the distinct anchor keys (32 bits in a
   bucket) once; a bucket answers with one bit per key: seen in more than one document or not. Windows without a shared
   anchor are unique, and most text ends here.
2. Around each shared anchor a pack cuts the snippet of the windows that this anchor stands for, each distinct snippet
   once with its smallest document.
3. A bucket of anchors gets all its snippets. Shards of them are sorted into Burrows-Wheeler transforms, which are merged
   by refining their interleave ``STEP`` symbols a round: after h rounds the order is that of the first ``STEP * h``
   symbols, and suffixes that a border first parts in a round have a common prefix that ends within its symbols. After
   ``LENGTH`` symbols every block is a repeated interval, whose smallest document goes back to the packs. No suffix is
   sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, table

LENGTH = 50
K = 24
#: Text bytes of a pack, anchor keys and snippet bytes of a bucket (about).
PACK, KEYS, SNIPPETS = 4 << 20, 1 << 20, 4 << 20
#: Suffixes that one shard sorts, and (about) those that are merged at a time: whole anchors, so that the arrays of a merge
#: stay in the cache. An anchor with more snippets is merged in one piece.
SHARD, MERGED = 1 << 14, 1 << 16
#: Symbols by which a round of a merge refines the order.
STEP = 5
_P = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max
#: Never part of UTF-8: ends a snippet.
_END = 0xFF


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_P, n, 1 << 64))


def _slide(f, x: np.ndarray, n: int) -> np.ndarray:
    """``f`` over every run of ``n`` neighbours."""
    w = 1
    while 2 * w <= n:
        x = f(x[:-w], x[w:])
        w *= 2
    return f(x[: len(x) - (n - w)], x[n - w :]) if n > w else x


def _hashes(b: np.ndarray) -> np.ndarray:
    """Hash of the 24 bytes from each position."""
    h = b.astype(np.uint64) + np.uint64(1)
    h = h[:-1] * _power(1) + h[1:]
    h = h[:-2] * _power(2) + h[2:]
    h8 = h[:-4] * _power(4) + h[4:]
    h = h8[:-8] * _power(8) + h8[8:]
    h = h[:-8] * _power(8) + h8[16:]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Pack:
    """Texts of a pack in order of their ids, as one byte array."""

    def __init__(self, rows: pa.Table):
        got: list[tuple[int, bool, bytes]] = []
        decode = zstandard.ZstdDecompressor()
        for ids, nulls, sizes, blob in zip(*(rows.column(c).to_pylist() for c in ("ids", "nulls", "sizes", "blob")), strict=True):
            data = decode.decompress(blob, max_output_size=int(sum(np.frombuffer(sizes, np.int64))) + 1)
            at = 0
            for i, null, n in zip(*(np.frombuffer(x, kind).tolist() for x, kind in ((ids, np.int64), (nulls, bool), (sizes, np.int64))), strict=True):
                got.append((i, null, data[at : at + n]))
                at += n
        # Equal ids are ordered by their text, so that every pass over a pack sees the same order.
        got.sort()
        self.ids = np.array([g[0] for g in got], np.int64)
        self.null = [g[1] for g in got]
        self.sizes = np.array([len(g[2]) for g in got], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(g[2] for g in got), np.uint8)

    def anchors(self, block: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Position and hash of each anchor, and the first and last window that it stands for."""
        width, n = LENGTH - K + 1, len(self.data)
        first_bad = np.maximum(self.ends - LENGTH + 1, self.ends - self.sizes)
        padded = np.concatenate([self.data, np.zeros(LENGTH, np.uint8)])
        out: list[tuple[np.ndarray, ...]] = []
        for lo in range(0, n, block):
            hi = min(n, lo + block)
            a, z = max(0, lo - width + 1), min(n, hi + width - 1)
            x = _hashes(padded[a : z + width + K])
            low = _slide(np.minimum, x, width)[: z - a].copy()
            # Windows that would run over the end of their document stand for nothing.
            for e, s in zip(self.ends[k0 : k1 + 1], first_bad[k0 : k1 + 1], strict=True) if (k0 := np.searchsorted(self.ends, a, "right")) <= (k1 := np.searchsorted(self.ends, z)) else ():
                low[max(0, s - a) : max(0, e - a)] = 0
            front = np.zeros(width - 1, np.uint64)
            top = _slide(np.maximum, np.concatenate([front, low]), width)
            at = np.flatnonzero((top == x[: z - a]) & (x[: z - a] != 0))
            at = at[(at + a >= lo) & (at + a < hi)]
            near = np.concatenate([front, low])[at[:, None] + np.arange(width)] == x[at][:, None]
            out.append((at + a, x[at], at + a - width + 1 + near.argmax(axis=1), at + a - near[:, ::-1].argmax(axis=1)))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _packer(n_packs: int):
    """Compressed runs of documents, one row for each pack that a batch has rows of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            pack = np.asarray(batch.column("pack"))
            ids = batch.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
            null = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            data = [b"" if t is None else t.encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            order = np.argsort(pack, kind="stable")
            cuts = np.r_[0, np.flatnonzero(np.diff(pack[order])) + 1, len(order)] if len(order) else np.zeros(1, int)
            rows = [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array([pack[r[0]] for r in rows], np.int64)),
                    pa.array([ids[r].astype(np.int64).tobytes() for r in rows], pa.binary()),
                    pa.array([null[r].tobytes() for r in rows], pa.binary()),
                    pa.array([np.array([len(data[k]) for k in r], np.int64).tobytes() for r in rows], pa.binary()),
                    pa.array([press.compress(b"".join(data[k] for k in r)) for r in rows], pa.binary()),
                ],
                names=["pack", "ids", "nulls", "sizes", "blob"],
            )

    return run


def _keys(pack: Pack, bits: int) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Distinct anchor keys of a pack (bucket bits, then 32 bits), the key of each anchor, and the anchors."""
    found = pack.anchors()
    keys, of = np.unique(found[1] >> np.uint64(32 - bits), return_inverse=True)
    return keys, of, found


_SENT = "pack long, bucket long, keys binary, many binary"


def _announce(bits: int):
    def run(rows: pa.Table) -> pa.Table:
        pack = Pack(rows)
        keys, of, found = _keys(pack, bits)
        doc = np.searchsorted(pack.ends, found[0], "right")
        low, high = np.full(len(keys), len(pack.ids)), np.full(len(keys), -1)
        np.minimum.at(low, of, doc)
        np.maximum.at(high, of, doc)
        many = low != high
        bucket = (keys >> np.uint64(32)).astype(np.int64)
        cuts = np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)] if len(bucket) else np.zeros(1, int)
        short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        parts_ = list(zip(cuts[:-1], cuts[1:], strict=True))
        me = rows.column("pack")[0].as_py()
        return pa.table(
            [
                pa.array([me] * len(parts_), pa.int64()),
                pa.array([int(bucket[a]) for a, _ in parts_], pa.int64()),
                pa.array([short[a:b].tobytes() for a, b in parts_], pa.binary()),
                pa.array([np.packbits(many[a:b]).tobytes() for a, b in parts_], pa.binary()),
            ],
            names=["pack", "bucket", "keys", "many"],
        )

    return run


def _shared(rows: pa.Table) -> pa.Table:
    """One bit for each announced key: in several documents."""
    keys = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
    many = [np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool) for k, m in zip(keys, rows.column("many").to_pylist(), strict=True)]
    flat, flags = np.concatenate(keys), np.concatenate(many)
    distinct, of, n = np.unique(flat, return_inverse=True, return_counts=True)
    yes = n > 1
    yes[of[flags]] = True
    bits = [np.packbits(x).tobytes() for x in np.split(yes[of], np.cumsum([len(k) for k in keys])[:-1])]
    return pa.table([rows.column("pack"), rows.column("bucket"), pa.array(bits, pa.binary()), pa.array([len(k) for k in keys], pa.int64())], names=["pack", "bucket", "bits", "n"])


_CUT = "pack long, bucket long, keys binary, sizes binary, docs binary, data binary, times binary, places binary"


def _cut(bits: int, buckets: int):
    """Distinct snippets around the shared anchors of a pack, and where each occurs."""

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in _CUT.split(", ")]
        if not rows.num_rows or not answers.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], pa.binary())] * 6, names=names)
        pack = Pack(rows)
        keys, of, (at, hashed, lo, hi) = _keys(pack, bits)
        answers = answers.sort_by("bucket")
        yes = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(answers.column("bits").to_pylist(), answers.column("n").to_pylist(), strict=True)]).astype(bool)
        take = yes[of]
        hashed, lo, hi = hashed[take], lo[take], hi[take]
        data, seen = pack.data.tobytes(), {}
        which = np.fromiter((seen.setdefault(data[a : b + LENGTH], len(seen)) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)), np.int64, len(lo))
        order = np.argsort(which, kind="stable")
        first = order[np.searchsorted(which[order], np.arange(len(seen)))] if len(seen) else order
        snippets = list(seen)
        doc = np.searchsorted(pack.ends, lo, "right")
        # Positions rise with ids, so the first occurrence has the smallest document.
        owner = pack.ids[doc[first]]
        times = np.bincount(which, minlength=len(seen))
        starts = np.cumsum(times) - times
        bucket = (hashed[first] % np.uint64(buckets)).astype(np.int64)
        turn = np.argsort(bucket, kind="stable")
        cuts = np.r_[np.flatnonzero(np.r_[True, bucket[turn][1:] != bucket[turn][:-1]]), len(turn)] if len(turn) else np.zeros(1, int)
        made: list[tuple] = []
        me, press = rows.column("pack")[0].as_py(), zstandard.ZstdCompressor(level=3).compress
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            # Neighbours in the text stay neighbours in the blob, which then compresses well.
            own = turn[a:b]
            places = np.concatenate([order[starts[k] : starts[k] + times[k]] for k in own])
            made.append(
                (me, int(bucket[own[0]]), hashed[first[own]].astype(np.uint32).tobytes(), np.array([len(snippets[k]) for k in own], np.uint8).tobytes(), press(owner[own].tobytes()), press(b"".join(snippets[k] for k in own)), times[own].astype(np.uint32).tobytes(), lo[places].astype(np.uint32).tobytes())
            )
        columns = list(zip(*made, strict=True)) or [[]] * 8
        return pa.table([pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, c in enumerate(columns)], names=names)

    return run


class Shard:
    """Burrows-Wheeler transform of a run of snippets: suffixes in order, the symbols before each, and the place of what they begin."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, first: int):
        """``data`` holds snippets with an end symbol each; ``first`` is the number of the first snippet."""
        n = len(data)
        key = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
        for k in (1, 2, 4):
            key = key[:-k] << np.uint64(8 * k) | key[k:]
        key = key[:n]
        grams, bits, step = key >> np.uint64(64 - 8 * STEP), np.uint64((n + 1).bit_length()), 8
        rank = _rank(key)
        # As many ranks as 64 bits hold make the next key. Suffixes that are equal to their ends are ordered by what follows.
        while step < int(size.max()) and int(rank.max()) < n:
            key, folds = rank, 64 // int(bits)
            for k in range(1, folds):
                after = np.zeros(n, np.uint64)
                after[: max(0, n - k * step)] = rank[k * step :]
                key = key << bits | after
            rank, step = _rank(key), folds * step
        order = np.argsort(rank.astype(np.uint16) if n < 1 << 16 else rank, kind="stable")
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        own = np.repeat(np.arange(len(size)), size)[order]
        self.snippet = own + first
        self.offset = order - start[own]
        # STEP symbols back at a time: the suffix that begins there, and the number of those symbols among the shard's. The
        # first ones of a snippet have no such suffix and point anywhere; a merge never asks for it.
        self.far = place[order - STEP]
        grams = grams[order]
        new = np.r_[True, grams[1:] != grams[:-1]]
        self.grams = grams[new]
        self.symbols = (np.cumsum(new, dtype=np.int32) - 1)[self.far]


def _rank(key: np.ndarray) -> np.ndarray:
    """Number of each key among the distinct ones, from 1."""
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(len(key), np.uint64)
    rank[order] = np.cumsum(np.r_[True, key[1:] != key[:-1]], dtype=np.uint64)
    return rank


def merge(shards: list[Shard], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Merged order of all suffixes of ``length`` symbols and an end or more, by those symbols, and the number of each one's block of equal ones.

    Each round reads the ``STEP`` symbols before the suffixes in the present interleave and deals the suffixes that much
    longer into symbol blocks, keeping their order: the interleave of the shards refined by ``STEP`` symbols. ``length``
    is a multiple of ``STEP``, and no snippet is shorter. The first interleave has the suffixes with ``length`` symbols
    before them: all others lead to none that is asked for.
    """
    base = np.cumsum([0] + [len(s.far) for s in shards])
    far = np.concatenate([s.far + np.int32(b) for s, b in zip(shards, base, strict=False)])
    alphabet, number = np.unique(np.concatenate([s.grams for s in shards]), return_inverse=True)
    number = number.astype(np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
    grams = np.cumsum([0] + [len(s.grams) for s in shards])
    symbols = np.concatenate([number[g:][s.symbols] for s, g in zip(shards, grams, strict=False)])
    order = np.flatnonzero(np.concatenate([s.offset for s in shards]) >= length).astype(np.int32)
    block, border = np.zeros(len(order), np.int32), np.ones(len(order), bool)
    for _ in range(length // STEP):
        seen = symbols[order]
        turn = np.argsort(seen, kind="stable")
        came, seen = block[turn], seen[turn]
        order = far[order[turn]]
        border[1:] = (seen[1:] != seen[:-1]) | (came[1:] != came[:-1])
        block = np.cumsum(border, dtype=np.int32)
    return order, block


def earliest(snippets: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each window of each snippet, one snippet after the other, the smallest document that holds the same window."""
    size = np.array([len(s) + 1 for s in snippets], np.int64)
    data, ends = np.frombuffer(b"\xff".join([*snippets, b""]), np.uint8), np.cumsum(size)
    shards, lo = [], 0
    cuts = np.searchsorted(ends, np.arange(SHARD, int(size.sum()) + SHARD, SHARD))
    for hi in np.unique(np.minimum(cuts + 1, len(snippets))).tolist():
        if hi > lo:
            at = ends[lo] - size[lo]
            shards.append(Shard(data[at : ends[hi - 1]], ends[lo:hi] - size[lo:hi] - at, size[lo:hi], lo))
            lo = hi
    order, block = merge(shards)
    snippet = np.concatenate([s.snippet for s in shards])[order]
    offset = np.concatenate([s.offset for s in shards])[order]
    least = np.minimum.reduceat(docs[snippet], np.flatnonzero(np.r_[True, block[1:] != block[:-1]]))
    windows = size - LENGTH
    flat = np.empty(len(order), np.int64)
    flat[(np.cumsum(windows) - windows)[snippet] + offset] = least[block - 1]
    return flat


_RUNS = "pack long, times binary, places binary, runs binary, lengths binary, least binary"


def _judge(rows: pa.Table) -> pa.Table:
    """Runs of windows with the same smallest document, for each snippet that a pack sent."""
    unpress = zstandard.ZstdDecompressor().decompress
    docs = [np.frombuffer(unpress(d), np.int64) for d in rows.column("docs").to_pylist()]
    sizes = [np.frombuffer(s, np.uint8).astype(np.int64) for s in rows.column("sizes").to_pylist()]
    keys = np.concatenate([np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()])
    flat_docs, seen, which = np.concatenate(docs), {}, []
    for data, size in zip(map(unpress, rows.column("data").to_pylist()), sizes, strict=True):
        ends = np.cumsum(size).tolist()
        which += [seen.setdefault(data[a:b], len(seen)) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    which, snippets = np.array(which, np.int64), list(seen)
    owner, key_of = np.full(len(snippets), _LAST), np.zeros(len(snippets), np.uint32)
    np.minimum.at(owner, which, flat_docs)
    key_of[which] = keys
    # Equal windows have equal anchors: snippets of an anchor are merged together, those of several anchors at a time.
    turn = np.argsort(key_of, kind="stable")
    sorted_ = [snippets[k] for k in turn.tolist()]
    long = np.array([len(s) for s in sorted_], np.int64)
    heads = np.flatnonzero(np.r_[True, np.diff(key_of[turn]) != 0])
    reached = np.cumsum(long + 1)[np.r_[heads[1:], len(turn)] - 1] // MERGED
    cuts = [*heads[np.flatnonzero(np.r_[True, np.diff(reached) != 0])].tolist(), len(turn)]
    least = np.concatenate([earliest(sorted_[a:b], owner[turn[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    # Runs of windows, of all snippets as they were merged; then those of each snippet that was sent.
    windows = long - LENGTH + 1
    starts = np.cumsum(windows) - windows
    new = np.r_[True, least[1:] != least[:-1]]
    new[starts] = True
    heads = np.flatnonzero(new)
    length = np.diff(np.r_[heads, len(least)]).astype(np.uint8)
    first, many = np.empty(len(turn), np.int64), np.empty(len(turn), np.int64)
    first[turn], many[turn] = np.searchsorted(heads, starts), np.add.reduceat(new, starts, dtype=np.int64)
    first, many = first[which], many[which]
    ends = np.cumsum(many)
    run = np.repeat(first - ends + many, many) + np.arange(int(many.sum()))
    length, least = length[run], least[heads][run]
    cuts = np.cumsum([0] + [len(d) for d in docs])
    at = np.r_[0, ends][cuts].tolist()
    cuts = cuts.tolist()
    many = many.astype(np.uint8)
    made = [[many[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], *([x[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)] for x in (length, least))]
    return pa.table([rows.column("pack"), rows.column("times"), rows.column("places"), *(pa.array(x, pa.binary()) for x in made)], names=[c.split()[0] for c in _RUNS.split(", ")])


def _covered(pack: Pack, answers: pa.Table) -> np.ndarray:
    """True for each byte of the pack that is removed."""
    steps = np.zeros(len(pack.data) + 1, np.int32)
    times, places, counts, size, least = (np.frombuffer(b"".join(answers.column(c).to_pylist()), kind).astype(np.int64) for c, kind in (("times", np.uint32), ("places", np.uint32), ("runs", np.uint8), ("lengths", np.uint8), ("least", np.int64)))
    if len(times):
        first = np.cumsum(counts) - counts
        total = np.cumsum(size)
        within = total - size - np.repeat((total - size)[first], counts)
        # Every occurrence meets every run of its snippet.
        snippet = np.repeat(np.arange(len(times)), times)
        many = counts[snippet]
        occurrence = np.repeat(np.arange(len(snippet)), many)
        run = np.repeat(first[snippet], many) + np.arange(len(occurrence)) - np.repeat(np.cumsum(many) - many, many)
        start = places[occurrence] + within[run]
        gone = least[run] < pack.ids[np.searchsorted(pack.ends, places, "right")][occurrence]
        np.add.at(steps, start[gone], 1)
        np.add.at(steps, start[gone] + size[run][gone] - 1 + LENGTH, -1)
    return np.cumsum(steps[:-1]) > 0


_DIGEST = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_TEXT = "doc_id long, text_hash long, kept_text string"


def _apply(as_text: bool):
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows:
            pack = Pack(rows)
            gone = _covered(pack, answers) if answers.num_rows else np.zeros(len(pack.data), bool)
            for i, null, a, b in zip(pack.ids.tolist(), pack.null, (pack.ends - pack.sizes).tolist(), pack.ends.tolist(), strict=True):
                own = gone[a:b]
                n = int(own.sum())
                kept = pack.data[a:b][~own].tobytes() if n else pack.data[a:b].tobytes()
                i = None if null else i
                if as_text:
                    # A cut inside a character leaves no half of it.
                    mark = xxhash.xxh64_intdigest(pack.data[a:b].tobytes(), seed=42)
                    out.append((i, mark - (mark >> 63 << 64), kept.decode("utf-8", "ignore")))
                else:
                    spans = int(own[0]) + int((own[1:] & ~own[:-1]).sum()) if n else 0
                    out.append((i, b - a, n, spans, hashlib.sha256(kept).hexdigest()))
        kinds = [pa.int64()] * 2 + [pa.string()] if as_text else [pa.int64()] * 4 + [pa.string()]
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in (_TEXT if as_text else _DIGEST).split(", ")])

    return run


def remove_repeats(documents: DataFrame, as_text: bool = False) -> DataFrame:
    """Per row the digest of what is left (or its text): ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Null text is empty; texts shorter than ``LENGTH`` bytes stay whole. Rows that repeat an id never remove each other's
    bytes, since no id is smaller; a null id counts as the largest. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = max(1, -(-total // PACK))
    bits = max(3, int(total * 0.08 / KEYS).bit_length())
    buckets = max(parts(spark), int(total / SNIPPETS))
    packed = docs.withColumn("pack", F.pmod(F.xxhash64("doc_id"), F.lit(packs))).mapInArrow(_packer(packs), "pack long, ids binary, nulls binary, sizes binary, blob binary")
    packed = packed.repartition(max(parts(spark), min(packs, 4 * parts(spark))), "pack")
    announced = packed.groupBy("pack").applyInArrow(_announce(bits), _SENT)
    answers = announced.groupBy("bucket").applyInArrow(_shared, "pack long, bucket long, bits binary, n long")
    # One plan: the exchange of the packs is written once and read by all three passes over them.
    cut = packed.groupBy("pack").cogroup(answers.groupBy("pack")).applyInArrow(_cut(bits, buckets), _CUT)
    verdict = cut.groupBy("bucket").applyInArrow(_judge, _RUNS)
    return packed.groupBy("pack").cogroup(verdict.groupBy("pack")).applyInArrow(_apply(as_text), _TEXT if as_text else _DIGEST)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all ``documents`` without repeats of 50 bytes."""
    return remove_repeats(table(spark, sf_dir, "documents"))


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes that an earlier one has; ``n_chars`` follows the text (null becomes empty).

    A row finds its text again by its id and the hash of the text it had, so repeated ids and null ids keep their own.
    """
    kept = remove_repeats(docs, as_text=True).distinct()
    whole = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.struct(*docs.columns).alias("row_itself"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash"))
    joined = whole.join(kept.toDF("its_id", "its_hash", "kept_text"), same)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return joined.select(*[new.get(c, F.col("row_itself")[c]).alias(c) for c in docs.columns])
