"""SentencePiece BPE encoding and decoding with vectorised merge rounds.

A text becomes units: a run of word marks and what follows it, since no piece of such a model holds a mark after another
character (checked when the model is read). Distinct units are encoded together: flat numpy symbol arrays, the minimum
pair rank of each unit, all leftmost merges of that pair at once, compaction, until no pair remains. The long units of a
batch go through the same rounds together, with links in place of compaction.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from .common import table, texts

MARK = "▁"
BOS, EOS = 1, 2
#: Units that a worker remembers before it starts anew.
MEMORY = 200_000
#: Longer units run their rounds from one queue of ranks, which finds a round's pairs without a scan of the units; about
#: where both forms cost the same in a batch of 300 (5.3 and 6.0 microseconds a character, measured).
LONG = 512
_NONE = np.int64(1 << 40)


class PieceModel:
    """Pieces, pair table and byte pieces of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self.text.values()):
            raise ValueError("this model has pieces that cross word marks")
        self.bytes_ = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        score = {p: sp.get_score(i) for i, p in self.text.items()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank_of = {p: order[s] for p, s in score.items()}
        self.id_of = {p: i for i, p in self.text.items()}
        self.symbol = {p: i for p, i in self.id_of.items() if len(p) == 1}
        for p in self.id_of:
            for c in p:
                self.symbol.setdefault(c, size + len(self.symbol))
        symbol = {**self.symbol, **{p: i for p, i in self.id_of.items() if len(p) > 1}}
        pairs = {}
        for p, i in self.id_of.items():
            for k in range(1, len(p)):
                if p[:k] in symbol and p[k:] in symbol:
                    pairs[symbol[p[:k]] << 20 | symbol[p[k:]]] = (self.rank_of[p], i)
        self.size = size
        self._index(pairs)
        self.raw = {i: p.replace(MARK, " ").encode() for i, p in self.text.items()}
        self.raw |= {i: bytes([b]) for b, i in enumerate(self.bytes_)} | {0: " ⁇ ".encode(), BOS: b"", EOS: b""}
        self.raw_length = np.array([len(self.raw.get(i, b"")) for i in range(size)], np.int64)
        self.raw_start = np.cumsum(self.raw_length) - self.raw_length
        self.raw_flat = np.frombuffer(b"".join(self.raw.get(i, b"") for i in range(size)), np.uint8)
        self.of_code = np.full(0x110000, -1, np.int64)
        for c, i in self.symbol.items():
            self.of_code[ord(c)] = i

    def _index(self, pairs: dict[int, tuple[int, int]]) -> None:
        """Hash levels: a key that finds its slot taken goes to the next level."""
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        self.levels = []
        while len(keys):
            bits = max(10, int(len(keys) * 8 - 1).bit_length())
            factor = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
            slot = ((keys.astype(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            table_ = np.full((1 << bits, 3), -1, np.int64)
            table_[slot[first], 0], table_[slot[first], 1:] = keys[first], values[first]
            self.levels.append((bits, factor, table_))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values = keys[rest], values[rest]

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; the rank of a pair that does not merge is ``_NONE``."""
        rank, merged = np.full(len(left), _NONE), np.full(len(left), -1, np.int64)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[at] << 20 | right[at]
        for bits, factor, table_ in self.levels:
            slot = ((keys.astype(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)
            got = table_[slot]
            hit = got[:, 0] == keys
            rank[at[hit]], merged[at[hit]] = got[hit, 1], got[hit, 2]
            taken = ~hit & (got[:, 0] >= 0)
            at, keys = at[taken], keys[taken]
            if not len(at):
                break
        return rank, merged

    def _ranks(self, at: np.ndarray, sym: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of the pairs that begin at the given positions."""
        after = np.minimum(at + 1, max(0, len(sym) - 1))
        return self.lookup(sym[at], np.where((at + 1 < len(sym)) & (unit[after] == unit[at]), sym[after], -1))

    def encode_units(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        """Piece ids of each unit, exactly as sequential best-pair merging gives them, and their decoded bytes."""
        long = [k for k, u in enumerate(units) if len(u) > LONG]
        short = [u for u in units if len(u) <= LONG] if long else units
        length = np.fromiter(map(len, short), np.int64, len(short))
        codes = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        sym = self.of_code[codes]
        unit = np.repeat(np.arange(len(short)), length)
        start = np.arange(len(sym))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank, merged = self._ranks(np.arange(len(sym)), sym, unit)
        while len(sym):
            heads = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            sizes = np.diff(np.r_[heads, len(sym)])
            best = np.repeat(np.minimum.reduceat(rank, heads), sizes)
            live = best < _NONE
            if not live.all():
                done.append((unit[~live], start[~live], sym[~live]))
                sym, unit, start, rank, merged, best = (x[live] for x in (sym, unit, start, rank, merged, best))
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == best)
            # In a run of overlapping pairs every other one merges, the leftmost first.
            fresh = np.r_[True, np.diff(hit) != 1]
            turn = np.arange(len(hit)) - np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[turn % 2 == 0]
            hit = self._safe(hit, sym, unit, rank, merged)
            sym[hit] = merged[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            at = (np.cumsum(keep) - 1)[hit]
            sym, unit, start, rank, merged = (x[keep] for x in (sym, unit, start, rank, merged))
            # Only pairs beside a merge have changed.
            at = np.r_[at, at[at > 0] - 1]
            rank[at], merged[at] = self._ranks(at, sym, unit)
        out = self._emit(*(np.concatenate(x) for x in zip(*done, strict=True)), codes, len(short)) if done else []
        if long:
            queued = iter(self._encode_long([units[k] for k in long]))
            short_out = iter(out)
            out = [next(queued) if len(u) > LONG else next(short_out) for u in units]
        return out

    def _encode_long(self, units: list[str]) -> list[tuple[bytes, bytes]]:
        codes = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        unit = np.repeat(np.arange(len(units)), [len(u) for u in units])
        sym, start = self._queued(self.of_code[codes], unit)
        return self._emit(unit[start], start, sym, codes, len(units))

    def _emit(self, unit: np.ndarray, start: np.ndarray, sym: np.ndarray, codes: np.ndarray, n: int) -> list[tuple[bytes, bytes]]:
        """Ids and decoded bytes of each unit; a character without a piece becomes its UTF-8 bytes."""
        order = np.argsort(start)
        unit, start, sym = unit[order], start[order], sym[order]
        lost = np.flatnonzero((sym < 0) | (sym >= self.size))
        if len(lost):
            raw = [chr(c).encode("utf-8", "replace") for c in codes[start[lost]].tolist()]
            times = np.ones(len(sym), np.int64)
            times[lost] = [len(r) for r in raw]
            at = np.repeat(np.isin(np.arange(len(sym)), lost), times)
            unit, sym = np.repeat(unit, times), np.repeat(sym, times)
            sym[at] = np.array(self.bytes_)[np.frombuffer(b"".join(raw), np.uint8)]
        cuts = np.searchsorted(unit, np.arange(n + 1))
        sizes = self.raw_length[sym]
        ends = np.r_[0, np.cumsum(sizes)]
        place = np.arange(ends[-1]) + np.repeat(self.raw_start[sym] - ends[:-1], sizes)
        text, ids = self.raw_flat[place].tobytes(), sym.astype("<u4").tobytes()
        a, b = (cuts * 4).tolist(), ends[cuts].tolist()
        return [(ids[i:j], text[k:m]) for i, j, k, m in zip(a[:-1], a[1:], b[:-1], b[1:], strict=True)]

    def _safe(self, hit: np.ndarray, sym: np.ndarray, unit: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> np.ndarray:
        """Only the leftmost merge of a unit where a merge would open a pair that is due no later than its siblings."""
        n = len(sym)
        first = np.r_[True, unit[hit][1:] != unit[hit][:-1]]
        if first.all():
            return hit
        m, r = merged[hit], rank[hit]
        before = np.where((hit > 0) & (unit[hit - 1] == unit[hit]), sym[hit - 1], -1)
        after_at = np.minimum(hit + 2, n - 1)
        after = np.where((hit + 2 < n) & (unit[after_at] == unit[hit]), sym[after_at], -1)
        bad = (self.lookup(before, m)[0] <= r) | (self.lookup(m, after)[0] <= r) | (self.lookup(m, m)[0] <= r)
        if not bad.any():
            return hit
        risky = np.isin(unit[hit], unit[hit[bad]])
        return hit[first | ~risky]

    def _queued(self, symbols: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of long units after all rounds, and where each begins.

        A round takes the least rank that waits in any unit and does its leftmost merges in all of them. Units never meet,
        so each still merges in the order of its own ranks. Symbols are linked instead of compacted and positions wait
        under their rank: a round costs what it merges.
        """
        n = len(symbols)
        sym, alive = np.r_[symbols, -1], np.ones(n, bool)
        # Position n stands behind the last symbol of every unit.
        ends = np.r_[unit[1:] != unit[:-1], True]
        right = np.r_[np.where(ends, n, np.arange(1, n + 1)), n]
        left = np.r_[np.where(np.r_[True, ends[:-1]], -1, np.arange(-1, n - 1)), -1]
        rank, merged = np.full(n, _NONE), np.full(n, -1, np.int64)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def put(r: int, at: np.ndarray) -> None:
            if r not in waiting:
                heapq.heappush(ranks, r)
            waiting.setdefault(r, []).append(at)

        def wait(at: np.ndarray) -> None:
            rank[at], merged[at] = self.lookup(sym[at], sym[right[at]])
            at = at[rank[at] < _NONE]
            if len(at):
                at = at[np.argsort(rank[at], kind="stable")]
                heads = np.flatnonzero(np.r_[True, np.diff(rank[at]) != 0])
                for some in np.split(at, heads[1:]):
                    put(int(rank[some[0]]), some)

        wait(np.arange(n))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[alive[at] & (rank[at] == r)]
            if not len(at):
                continue
            fresh = np.r_[True, right[at[:-1]] != at[1:]]
            turn = np.arange(len(at)) - np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            hit = at[turn % 2 == 0]
            first = np.r_[True, np.diff(unit[hit]) != 0]
            if not first.all():
                m, after = merged[hit], sym[right[right[hit]]]
                before = np.where(left[hit] >= 0, sym[left[hit]], -1)
                opened = np.minimum(np.minimum(self.lookup(before, m)[0], self.lookup(m, after)[0]), self.lookup(m, m)[0])
                bad = opened <= r
                if bad.any():
                    # A merge opens a pair that is due no later: in such a unit the leftmost goes alone, the others wait on.
                    risky = np.zeros(int(unit[-1]) + 1, bool)
                    risky[unit[hit[bad]]] = True
                    hit = hit[first | ~risky[unit[hit]]]
                    put(r, at[risky[unit[at]] & ~np.isin(at, hit)])
            gone = right[hit]
            sym[hit], alive[gone] = merged[hit], False
            right[hit] = right[gone]
            left[right[hit]] = hit
            wait(np.unique(np.r_[hit, left[hit][left[hit] >= 0]]))
        kept = np.flatnonzero(alive)
        return sym[kept], kept

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids; the mark that encoding put first goes, broken byte runs become U+FFFD."""
        out, run, first = [], bytearray(), True
        byte = {i: b for b, i in enumerate(self.bytes_)}
        for i in [*ids, BOS]:
            if i in byte:
                run.append(byte[i])
                first = False
                continue
            if run:
                out.append(bytes(run).decode("utf-8", "replace"))
                run = bytearray()
            piece = self.raw[i]
            if first and piece:
                piece = piece[1:] if piece.startswith(b" ") and i != 0 else piece
                first = False
            out.append(piece.decode("utf-8"))
        return "".join(out)


class Encoder(dict):
    """Unit (without its last mark) -> (ids as little-endian bytes, decoded bytes), filled a batch at a time."""

    def __init__(self, model: PieceModel, memory: int = MEMORY):
        super().__init__()
        self.model, self.memory = model, memory

    def split(self, text: str) -> list[str]:
        """Keys of a text's units: every part stands for itself after one mark, a run of marks is carried to the next."""
        if not text:
            return []
        parts = text.replace(" ", MARK).split(MARK)
        if "" not in parts:
            return parts
        units, run = [], ""
        for p in parts[:-1]:
            if p:
                units.append(run + p)
                run = ""
            else:
                run += MARK
        units.append(run + parts[-1])
        return units

    def learn(self, docs: list[list[str]]) -> None:
        if len(self) > self.memory:
            self.clear()
        new = list(set().union(*docs).difference(self))
        for lo in range(0, len(new), 20_000):
            some = new[lo : lo + 20_000]
            self.update(zip(some, self.model.encode_units([MARK + u for u in some]), strict=True))

    def encode(self, docs: list[list[str]]) -> Iterator[tuple[bytes, bytes]]:
        """Ids (begin and end included) and decoded text of each document, as bytes."""
        self.learn(docs)
        begin, end = np.array([BOS], "<u4").tobytes(), np.array([EOS], "<u4").tobytes()
        for d in docs:
            got = [self[u] for u in d]
            yield b"".join([begin, *(g[0] for g in got), end]), b"".join([g[1] for g in got])[1:]


def _runner(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(path))
        for batch in batches:
            n, ids, decoded = [], [], []
            docs: list[list[str]] = []
            held = 0

            def flush() -> None:
                for a, b in encoder.encode(docs):
                    n.append(len(a) // 4)
                    ids.append(hashlib.sha256(a).hexdigest())
                    decoded.append(hashlib.sha256(b).hexdigest())
                docs.clear()

            for text in texts(batch.column("text")):
                docs.append(encoder.split(text))
                held += len(text)
                if held > 1 << 20:
                    flush()
                    held = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def _lister(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(PieceModel(path))
        for batch in batches:
            ids, out = [], []
            for a, b in encoder.encode([encoder.split(t) for t in texts(batch.column("text"))]):
                ids.append(np.frombuffer(a, "<u4").astype(np.int32)), out.append(b.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(out, pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of every text; null is empty and gives the begin and end ids alone.

    Texts are encoded whole however long; repeated rows give the same each, an empty table stays empty, and other columns
    are not read.
    """
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string"
    return documents.select("doc_id", "text").mapInArrow(_lister(path or public_tokenizers.path("piece_bpe_32k.model")), schema)


def digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, from the same encoder, without listing the ids.

    Null, empty, long and repeated texts as for :func:`encode`.
    """
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select("doc_id", "text").mapInArrow(_runner(path or public_tokenizers.path("piece_bpe_32k.model")), schema)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoding and decoding of all ``documents`` with the 32k piece model."""
    return digests(table(spark, sf_dir, "documents"))
