"""MinHash near-duplicates with sequential Bayesian verification.

Equal shingle sets are one representative. A signature holds one byte of each minimum hash. Banded signatures give
candidates: every member of a bucket is compared with the bucket's smallest member, and members that this leaves in
different components with each other. Signatures are compared a batch at a time; a pair goes when the posterior
probability that it reaches the threshold falls below ``MISS``. Survivors are verified on their full shingle sets, which
are made only for documents that have a survivor.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize, slices, table, texts
from .components import connected_components
from .words import WordTable, word_hashes

#: Prints in a band.
ROWS = 6
#: Prints compared between two looks at the posterior, and survivors verified at a time.
BATCH = 16
#: Posterior probability below which a pair is given up at a look; also the most that bands may miss at the threshold.
MISS = 1e-5
SHINGLE = 3
#: Similarity threshold in percent.
PERCENT = 85
#: Members of a bucket that one task compares with each other, or that one task verifies against one set.
BLOCK = 1024
#: Bits of the table of wanted ids that is broadcast before texts are read again (a bound, whatever the corpus).
WANTED = 1 << 24
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def bands(percent: int) -> int:
    """Bands that miss a pair at the threshold with probability ``MISS`` at most: 25 at 85 %, 38 at 80 %."""
    agree = (percent / 100) ** ROWS
    return ceil(log(MISS) / log1p(-agree)) if agree < 1 else 1


def hashes(percent: int) -> int:
    """Prints of a signature: those of the bands, and at least one look's."""
    return max(BATCH, ROWS * bands(percent))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_table() -> WordTable:
    return WordTable(lambda words: word_hashes(words)[:, None], 1, np.uint64)


def _shingles(docs: list[bytes], index: WordTable, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a shorter text is one shingle, one without words none."""
    flat, offsets = index.number([d.lower().split() for d in docs])
    h = index.values[flat, 0]
    run = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        run = _mix(run * _A + h[k : k + len(run)])
    out = []
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(run[lo : hi - size + 1]))
        elif hi > lo:
            one = np.uint64([hi - lo])
            for k in range(lo, hi):
                one = _mix(one * _B + h[k : k + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signatures(shingle: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _word_table()
        rng = np.random.default_rng(8)
        factor = rng.integers(1, 1 << 63, size, np.uint64) | np.uint64(1)
        shift = rng.integers(0, 1 << 63, size, np.uint64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _shingles([t.encode("utf-8", "replace") for t in texts(part.column("text"))], index, shingle)
                n = np.array([len(s) for s in sets], np.int64)
                some = n > 0
                flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
                heads = (np.cumsum(n) - n)[some]
                signature = np.zeros((len(sets), size), np.uint8)
                marks = np.zeros((len(sets), 2), np.uint64)
                if some.any():
                    for k in range(size):
                        value = ((flat * factor[k] + shift[k]) >> np.uint64(32)).astype(np.uint32)
                        # The low byte of a minimum is its print; different sets agree in it by chance once in 256.
                        signature[some, k] = np.minimum.reduceat(value, heads) & np.uint32(0xFF)
                    marks[some, 0] = np.add.reduceat(_mix(flat + _A), heads)
                    marks[some, 1] = np.add.reduceat(_mix(flat * _C + _B), heads)
                raw = [s.tobytes() if k else None for s, k in zip(signature, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), pa.array(marks[:, 0].view(np.int64)), pa.array(marks[:, 1].view(np.int64)), pa.array(raw, pa.binary())],
                    names=["doc_id", "n_shingles", "f1", "f2", "sig"],
                )

    return run


def _sets(shingle: int):
    """Adds the full shingle set, as sorted unsigned 64-bit hashes, to rows with an id and a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _word_table()
        for batch in batches:
            for part in slices(batch, "text"):
                sets = _shingles([t.encode("utf-8", "replace") for t in texts(part.column("text"))], index, shingle)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "shingles"])

    return run


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Matches among ``n`` prints below which P(similarity >= threshold) < ``miss`` under a uniform prior.

    The posterior after m matches is Beta(m + 1, n - m + 1), whose upper tail at t is P(Binomial(n + 1, t) <= m). Prints
    that agree by chance only add matches, so the bound gives up no more pairs than with whole hashes.
    """
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n + 1


def looks(percent: int) -> list[tuple[int, int]]:
    """Prints compared and matches needed at each look."""
    return [(n, least_matches(n, percent / 100, MISS)) for n in range(BATCH, hashes(percent) + 1, BATCH)]


def _survive(left: np.ndarray, right: np.ndarray, stops: list[tuple[int, int]]) -> np.ndarray:
    """Positions of pairs of signatures that pass every look, and their matches."""
    at, matches, seen = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for n, least in stops:
        matches = matches + (left[at, seen:n] == right[at, seen:n]).sum(axis=1)
        seen = n
        kept = matches >= least
        at, matches = at[kept], matches[kept]
    return at


def _prune(percent: int):
    stops, size = looks(percent), hashes(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, size) for c in ("sig_a", "sig_b"))
            kept = pa.array(_survive(left, right, stops))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(kept), batch.column("b").take(kept)], names=["a", "b"])

    return run


def _links(own: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the other sets reach the threshold with one set, on full sets; all are sorted and without repeats."""
    sizes = np.array([len(o) for o in others], np.int64)
    flat = np.concatenate(others)
    at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
    both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * both >= percent * (len(own) + sizes - both)


class _Pair:
    """Two blocks of a bucket (or one with itself): which of the right rows may be near to a left row of another component."""

    def __init__(self, rows: pa.Table, percent: int):
        self.rep = np.asarray(rows.column("rep"))
        _, self.root = np.unique(np.asarray(rows.column("component")), return_inverse=True)
        i, j, bucket = (rows.column(c)[0].as_py() for c in ("i", "j", "bucket"))
        self.band, self.stops = bucket & _BAND, looks(percent)
        self.sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, hashes(percent))
        chunk = np.asarray(rows.column("chunk"))
        self.left, self.right, self.same_block = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j), i == j

    def near(self, x: int) -> np.ndarray:
        """Rows that pass every look with row ``x``, best first. A pair is looked at in the first band that it shares."""
        other = self.right[(self.root[self.right] != self.root[x]) & ((self.rep[self.right] > self.rep[x]) if self.same_block else True)]
        seen, matches = 0, np.zeros(len(other), np.int64)
        for n, least in self.stops:
            matches = matches + (self.sig[other, seen:n] == self.sig[x, seen:n]).sum(axis=1)
            seen, kept = n, matches >= least
            other, matches = other[kept], matches[kept]
        met = (self.sig[other, : ROWS * self.band] == self.sig[x, : ROWS * self.band]).reshape(len(other), self.band, ROWS).all(axis=2).any(axis=1)
        return other[~met][np.argsort(-matches[~met], kind="stable")]


def _involved(percent: int):
    """Rows of a block pair that have a survivor in another component; nothing else needs its full set."""

    def run(rows: pa.Table) -> pa.Table:
        pair, hit = _Pair(rows, percent), np.zeros(rows.num_rows, bool)
        for x in pair.left:
            near = pair.near(x)
            hit[near] = True
            hit[x] |= len(near) > 0
        return rows.filter(pa.array(hit))

    return run


def _cross(percent: int):
    """Links between different components of one block pair of a bucket: survivors, best first, until components meet.

    Nothing but a spanning set of verified links leaves the task.
    """

    def run(rows: pa.Table) -> pa.Table:
        pair, edges = _Pair(rows, percent), []
        sets, rep, root = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()], pair.rep, pair.root
        for x in pair.left:
            other = pair.near(x)
            while len(other):
                some, other = other[:BATCH], other[BATCH:]
                for y in some[_links(sets[x], [sets[k] for k in some], percent)]:
                    if root[y] != root[x]:
                        edges.append((rep[x], rep[y]))
                        root[root == root[y]] = root[x]
                other = other[root[other] != root[x]]
        a, b = (np.array(e, np.int64) for e in zip(*edges, strict=True)) if edges else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": a, "b": b})

    return run


def _exact(percent: int):
    """Verified links of one set (role 0) with a block of others."""

    def run(rows: pa.Table) -> pa.Table:
        role, rep = np.asarray(rows.column("role")), np.asarray(rows.column("rep"))
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        centres, members = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        hits = [(np.full(int(h.sum()), rep[c]), rep[members[h]]) for c in centres if len(members) for h in [_links(sets[c], [sets[k] for k in members], percent)]]
        a, b = (np.concatenate(x) for x in zip(*hits, strict=True)) if hits else (np.zeros(0, np.int64),) * 2
        return pa.table({"a": a, "b": b})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among candidate pairs, exact on full sets. A set with many partners is sent once for each block of them."""
    dealt = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("g")), "a")
    dealt = dealt.select(F.col("a").alias("centre"), F.pmod(F.xxhash64("b"), "g").alias("salt"), F.col("b").alias("rep"))
    needs = dealt.withColumn("role", F.lit(1)).union(dealt.select("centre", "salt", F.col("centre").alias("rep")).distinct().withColumn("role", F.lit(0)))
    return needs.join(sets, "rep").groupBy("centre", "salt").applyInArrow(_exact(percent), "a long, b long")


def _full_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``rep, shingles`` of the texts whose ids are wanted.

    A bit table of bounded size keeps almost all other texts out of the join's shuffle; where it fills up, at many times
    ``WANTED`` ids, it lets more pass, and the exact join behind it decides as before.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(WANTED))
    bits = wanted.select(place("rep").alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))
    at = docs.where("doc_id is not null").withColumn("p", place("doc_id")).withColumn("word", F.shiftright("p", 6))
    near = at.join(F.broadcast(bits), "word").where(F.expr("(shiftrightunsigned(bits, cast(p & 63 as int)) & 1) = 1")).select("doc_id", "text")
    found = near.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
    return materialize(found.mapInArrow(_sets(shingle), "rep long, shingles binary"), "sets")


def _mixed(members: DataFrame, component: DataFrame) -> DataFrame:
    """Rows of buckets that hold several components, dealt into pairs of blocks: ``bucket, rep, component, chunk, i, j``.

    A component that fills whole blocks of a bucket has blocks of its own, which never meet each other: a bucket of one
    large class and a few strangers costs as many rows as it has members.
    """
    rest = members.where("rep != centre and size > 2").join(component.withColumnRenamed("node", "rep"), "rep", "left")
    rest = rest.select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = rest.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("total")).where("lo < hi")
    rest = materialize(rest.join(mixed.select("bucket", "total"), "bucket"), "mixed")
    none = F.lit(0).cast("long")
    small = rest.where(F.col("total") <= BLOCK).select("bucket", "rep", "component", none.alias("chunk"), none.alias("i"), none.alias("j"))
    large = rest.where(F.col("total") > BLOCK)
    sizes = large.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    shared = sizes.where(F.col("n") < BLOCK).groupBy("bucket").agg(F.ceil(F.sum("n") / BLOCK).alias("blocks"))
    sizes = sizes.join(shared, "bucket", "left")
    turn = F.xxhash64("rep")
    own = F.when(F.col("n") >= BLOCK, F.xxhash64("component", F.pmod(turn, F.ceil(F.col("n") / BLOCK)))).otherwise(F.pmod(turn, F.coalesce("blocks", F.lit(1))))
    large = large.join(sizes, ["bucket", "component"]).select("bucket", "rep", "component", own.alias("chunk"), F.when(F.col("n") >= BLOCK, F.col("component")).alias("whole"))
    chunks = large.select("bucket", "chunk", "whole").distinct()
    pairs = chunks.toDF("bucket", "i", "wi").join(chunks.toDF("bucket", "j", "wj"), "bucket").where(F.expr("i <= j and not coalesce(wi = wj, false)")).select("bucket", "i", "j")
    ends = pairs.select("bucket", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("chunk"))
    return small.unionByName(large.join(ends, ["bucket", "chunk"]).select("bucket", "rep", "component", "chunk", "i", "j"))


#: Bits of a bucket's name that hold its band.
_BAND = 0xFF


def near_duplicates(documents: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Texts without words, empty or null, have no shingles and link with nothing. Repeated texts are one representative, so
    their number never multiplies pairs; rows that share an id count as one document, which has the links of each of its
    texts. A row without an id has no class name of its own and takes part only as a copy. An empty table stays empty.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = materialize(docs.mapInArrow(_signatures(shingle, hashes(percent)), "doc_id long, n_shingles long, f1 long, f2 long, sig binary"), "signatures")
    key = ["n_shingles", "f1", "f2"]
    reps = marks.where("n_shingles > 0 and doc_id is not null").groupBy(*key).agg(F.min(F.struct("doc_id", "sig")).alias("m"))
    reps = materialize(reps.select(*key, F.col("m.doc_id").alias("rep"), F.col("m.sig").alias("sig")), "representatives")
    name = lambda k: F.xxhash64(F.lit(k), F.substring("sig", ROWS * k + 1, ROWS)).bitwiseAND(F.lit(~_BAND)).bitwiseOR(F.lit(k))
    banded = reps.select("rep", F.explode(F.array(*[name(k) for k in range(bands(percent))])).alias("bucket"))
    full = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("centre")).where("size > 1")
    members = materialize(banded.join(full, "bucket"), "buckets")
    signed = reps.select("rep", "sig").dropDuplicates(["rep", "sig"])

    star = members.where("rep != centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    star = star.join(signed.toDF("a", "sig_a"), "a").join(signed.toDF("b", "sig_b"), "b").mapInArrow(_prune(percent), "a long, b long")
    star = materialize(star, "pairs")
    sets = _full_sets(docs, star.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), shingle)
    component = materialize(connected_components(_verified(star.distinct(), sets, percent)), "components")
    # Members that the stars leave in different components of a bucket; their smallest one has met all of them.
    dealt = _mixed(members, component).join(signed, "rep").select("bucket", "i", "j", "chunk", "rep", "component", "sig")
    dealt = materialize(dealt.groupBy("bucket", "i", "j").applyInArrow(_involved(percent), dealt.schema), "involved")
    discard(star, sets, members)
    sets = _full_sets(docs, dealt.select("rep").distinct(), shingle)
    more = dealt.join(sets, "rep").groupBy("bucket", "i", "j").applyInArrow(_cross(percent), "a long, b long")
    # Known components enter as stars, so that no earlier round is gone through again.
    joined = materialize(connected_components(component.toDF("a", "b").union(more)), "components")
    discard(component, dealt, sets)
    classes = reps.select(*key, "rep").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(*key, F.coalesce("component", "rep").alias("component"))
    found = marks.select("doc_id", *key).join(classes, key, "left")
    component_id = F.coalesce("component", "doc_id")
    return found.select("doc_id", "n_shingles", component_id.alias("component_id"), F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"))


def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents`` at 85 % of three-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"))


#: The pipeline's near duplicates take five words and a similarity of 0.8.
STAGE_PERCENT, STAGE_SHINGLE = 80, 5


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class, the one with the smallest id; a row without an id stays only if none has one.

    Rows are compared by their texts, not by their ids: rows that share an id but are no near copies all stay, and rows
    without an id are decided like others. A text without words is dropped only as a whole copy (same id, same text).
    """
    columns = list(docs.columns)
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*columns).alias("doc")), "rows")
    found = near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text"), STAGE_PERCENT, STAGE_SHINGLE)
    found = found.select(F.col("doc_id").alias("row"), "component_id", F.col("n_shingles").alias("size"))
    named = found.join(rows.select("row", F.col("doc.doc_id").alias("id"), F.sha2("doc.text", 256).alias("mark")), "row")
    bare = F.col("size") == 0
    same = [F.when(~bare, F.col("component_id")), F.when(bare, F.col("id")), F.when(bare, F.col("mark")), F.when(bare & F.col("id").isNull(), F.col("row"))]
    first = named.groupBy(*[c.alias(f"same{k}") for k, c in enumerate(same)]).agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark", "row")).alias("first"))
    return rows.join(first.select("first.row"), "row", "left_semi").select("doc.*").select(*columns)
