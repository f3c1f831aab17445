"""Vector code compression: every part of a vector becomes the index of its nearest entry in a small integer codebook.

Codebooks are refined over all vectors. In each round every task assigns its vectors and adds them up for each entry, so
what leaves a task, and what the driver gathers, is a sum for each component of the codebooks. Nearest entries are found by
segment-mean lower bounds: distances between block means, with what residual norms add, rule entries out from coarse to fine
blocks; the entries left get exact integer distances.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Integer steps of 1.0, parts of a vector, entries of a part's codebook, and rounds of refinement.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Up to this size of a component, int64 holds every squared distance of up to 2**14 components; beyond it Python integers do.
SMALL = 1 << 23
_LONGEST = (1 << 63) - 1

#: Codebooks of one length of vectors: for each part, entries x components.
Codebook = list[np.ndarray]


def integers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)``, exact for any finite x when the scale is a power of two."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.astype(np.float64) * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    # A product that leaves the doubles is made in integers.
    exact = [int(x) * scale if abs(x) >= 2.0**900 else int(s) for x, s in zip(vectors.astype(np.float64).ravel(), scaled.ravel(), strict=True)]
    return np.array(exact, object).reshape(scaled.shape)


def _fits(*arrays: np.ndarray) -> bool:
    return all(a.dtype != object and (not a.size or int(np.abs(a).max()) < SMALL) for a in arrays)


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    """Where the parts of a vector lie; if ``parts`` does not divide the length, the first ones are one longer."""
    edge = [k * (length // parts) + min(k, length % parts) for k in range(parts + 1)]
    return list(zip(edge[:-1], edge[1:], strict=True))


def _blocks(x: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means of the blocks of every row, and the norm of what the means leave over in each block."""
    size = np.diff(np.r_[edges, x.shape[1]])
    mean = np.add.reduceat(x, edges, axis=1) / size
    rest = x - np.repeat(mean, size, axis=1)
    return mean, np.sqrt(np.add.reduceat(rest * rest, edges, axis=1))


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of each row's nearest entry (ties to the lower), its exact squared distance, and how many distances were computed.

    For a block of n components, ``n * (mean - mean')**2 + (rest - rest')**2`` never exceeds the squared distance of its
    components. Entries whose sum over blocks is above a distance already known are out; halving the blocks sharpens the sum.
    """
    n, d = x.shape
    if not d or not n:
        return np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    small = _fits(x, entries)
    own, other = (x, entries) if small else (x.astype(object), entries.astype(object))
    exact = lambda r, e: ((own[r] - other[e]) ** 2).sum(axis=1)
    known = np.full((n, len(entries)), _LONGEST, np.int64) if small else np.full((n, len(entries)), None, object)
    alive, best, done, blocks = np.ones(known.shape, bool), None, 0, 1
    if all(a.dtype != object or np.abs(a).max() < 10**140 for a in (x, entries)):
        xf, ef = x.astype(np.float64), entries.astype(np.float64)
    else:
        blocks = d + 1  # squares would leave the doubles: no bounds, all entries get exact distances
    while blocks <= max(1, d // 2):
        edges = np.arange(blocks) * d // blocks
        size = np.diff(np.r_[edges, d])
        (mean, rest), (mean2, rest2) = _blocks(xf, edges), _blocks(ef, edges)
        rows, at = np.nonzero(alive)
        low = np.zeros(known.shape)
        low[rows, at] = (size * (mean[rows] - mean2[at]) ** 2 + (rest[rows] - rest2[at]) ** 2).sum(axis=1)
        if best is None:
            # The entry with the least bound gives the first distance to compare with.
            first = low.argmin(axis=1)
            found = exact(np.arange(n), first)
            known[np.arange(n), first], best, done = found, found.astype(np.float64), n
        # Slack for rounding: no entry at the least distance is ever ruled out.
        scale = (xf * xf).sum(axis=1) + (ef * ef).sum(axis=1).max()
        alive &= low <= (best + 1e-9 * (best + scale) + 1)[:, None]
        blocks *= 2
    rows, at = np.nonzero(alive & (known == _LONGEST if small else np.equal(known, None)))
    known[rows, at] = exact(rows, at)
    done += len(rows)
    if small:
        index = known.argmin(axis=1)
        return index, known[np.arange(n), index], done
    index = np.array([min((v, k) for k, v in enumerate(row) if v is not None)[1] for row in known], np.int64)
    return index, known[np.arange(n), index], done


def _vectors(column: pa.Array, kept: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and integer vectors of the valid rows, one run for each length."""
    column = column.take(pa.array(kept))
    length = np.diff(np.asarray(column.offsets))
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        values = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), n)
        yield kept[rows], integers(values, scale)


def _valid(column: pa.Array) -> np.ndarray:
    """Rows whose vector is there and holds finite numbers only."""
    import pyarrow.compute as pc

    there = np.flatnonzero(np.asarray(column.is_valid()))
    some = column.take(pa.array(there))
    flat = some.flatten()
    bad = ~np.asarray(pc.fill_null(pc.is_finite(flat), False))
    owner = np.repeat(np.arange(len(there)), np.diff(np.asarray(some.offsets)))
    return np.delete(there, np.unique(owner[bad]))


def _sums(books: dict[int, Codebook], scale: int, parts: int):
    """For each length, part and entry the vectors assigned to it and their sums, once for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            column = batch.column("vec")
            for _, x in _vectors(column, _valid(column), scale):
                for p, (a, b) in enumerate(cuts(x.shape[1], parts)):
                    index, _, _ = nearest(x[:, a:b], books[x.shape[1]][p])
                    for e in np.unique(index):
                        rows = x[index == e, a:b]
                        have = total.setdefault((x.shape[1], p, int(e)), [0, [0] * (b - a)])
                        have[0] += len(rows)
                        have[1] = [s + int(t) for s, t in zip(have[1], rows.sum(axis=0), strict=True)]
        rows = [(n, p, e, k, digit, count, part) for (n, p, e), (count, each) in total.items() for k, s in enumerate(each) for digit, part in enumerate(_digits(s))]
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["length", "part", "entry", "place", "digit", "count", "total"])

    return run


_SUMS = "length int, part int, entry int, place int, digit int, count long, total long"
_DIGIT = 60


def _digits(total: int) -> list[int]:
    """A sum in digits to base 2**60, each with its sign, so that sums of any size add up in longs."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest or not out:
        out.append(sign * (rest & ((1 << _DIGIT) - 1)))
        rest >>= _DIGIT
    return out


def _coded(books: dict[int, Codebook], digests: dict[int, str], scale: int, parts: int):
    """Codes and errors of every valid vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vec")
            for rows, x in _vectors(column, _valid(column), scale):
                index, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), object)
                for p, (a, b) in enumerate(cuts(x.shape[1], parts)):
                    index[:, p], found, _ = nearest(x[:, a:b], books[x.shape[1]][p])
                    error = error + found
                taken = pa.array(rows)
                code = ["".join(map("{:02x}".format, row)) for row in index.tolist()]
                made = [pa.array(code, pa.string()), pa.array([min(int(v), _LONGEST) for v in error], pa.int64()), pa.array([digests[x.shape[1]]] * len(rows), pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(taken), batch.column("label").take(taken), *made], names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    return run


def digest(book: Codebook) -> str:
    """Lowercase sha256 of all decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for part in book for entry in part for v in entry).encode()).hexdigest()


def _first_books(vectors: DataFrame, scale: int, parts: int, entries: int) -> dict[int, Codebook]:
    """The codebooks before the first round: the parts of the smallest ids of each length, at most ``entries`` of them."""
    kept = vectors.where("vec IS NOT NULL").where(~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    books = {}
    for n in [r[0] for r in kept.select(F.size("vec")).distinct().collect()]:
        first = kept.where(F.size("vec") == n).orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()
        x = integers(np.array([r["vec"] for r in first], np.float64).reshape(len(first), n), scale)
        books[n] = [x[:, a:b] for a, b in cuts(n, parts)]
    return books


def train(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> dict[int, Codebook]:
    """Codebooks for each length of vectors, refined over all of them.

    Each round reads all vectors and gathers one count and sum for each component of the codebooks, whatever the number of
    vectors; a mean is ``floor(sum / count)`` in integers, and an entry that no part chose stays as it is.
    """
    vectors = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    books = _first_books(vectors, scale, parts, entries)
    for _ in range(rounds if books else 0):
        partial = vectors.select("vec").mapInArrow(_sums(books, scale, parts), _SUMS)
        added = partial.groupBy("length", "part", "entry", "place", "digit").agg(F.sum("count").alias("count"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        count, total = {}, {}
        for r in added.collect():
            key = (r["length"], r["part"], r["entry"], r["place"])
            total[key] = total.get(key, 0) + (int(r["total"]) << (_DIGIT * r["digit"]))
            count[key] = max(count.get(key, 0), r["count"])  # digit 0 is always there
        books = {n: [part.copy() for part in book] for n, book in books.items()}
        for n, p, e, place in total:
            mean = total[n, p, e, place] // count[n, p, e, place]
            part = books[n][p]
            if part.dtype != object and abs(mean) >= 1 << 62:
                part = books[n][p] = part.astype(object)
            part[e, place] = mean
    return books


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` for every vector that holds finite numbers only.

    Null vectors and vectors with null or non-finite components are dropped. Rows that repeat an id are vectors of their own;
    among equal ids the smaller vector comes first for the first codebook, null ids come last. With fewer vectors than
    entries the codebooks are smaller. Vectors of different lengths have codebooks (and digests) of their own; where the
    number of parts does not divide the length, the first parts are one longer, and empty parts have code 0 at distance 0.
    Errors beyond a long are given as the largest long, as are their sums. Null labels count as one label. An empty table
    stays empty; other columns are not read.
    """
    books = train(embeddings, parts, entries, rounds, scale)
    kind = embeddings.schema["label"].dataType.simpleString()
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("vec"))
    run = _coded(books, {n: digest(book) for n, book in books.items()}, scale, parts)
    id_kind = embeddings.schema["vec_id"].dataType.simpleString()
    coded = materialize(rows.mapInArrow(run, f"vec_id {id_kind}, label {kind}, code string, error long, codebooks_sha256 string"), "codes")
    # One row for each label; written, so that Spark knows its size before it chooses the join.
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONGEST)).cast("long")
    sums = materialize(coded.groupBy("label").agg(whole.alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings`` in eight indexes into codebooks of sixteen entries."""
    return compress(table(spark, sf_dir, "embeddings"))


def oracle_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same by every distance to every entry, for vectors of one length that the parts divide."""
    steps = [
        f"""
v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
x AS MATERIALIZED (SELECT vec_id, part, e[part * len(e) // {parts} + 1 : (part + 1) * len(e) // {parts}] AS e FROM v, range({parts}) p(part)),
b0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, e FROM x
    WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries}))"""
    ]
    distance = "list_sum(list_transform(list_zip(x.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT vec_id, x.part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (SELECT x.vec_id, x.part, x.e, b.entry, {distance} AS d FROM x JOIN b{k} b ON b.part = x.part) x GROUP BY ALL)")
        if k < rounds:
            means = f"SELECT part, entry, list(m ORDER BY i) AS e FROM (SELECT a.part, a.entry, i, CAST(floor_sum // n AS BIGINT) AS m FROM (SELECT a.part, a.entry, i, count(*) AS n, sum(x.e[i]) - ((sum(x.e[i]) % count(*)) + count(*)) % count(*) AS floor_sum FROM a{k} a JOIN x USING (vec_id, part), unnest(range(1, len(x.e) + 1)) u(i) GROUP BY ALL) a) GROUP BY ALL"
            steps.append(f"m{k} AS ({means})")
            steps.append(f"b{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM b{k} b LEFT JOIN m{k} m ON m.part = b.part AND m.entry = b.entry)")
    steps.append(f"r AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)")
    steps.append("l AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM r JOIN v USING (vec_id) GROUP BY label)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, label_error, codebooks_sha256 FROM r JOIN v USING (vec_id) JOIN l ON l.label IS NOT DISTINCT FROM v.label, h"
