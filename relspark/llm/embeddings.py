"""Embedding near-duplicates by sorted projection passes.

Every pass gives each vector a key of 64 random hyperplane signs, sorts all vectors by (label, key) over the whole
cluster and compares each with a bounded window of followers. Passes carry one byte for each component and the length of the
rounding error, so a pair counts as verified only if no rounding can take it below the threshold. Verified pairs of all
passes are united into components.
A cover then compares all distinct vectors of a label with each other in pairs of blocks: it counts every link and hands
on those between different components, so the result does not rest on what comes near in a pass, at any size or density.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, parts, table
from .components import connected_components

BITS = 64
THRESHOLD = 0.93
#: A pass finds a pair at cosine 0.93 with probability 0.88 ** (sorted bits that must agree). What the passes miss, which
#: grows with a label's size and concentration, is left to the cover.
PASSES = 20
WINDOW = 40
#: Vectors of a label in one block of the cover; a label of more than ``BLOCKS`` such blocks has larger ones, up to
#: ``LARGE`` vectors, because every vector is sent once for each block of its label.
BLOCK, BLOCKS, LARGE = 16384, 64, 131072
#: Products that a cover task holds at a time.
PRODUCTS = 1 << 22


def _unit(column: pa.Array) -> np.ndarray:
    """Rows as double-precision unit vectors; scaling by the largest component first keeps huge values finite."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest connected position of each of n positions, by minimum propagation with pointer jumping."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
        open_ = root[a] != root[b]
        if not open_.any():
            break
    while (root != root[root]).any():
        root = root[root]
    return root


def _coded(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One signed byte for each component, the size of a step of each row, and the length of each row's rounding error."""
    step = np.abs(unit).max(axis=1) / 127
    code = np.rint(unit / step[:, None])
    return code.astype(np.int8), step, np.linalg.norm(unit - code * step[:, None], axis=1)


_KEYED = "pass int, label string, dim int, key long, rep long, code binary, step double, error double"
_CARRIED = pa.schema([("pass", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("key", pa.int64()), ("rep", pa.int64()), ("code", pa.binary()), ("step", pa.float64()), ("error", pa.float64())])


def _keyed(passes: int, seed: int):
    """One row per pass with the sort key: 64 hyperplane signs as an order-preserving signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(batch.column("dim"))
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim)) if (sizes != dim).any() else batch
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, int(dim)]).standard_normal((int(dim), passes * BITS))
                unit = _unit(part.column("vec"))
                code, step, error = _coded(unit)
                code = pa.array([row.tobytes() for row in code], pa.binary())
                signs = unit @ planes[dim] >= 0
                keys = np.packbits(signs.reshape(len(signs), passes, BITS), axis=2).view(">u8")[:, :, 0]
                keys = (keys ^ np.uint64(1 << 63)).astype(np.uint64).view(np.int64)
                for k in range(passes):
                    columns = [pa.array(np.full(len(signs), k, np.int32)), part.column("label"), part.column("dim"), pa.array(keys[:, k]), part.column("rep"), code, pa.array(step), pa.array(error)]
                    yield pa.RecordBatch.from_arrays(columns, names=_CARRIED.names)

    return run


def _window_links(batch: pa.Table, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of surely linked pairs at most ``window`` apart, within one pass, label and dimension."""
    changed = [(x[1:] != x[:-1]) for x in (np.asarray(batch.column(c)) for c in ("pass", "label", "dim"))]
    cuts = np.r_[0, np.flatnonzero(np.any(changed, axis=0)) + 1, batch.num_rows]
    steps, errors = np.asarray(batch.column("step")), np.asarray(batch.column("error"))
    left, right = [], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        if hi - lo < 2:
            continue
        code = np.frombuffer(b"".join(batch.column("code").slice(lo, hi - lo).to_pylist()), np.int8).reshape(hi - lo, -1)
        near, error = (code * steps[lo:hi, None]).astype(np.float32), errors[lo:hi]
        rounding = (code.shape[1] + 8) * 2.0**-22
        for s in range(1, min(window, hi - lo - 1) + 1):
            # |u.v - u'.v'| <= |u - u'| + |v - v'| + |u - u'||v - v'| for unit vectors u and v.
            slack = error[:-s] + error[s:] + error[:-s] * error[s:] + rounding
            hit = np.flatnonzero(np.einsum("ij,ij->i", near[:-s], near[s:]) >= threshold + slack)
            left.append(hit + lo)
            right.append(hit + lo + s)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _stars(rows: pa.Table, window: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of a run of sorted rows, as edges from each vector to the first one it is connected with."""
    a, b = _window_links(rows, window, threshold)
    root = _roots(rows.num_rows, a, b)
    moved = np.flatnonzero(root != np.arange(rows.num_rows))
    rep = np.asarray(rows.column("rep"))
    return rep[moved], rep[root[moved]]


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _windows(window: int, threshold: float, schema: pa.Schema = _CARRIED):
    """Edges of a sorted partition, and its first and last rows for the comparison across the partition's border."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        head, carry = None, None

        def edges(rows: pa.Table) -> pa.RecordBatch:
            a, b = _stars(rows, window, threshold)
            empty = [pa.nulls(len(a), f.type) for f in schema]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), *empty], names=["a", "b", "border", *schema.names])

        def border(rows: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
            n = rows.num_rows
            filled = [pa.nulls(n, pa.int64())] * 2 + [pa.array(np.full(n, k, np.int32))]
            for b in pa.table([*filled, *rows.columns], names=["a", "b", "border", *schema.names]).combine_chunks().to_batches():
                yield b

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if head is None or head.num_rows < window:
                head = rows.slice(0, window) if head is None else pa.concat_tables([head, rows]).slice(0, window)
            rows = rows if carry is None else pa.concat_tables([carry, rows])
            yield edges(rows)
            carry = rows.slice(max(0, rows.num_rows - window))
        if carry is not None:
            yield from border(head, here - 1)
            yield from border(carry, here)

    return run


def _across(window: int, threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("pass", "label", "dim", "key", "rep")])
        a, b = _stars(rows, 2 * window, threshold)
        return pa.table([pa.array(a), pa.array(b)], schema=_EDGE)

    return run


def _cover(threshold: float):
    """All links inside one pair of blocks: weighted counts (``rep, links``) and links between components (``a, b``).

    Products are single-precision; those within their rounding error of the threshold are taken again in double.
    """

    def run(rows: pa.Table) -> pa.Table:
        chunk, own, rep, component = (np.asarray(rows.column(c)) for c in ("chunk", "n", "rep", "component"))
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        vec = rows.column("vec").combine_chunks()
        unit = np.empty((len(rep), rows.column("dim")[0].as_py()), np.float32)
        for lo in range(0, len(rep), BLOCK):
            unit[lo : lo + BLOCK] = _unit(vec.slice(lo, BLOCK))
        slack = (unit.shape[1] + 8) * 2.0**-23
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        across = np.ascontiguousarray(unit[right].T)
        found = np.zeros(len(rep), np.int64)
        ends = [np.zeros((0, 2), np.int64)]
        step = max(1, PRODUCTS // max(1, len(right)))
        for lo in range(0, len(left), step):
            product = unit[left[lo : lo + step]] @ across
            at = np.flatnonzero(product >= threshold - slack)
            near = product.ravel()[at] < threshold + slack
            x, y = np.divmod(at, max(1, len(right)))
            x, y = left[lo + x], right[y]
            once = rep[x] < rep[y] if i == j else np.ones(len(x), bool)
            x, y, near = x[once], y[once], near[once]
            if near.any():
                at, inverse = np.unique(np.r_[x[near], y[near]], return_inverse=True)
                exact, half = _unit(vec.take(pa.array(at))), int(near.sum())
                hit = np.ones(len(x), bool)
                for k in range(0, half, BLOCK):
                    stop = min(half, k + BLOCK)
                    hit[np.flatnonzero(near)[k:stop]] = np.einsum("ij,ij->i", exact[inverse[k:stop]], exact[inverse[half + k : half + stop]]) >= threshold
                x, y = x[hit], y[hit]
            np.add.at(found, x, own[y])
            np.add.at(found, y, own[x])
            apart = component[x] != component[y]
            if apart.any():
                ends.append(np.unique(np.stack([component[x[apart]], component[y[apart]]], axis=1), axis=0))
        node, at = np.unique(np.concatenate(ends), return_inverse=True)
        at = at.reshape(-1, 2)
        root = _roots(len(node), at[:, 0], at[:, 1])
        moved = np.flatnonzero(root != np.arange(len(node)))
        some = np.flatnonzero(found)
        counts, edges = pa.nulls(len(some), pa.int64()), pa.nulls(len(moved), pa.int64())
        return pa.concat_tables(
            [
                pa.table([pa.array(rep[some]), pa.array(found[some]), counts, counts], names=["rep", "links", "a", "b"]),
                pa.table([edges, edges, pa.array(node[moved]), pa.array(node[root[moved]])], names=["rep", "links", "a", "b"]),
            ]
        )

    return run


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, seed: int = 20
) -> DataFrame:
    """Near-duplicate classes of vectors with equal labels: ``vec_id, n_links, component_id, kept, n_copies``.

    Exact copies are one representative through all passes, so a vector that a third of the rows repeat is compared once.
    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label, link with
    nothing; vectors of different length neither. Labels keep their type: they are equal if Spark holds them for equal
    (0.0 and -0.0 are; 1.2 and 1.7 are not). A repeated id keeps its rows (each copy counts as a row); an empty table gives
    an empty result. Other columns, whatever their names, are not read.
    """
    spark = vectors.sparkSession
    # Text stands for any type of label; adding 0.0 makes one zero of two.
    label = F.col(label_col) + F.lit(0.0).cast(vectors.schema[label_col].dataType) if vectors.schema[label_col].dataType.typeName() in ("float", "double") else F.col(label_col)
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"), label.cast("string").alias("label"))
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.coalesce((F.size("vec") > 0) & F.forall("vec", number) & F.exists("vec", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("dim", F.size("vec")).withColumn("vec", F.when(good, F.col("vec")))
    copies = rows.where("vec is not null").groupBy("label", "dim", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
    copies = materialize(copies, "vectors")
    keyed = copies.select("label", "dim", "rep", "vec").mapInArrow(_keyed(passes, seed), _KEYED)
    order = ["pass", "label", "dim", "key", "rep"]
    ranged = keyed.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order)
    walked = materialize(ranged.mapInArrow(_windows(window, threshold), f"a long, b long, border int, {_KEYED}"), "windows")
    across = walked.where("border is not null").groupBy("border").applyInArrow(_across(window, threshold), "a long, b long")
    edges = walked.where("a is not null").select("a", "b").union(across)
    component = materialize(connected_components(edges).withColumnRenamed("node", "rep"), "components")
    key = ["label", "dim"]
    sizes = copies.groupBy(*key).agg(F.count("*").alias("m")).where("m > 1")
    blocks = F.greatest(F.ceil(F.col("m") / LARGE), F.least(F.ceil(F.col("m") / BLOCK), F.lit(BLOCKS))).cast("int")
    block = copies.join(sizes.select(*key, blocks.alias("g")), key).join(component, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    block = block.withColumn("chunk", F.pmod(F.xxhash64("rep"), "g").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    block = block.select(*key, "rep", "n", "vec", "component", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    covered = block.groupBy(*key, "i", "j").applyInArrow(_cover(threshold), "rep long, links long, a long, b long")
    covered = materialize(covered, "cover")
    links = covered.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    # What the cover adds joins whole components of the passes.
    joined = connected_components(covered.where("a is not null")).toDF("component", "joined")
    member = component.select("rep").union(joined.select("component")).distinct().join(component, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    component = member.join(joined, "component", "left").select("rep", F.coalesce("joined", "component").alias("component"))
    classes = copies.join(component, "rep", "left").join(links, "rep", "left")
    classes = classes.select("label", "dim", "vec", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    # Rows that link with nothing are many of one key: they need no join.
    alone = rows.where("vec is null").select("vec_id", F.lit(None).cast("long").alias("n"), F.lit(0).cast("long").alias("links"), F.lit(None).cast("long").alias("component"))
    found = rows.where("vec is not null").join(classes, ["label", "dim", "vec"], "left").select("vec_id", "n", "links", "component").unionByName(alone)
    component_id = F.coalesce("component", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce(F.col("n") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(True)).alias("kept"),
        F.coalesce("n", F.lit(1)).cast("long").alias("n_copies"),
    )


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``embeddings`` at cosine 0.93."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
