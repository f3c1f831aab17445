"""Quality rules: exact counts of a few rules, and a hashed word and character n-gram logistic regression on top."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held_out, slices, table, texts
from .words import Sparse, WordTable, code_points, fit_logistic, gram_hashes, per_document, platt, sigmoid, word_hashes

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: Buckets of the hashed features: words, word pairs and character 1- to 3-grams share them.
BUCKETS = 1 << 14
#: Labelled rows (about) that the classifier is fitted on; a fifth of them calibrates the probabilities.
MAX_ROWS = 3000
#: A document is kept if its calibrated probability of good quality is at least this.
KEEP_AT = 0.5
_PAIR = np.uint64(0x94D049BB133111EB)


def _bucket(h: np.ndarray) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(BUCKETS)


def _pair_buckets(h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of neighbouring words of one document, and the position of the first word of each."""
    inner = np.ones(max(0, len(h) - 1), bool)
    ends = offsets[1:-1]
    inner[ends[(ends > 0) & (ends < len(h))] - 1] = False
    at = np.flatnonzero(inner)
    return _bucket(h[at] * _PAIR + h[at + 1]), at


def _word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a word's own features and the number of the word."""
    points, borders = code_points(words)
    parts = [gram_hashes(points, borders, n, BUCKETS) for n in (1, 2, 3)]
    own = (_bucket(word_hashes(words)), np.arange(len(words)))
    return np.concatenate([p[0] for p in [*parts, own]]).astype(np.int64), np.concatenate([p[1] for p in [*parts, own]])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashed feature frequencies of the labelled sample: one row per document."""
    for batch in batches:
        for part in slices(batch, "text"):
            columns, values = [], []
            for text in texts(part.column("text")):
                words = text.encode("utf-8", "replace").split()
                if not words:
                    columns.append([]), values.append([])
                    continue
                distinct, inverse, count = np.unique(np.array(words, dtype=object), return_inverse=True, return_counts=True)
                feature, word = _word_features(list(distinct))
                h = word_hashes(list(distinct))[inverse.ravel()]
                pair, _ = _pair_buckets(h, np.array([0, len(h)]))
                total = np.bincount(feature, count[word], BUCKETS) + np.bincount(pair.astype(np.int64), minlength=BUCKETS)
                at = np.flatnonzero(total)
                columns.append(at.astype(np.int32)), values.append((total[at] / len(words)).astype(np.float32))
            yield pa.RecordBatch.from_arrays([part.column("y"), part.column("fold"), pa.array(columns, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["y", "fold", "f", "v"])


class Model:
    """Weights by bucket, bias, and the calibration of the logit."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float, shift: float):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, ridge: float = 1e-3) -> Model:
    """Fit on at most about ``max_rows`` labelled rows of the learning fold, chosen by a hash of the id.

    Features are made on the executors; the driver gets ``max_rows`` sparse rows of at most ``BUCKETS`` numbers. Null
    labels and ids are left out; without labels the model holds every text good.
    """
    good = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("y"))
    share = max_rows / max(1, good.count())
    pick = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20))
    sample = good.where(pick).select("doc_id", F.col("y").cast("double").alias("y"), (F.pmod(F.xxhash64("doc_id", F.lit(66)), F.lit(5)) == 0).alias("fold"))
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("y", "fold", "text")
    got = rows.mapInArrow(_features, "y double, fold boolean, f array<int>, v array<float>").toArrow()
    y, fold = np.asarray(got.column("y")), np.asarray(got.column("fold"))
    if len(y) == 0 or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 4.0 if len(y) == 0 or y.max() > 0 else -4.0, 1.0, 0.0)
    f, v = got.column("f").combine_chunks(), got.column("v").combine_chunks()
    counts = np.diff(np.asarray(f.offsets)) if len(f) else np.zeros(0, int)
    x = Sparse(np.repeat(np.arange(len(y)), counts), np.asarray(f.flatten()).astype(np.int64), np.asarray(v.flatten()).astype(np.float64), (len(y), BUCKETS))
    share_good = y[~fold].mean() if (~fold).any() else 0.5
    balance = np.where(y > 0, 0.5 / max(share_good, 1e-3), 0.5 / max(1 - share_good, 1e-3)) * ~fold
    weights, bias = fit_logistic(x, y, balance, ridge)
    slope, shift = platt((x.dot(weights) + bias)[fold], y[fold])
    return Model(weights, bias, slope, shift)


def _counts(text: str, words: list[bytes]) -> tuple[int, int, int]:
    """Code points in words, symbols, repeated lines."""
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = text.split("\n")
    dup = 0
    if len(lines) > 1:
        seen = set()
        for line in lines:
            if line in seen:
                dup += 1
            elif line.encode("utf-8", "replace").split():
                seen.add(line)
    return len(text) - blanks, sum(map(text.count, SYMBOLS)), dup


def _repeats(h: np.ndarray, offsets: np.ndarray, n: int = 8) -> np.ndarray:
    """Per document, the words inside n-word windows that the document has twice or more."""
    out = np.zeros(len(offsets) - 1, np.int64)
    if len(h) < n:
        return out
    doc = np.repeat(np.arange(len(out)), np.diff(offsets)).astype(np.uint64)
    run = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        run = run * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(run)]
        run ^= run >> np.uint64(31)
    run = (run + doc[: len(run)] * np.uint64(0xBF58476D1CE4E5B9)) * np.uint64(0x94D049BB133111EB)
    at = np.flatnonzero(doc[: len(run)] == doc[n - 1 :])
    order = np.argsort(run[at])
    sorted_ = run[at][order]
    same = sorted_[1:] == sorted_[:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    steps = np.zeros(len(h) + 1, np.int64)
    found = at[order[twice]]
    np.add.at(steps, found, 1)
    np.add.at(steps, found + n, -1)
    covered = (np.cumsum(steps[:-1]) > 0).astype(np.int64)
    return per_document(covered, offsets)


_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def _scorer(model: Model, passed: list[str], keep_at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights

        def fill(words: list[bytes]) -> np.ndarray:
            feature, word = _word_features(words)
            return np.stack([np.bincount(word, weights[feature], len(words)), word_hashes(words).view(np.float64)], axis=1)

        index = WordTable(fill, 2)
        for batch in batches:
            for part in slices(batch, "text"):
                all_text = texts(part.column("text"))
                docs = [t.encode("utf-8", "replace").split() for t in all_text]
                flat, offsets = index.number(docs)
                own, h = index.values[flat, 0], np.ascontiguousarray(index.values[flat, 1]).view(np.uint64)
                pair, at = _pair_buckets(h, offsets)
                value = own.copy()
                np.add.at(value, at, weights[pair.astype(np.int64)])
                n = np.diff(offsets)
                p = sigmoid(model.slope * (per_document(value, offsets) / np.maximum(n, 1) + model.bias) + model.shift)
                repeat = _repeats(h, offsets)
                counts = np.array([_counts(t, w) for t, w in zip(all_text, docs, strict=True)], np.int64).reshape(-1, 3)
                failed = (n < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n)
                made = [n, counts[:, 0], counts[:, 1], counts[:, 2], repeat, failed, ~failed & (p >= keep_at), p]
                names = [c.split()[0] for c in _SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in passed), *map(pa.array, made)], names=[*passed, *names])

    return run


def score(documents: DataFrame, model: Model, columns: list[str], keep_at: float = KEEP_AT) -> DataFrame:
    """``columns`` of the documents with the rule counts, ``base_failed``, the calibrated probability and ``kept``.

    A null or empty text has no words and fails the base rules. Texts are read whole, in slices of about 1 MB.
    """
    rows = documents.select(*dict.fromkeys([*columns, "text"]))
    schema = T.StructType([*(rows.schema[c] for c in columns), *T.StructType.fromDDL(_SCHEMA).fields])
    return rows.mapInArrow(_scorer(model, columns, keep_at), schema)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the classifier's verdict on all ``documents``."""
    documents = table(spark, sf_dir, "documents")
    return score(documents, train(documents, table(spark, sf_dir, "labels")), ["doc_id"])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the classifier keep."""
    # The row travels as one struct, so that no column of its own meets a computed one.
    whole = docs.select(F.struct(*docs.columns).alias("row_itself"), "text")
    scored = score(whole, train(docs, table(spark, sf_dir, "labels")), ["row_itself"])
    return scored.where("kept").select("row_itself.*")
