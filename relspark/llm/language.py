"""Language identification as multilingual mixture inference.

Hashed character n-gram models give every word a likelihood in each learned language. Expectation-maximisation finds a
document's language proportions; the number of languages is chosen by penalised likelihood (BIC).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, slices, table, texts
from .words import WordTable, code_points, gram_hashes, per_document

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: Learning documents (about) of each language.
MAX_ROWS = 1500
#: Values of ``lang`` that get a model at most, the commonest first: a dirty column does not grow the model.
MAX_LANGUAGES = 512
ROUNDS = 12
#: Neighbouring n-grams overlap: a word's log-likelihood is divided by this before it enters the mixture.
TEMPER = 2.0


def _grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket (orders apart) and word of each n-gram of the words without case."""
    points, borders = code_points([w.decode("utf-8", "replace").lower().encode() for w in words])
    got = [gram_hashes(points, borders, n, BUCKETS) for n in ORDERS]
    return np.concatenate([g[0].astype(np.int64) + k * BUCKETS for k, g in enumerate(got)]), np.concatenate([g[1] for g in got])


def _count(languages: list[str]):
    at = {name: i for i, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(texts(batch.column("text")), batch.column("lang").to_pylist(), strict=True):
                words, counts = np.unique(np.array(text.encode("utf-8", "replace").split() or [b""], dtype=object), return_counts=True)
                if words[0] or len(words) > 1:
                    bucket, word = _grams(list(words))
                    more = np.bincount(bucket, counts[word], len(ORDERS) * BUCKETS)
                    totals[at[lang]] = totals[at[lang]] + more if at[lang] in totals else more
        for lang, total in totals.items():
            bucket = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), lang, np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[bucket])], names=["lang", "bucket", "n"])

    return run


class Model:
    """Log-probability of each n-gram bucket in each language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs


def train(documents: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """n-gram models from at most about ``max_rows`` learning documents of each language, counted on the executors.

    The driver gets one number for each language and bucket, of ``MAX_LANGUAGES`` languages at most. Rows with null text or
    language are left out, repeated rows count each time, and an empty table gives a model that calls every text ``und``.
    """
    known = documents.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, len(ORDERS) * BUCKETS)))
    limit = F.create_map(*[F.lit(x) for name in languages for x in (name, int(min(1.0, max_rows / sizes[name]) * (1 << 20)))])
    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < limit[F.col("lang")]).select("text", "lang")
    counted = sample.mapInArrow(_count(languages), "lang int, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros((len(languages), len(ORDERS) * BUCKETS))
    total[np.asarray(counted.column("lang")), np.asarray(counted.column("bucket"))] = np.asarray(counted.column("n"))
    total = total.reshape(len(languages), len(ORDERS), BUCKETS) + 0.05
    # Each order is a distribution of its own; a word averages the orders.
    logs = np.log(total / total.sum(axis=2, keepdims=True)) / len(ORDERS)
    return Model(languages, logs.reshape(len(languages), -1))


def mixture(logs: np.ndarray, offsets: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Chosen proportions of each document, and the number of languages that penalised likelihood selects.

    ``logs`` holds a word's log-likelihood in each language. The full mixture orders the languages; nested sets of one to
    all of them are then fitted and compared by log-likelihood less half a log of the words per free proportion. Sets end
    where even each word's best language could not make up for the penalty.
    """
    n_docs, n_langs = len(offsets) - 1, logs.shape[1]
    n = np.diff(offsets)
    top = logs.max(axis=1, initial=-np.inf)
    like = np.exp(logs - top[:, None])

    def fit(mask: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        share = mask / mask.sum(axis=1, keepdims=True)
        for _ in range(rounds):
            joint = like * np.repeat(share, n, axis=0)
            share = per_document(joint / (joint.sum(axis=1, keepdims=True) + 1e-300), offsets) / np.maximum(n, 1)[:, None]
            share = np.where(n[:, None] > 0, share, mask / mask.sum(axis=1, keepdims=True))
        fitted = np.log((like * np.repeat(share, n, axis=0)).sum(axis=1) + 1e-300) + top
        return share, per_document(fitted, offsets)

    full, _ = fit(np.ones((n_docs, n_langs)), rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    best, best_value, size = None, None, np.ones(n_docs, np.int64)
    most = per_document(top, offsets)
    for k in range(1, n_langs + 1):
        if k > 1 and not (most - 0.5 * (k - 1) * np.log(np.maximum(n, 2)) > best_value).any():
            break
        mask = np.zeros((n_docs, n_langs))
        np.put_along_axis(mask, order[:, :k], 1.0, axis=1)
        share, value = fit(mask, rounds if k > 1 else 1)
        value = value - 0.5 * (k - 1) * np.log(np.maximum(n, 2))
        if best is None:
            best, best_value = share, value
            continue
        better = value > best_value
        best[better], best_value[better], size[better] = share[better], value[better], k
    return best, size


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.languages)

        def fill(words: list[bytes]) -> np.ndarray:
            bucket, word = _grams(words)
            lengths = np.maximum(np.bincount(word, minlength=len(words)), 1)
            sums = np.stack([np.bincount(word, row[bucket], len(words)) for row in model.logs], axis=1)
            # A word without letters says nothing about the language.
            letters = np.array([any(map(str.isalpha, w.decode("utf-8", "replace"))) for w in words])
            return np.column_stack([np.where(letters[:, None], sums / TEMPER, 0.0), letters * lengths]).astype(np.float32)

        index = WordTable(fill, width + 1, np.float32)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, offsets = index.number([t.encode("utf-8", "replace").split() for t in texts(part.column("text"))])
                values = index.values[flat].astype(np.float64)
                letters = per_document(values[:, width], offsets) > 0
                if width:
                    share, size = mixture(values[:, :width], offsets)
                    best = share.argmax(axis=1)
                    score = share[np.arange(len(best)), best]
                else:
                    best, score, size = np.zeros(part.num_rows, int), np.zeros(part.num_rows), np.zeros(part.num_rows, int)
                known = letters & (width > 0)
                names = [model.languages[b] if k else "und" for b, k in zip(best, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(known, np.clip(score, 0, 1), 0.0)), pa.array(np.where(known, size, 0).astype(np.int32))],
                    names=["doc_id", "lang_pred", "score", "n_languages"],
                )

    return run


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, n_languages``; ``und`` with score 0 for texts that are null or hold no letter.

    Of languages with equal proportions the first by name is predicted. Whole texts are read however long; repeated rows
    are predicted each, an empty table stays empty, and other columns are not read.
    """
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, n_languages int"
    found = documents.select("doc_id", "text").mapInArrow(_scorer(model), schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_languages")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``."""
    documents = table(spark, sf_dir, "documents")
    return identify(documents, train(documents))
