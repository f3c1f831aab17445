"""Toxicity by weak supervision.

Voters are lexicons of whole words and of word beginnings, and surface patterns. Gold labels only choose which words may
vote. A generative model then estimates each voter's accuracy and the strongest correlations between voters from the votes
of learning documents with and without labels; its posterior, which never sees a label, trains a linear classifier over
word and word-beginning features, which scores every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, slices, table, texts
from .words import Sparse, WordTable, fit_logistic, sigmoid

#: Learning documents (about) that voters and classifier are fitted on: so many with a label, and so many of all.
MAX_ROWS = 12_000
#: Lexicons that the learned features of one kind are dealt into, by turns of their rank.
LEXICONS = 6
#: Correlation of two voters within the classes from which on the model holds them for dependent.
DEPENDENT = 0.2
#: Features (words and beginnings) that the lexicons hold at most; the strongest stay.
MAX_FEATURES = 4000
#: Documents that must hold a feature before it may vote.
MIN_DOCS = 3
#: Clean documents that are added to those that hold a feature, so that few toxic ones alone do not make it a voter.
SHRINK = 3
PREFIXES = (3, 4, 5, 6)
#: Insults that vote from the start, whatever the labels say.
BASE_LEXICON = ("asshole", "bastard", "bitch", "clown", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
_STRIP = b".,;:!?\"'()[]{}<>|*#$%&-_"


def _clean(words: list[bytes]) -> list[str]:
    return [w.strip(_STRIP).decode("utf-8", "replace").lower() for w in words]


def _word_keys(word: str) -> list[str]:
    """A word's features: itself, and its beginnings (marked with their length)."""
    return [f"w:{word}", *(f"{n}:{word[:n]}" for n in PREFIXES if len(word) > n)] if word else []


def _sample(documents: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``y, text`` of learning documents: labelled ones, and by another hash any (``y`` is null where no label is known)."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    learn = documents.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    turn = lambda seed, n: F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int(min(1.0, max_rows / max(1, n)) * (1 << 20))
    labelled = known.where(turn(2, known.count()))
    return learn.join(F.broadcast(labelled), "doc_id", "left").where(F.col("y").isNotNull() | turn(3, learn.count())).select("y", "text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a feature; features of no toxic document of the slice carry no vote yet."""
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            found: dict[str, list[int]] = {}
            for text, y in zip(texts(part.column("text")), part.column("y").to_pylist(), strict=True):
                for key in {k for w in set(_clean(text.encode("utf-8", "replace").split())) for k in _word_keys(w)}:
                    found.setdefault(key, [0, 0])[y > 0] += 1
            keys = list(found)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([found[k][0] for k in keys], pa.int64()), pa.array([found[k][1] for k in keys], pa.int64())], names=["key", "clean", "toxic"])


#: Names of the surface votes.
PATTERNS = ("shouting", "rows of exclamation marks", "mixed marks", "second-person insult", "exclaimed insult", "several insults")


def _patterns(text: str, words: list[bytes]) -> list[int]:
    """Surface votes, in the order of ``PATTERNS``."""
    upper = sum(map(bytes.isupper, words))
    lower = text.lower()
    insult = any(w in lower for w in BASE_LEXICON)
    return [int(upper > 5 and 2 * upper > len(words)), int("!!" in text), int("?!" in text or "!?" in text), int("you " in lower and insult), int(insult and "!" in text), int(sum(w in lower for w in BASE_LEXICON) > 1)]


def _votes(index: dict[str, int]):
    """Per document of the sample: its selected features, with how many distinct words show each, and the pattern votes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, surface = [], [], []
            for text in texts(batch.column("text")):
                words = text.encode("utf-8", "replace").split()
                got = np.array([index[k] for w in set(_clean(words)) for k in _word_keys(w) if k in index], np.int64)
                at, n = np.unique(got, return_counts=True)
                ids.append(at), counts.append(n), surface.append(_patterns(text, words))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(counts, kind), pa.array(surface, kind)], names=["f", "n", "p"])

    return run


def _dependencies(votes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Correlations of the voters within the classes, and each voter's parent in the forest of the strongest ones (-1: none)."""
    cov = np.zeros((votes.shape[1],) * 2)
    for weight in classes:
        rest = votes - weight @ votes / weight.sum()
        cov += (rest * weight[:, None]).T @ rest / len(votes)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    corr = cov / sd[:, None] / sd[None, :]
    strength, parent = np.abs(corr) * (1 - np.eye(len(corr))), np.full(len(corr), -1)
    inside = np.zeros(len(corr), bool)
    for _ in range(len(corr)):
        # The next voter is the one most correlated with any that is in the forest; it is a root if none is dependent.
        reach = np.where(inside[:, None] & ~inside[None, :], strength, -1.0)
        k = int(reach.max(axis=0).argmax()) if inside.any() else 0
        best = int(reach[:, k].argmax())
        parent[k] = best if reach[best, k] >= DEPENDENT else -1
        inside[k] = True
    return corr, parent


def label_model(votes: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the positive class, voters' (false, true) firing rates, their correlations, and their parents.

    Expectation-maximisation over votes in {0, 1}; no label takes part. In either class a voter fires with a probability
    that depends on the vote of its parent, the dependent voter it goes with most closely: a copy of another voter is no
    evidence of its own. The share of voters that fire starts the posterior, so that class 1 is the one they fire for.
    """
    n, m = votes.shape
    total = votes.sum(axis=1)
    post = 0.02 + 0.96 * total / (total + 1)
    rates, corr, parent = np.zeros((2, m)), np.eye(m), np.full(m, -1)
    for _ in range(rounds):
        classes = np.stack([1 - post, post]) + 1e-9
        corr, parent = _dependencies(votes, classes)
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        up = np.where(parent[None, :] >= 0, votes[:, np.maximum(parent, 0)], 0)
        logs = np.zeros((2, n))
        for c, weight in enumerate(classes):
            rates[c] = np.clip((weight @ votes + 0.5) / (weight.sum() + 1), 1e-4, 1 - 1e-4)
            for given in (0, 1):
                own = weight[:, None] * (up == given)
                fires = np.clip(((own * votes).sum(axis=0) + rates[c]) / (own.sum(axis=0) + 1), 1e-4, 1 - 1e-4)
                logs[c] += ((up == given) * (votes * np.log(fires) + (1 - votes) * np.log1p(-fires))).sum(axis=1)
        new = sigmoid(np.log(prior / (1 - prior)) + logs[1] - logs[0])
        done, post = np.abs(new - post).max() < 1e-6, new
        if done:
            break
    return post, rates, corr, parent


class Model:
    """Weight of each feature and the bias of the classifier."""

    def __init__(self, weights: dict[str, float], bias: float, voters: dict):
        self.weights, self.bias, self.voters = weights, bias, voters


def train(documents: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Choose lexicons, run the label model, fit the classifier; the driver holds ``2 * max_rows`` short rows at most (about).

    Null labels and ids are left out, repeated rows count each time, and of different labels of a document the higher one
    counts. Without a toxic row, an empty table included, only the base lexicon speaks.
    """
    sample = _sample(documents, labels, max_rows)
    counted = sample.where("y is not null").mapInArrow(_count, "key string, clean long, toxic long").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Rate of toxicity among the documents that hold the feature, shrunk towards none: a feature votes from 70 % on.
    lift = F.col("toxic") / (F.col("toxic") + F.col("clean") + SHRINK)
    strong = counted.where((F.col("toxic") >= MIN_DOCS) & (lift >= 0.7)).orderBy((F.col("toxic") * lift).desc(), "key").limit(MAX_FEATURES).collect()
    base = {f"w:{w}" for w in BASE_LEXICON}
    keys = sorted(base | {r["key"] for r in strong})
    index = {k: i for i, k in enumerate(keys)}
    if not strong:
        return Model(dict.fromkeys(base, 6.0), -3.0, {})
    # From here on no label is read.
    got = sample.select("text").mapInArrow(_votes(index), "f array<long>, n array<long>, p array<long>").toArrow().to_pylist()
    lexicons: dict[str, list[int]] = {"base": [index[k] for k in base]}
    turns: dict[str, int] = {}
    for r in strong:
        kind = r["key"].split(":")[0]
        turns[kind] = turns.get(kind, -1) + 1
        lexicons.setdefault(f"{kind}/{turns[kind] % LEXICONS}", []).append(index[r["key"]])
    member = np.zeros((len(lexicons), len(keys)), bool)
    for i, own in enumerate(lexicons.values()):
        member[i, own] = True
    rows = np.repeat(np.arange(len(got)), [len(r["f"]) for r in got])
    columns = np.array([i for r in got for i in r["f"]], np.int64)
    values = np.array([n for r in got for n in r["n"]], np.float64)
    votes = np.zeros((len(got), len(lexicons)))
    for i in range(len(lexicons)):
        votes[:, i] = np.bincount(rows, member[i, columns], len(got)) > 0
    votes = np.column_stack([votes, np.array([r["p"] for r in got])])
    posterior, rates, corr, parent = label_model(votes)
    weights, bias = fit_logistic(Sparse(rows, columns, values, (len(got), len(keys))), posterior, ridge=1e-4, rounds=600)
    voters = {"names": [*lexicons, *PATTERNS], "rates": rates, "correlations": corr, "parents": parent}
    return Model({k: float(weights[i]) for k, i in index.items() if abs(weights[i]) > 1e-6}, bias, voters)


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = model.weights.get

        def fill(words: list[bytes]) -> np.ndarray:
            return np.array([[sum(get(k, 0.0) for k in _word_keys(w))] for w in _clean(words)])

        index = WordTable(fill, 1)
        for batch in batches:
            for part in slices(batch, "text"):
                flat, offsets = index.number([t.encode("utf-8", "replace").split() for t in texts(part.column("text"))])
                hit = np.flatnonzero(index.values[flat, 0])
                doc = np.searchsorted(offsets, hit, "right") - 1
                pairs = np.unique(doc * np.int64(1 << 32) + flat[hit])
                logit = np.bincount(pairs >> 32, index.values[pairs & 0xFFFFFFFF, 0], part.num_rows) + model.bias
                p = sigmoid(logit)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return run


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; a null or empty text gets the score of no evidence.

    A score of exactly 0.5 predicts 1. Whole texts are scored however long; repeated rows are scored each, an empty table
    stays empty, and other columns are not read.
    """
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, score double, predicted int"
    scored = documents.select("doc_id", "text").mapInArrow(_scorer(model), schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``."""
    documents = table(spark, sf_dir, "documents")
    return score(documents, train(documents, table(spark, sf_dir, "labels")))
