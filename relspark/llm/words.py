"""Vectorised word features for Arrow batches.

Words are the runs between ASCII white space (``bytes.split``). Each worker numbers the words that it meets, keeps what
was computed for a word in flat tables, and forgets all when the tables reach their bound: the memory of a task does
not grow with the vocabulary of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Words that a worker remembers before it starts anew.
MEMORY = 250_000


class WordTable(dict):
    """Numbers words in order of first sight and holds one row of ``width`` values per word, filled by ``fill(words)``."""

    def __init__(self, fill: Callable[[list[bytes]], np.ndarray], width: int, dtype=np.float64, memory: int = MEMORY):
        super().__init__()
        self.fill, self.memory, self.new = fill, memory, []
        self.values = np.zeros((1024, width), dtype)

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        self.new.append(word)
        return at

    def number(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all documents in a row, and the offsets of the documents in it."""
        if len(self) > self.memory:
            self.clear()
        offsets = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(d) for d in docs], out=offsets[1:])
        flat = np.fromiter((n for d in docs for n in map(self.__getitem__, d)), np.int64, offsets[-1])
        if self.new:
            first = len(self) - len(self.new)
            if len(self) > len(self.values):
                self.values = np.concatenate([self.values, np.zeros((max(len(self), 2 * len(self.values)) - len(self.values), self.values.shape[1]), self.values.dtype)])
            for lo in range(0, len(self.new), 20_000):
                some = self.new[lo : lo + 20_000]
                self.values[first + lo : first + lo + len(some)] = self.fill(some)
            self.new = []
        return flat, offsets


def code_points(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of ``" w1 w2 ... "`` and the position of the blank before each word, then of the last blank."""
    joined = np.frombuffer((b" " + b" ".join(words) + b" ").decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    # Words hold no blank, so every blank is a border.
    return joined, np.flatnonzero(joined == 32)


def gram_hashes(points: np.ndarray, borders: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each character n-gram inside a word with its border blanks, and the number of the word."""
    h = np.zeros(max(0, len(points) - n + 1), np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + points[k : k + len(h)] + np.uint64(n)
        h ^= h >> np.uint64(29)
    word = np.searchsorted(borders, np.arange(len(h)), "right") - 1
    last = len(borders) - 1
    inside = (word < last) & (np.arange(len(h)) + n - 1 <= borders[np.minimum(word + 1, last)])
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20))[inside] % np.uint64(buckets), word[inside]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word that does not depend on the process."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the rows of each document; documents without words get zero."""
    out = np.zeros((len(offsets) - 1, *values.shape[1:]), values.dtype)
    some = offsets[1:] > offsets[:-1]
    if some.any():
        out[some] = np.add.reduceat(values, offsets[:-1][some], axis=0)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Sparse:
    """Row-compressed matrix with the two products that logistic regression needs."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, shape: tuple[int, int]):
        self.rows, self.columns, self.values, self.shape = rows, columns, values, shape

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, w[self.columns] * self.values, self.shape[0])

    def tdot(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, r[self.rows] * self.values, self.shape[1])


def fit_logistic(x: Sparse, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 120, rate: float = 1.0) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic regression on (soft) targets, by Nesterov steps on columns scaled to equal size."""
    n = x.shape[0]
    weight = np.ones(n) if weight is None else weight
    weight = weight / max(weight.sum(), 1e-12)
    scale = 1 / np.sqrt(np.bincount(x.columns, x.values**2 * weight[x.rows], x.shape[1]) + 1e-4)
    scaled = Sparse(x.rows, x.columns, x.values * scale[x.columns], x.shape)
    # A row's squared length bounds the curvature.
    step = rate * 4 / max(1.0, float(np.average(np.bincount(scaled.rows, scaled.values**2, n) + 1, weights=weight)))
    w = v = np.zeros(x.shape[1])
    b = c = float(np.log((y @ weight + 1e-3) / ((1 - y) @ weight + 1e-3)))
    for k in range(rounds):
        m = k / (k + 3)
        pw, pb = w + m * (w - v), b + m * (b - c)
        r = (sigmoid(scaled.dot(pw) + pb) - y) * weight
        v, c = w, b
        w, b = pw - step * (scaled.tdot(r) + ridge * pw), pb - step * r.sum()
    return w * scale, b


def platt(logits: np.ndarray, y: np.ndarray, rounds: int = 400) -> tuple[float, float]:
    """Slope and shift that calibrate logits on rows not used for fitting; (1, 0) without both classes."""
    if len(logits) < 20 or y.min() == y.max():
        return 1.0, 0.0
    spread = logits.std() + 1e-9
    z, a, b = logits / spread, 1.0, 0.0
    for _ in range(rounds):
        p = sigmoid(a * z + b)
        h = p * (1 - p) + 1e-4
        g = np.array([((p - y) * z).mean() + 1e-3 * a, (p - y).mean()])
        H = np.array([[(h * z * z).mean() + 1e-3, (h * z).mean()], [(h * z).mean(), h.mean() + 1e-6]])
        d = np.linalg.solve(H, g)
        a, b = a - 0.5 * d[0], b - 0.5 * d[1]
        if np.abs(d).max() < 1e-8:
            break
    return max(a, 1e-3) / spread, b
