"""Longest common subsequences of many pairs of texts at once, in words of 64 bits.

A text's characters are bits of a row of words. One step takes the next character of the other text for all pairs of a
batch together: a few array operations on words, where a plain table would fill a line of cells for every pair.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Words that a step's tables hold together; longer batches are cut.
ROOM = 1 << 21
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and where each begins."""
    ends = np.cumsum([0, *map(len, texts)])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64), ends


def _inside(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place in the row of every character."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _steps(short: Sequence[str], long: Sequence[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit masks of the short texts' characters, and for each place of the long texts the mask of its character.

    The last mask is empty; places behind a text's end point at it.
    """
    a, a_at = _codes(short)
    b, b_at = _codes(long)
    row, place = _inside(a_at, np.diff(a_at))
    known, own = np.unique(row << 21 | a, return_inverse=True)
    masks = np.zeros((len(known) + 1, words), np.uint64)
    np.bitwise_or.at(masks, (own, place >> 6), np.uint64(1) << (place & 63).astype(np.uint64))
    row, place = _inside(b_at, np.diff(b_at))
    want = row << 21 | b
    at = np.minimum(np.searchsorted(known, want), len(known) - 1)
    steps = np.full((len(long), int(np.diff(b_at).max(initial=0))), len(known), np.int32)
    steps[row, place] = np.where(known[at] == want, at, len(known))
    return masks, steps


def _advance(state: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """One step: zeros of the state are the characters matched so far."""
    hit = state & mask
    if state.shape[1] == 1:
        return (state + hit) | (state & ~mask)
    total, carry = np.empty_like(state), np.zeros(len(state), np.uint64)
    for w in range(state.shape[1]):
        part = state[:, w] + hit[:, w]
        total[:, w] = part + carry
        carry = ((part < hit[:, w]) | (total[:, w] < part)).astype(np.uint64)
    return total | (state & ~mask)


def _matched(state: np.ndarray) -> np.ndarray:
    return 64 * state.shape[1] - np.bitwise_count(state).sum(axis=1, dtype=np.int64)


def _groups(short: Sequence[str], long: Sequence[str], cost):
    """Numbers of pairs that need as many words, in runs whose tables fit ``ROOM``; pairs with an empty text are left out."""
    words = np.array([-(-len(x) // 64) for x in short], np.int64)
    for w in np.unique(words[words > 0]):
        numbers = np.flatnonzero(words == w)
        numbers = numbers[np.argsort([len(long[k]) for k in numbers], kind="stable")]
        begin, held = 0, 0
        for end, k in enumerate(numbers):
            own = int(w) * cost(len(short[k]), len(long[k]))
            if end > begin and held + own > ROOM:
                yield int(w), numbers[begin:end]
                begin, held = end, 0
            held += own
        yield int(w), numbers[begin:]


def common_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(short), np.int64)
    for words, some in _groups(short, long, lambda _, n: n):
        masks, steps = _steps([short[k] for k in some], [long[k] for k in some], words)
        state = np.full((len(some), words), _ALL)
        for j in range(steps.shape[1]):
            state = _advance(state, masks[steps[:, j]])
        out[some] = _matched(state)
    return out


def window_lengths(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """The greatest common length of the shorter text of each pair with any stretch as long as itself of the longer one."""
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    out = np.zeros(len(short), np.int64)
    for words, some in _groups(short, long, lambda m, n: n - m + 1):
        masks, steps = _steps([short[k] for k in some], [long[k] for k in some], words)
        size = np.array([len(short[k]) for k in some])
        count = np.array([len(long[k]) for k in some]) - size + 1
        row, first = _inside(np.r_[0, np.cumsum(count)], count)
        for lo in range(0, len(row), ROOM):
            r, f = row[lo : lo + ROOM], first[lo : lo + ROOM]
            state = np.full((len(r), words), _ALL)
            for j in range(int(size[r].max())):
                at = np.where(j < size[r], steps[r, np.minimum(f + j, steps.shape[1] - 1)], len(masks) - 1)
                state = _advance(state, masks[at])
            best = np.zeros(len(some), np.int64)
            np.maximum.at(best, r, _matched(state))
            out[some] = np.maximum(out[some], best)
    return out
