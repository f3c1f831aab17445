"""Text normal forms and fuzzy scores that need Unicode tables or common subsequences: Arrow-batched pandas functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from .subsequence import common_lengths, window_lengths

#: Spellings of letters with two dots, sharp s and the ampersand (fixed values).
_UMLAUTS = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue", "&": "and"})


def _normalised(text: str | None) -> str | None:
    if text is None:
        return None
    plain = unicodedata.normalize("NFD", text.translate(_UMLAUTS))
    return "".join(c for c in plain if not unicodedata.combining(c) and (c.isalnum() or c == "+")).lower()


@F.pandas_udf(StringType())
def normalise_title(text: pd.Series) -> pd.Series:
    """Umlauts spelled out, marks stripped, letters, digits and plus signs kept, lower case."""
    return text.map(_normalised)


@F.pandas_udf(StringType())
def clean_title(text: pd.Series) -> pd.Series:
    """Like :func:`normalise_title`, word by word, with single blanks between words."""
    return text.map(lambda t: None if t is None else " ".join(filter(None, (_normalised(w) for w in re.split(r"[\s._\-]+", t)))))


@F.pandas_udf(StringType())
def compatible_form(text: pd.Series) -> pd.Series:
    """NFKC form with separators as blanks, brackets and file endings dropped, lower case."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = unicodedata.normalize("NFKC", t).lower()
        t = re.sub(r"\.(?:mkv|mp4|avi|m4v|ts)$", "", t)
        t = re.sub(r"\[[^\]]*\]|\([^)]*\)", " ", t)
        return " ".join(re.sub(r"[._\-]+", " ", t).split())

    return text.map(one)


def ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Twice the longest common subsequence over both lengths, 0 to 100; two empty texts have 100."""
    both = np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)], float)
    return np.where(both == 0, 100.0, 200.0 * common_lengths(a, b) / np.maximum(both, 1))


def partial_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Best ratio of the shorter text with a stretch as long as itself of the longer one; an empty text has 0 with others."""
    least = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], float)
    most = np.array([max(len(x), len(y)) for x, y in zip(a, b, strict=True)], float)
    return np.where(most == 0, 100.0, 100.0 * window_lengths(a, b) / np.maximum(least, 1))


def _scored(a: pd.Series, b: pd.Series, score) -> pd.Series:
    known = (a.notna() & b.notna()).to_numpy()
    out = np.full(len(a), np.nan)
    out[known] = score(a[known].tolist(), b[known].tolist())
    return pd.Series(out).astype(object).where(known, None)


@F.pandas_udf(DoubleType())
def fuzzy_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """:func:`ratios` of two columns; null where either is."""
    return _scored(a, b, ratios)


@F.pandas_udf(DoubleType())
def fuzzy_partial(a: pd.Series, b: pd.Series) -> pd.Series:
    """:func:`partial_ratios` of two columns; null where either is."""
    return _scored(a, b, partial_ratios)
