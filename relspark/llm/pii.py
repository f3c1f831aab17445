"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus-signs, digits, scheme marks and identifier cues. A local
parser for each kind walks outwards from the anchor to the span's borders and validates it. Every parser states the
leftmost greedy match of its kind, so no text beside anchors is looked at twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts, table

#: Kinds in output order; the first four are the base ones.
KINDS = ("email", "ip", "card", "phone", "account", "url")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_VALUE = _ALNUM | frozenset("_-+/.=")
#: Words after which a secret or a name of a user stands, with digits or without.
SECRETS = (*(f"{a}{mark}{b}" for a, b in (("api", "key"), ("user", "id")) for mark in ("", " ", "_", "-")), "passwd", "password", "secret", "token")
#: Words after which an identifier of an account or person stands, in any case; those that are no secrets take a digit.
CUES = (*SECRETS, "account", "iban", "passport", "ssn")


def anchors() -> ahocorasick.Automaton:
    """Automaton of all anchors in lower case; values are their class, and the length of a cue."""
    found = ahocorasick.Automaton()
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        found.add_word(cue, ("secret" if cue in SECRETS else "cue", len(cue)))
    found.make_automaton()
    return found


def _emails(t: str, at: list[int]) -> Iterator[tuple[int, int]]:
    free, n = 0, len(t)
    for p in at:
        s = p
        while s > free and t[s - 1] in _LOCAL:
            s -= 1
        e, labels = p + 1, 0
        while True:
            q = e + (labels > 0)
            if labels and (e >= n or t[e] != "."):
                break
            r = q
            while r < n and t[r] in _LABEL:
                r += 1
            if r == q:
                break
            e, labels = r, labels + 1
        if s < p and labels > 1:
            yield s, e
            free = e


def _runs(digits: list[int]) -> list[tuple[int, int]]:
    """Maximal runs of neighbouring digits."""
    a = np.asarray(digits)
    cut = np.flatnonzero(np.diff(a) != 1)
    return list(zip(a[np.r_[0, cut + 1]].tolist(), (a[np.r_[cut, len(a) - 1]] + 1).tolist(), strict=True))


def _ips(t: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    chain: list[tuple[int, int]] = []
    for s, e in runs:
        if chain and not (s == chain[-1][1] + 1 and t[s - 1] == "."):
            chain = []
        chain.append((s, e))
        if len(chain) == 4:
            if all(len(x := t[a:b].lstrip("0")) <= 3 and int(x or 0) <= 255 for a, b in chain):
                yield chain[0][0], e
            chain = []


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _cards(t: str, runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(runs):
        s, e = runs[i]
        n = e - s
        while i + 1 < len(runs) and runs[i + 1][0] == e + 1 and t[e] in " -":
            i += 1
            n += runs[i][1] - runs[i][0]
            e = runs[i][1]
        i += 1
        if 14 <= n <= 19 and _luhn(t[s:e].replace(" ", "").replace("-", "")):
            yield s, e


def _phones(t: str, plus: list[int]) -> Iterator[tuple[int, int]]:
    n = len(t)
    for p in plus:
        if p + 1 >= n or t[p + 1] not in _DIGITS:
            continue
        e = p + 2
        while e < n and t[e] in _PHONE:
            e += 1
        while e > p + 3 and t[e - 1] not in _DIGITS:
            e -= 1
        if e > p + 3 and 10 <= sum(c in _DIGITS for c in t[p:e]) <= 15:
            yield p, e


def _accounts(t: str, cues: list[tuple[int, int, bool]]) -> Iterator[tuple[int, int]]:
    """A value of at least 6 characters after a cue and ``:``, ``=`` or ``#`` (quotes and blanks allowed).

    It needs a digit unless the cue is one of a secret. A full stop that ends it is the sentence's.
    """
    free, n = 0, len(t)
    run = last = 0  # End of the run of value characters that was read last, and behind its last digit.
    for s, e, secret in cues:
        if s and t[s - 1] in _ALNUM:
            continue
        signs = 0
        while e < n and t[e] in " :=#\"'":
            signs += t[e] in ":=#"
            e += 1
        if not signs or e < free:
            continue
        for q in range(max(e, run), n):
            if t[q] not in _VALUE:
                run = q
                break
            if t[q] in _DIGITS:
                last = q + 1
        else:
            run = n
        q = run
        while q > e and t[q - 1] == ".":
            q -= 1
        if q - e >= 6 and (secret or last > e):
            yield e, q
            free = q


def _urls(t: str, schemes: list[int]) -> Iterator[tuple[int, int]]:
    free, n = 0, len(t)
    for p in schemes:
        s = p
        while s > free and p - s < 12 and t[s - 1] in _ALNUM:
            s -= 1
        e = p + 3
        while e < n and not t[e].isspace() and t[e] not in "<>\"'":
            e += 1
        while e > p + 3 and t[e - 1] in ".,;:!?)]}":
            e -= 1
        if s < p and "." in t[p + 3 : e]:
            yield s, e
            free = e


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind number, end), sorted; positions are code points."""
    at, plus, digits, schemes, cues = [], [], [], [], []
    low = text.lower()
    if len(low) != len(text):  # Letters whose small form is longer keep their place.
        low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    for end, (kind, n) in automaton.iter(low):
        if kind == "digit":
            digits.append(end)
        elif kind == "at":
            at.append(end)
        elif kind == "plus":
            plus.append(end)
        elif kind == "scheme":
            schemes.append(end - 2)
        else:
            cues.append((end - n + 1, end + 1, kind == "secret"))
    if not (at or plus or digits or schemes or cues):
        return []
    runs = _runs(digits) if digits else []
    found = (_emails(text, at), _ips(text, runs), _cards(text, runs), _phones(text, plus), _accounts(text, cues), _urls(text, schemes))
    return sorted((s, k, e) for k, spans in enumerate(found) for s, e in spans)


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _finder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = anchors()
    for batch in batches:
        counts, digest, listed = [], [], []
        for text in texts(batch.column("text")):
            spans = find(text, automaton)
            counts.append([sum(k == own for _, k, _ in spans) for own in range(4)] if spans else [0] * 4)
            digest.append(hashlib.sha256(_listed([x for x in spans if x[1] < 4]).encode()).hexdigest())
            listed.append(_listed(spans))
        columns = np.array(counts, np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *map(pa.array, columns), pa.array(digest, pa.string()), pa.array(listed, pa.string())],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
        )


def find_pii(documents: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of the base spans and all spans of every text; null is empty."""
    schema = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return documents.select("doc_id", "text").mapInArrow(_finder, schema)


def _redacted(text: str, automaton: ahocorasick.Automaton) -> str:
    out, free = [], 0
    for s, k, e in find(text, automaton):
        if e <= free:
            continue
        if s >= free:
            out += [text[free:s], f"[{KINDS[k].upper()}]"]
        free = e
    return "".join([*out, text[free:]]) if out else text


def _redactor(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            new = [None if t is None else _redacted(t, automaton) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in columns], names=columns)

    return run


def redact(documents: DataFrame) -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets; overlapping spans become one mark."""
    columns = list(documents.columns)
    done = documents.mapInArrow(_redactor(columns), documents.schema)
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*columns) if "n_chars" in columns else done


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    return find_pii(table(spark, sf_dir, "documents"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data masked."""
    return redact(docs)
