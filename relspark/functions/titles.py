"""Titles in release names: comparable forms, Latin spelling, and what a release name says of a film."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters spelled out before marks are stripped, and words that comparable titles leave out (fixed values).
UMLAUTS = {"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss", "Ä": "Ae", "Ö": "Oe", "Ü": "Ue"}
ARTICLES = ("a", "an", "the", "and", "or", "of", "à")

#: Latin spelling of Russian letters (fixed values); letters without a pair of one letter each stand in the second table.
CYRILLIC = ("абвгдезийклмнопрстуфхыёэАБВГДЕЗИЙКЛМНОПРСТУФХЫЁЭъьЪЬ", "abvgdezijklmnoprstufhyeeABVGDEZIJKLMNOPRSTUFHYEE''''")
CYRILLIC_PAIRS = {"ж": "zh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "ju", "я": "ja", "Ж": "Zh", "Ц": "Ts", "Ч": "Ch", "Ш": "Sh", "Щ": "Sch", "Ю": "Ju", "Я": "Ja"}

#: Patterns of release names (fixed values): names that are no titles, mirrored names, and what is cut before the title is read.
NO_TITLES = (r"^[0-9a-zA-Z]{32}$", r"^[a-z0-9]{24}$", r"^[A-Z]{11}\d{3}$", r"^[a-z]{12}\d{3}$", r"^Backup_\d{5,}S\d{2}-\d{2}$", r"^123$", r"(?i)^abc$", r"(?i)^abc[-_. ]xyz", r"(?i)^b00bs$")
MIRRORED = r"(?i)(?:^|[-._ ])(p027|p0801)[-._ ]"
FILE_ENDING = r"(?i)\.[a-z0-9]{1,4}$"
CUT = (
    r"(?iU)(?:(480|540|576|720|1080|2160)[ip]|[xh][\W_]?26[45]|DD\W?5\W1|[<>?*]|848x480|1280x720|1920x1080|3840x2160|4096x2160|(8|10)b(it)?|10-bit)\s*?(?![a-b0-9])",
    r"(?i)^(?:(?:\[|\()\s*)?(?:www\.)?[-a-z0-9]{1,256}\.(?<!Naruto-Kun\.)(?:[a-z]{2,6}\.[a-z]{2,6}|xn--[a-z0-9-]{4,}|[a-z]{2,})\b(?:\s*(?:\]|\))|[ -]{2,})[ -]*",
    r"(?i)(?:\[\s*)?(?:www\.)?[-a-z0-9]{1,256}\.(?:xn--[a-z0-9-]{4,}|[a-z]{2,6})\b(?:\s*\])$",
    r"(?i)\[(?:ettv|rartv|rarbg|cttv|publichd)\]$",
    r"(?i)\[[a-z0-9 ._-]+\]$",
)
_YEAR = r"(?:1[89]|20)\d{2}"
_GAP = r"(?:[-_\W](?<![)\[!]))*"
#: Forms of a name in order of trial (fixed values), each with the groups of its title and its year (0: none).
FORMS = (
    (rf"(?iU)^(?:\[.+?\][-_. ]?)?((?![(\[]).+?)?(?:{_GAP}({_YEAR}(?!p|i|x|\d|\]|\W\d)))+", 1, 2),
    (r"(?iU)^\[.+?\][-_. ]?((?![(\[]).+?)v\d{1,2}[-_. ](?:\[.*)?(?:[\[(][^\])])?.*?\[\w{8}\](?:$|\.)", 1, 0),
    (r"(?iU)^\[.+?\][-_. ]?((?![(\[]).+?)\[.*\[\w{8}\](?:$|\.)", 1, 0),
    (r"(?iU)^\[.+?\][-_. ]?((?![(\[]).+)[\[(][^\])].*?\[\w{8}\](?:$|\.)", 1, 0),
    (rf"(?iU)^((?![(\[]).+?)(?:{_GAP}({_YEAR}(?!p|i|{_YEAR}|\])))+(?:\W+|_|$)(?!\\)", 1, 2),
    (rf"(?iU)^(.+?)?(?:{_GAP}({_YEAR}(?!p|i|\d|\]|\W\d)))+(?:\W+|_|$)(?!\\)", 1, 2),
    (r"(?iU)^(?:(?:[-_\W](?<![)!]))*((?:19|20)\d{2}(?!p|i|\d|\W\d)))+(?:\W+|_|$)(.+?)?$", 2, 1),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is stated once, so that steps on steps don't multiply the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _marked() -> tuple[str, str]:
    """Every letter that is one other letter with marks, and that letter, by the Unicode tables."""
    pairs = []
    for code in range(0xC0, 0x2000):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def without_marks(text: Column) -> Column:
    """Text without accents and other marks, for letters below U+2000 (all alphabets of Europe and its neighbours)."""
    return F.regexp_replace(F.translate(text, *_marked()), r"\p{Mn}+", "")


def movie_title(title: Column) -> Column:
    """Comparable form of a title: umlauts spelled out, articles and separators left out, no marks, lower case.

    A title of digits alone stays as it is; a null title gives an empty form.
    """
    spelled = title
    for letter, form in UMLAUTS.items():
        spelled = F.replace(spelled, F.lit(letter), F.lit(form))
    words = F.split(F.lower(spelled), r"[^\p{L}\p{N}]+")
    kept = F.array_join(F.filter(words, lambda w: ~w.isin(*ARTICLES)), "")
    return F.coalesce(F.when(title.rlike(r"^\p{Nd}+$"), title).otherwise(without_marks(kept)), F.lit(""))


def latin(text: Column) -> Column:
    """Russian letters in Latin spelling; all other characters stay."""
    out = F.translate(text, *CYRILLIC)
    for letter, form in CYRILLIC_PAIRS.items():
        out = F.replace(out, F.lit(letter), F.lit(form))
    return out


def undotted(title: Column) -> Column:
    """Blanks for the dots between words, while single letters and ``dr`` keep theirs.

    A digit is no such letter, and ``a`` is one only before another single character.
    """

    def joined(parts: Column) -> Column:
        def short(i: Column) -> Column:
            part, after = F.get(parts, i), F.coalesce(F.get(parts, i + 1), F.lit(""))
            low = F.lower(part)
            return ((F.length(part) == 1) & (low != "a") & ~part.rlike(r"^\d$")) | ((low == "a") & (F.length(after) == 1)) | (low == "dr")

        def shown(part: Column, i: Column) -> Column:
            before = F.when((i > 0) & F.coalesce(short(i - 1), F.lit(False)), F.lit(" ")).otherwise(F.lit(""))
            return F.when(short(i), F.concat(part, F.lit("."))).otherwise(F.concat(before, part, F.lit(" ")))

        return F.trim(F.array_join(F.transform(parts, shown), ""))

    return F.when(title.contains("."), _let(F.split(title, r"\."), joined)).otherwise(title)


def release_title(raw: Column) -> Column:
    """What a release name says of a film: struct of ``title, year, titles, imdb_id, tmdb_id, release_title``.

    Null for names without a letter or digit, for digests and placeholders, and where no form fits. ``titles`` holds the
    title and then what stands on either side of AKA or a lone slash, in brackets too; a repeated title stands once.
    """

    def of_text(text: Column) -> Column:
        readable = text.rlike(r"[\p{L}\p{N}]") & ~text.rlike("|".join(f"(?:{p})" for p in NO_TITLES))
        turned = F.when(text.rlike(MIRRORED), F.reverse(text)).otherwise(text)
        name = F.translate(F.regexp_replace(F.regexp_replace(turned, FILE_ENDING, ""), r"^[-_]+|[-_]+$", ""), "【】", "[]")
        return F.when(readable, _let(name, of_name))

    def of_name(name: Column) -> Column:
        simple = name
        for pattern in CUT:
            simple = F.regexp_replace(simple, pattern, "")
        return _let(_let(simple, first_form), lambda best: F.when(best.isNotNull(), _let(title_of(best["t"]), lambda title: said(name, title, best["y"]))))

    def first_form(simple: Column) -> Column:
        year_of = lambda form, group: F.nullif(F.regexp_extract(simple, form, group), F.lit("")).cast("int") if group else F.lit(None).cast("int")
        found = F.array(*[F.struct(F.regexp_extract(simple, form, title).alias("t"), year_of(form, year).alias("y")) for form, title, year in FORMS])
        return F.get(F.filter(found, lambda f: ~f["t"].isin("", "(")), F.lit(0))

    def title_of(text: Column) -> Column:
        spaced = F.regexp_replace(F.translate(text, "_", " "), r"(?i) +A\.K\.A\. +", " AKA ")
        return F.trim(F.regexp_replace(_let(F.trim(F.regexp_replace(spaced, r"^(?:\[.+?\])+", "")), undotted), r"\s+", " "))

    def said(name: Column, title: Column, year: Column) -> Column:
        sides = F.split(F.regexp_replace(title, r"(?i)^(.*) \( *AKA +(.*)\)$", "$1 AKA $2"), r"(?i) +(?:AKA|/) +")
        titles = F.array_distinct(F.concat(F.array(title), F.filter(F.transform(sides, F.trim), lambda t: t != "")))
        imdb = F.nullif(F.lower(F.regexp_extract(name, r"(?i)tt\d{7,8}", 0)), F.lit(""))
        tmdb = F.nullif(F.regexp_extract(name, r"(?i)tmdb(?:id)?[-_]?(\d+)", 1), F.lit("")).cast("long")
        return F.struct(title.alias("title"), year.alias("year"), titles.alias("titles"), imdb.alias("imdb_id"), tmdb.alias("tmdb_id"), name.alias("release_title"))

    return _let(F.trim(raw), of_text)
