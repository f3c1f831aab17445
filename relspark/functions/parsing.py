"""Column functions that read names, units, identifiers and query strings out of release text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Token vocabularies in order of preference (fixed values): label, pattern of the token.
RESOLUTION_TOKENS = (
    ("2160p", r"(bd|hd|m)?(4k|2160(p|i)?)|u(ltra)?[ .\-_]?hd|3840\s?x\s?(\d{4})"), ("1440p", r"(bd|hd|m)?(1440(p|i)?)|2k|w?q(uad)?[ .\-_]?hd|2560\s?x(\d{4})"),
    ("1080p", r"(bd|hd|m)?(1080(p|i)?)|f(ull)?[ .\-_]?hd|1920\s?x\s?(\d{3,4})"), ("720p", r"(bd|hd|m)?((720|800)(p|i)?)|hd|1280\s?x\s?(\d{3,4})"),
    ("576p", r"(bd|hd|m)?((576|534)(p|i)?)"), ("480p", r"(bd|hd|m)?(480(p|i)?)|sd"), ("360p", r"(bd|hd|m)?(360(p|i)?)"), ("240p", r"(bd|hd|m)?((240|266)(p|i)?)"), ("144p", r"(bd|hd|m)?(144(p|i)?)"),
)
QUALITY_TOKENS = (
    ("BluRay REMUX", r"(bd|br|b|uhd)?remux"), ("BluRay", r"(?<!remux.{0,255})(bd|blu[ .\-_]?ray|((bd|br)[ .\-_]?rip))(?!.*remux)"), ("WEB-DL", r"web[ .\-_]?(dl)?(?![ .\-_]?(rip|DLRip|cam))"),
    ("WEBRip", r"web[ .\-_]?rip"), ("HDRip", r"hd[ .\-_]?rip|web[ .\-_]?dl[ .\-_]?rip"), ("HC HD-Rip", r"hc|hd[ .\-_]?rip"), ("DVDRip", r"dvd[ .\-_]?(rip|mux|r|full|5|9)?"),
    ("HDTV", r"(hd|pd)tv|tv[ .\-_]?rip|hdtv[ .\-_]?rip|dsr(ip)?|sat[ .\-_]?rip"), ("CAM", r"cam|hdcam|cam[ .\-_]?rip"), ("TS", r"telesync|ts|hd[ .\-_]?ts|pdvd|predvd(rip)?"),
    ("TC", r"telecine|tc|hd[ .\-_]?tc"), ("SCR", r"((dvd|bd|web|hd)?[ .\-_]?)?(scr(eener)?)"),
)
VISUAL_TOKENS = (
    ("10bit", r"10[ .\-_]?bit"), ("HDR10+", r"hdr[ .\-_]?10[ .\-_]?(p(lus)?|[+])"), ("HDR10", r"hdr[ .\-_]?10(?![ .\-_]?(?:\+|p(lus)?))"), ("HDR", r"hdr(?![ .\-_]?10)(?![ .\-_]?(?:\+|p(lus)?))"),
    ("HLG", r"hlg"), ("DV", r"do?(lby)?[ .\-_]?vi?(sion)?(?:[ .\-_]?atmos)?|dv"), ("3D", r"(bd)?(3|three)[ .\-_]?(d(imension)?(al)?)"), ("IMAX", r"imax"), ("AI", r"ai[ .\-_]?(upscale|enhanced|remaster)?"),
    ("SDR", r"sdr"), ("H-OU", r"h?(alf)?[ .\-_]?(ou|over[ .\-_]?under)"), ("H-SBS", r"h?(alf)?[ .\-_]?(sbs|side[ .\-_]?by[ .\-_]?side)"),
)
AUDIO_TOKENS = (
    ("Atmos", r"atmos|ddpa\d?"), ("DD+", r"(d(olby)?[ .\-_]?d(igital)?[ .\-_]?((p(lus)?|\+)a?)(?:[ .\-_]?(2[ .\-_]?0|5[ .\-_]?1|7[ .\-_]?1))?)|e[ .\-_]?ac[ .\-_]?3"),
    ("DD", r"(d(olby)?[ .\-_]?d(igital)?(?:[ .\-_]?(5[ .\-_]?1|7[ .\-_]?1|2[ .\-_]?0?))?)|(?<!e[ .\-_]?)ac[ .\-_]?3"), ("DTS:X", r"dts[ .\-:_]?x"), ("DTS-HD MA", r"dts[ .\-_]?hd[ .\-_]?ma"),
    ("DTS-HD", r"dts[ .\-_]?hd(?![ .\-_]?ma)"), ("DTS-ES", r"dts[ .\-_]?es"), ("DTS", r"dts(?![ .\-:_]?(x(?=[\s)\]_.\-,]|$)|hd[ .\-_]?(ma)?|es))"), ("TrueHD", r"true[ .\-_]?hd"), ("OPUS", r"opus"),
    ("AAC", r"q?aac(?:[ .\-_]?2)?"), ("FLAC", r"flac(?:[ .\-_]?(lossless|2\.0|x[2-4]))?"),
)
_BEFORE_CHANNELS = r"(d(olby)?[ .\-_]?d(igital)?[ .\-_]?((p(lus)?|\+)a?)?)?"
CHANNEL_TOKENS = (("2.0", r"(d(olby)?[ .\-_]?d(igital)?)?2[ .\-_]?0(ch)?"), *((f"{n}.1", rf"{_BEFORE_CHANNELS}{n}[ .\-_]?1(ch)?") for n in (5, 6, 7)))
ENCODE_TOKENS = (("HEVC", r"hevc[ .\-_]?(10)?|[xh][ .\-_]?265"), ("AVC", r"avc|[xh][ .\-_]?264"), ("AV1", r"av1"), ("XviD", r"xvid"), ("DivX", r"divx|dvix"))


#: Signs that may stand directly before and behind a token (fixed values).
_BEFORE, _BEHIND = r"\s\[(_\-.,", r"\s)\]_.\-,"


def token(pattern: str) -> str:
    """Case-blind pattern of a whole token: nothing word-like on its left, a separator or the end on its right."""
    return rf"(?i)(?<![^{_BEFORE}])(?:{pattern})(?=[{_BEHIND}]|$)"


def first_token(name: Column, vocabulary: Sequence[tuple[str, str]]) -> Column:
    """Label of the first entry of the vocabulary that the name holds."""
    return F.coalesce(*[F.when(name.rlike(token(p)), F.lit(label)) for label, p in vocabulary])


def all_tokens(name: Column, vocabulary: Sequence[tuple[str, str]]) -> Column:
    """Labels of all entries that the name holds, in order of the vocabulary."""
    return F.array_compact(F.array(*[F.when(name.rlike(token(p)), F.lit(label)) for label, p in vocabulary]))


def release_group(name: Column) -> Column:
    """The word behind the last hyphen, before an optional file ending."""
    return F.nullif(F.regexp_extract(name, r"-\s?([A-Za-z0-9]+)(?:\.(?:mkv|mp4|avi|nzb))?$", 1), F.lit(""))


def season_episode(name: Column) -> Column:
    """Struct of season and episode from S01E02 or 1x02 forms; a season alone leaves the episode null."""
    s = F.nullif(F.coalesce(F.nullif(F.regexp_extract(name, r"(?i)(?<![a-z0-9])s(\d{1,2})", 1), F.lit("")), F.regexp_extract(name, r"(?<!\d)(\d{1,2})x\d{2,3}(?!\d)", 1)), F.lit(""))
    e = F.nullif(F.coalesce(F.nullif(F.regexp_extract(name, r"(?i)s\d{1,2}[ ._-]?e(\d{1,3})", 1), F.lit("")), F.regexp_extract(name, r"(?<!\d)\d{1,2}x(\d{2,3})(?!\d)", 1)), F.lit(""))
    return F.struct(s.cast("int").alias("season"), e.cast("int").alias("episode"))


def release_year(name: Column, as_of: int) -> Column:
    """The first year between 1900 and the year after ``as_of``."""
    years = F.filter(F.transform(F.regexp_extract_all(name, F.lit(r"(?<!\d)((?:19|20)\d{2})(?!\d)"), F.lit(1)), lambda y: y.cast("int")), lambda y: (y >= 1900) & (y <= as_of + 1))
    return F.try_element_at(years, F.lit(1))


def info_hash(url: Column) -> Column:
    return F.lower(F.nullif(F.regexp_extract(url, r"(?<![0-9A-Za-z])([0-9a-fA-F]{40})(?![0-9A-Za-z])", 1), F.lit("")))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is computed once; Spark would put the expression in place of each use."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _known(text: Column) -> Column:
    """The text, or null if it is empty."""
    return F.when(text != "", text)


def size_bytes(text: Column) -> Column:
    """Bytes of the first size in a text; units are powers of 1024."""
    number = lambda size: _known(F.regexp_extract(size, r"^[\d.]+", 0)).cast("double")
    power = lambda size: F.call_function("instr", F.lit("KMGT"), F.upper(F.regexp_extract(size, r"(?i)[KMGT]", 0)))
    found = F.regexp_extract(text, r"(?i)\d+(?:\.\d+)?\s?[KMGT]i?B", 0)
    return once(found, lambda size: F.floor(number(size) * F.pow(F.lit(1024.0), power(size))).cast("long"))


def duration_ms(text: Column) -> Column:
    """Milliseconds of the first hours, minutes and seconds in a text that stand as a token of their own; 0 without one.

    A smaller unit follows its larger one directly, behind a colon or behind a blank.
    """
    whole = rf"(?i)(?<![^{_BEFORE}])(\d+h(?:[:\s]?\d+m(?:[:\s]?\d+s)?)?|\d+m(?:[:\s]?\d+s)?|\d+s)(?=[{_BEHIND}]|$)"
    part = lambda found, u: F.coalesce(_known(F.regexp_extract(found, rf"(?i)(\d+){u}", 1)).cast("long"), F.lit(0))
    return once(F.regexp_extract(text, whole, 1), lambda found: (part(found, "h") * 3600 + part(found, "m") * 60 + part(found, "s")) * 1000)


def age_hours(text: Column) -> Column:
    """Hours of an age such as 3d, 12h, 30m (minutes) or 1y (365 days); null for any other text."""
    form = r"^(\d+)([A-Za-z])$"

    def hours(age: Column) -> Column:
        number, unit = _known(F.regexp_extract(age, form, 1)).cast("double"), F.lower(F.regexp_extract(age, form, 2))
        return F.when(unit == "h", number).when(unit == "d", number * 24).when(unit == "m", number / 60).when(unit == "y", number * 24 * 365)

    return once(text, hours)


def bitrate_bps(text: Column) -> Column:
    """Bits a second of a text that is a rate such as 5.5 Mbps, or a plain number; null for any other text."""
    form = r"(?i)^(\d+(?:\.\d+)?)(?:\s*([kmgt]?)bps)?$"
    text = F.trim(text)
    number, unit = F.nullif(F.regexp_extract(text, form, 1), F.lit("")).cast("double"), F.lower(F.regexp_extract(text, form, 2))
    return number * F.when(unit == "k", 1e3).when(unit == "m", 1e6).when(unit == "g", 1e9).when(unit == "t", 1e12).otherwise(1.0)


def service_of(name: Column, services: Sequence[tuple[str, str]], cached: str = "+", uncached: str = "download") -> Column:
    """Struct of service and cached flag; of several services the last one listed wins, an uncached mark beats a cached one."""
    found: Column = F.lit(None).cast("string")
    for service, mark in services:
        found = F.when(name.contains(mark), F.lit(service)).otherwise(found)
    flag = F.when(name.contains(uncached), F.lit(False)).when(name.contains(cached), F.lit(True)).otherwise(F.lit(False))
    return F.when(found.isNotNull(), F.struct(found.alias("id"), flag.alias("cached")))


def stream_type(service: Column, is_live: Column, nzb: Column, info: Column, url: Column, external: Column, video_id: Column) -> Column:
    """Type of a raw row: the first form that it has."""
    return (
        F.when(F.coalesce(is_live, F.lit(False)), "live").when(nzb.isNotNull() & service.isNotNull(), "usenet").when(service.isNotNull(), "debrid").when(url.isNotNull(), "http")
        .when(info.isNotNull(), "p2p").when(external.isNotNull(), "external").when(video_id.isNotNull(), "youtube").when(nzb.isNotNull(), "stremio-usenet").otherwise("archive")
    )


#: Identifier namespaces in order of trial (fixed values): name, prefixes, characters of the value, what may follow it.
ID_SPACES = (
    ("imdb", ("tt", "imdb"), r"\d", "season episode"),
    ("mal", ("mal",), r"\d", "episode"),
    ("tvdb", ("tvdb",), r"\d", "season episode"),
    ("tmdb", ("tmdb",), r"\d", "season episode"),
    ("kitsu", ("kitsu",), r"\d", "episode"),
    ("anilist", ("anilist",), r"\d", "episode"),
    ("anidb", ("anidb", "anidb_id", "anidbid"), r"\d", "episode"),
    ("animeplanet", ("animeplanet", "ap"), r"\d", ""),
    ("animecountdown", ("acd",), r"\d", ""),
    ("anisearch", ("anisearch",), r"\d", ""),
    ("notifymoe", ("notifymoe", "nm"), r"[A-Za-z0-9]", ""),
    ("simkl", ("simkl",), r"\d", ""),
)
_FOLLOWS = {"season episode": r"(?::(\d+):(\d+))?", "episode": r"()(?::(\d+))?", "": "()()"}


def parse_id(text: Column) -> Column:
    """Struct ``type, value, season, episode`` of an identifier, or null.

    A prefix is followed by a colon, a hyphen or nothing; an imdb value is written with ``tt`` whatever its prefix was.
    """
    out: Column = F.lit(None).cast("struct<type:string,value:string,season:int,episode:int>")
    for name, prefixes, signs, follows in reversed(ID_SPACES):
        pattern = f"^(?:{'|'.join(prefixes)})[:-]?({signs}+){_FOLLOWS[follows]}$"
        part = lambda k, pattern=pattern: F.regexp_extract(text, pattern, k)
        number = lambda k, part=part: F.nullif(part(k), F.lit("")).cast("int")
        value = F.concat(F.lit("tt"), part(1)) if name == "imdb" else part(1)
        out = F.when(text.rlike(pattern), F.struct(F.lit(name).alias("type"), value.alias("value"), number(2).alias("season"), number(3).alias("episode"))).otherwise(out)
    return out


def query_map(text: Column) -> Column:
    """Map of a query string ``a=1&b=2``; null for a text without one."""
    return F.str_to_map(F.nullif(text, F.lit("")), F.lit("&"), F.lit("="))


def title_key(text: Column, words: int = 12) -> Column:
    """Lower case, separators to blanks, signs other than letters and digits of any script dropped, the first words joined."""
    return F.array_join(F.slice(_title_words(text), F.lit(1), F.lit(words)), " ")


def _title_words(text: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[._\-]+", " "), r"[^\p{L}\p{N} ]+", ""))
    return F.filter(F.split(clean, " +"), lambda w: w != "")


def lookup_title(text: Column) -> Column:
    """The first twelve words of more than one character."""
    return F.array_join(F.slice(F.filter(_title_words(text), lambda w: F.length(w) > 1), F.lit(1), F.lit(12)), " ")


def season_bucket(season: Column) -> Column:
    """``s01``, ``s12``, ``s100``; empty without a season."""
    digits = season.cast("string")
    return F.when(season.isNull(), "").otherwise(F.concat(F.lit("s"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)))


def compound_key(*columns: Column) -> Column:
    """Parts joined by a sign that no title holds; nulls count as empty parts."""
    return F.concat_ws("␟", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])


def noise(text: Column, heavy: Sequence[str], light: Sequence[str]) -> Column:
    """3 for each heavy and 1 for each light token; 999 for an empty text."""
    words = F.split(title_key(text, 10_000), " ")
    count = lambda xs: F.size(F.filter(words, lambda w: w.isin(*xs)))
    return F.when(F.coalesce(title_key(text), F.lit("")) == "", 999).otherwise(3 * count(heavy) + count(light))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct words of two texts; two empty texts are unlike."""
    x, y = (F.array_distinct(F.filter(F.split(t, " "), lambda w: w != "")) for t in (a, b))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y))), F.lit(0.0))


def episodes(json: Column) -> Column:
    """Struct ``season, first, last, n`` of a nested map that holds exactly one season; nulls and 0 for any other.

    Keys that are no numbers are passed over; a season key that is none counts as no season.
    """
    seasons = F.from_json(json, "map<string,map<string,string>>")
    one = F.size(F.map_keys(seasons)) == 1
    season = F.when(one, F.try_element_at(F.map_keys(seasons), F.lit(1)).try_cast("int"))
    inside = F.when(season.isNotNull(), F.map_keys(F.try_element_at(F.map_values(seasons), F.lit(1))))
    eps = F.filter(F.transform(inside, lambda k: k.try_cast("int")), lambda k: k.isNotNull())
    return F.struct(season.alias("season"), F.array_min(eps).alias("first"), F.array_max(eps).alias("last"), F.coalesce(F.array_size(eps), F.lit(0)).alias("n"))


def content_class(n: Column) -> Column:
    """Class by the number of episodes named: none or more than ten is a whole season."""
    return F.when(n == 1, "episode").when(n.between(2, 10), "multi_episode").otherwise("season_pack")


def dedup_keys(filename: Column, info: Column, file_index: Column, fingerprint: Column) -> Column:
    """Keys under which rows are the same: cleaned name, hash and file, attributes with the size in steps of 100 MB."""
    name = F.regexp_replace(F.lower(F.regexp_replace(filename, r"\.[a-z0-9]{2,4}$", "")), r"[^\p{L}\p{N}+]", "")
    return F.array_compact(F.array(F.when(name != "", F.concat(F.lit("name:"), name)), F.when(info.isNotNull(), F.concat_ws("", F.lit("hash:"), info, F.coalesce(file_index, F.lit(0)).cast("string"))), F.when(fingerprint.isNotNull(), F.concat(F.lit("attr:"), fingerprint))))


def keyword_pattern(keywords: Sequence[str]) -> str:
    """One pattern for all keywords; a blank stands for any separator or none."""
    import re

    return token("|".join(re.escape(k).replace(r"\ ", r"[\s.\-_]?") for k in keywords))


def bounded_pattern(pattern: str, longest: int = 1000) -> str:
    """Refuses patterns that nest quantifiers or are very long, since the regex engine has no time limit."""
    import re

    if len(pattern) > longest or re.search(r"\([^)]*[+*][^)]*\)[+*{]", pattern):
        raise ValueError("this pattern could take exponential time")
    return pattern


def literal_pattern(text: str) -> tuple[str, bool]:
    """Pattern and negation of ``/pattern/flags``; flag ``n`` negates."""
    if not text.startswith("/") or text.rfind("/") == 0:
        return text, False
    body, flags = text[1:].rsplit("/", 1)
    inline = "".join(f for f in flags if f in "ims")
    return (f"(?{inline}){body}" if inline else body), "n" in flags


def media_score(size: Column, resolution: Column, content: Column, scores: dict[str, float], factors: dict[str, float]) -> Column:
    """Table score of the resolution times the factor of the class, raised by a known size, between 0 and 1."""
    lookup = lambda key, table, other: F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key], F.lit(other))
    score = lookup(resolution, scores, 0.1) * lookup(content, factors, 1.0) + F.when(F.coalesce(size, F.lit(0)) > 0, 0.1).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def any_pattern(name: Column, patterns: Sequence[str]) -> Column:
    """Whether one of the patterns is in the name; null names have none."""
    return F.coalesce(name.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False)) if patterns else F.lit(False)


def mapped(value: Column, names: dict[str, str]) -> Column:
    """Case-blind translation by a table (language codes, provider aliases); unknown values stay as they are."""
    return F.coalesce(F.create_map(*[F.lit(x) for k, v in names.items() for x in (k.lower(), v)])[F.lower(F.trim(value))], value)


def leading_year(text: Column) -> Column:
    """First year of a text such as ``1999-2003``; 0 if there is none."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"((?:19|20)\d{2})", 1), F.lit("")).cast("int"), F.lit(0))


#: Roman numbers that titles exchange with Arabic ones, from 1 (fixed values).
ROMAN = ("i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii", "xviii", "xix", "xx", "xxi")


def roman_variants(title: Column) -> Column:
    """The title, and for each number a form with it exchanged wherever it stands, inside words and longer numbers too.

    Every form exchanges one number in one direction; numbers that do not occur add no form.
    """
    swaps = [(x, y) for n, roman in enumerate(ROMAN, 1) for x, y in ((str(n), roman), (roman, str(n)))]
    return F.array_distinct(F.array(title, *[F.replace(title, F.lit(x), F.lit(y)) for x, y in swaps]))


def in_script(text: Column, script: str = "Cyrillic") -> Column:
    """Whether a text has a letter of a script."""
    return text.rlike(rf"\p{{Is{script}}}")


def preprocessed(title: Column, wanted: Column) -> Column:
    """Title up to a slash, bar or AKA, and without a trailing bracket, unless a wanted title uses them itself."""
    uses = lambda pattern: F.exists(wanted, lambda t: t.rlike(pattern))
    cut = title
    for pattern in (r"[/|]", r"(?i)\baka\b", r"\([^)]*\)\s*$"):
        cut = F.when(uses(pattern), cut).otherwise(F.trim(F.regexp_replace(cut, pattern + (r".*$" if "$" not in pattern else ""), "")))
    return F.when(F.length(cut) > 0, cut).otherwise(title)


def refined_series_title(title: Column, season: Column, dropped: Sequence[str]) -> Column:
    """Series title without the given words, and without a trailing number that repeats the season."""
    kept = F.array_join(F.filter(F.split(title, " "), lambda w: ~w.isin(*dropped) if dropped else F.lit(True)), " ")
    tail = F.regexp_extract(kept, r" 0*(\d+)$", 1)
    return F.when(F.nullif(tail, F.lit("")).cast("int") == season, F.regexp_replace(kept, r" \d+$", "")).otherwise(kept)


def epoch_seconds(text: Column, otherwise: Column) -> Column:
    """Seconds since 1970 of ``2024-01-31T12:00:00`` with Z, a fraction and Z, or an offset; ``otherwise`` for any other text."""
    known = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:(?:\.\d{1,6})?Z|[+-]\d{2}:?\d{2})$")
    with_colon = F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2")
    return F.coalesce(F.when(known, with_colon.try_cast("timestamp").cast("long")), otherwise.cast("long"))


def days_since(date: Column, as_of: Column) -> Column:
    """Whole days from one midnight to another; negative for dates to come, null for unknown ones."""
    return F.datediff(as_of, date)


def text_hash(text: Column) -> Column:
    """Identity of a text over runs and machines."""
    return F.sha2(text, 256)


def search_text(parts: Sequence[Column], year: Column, season: Column, first: Column, last: Column, keys: Sequence[Column]) -> Column:
    """All that a row is searched by, in one text: parts, year, season and episodes in two forms, keys; empty ones are left out.

    A last episode equal to the first adds nothing.
    """
    both = lambda word, n: F.concat(F.lit(f"{word} "), n.cast("string"), F.lit(f" {word[0]}"), F.when(n < 100, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string")))
    until = F.when(~last.eqNullSafe(first), last)
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts], year.cast("string"), both("season", season), both("episode", first), both("episode", until), *[F.nullif(k, F.lit("")) for k in keys])
