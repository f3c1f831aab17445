"""How the rows of each kind of source are read: one strategy for each kind, and one plan for all of them.

A strategy says which fields it reads in its own way; every other field is read as the default does. A field may use the raw
columns and the fields before it. All rows are parsed in one pass, whatever kinds their sources are of.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import parsing as ps
from . import rows as rw

#: A field as a column over raw columns and earlier fields.
Field = Callable[[], Column]

#: Messages of sources that failed, and what a text that says so looks like (fixed values).
FAILURES = (
    ("Invalid account or apikey or token", r"(?i)invalid\s+\w+\s+(account|apikey|token)"),
    ("Public rate limit exceeded", r"(?i)public\s+rate[-\s]?limit\s+exceeded"),
)
#: Sign between a folder and a file in a text, and the text of a row that only reports (fixed values).
ARROW, REPORT = "┈➤", "🚫 Streams Found\n⚙️ Filtered"
#: Raw columns that a source may leave out, with their types.
RAW = {
    "name": "string", "title": "string", "description": "string", "url": "string", "externalUrl": "string", "ytId": "string", "nzbUrl": "string", "infoHash": "string", "fileIdx": "int",
    "hint_filename": "string", "hint_folder": "string", "hint_size": "double", "hint_folder_size": "string", "binge_group": "string", "row_size": "double", "row_seeders": "int", "archives": "int",
}


def _text() -> Column:
    return F.col("description")


def _has(column: str, part: str) -> Column:
    return F.coalesce(F.col(column).contains(part), F.lit(False))


def _match(text: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _without(text: Column, part: Column) -> Column:
    """The text without the first place of a part."""
    cut = lambda t, at: F.concat(F.substr(t, F.lit(1), at - 1), F.substr(t, at + F.length(part)))
    return ps.once(text, lambda t: ps.once(F.call_function("instr", t, part), lambda at: F.when((at > 0) & (part != ""), cut(t, at)).otherwise(t)))


def _positive(x: Column) -> Column:
    return ps.once(x, lambda v: F.when(v > 0, v.cast("long")))


def _failure() -> Column:
    return F.coalesce(*[F.when(_text().rlike(pattern), message) for message, pattern in FAILURES])


def _size() -> Column:
    rest = _without(_without(_text(), F.col("filename")), F.col("folder"))
    some = lambda x: F.when(x != 0, F.round(x))
    return _positive(F.coalesce(some(F.col("hint_size")), some(F.col("row_size")), ps.size_bytes(rest), ps.size_bytes(F.col("name"))))


def _folder_size_of(text: Column) -> Column:
    plain = F.when(text.rlike(r"^\d+(\.\d+)?$"), F.floor(text.cast("double")).cast("long"))
    return F.coalesce(plain, ps.size_bytes(text))


def _type() -> Column:
    forms = [F.when(F.col("url").isNotNull(), "http"), F.when(F.col("infoHash").isNotNull(), "p2p"), F.when(F.col("externalUrl").isNotNull(), "external"), F.when(F.col("ytId").isNotNull(), "youtube")]
    forms += [F.when(F.col("nzbUrl").isNotNull(), "stremio-usenet"), F.when(F.col("archives") > 0, "archive")]
    service = F.when(F.col("service")["id"] == "easynews", "usenet").when(F.col("service").isNotNull(), "debrid")
    return F.coalesce(F.when(F.col("url").endswith(".m3u8"), "live"), service, *forms)


def _bitrate() -> Column:
    seconds = F.col("duration") / 1000
    return F.when((F.col("size") > 0) & (seconds > 0), F.round(F.col("size") * 8 / seconds).cast("long"))


def _default(services: Sequence[tuple[str, str]]) -> dict[str, Field]:
    """Every field in order of reading."""
    return {
        "skip": lambda: F.lit(False),
        "failure": _failure,
        "filename": lambda: rw.file_name(F.col("hint_filename"), _text()),
        "folder": lambda: F.col("hint_folder"),
        "size": _size,
        "folder_size": lambda: _folder_size_of(F.col("hint_folder_size")),
        "indexer": lambda: rw.text_behind(_text(), rw.INDEXER_MARKS),
        "service": lambda: ps.service_of(F.coalesce("name", F.lit("")), services),
        "duration": lambda: _positive(ps.duration_ms(F.coalesce(_text(), F.lit("")))),
        "type": _type,
        "library": lambda: F.lit(False),
        "age": lambda: F.lit(None).cast("double"),
        "bitrate": _bitrate,
        "message": lambda: F.lit(None).cast("string"),
        "info_hash": lambda: F.lower(_match(F.col("url"), r"(?<=[-/\[(;:&])([a-fA-F0-9]{40})(?=[-\])/:;&])")),
        "seeders": lambda: rw.marked_seeders(_text()),
        "file_index": lambda: F.lit(None).cast("int"),
    }


def _spread(names: Column) -> Column:
    """Blanks between words as dots, the ending with a dot of its own."""
    ended = F.regexp_replace(names, r"(?i)\s+(mkv|mp4)$", ".$1")
    return F.regexp_replace(ended, r"(?<![\[\]\-/()])\s+(?![\[\]\-/()])", ".")


def _both() -> Column:
    """Folder and file on one line, behind their mark."""
    return rw.text_behind(_text(), ("📂",))


def _beside(both: Column, k: int) -> Column:
    """What stands before or behind the arrow; null without one."""
    return F.when(both.contains(ARROW), F.trim(F.get(F.split(both, ARROW), F.lit(k))))


def _arrow_name(both: Column) -> Column:
    trimmed = F.trim(both)
    return F.coalesce(_spread(_beside(both, 1)), _spread(F.when(trimmed != "", trimmed)))


_ARROW_FOLDER: dict[str, Field] = {
    "skip": lambda: _has("description", REPORT),
    "failure": lambda: F.when(_has("description", "Content Warning"), _text()).otherwise(_failure()),
    "filename": lambda: F.coalesce(ps.once(_both(), _arrow_name), rw.file_name(F.col("hint_filename"), _text())),
    "folder": lambda: ps.once(_both(), lambda both: _beside(both, 0)),
    "folder_size": lambda: ps.size_bytes(F.trim(_match(_text(), r"💾\s?.*\s?/\s?💾\s?([^💾\n]+)"))),
    "indexer": lambda: rw.text_behind(_text(), ("🔗",)),
}


def _boxed_name() -> Column:
    lines = F.transform(F.split(_text(), "\n"), lambda x: F.regexp_replace(x, "-$", ""))
    return F.when(_has("description", "📦"), F.array_join(F.filter(lines, lambda x: ~x.contains("📦")), ""))


_BOXED_LINES: dict[str, Field] = {
    "filename": _boxed_name,
    "message": lambda: F.when(~_has("description", "📦"), F.concat("name", F.lit(" - "), "description")),
    "library": lambda: _has("name", "Yours"),
}


def _ready() -> Column:
    return _has("description", "Click play to start")


def tagged(service: str) -> dict[str, Field]:
    """Strategy of a source that labels its fields in the text and serves one service only."""
    return {
        "seeders": lambda: F.when(F.col("row_seeders") > 0, F.col("row_seeders")),
        "age": lambda: ps.age_hours(_match(_text(), r"(?i)\|\sAge:\s([0-9]+[dmyh])")),
        "indexer": lambda: F.trim(_match(_text(), r"Source:\s*([^\n]+)")),
        "library": lambda: _has("name", "Your Media") | _ready(),
        "service": lambda: F.struct(F.lit(service).alias("id"), (_has("name", "Your Media") | _has("name", "Instant") | _ready()).alias("cached")),
    }


def _path() -> Column:
    """Parts of the address's path, the empty one before the first slash too."""
    return F.split(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), "/")


#: Strategies by name: the fields that each reads in its own way. ``default`` reads all as the default does.
STRATEGIES: dict[str, dict[str, Field]] = {
    "default": {},
    # The first line names the folder, and a path of eight parts the number of the file.
    "first_line_folder": {
        "folder": lambda: F.get(F.split(_text(), "\n"), F.lit(0)),
        "file_index": lambda: F.when(F.size(_path()) == 8, F.get(_path(), F.lit(6)).try_cast("int")),
    },
    # Folder and file stand on one line with an arrow between them.
    "arrow_folder": _ARROW_FOLDER,
    # Lines with a box are not of the name; a text without any is a message.
    "boxed_lines": _BOXED_LINES,
    # A store: usenet by its name, the hash at the end of the group.
    "store": {
        "type": lambda: F.when(_has("name", "Usenet"), "usenet").otherwise(_type()),
        "info_hash": lambda: F.when(~F.col("type").eqNullSafe("usenet"), F.lower(_match(F.col("binge_group"), r"([a-fA-F0-9]{40})$"))),
    },
    "usenet": {"type": lambda: F.lit("usenet")},
}


#: Fields that later ones use.
_USED = ("failure", "filename", "folder", "size", "service", "duration", "type")


def _settled(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is computed once, however often later columns use it.

    Spark would put the expression in place of each use, and the uses of those uses; it computes what a generator gives once.
    """
    if name not in _USED:
        return rows.withColumn(name, value)
    return rows.select(*[c for c in rows.columns if c != name], F.inline_outer(F.array(F.struct(value.alias(name)))))


def source_rows(rows: DataFrame, sources: DataFrame, services: Sequence[tuple[str, str]] = (), strategies: Mapping[str, Mapping[str, Field]] = STRATEGIES) -> DataFrame:
    """Raw rows with their fields read as the kind of their source asks (``sources``: ``source_id, strategy``).

    Sources that the registry lacks, and strategies that do not exist, are read by the default. Rows that only report are left
    out; a row of a failed source says why in ``failure`` and has no other fields. A folder named as its file, or a folder's
    size within a twentieth of the file's, is no folder. The registry is as small as a list of sources is; Spark broadcasts
    it if it measures it so.
    """
    raw = [F.lit(None).cast(kind).alias(c) for c, kind in RAW.items() if c not in rows.columns]
    out = rows.select("*", *raw).join(sources.select("source_id", F.col("strategy").alias("_kind")), "source_id", "left")
    out = out.withColumn("description", F.coalesce(F.nullif("description", F.lit("")), "title"))
    for name, default in _default(services).items():
        column = default()
        for kind, own in strategies.items():
            if name in own:
                column = F.when(F.col("_kind") == kind, own[name]()).otherwise(column)
        if name not in ("skip", "failure"):
            column = F.when(F.col("failure").isNull(), column)
        out = _settled(out, name, column)
        if name == "skip":
            out = out.where(~F.col("skip"))
        if name == "folder":
            out = _settled(out, "folder", rw.folder_name(F.col("folder"), F.col("filename")))
        if name == "folder_size":
            out = out.withColumn("folder_size", rw.folder_size(F.col("folder_size"), F.col("size")))
    out = out.withColumns({"info_hash": F.coalesce("infoHash", "info_hash"), "file_index": F.coalesce("fileIdx", "file_index")})
    return out.drop("_kind", "skip", *[c for c in RAW if c not in rows.columns])
