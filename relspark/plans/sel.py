"""The row-set expression language, compiled to columns.

An expression sees the rows of one request. Row-sets become boolean columns, statistics become window aggregates over the
request, so a rule such as ``count(cached(streams)) == 0 ? uncached(streams) : []`` needs neither joins nor collecting.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.filters import scalar, values

_TOKEN = re.compile(r"\s*(?:(?P<num>\d+(?:\.\d+)?)|(?P<str>'[^']*'|\"[^\"]*\")|(?P<op>==|!=|<=|>=|&&|\|\||[-+*/<>?:(),\[\]!])|(?P<name>[A-Za-z_]\w*))")
_COMMENT = re.compile(r"/\*(.*?)\*/", re.S)


class SelError(ValueError):
    """An expression that can't be parsed or compiled."""


def rule_name(text: str) -> str | None:
    """Name of a rule: its block comments, but for those that begin with ``#``."""
    names = [c.strip() for c in _COMMENT.findall(text) if not c.strip().startswith("#")]
    return " ".join(names) or None


def tokens(text: str) -> list[tuple[str, str]]:
    text, at, out = _COMMENT.sub(" ", text), 0, []
    while text[at:].strip():
        m = _TOKEN.match(text, at)
        if not m:
            raise SelError(f"unexpected {text[at:].strip()[:12]!r}")
        kind = m.lastgroup or ""
        out.append((kind, m[kind]))
        at = m.end()
    return out


class Parser:
    """Recursive descent into nested tuples: ``(kind, ...)``."""

    LEVELS = (("or", "||"), ("and", "&&"), ("==", "!=", "<", "<=", ">", ">=", "in"), ("+", "-"), ("*", "/"))
    SAME = {"||": "or", "&&": "and"}

    def __init__(self, text: str):
        self.left = tokens(text)[::-1]

    def peek(self) -> str:
        return self.left[-1][1] if self.left and self.left[-1][0] in ("op", "name") else ""

    def take(self, *wanted: str) -> str:
        if wanted and self.peek() not in wanted:
            raise SelError(f"expected {' or '.join(wanted)}, found {self.peek() or 'the end'}")
        return self.left.pop()[1]

    def parse(self) -> tuple:
        tree = self.ternary()
        if self.left:
            raise SelError(f"unexpected {self.left[-1][1]!r}")
        return tree

    def ternary(self) -> tuple:
        test = self.binary(0)
        if self.peek() != "?":
            return test
        self.take("?")
        yes = self.ternary()
        self.take(":")
        return ("if", test, yes, self.ternary())

    def binary(self, level: int) -> tuple:
        if level == len(self.LEVELS):
            return self.unary()
        tree = self.binary(level + 1)
        while self.peek() in self.LEVELS[level]:
            op = self.take()
            tree = ("op", self.SAME.get(op, op), tree, self.binary(level + 1))
        return tree

    def unary(self) -> tuple:
        if self.peek() in ("-", "!", "not"):
            return ("unary", "-" if self.take() == "-" else "not", self.unary())
        return self.primary()

    def primary(self) -> tuple:
        if not self.left:
            raise SelError("the expression ends early")
        kind, text = self.left.pop()
        if kind == "num":
            return ("lit", float(text))
        if kind == "str":
            return ("lit", text[1:-1])
        if text == "(":
            inner = self.ternary()
            self.take(")")
            return inner
        if text == "[":
            return ("list", *self.items("]"))
        if kind == "name":
            if text in ("true", "false"):
                return ("lit", text == "true")
            if self.peek() == "(":
                self.take("(")
                return ("call", text, *self.items(")"))
            return ("name", text)
        raise SelError(f"unexpected {text!r}")

    def items(self, end: str) -> list[tuple]:
        out = []
        while self.peek() != end:
            out.append(self.ternary())
            if self.peek() != end:
                self.take(",")
        self.take(end)
        return out


@dataclass
class Rows:
    """A row-set: which rows of the request it holds."""

    mask: Column


@dataclass
class Numbers:
    """Values of an attribute over a row-set."""

    value: Column


_SIZES = {"B": 0, "KB": 1, "MB": 2, "GB": 3, "TB": 4}


def _size(x: Any) -> float:
    m = re.fullmatch(r"\s*([\d.]+)\s*([KMGT]?B)\s*", x, re.I) if isinstance(x, str) else None
    if isinstance(x, str) and not m:
        raise SelError(f"{x!r} is no size")
    return float(m[1]) * 1024 ** _SIZES[m[2].upper()] if m else float(x)


def _rate(x: Any) -> float:
    m = re.fullmatch(r"\s*([\d.]+)\s*([kmg]?)bps\s*", x, re.I) if isinstance(x, str) else None
    if isinstance(x, str) and not m:
        raise SelError(f"{x!r} is no bitrate")
    return float(m[1]) * {"": 1, "k": 1e3, "m": 1e6, "g": 1e9}[m[2].lower()] if m else float(x)


#: Stages that a row may pass unseen, and what a request says where it says nothing (fixed values).
STAGES = ("filter", "language", "dedup", "limit", "excluded", "required", "title", "year", "episode", "digitalRelease")
DEFAULTS: dict[str, Any] = {
    "queryType": "", "isAnime": False, "season": -1, "episode": -1, "genres": [], "title": "", "year": 0, "yearEnd": 0, "daysSinceRelease": -1, "runtime": 0, "absoluteEpisode": -1,
    "originalLanguage": "", "hasSeaDex": False, "hasNextEpisode": False, "daysUntilNextEpisode": -1, "daysSinceFirstAired": -1, "daysSinceLastAired": -1, "latestSeason": -1,
}


class Compiler:
    """Compiles a tree over the columns of ``releases``; ``constants`` are request values (columns or numbers).

    ``marks`` collects what ``passthrough`` calls ask for: masks and stages in order of evaluation, inside a branch of a
    conditional only where that branch is taken.
    """

    ATTRIBUTES = {"size": "size", "seeders": "seeders", "age": "age_hours", "bitrate": "bitrate", "folderSize": "folder_size", "regexScore": "regex_score", "streamExpressionScore": "sel_score", "duration": "duration"}
    SERVICES: tuple[str, ...] = ()

    def __init__(self, columns: list[str], key: str = "request_id", by: str = "pos", constants: dict[str, Any] | None = None, all_rows: tuple[str, ...] = ("streams", "rows")):
        self.all_rows = all_rows
        self.columns, self.key, self.by, self.constants = set(columns), key, by, DEFAULTS | (constants or {})
        ongoing = F.lit(self.constants["hasNextEpisode"]) & (F.lit(self.constants["season"]) == F.lit(self.constants["latestSeason"]))
        self.constants.setdefault("ongoingSeason", ongoing)
        self.w = Window.partitionBy(key)
        self.marks: list[tuple[Column, tuple[str, ...]]] = []
        self.guard: Column | None = None

    def rows(self, x: Any) -> Rows:
        """A row-set; a boolean is all or none, an empty list none."""
        if isinstance(x, Rows):
            return x
        if isinstance(x, list) and not x:
            return Rows(F.lit(False))
        if isinstance(x, bool):
            return Rows(F.lit(x))
        if isinstance(x, Column):
            return Rows(x)
        raise SelError("a row-set is needed here")

    def run(self, tree: tuple) -> Any:
        kind = tree[0]
        if kind == "lit":
            return tree[1]
        if kind == "list":
            return [self.run(t) for t in tree[1:]]
        if kind == "name":
            if tree[1] in self.all_rows:
                return Rows(F.lit(True))
            if tree[1] in self.constants:
                return self.constants[tree[1]]
            raise SelError(f"unknown name {tree[1]!r}")
        if kind == "if":
            test = F.coalesce(self.column(self.run(tree[1])), F.lit(False))
            yes, no = self.branch(test, tree[2]), self.branch(~test, tree[3])
            if isinstance(yes, (Rows, list, bool)) or isinstance(no, (Rows, list, bool)):
                return Rows(F.when(test, self.rows(yes).mask).otherwise(self.rows(no).mask))
            return F.when(test, self.column(yes)).otherwise(self.column(no))
        if kind == "unary":
            x = self.column(self.run(tree[2]))
            return -x if tree[1] == "-" else ~x
        if kind == "op":
            return self.operate(tree[1], self.run(tree[2]), self.run(tree[3]))
        return self.call(tree[1], [self.run(t) for t in tree[2:]])

    def truth(self, x: Any) -> Column:
        """A condition's result; a row-set is always true, as any object is."""
        if isinstance(x, (Rows, list)):
            return F.lit(True)
        if isinstance(x, (bool, int, float)):
            return F.lit(bool(x))
        return F.coalesce(self.column(x).cast("boolean"), F.lit(False))

    def branch(self, test: Column, tree: tuple) -> Any:
        outer = self.guard
        self.guard = test if outer is None else outer & test
        found = self.run(tree)
        self.guard = outer
        return found

    def column(self, x: Any) -> Column:
        if isinstance(x, Column):
            return x
        if isinstance(x, (Rows, Numbers, list)):
            raise SelError("a single value is needed here")
        return F.lit(x)

    def operate(self, op: str, a: Any, b: Any) -> Column:
        if op == "in":
            return self.column(a).isin(*b) if isinstance(b, list) else F.array_contains(b, self.column(a))
        a, b = self.column(a), self.column(b)
        return {"or": lambda: a | b, "and": lambda: a & b, "==": lambda: a == b, "!=": lambda: a != b, "<": lambda: a < b, "<=": lambda: a <= b, ">": lambda: a > b, ">=": lambda: a >= b, "+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: F.try_divide(a, b)}[op]()

    def call(self, name: str, args: list) -> Any:
        if name in _FILTERS:
            if not args:
                raise SelError(f"{name} needs a row-set")
            mask = self.rows(args[0]).mask
            return Rows(mask & F.coalesce(_FILTERS[name](self, *args[1:]), F.lit(False)))
        if name == "passthrough":
            chosen = self.rows(args[0])
            if not set(args[1:]) <= set(STAGES):
                raise SelError(f"unknown stage in {args[1:]}")
            self.marks.append((chosen.mask if self.guard is None else chosen.mask & self.guard, tuple(args[1:])))
            return chosen
        if name == "random":
            # One number for each request, the same whenever it is asked.
            part = F.pmod(F.xxhash64(F.lit("random"), F.col(self.key)), F.lit(1 << 53)) / F.lit(float(1 << 53))
            return part * (self.column(args[0]) if args else F.lit(1.0))
        if name == "count":
            return F.sum(F.when(self.rows(args[0]).mask, 1).otherwise(0)).over(self.w)
        if name == "negate":
            return Rows(~self.rows(args[0]).mask & self.rows(args[1]).mask)
        if name == "merge":
            mask = F.lit(False)
            for a in args:
                mask = mask | self.rows(a).mask
            return Rows(mask)
        if name == "slice":
            mask = self.rows(args[0]).mask
            place = F.sum(F.when(mask, 1).otherwise(0)).over(self.w.orderBy(self.by).rowsBetween(Window.unboundedPreceding, 0)) - 1
            n = F.sum(F.when(mask, 1).otherwise(0)).over(self.w)
            at = lambda k: F.lit(int(k)) if k >= 0 else F.greatest(n + int(k), F.lit(0))
            return Rows(mask & (place >= at(args[1])) & (place < at(args[2]) if len(args) > 2 else F.lit(True)))
        if name == "values":
            if args[1] not in self.ATTRIBUTES:
                raise SelError(f"unknown attribute {args[1]!r}")
            column = self.ATTRIBUTES[args[1]]
            value = F.col(column).cast("double") if column in self.columns else F.lit(None).cast("double")
            return Numbers(F.when(self.rows(args[0]).mask & ~F.isnan(F.coalesce(value, F.lit(0.0))), value))
        if name in _STATISTICS or name == "mode":
            if not isinstance(args[0], Numbers):
                raise SelError(f"{name} needs values")
            if name == "mode":
                return F.coalesce(_mode(args[0].value, self.key, self.by), F.lit(0.0))
            return F.coalesce(_STATISTICS[name](args[0].value, self.w, *args[1:]), F.lit(0.0))
        if name in ("sqrt",):
            return F.sqrt(self.column(args[0]))
        raise SelError(f"unknown function {name!r}")


def _lower(xs: tuple) -> list[str]:
    return [str(x).lower() for x in xs]


def _any_of(column: str):
    return lambda c, *xs: F.lower(scalar(column)).isin(*_lower(xs))


def _tags(column: str):
    return lambda c, *xs: F.arrays_overlap(F.transform(values(column), F.lower), F.array(*[F.lit(x) for x in _lower(xs)]))


def _range(column: str, parse=float, zero_bound: bool = False):
    """Inclusive bounds; a missing value counts as 0, and a bound of 0 is no bound unless ``zero_bound``."""

    def build(c: Compiler, low: Any = None, high: Any = None) -> Column:
        value, out = F.coalesce(F.col(column).cast("double"), F.lit(0.0)), F.lit(True)
        for bound, test in ((low, lambda b: value >= b), (high, lambda b: value <= b)):
            b = None if bound is None or isinstance(bound, str) and not bound else parse(bound)
            if b is not None and (b or zero_bound):
                out = out & test(b)
        return out

    return build


def _services(c: Compiler, *ids: str) -> Column:
    if c.SERVICES and not set(ids) <= set(c.SERVICES):
        raise SelError(f"unknown service in {ids}")
    return F.col("service_id").isin(*ids)


def _seasons(c: Compiler, mode: str = "") -> Column:
    alone = (F.size("seasons") > 0) & (F.coalesce(F.size("episodes"), F.lit(0)) <= 0)
    return F.col("season_pack") if mode == "flag" else alone


_FILTERS = {
    "indexer": lambda c, *xs: scalar("indexer").isin(*xs),
    "resolution": _any_of("resolution"),
    "quality": _any_of("quality"),
    "encode": _any_of("encode"),
    "type": lambda c, *xs: F.lower("type").isin(*_lower(xs)),
    "visualTag": _tags("tags"),
    "audioTag": _tags("audio_tags"),
    "audioChannels": _tags("channels"),
    "language": _tags("languages"),
    "seeders": _range("seeders"),
    "age": _range("age_hours"),
    "size": _range("size", _size),
    "bitrate": _range("bitrate", _rate, zero_bound=True),
    "service": _services,
    "cached": lambda c: F.col("cached").eqNullSafe(F.lit(True)),
    "uncached": lambda c: F.col("cached").eqNullSafe(F.lit(False)),
    "releaseGroup": lambda c, *xs: F.col("release_group").isin(*xs) if xs else F.col("release_group").isNotNull(),
    "seasonPack": _seasons,
    "addon": lambda c, *xs: F.col("source_id").isin(*xs),
    "library": lambda c: F.col("library"),
    "seadex": lambda c, mode="": F.col("seadex_best") if mode == "best" else F.col("seadex"),
    "regexMatched": lambda c, *xs: F.array_contains(F.array(*[F.lit(x) for x in xs]), F.col("regex_name")) if xs else F.col("regex_name").isNotNull(),
    "regexMatchedInRange": lambda c, low, high: F.col("regex_index").between(low, high),
    "regexScore": lambda c, low=None, high=None: F.col("regex_score").between(*(x if x is not None else e for x, e in ((low, float("-inf")), (high, float("inf"))))),
    "streamExpressionScore": lambda c, low=None, high=None: F.col("sel_score").between(*(x if x is not None else e for x, e in ((low, float("-inf")), (high, float("inf"))))),
    "message": lambda c, mode, *xs: F.col("message").isin(*xs) if mode == "exact" else F.col("message").rlike("|".join(map(re.escape, xs))),
}


def _mode(x: Column, key: str, by: str) -> Column:
    """The value that first reaches the highest frequency in order of appearance.

    Each row counts its value so far; of the rows with the greatest count the first one has the mode. Nothing is collected.
    """
    request = Window.partitionBy(key)
    seen = F.when(x.isNotNull(), F.row_number().over(Window.partitionBy(key, x).orderBy(by)))
    first = F.min(F.when(seen == F.max(seen).over(request), F.struct(F.col(by).alias("at"), x.alias("value")))).over(request)
    return first["value"]


def _quantile(x: Column, w, p: Any) -> Column:
    if not 0 <= float(p) <= 100:
        raise SelError("a percentile lies between 0 and 100")
    return F.percentile(x, float(p) / 100).over(w)


_STATISTICS = {
    "max": lambda x, w: F.max(x).over(w),
    "min": lambda x, w: F.min(x).over(w),
    "sum": lambda x, w: F.sum(x).over(w),
    "avg": lambda x, w: F.avg(x).over(w),
    "mean": lambda x, w: F.avg(x).over(w),
    "percentile": _quantile,
    "q1": lambda x, w: _quantile(x, w, 25),
    "median": lambda x, w: _quantile(x, w, 50),
    "q2": lambda x, w: _quantile(x, w, 50),
    "q3": lambda x, w: _quantile(x, w, 75),
    "iqr": lambda x, w: _quantile(x, w, 75) - _quantile(x, w, 25),
    "variance": lambda x, w: F.var_pop(x).over(w),
    "stddev": lambda x, w: F.stddev_pop(x).over(w),
    "range": lambda x, w: F.max(x).over(w) - F.min(x).over(w),
    "skewness": lambda x, w: F.when((F.count(x).over(w) >= 3) & (F.stddev_pop(x).over(w) > 0), F.skewness(x).over(w)),
    "kurtosis": lambda x, w: F.when((F.count(x).over(w) >= 4) & (F.stddev_pop(x).over(w) > 0), F.kurtosis(x).over(w)),
}


def compile_rows(text: str, rows: DataFrame, key: str = "request_id", by: str = "pos", constants: dict[str, Any] | None = None) -> Column:
    """Mask of the rows that the expression selects."""
    c = Compiler(rows.columns, key, by, constants)
    return c.rows(c.run(Parser(text).parse())).mask


def compile_value(text: str, rows: DataFrame, key: str = "request_id", by: str = "pos", constants: dict[str, Any] | None = None) -> Column:
    """Column of the value of the expression, the same for all rows of a request."""
    c = Compiler(rows.columns, key, by, constants)
    return c.column(c.run(Parser(text).parse()))


def group_condition(text: str, rows: DataFrame, key: str = "request_id", by: str = "pos", query_type: str = "") -> Callable[[Column, Column, Column, Column], Column]:
    """Condition of a group of sources for :func:`~relspark.operators.resolution.fetched_groups`, from its text.

    It sees ``previousStreams`` (the rows of the group before), ``totalStreams`` (all rows so far), ``previousGroupTimeTaken``,
    ``totalTimeTaken`` and ``queryType``, and all functions of the language. A text that can't be compiled raises here, for its
    group alone; numbers count as true unless they are 0.
    """
    tree = Parser(text).parse()

    def condition(_: Column, __: Column, previous_time: Column, total_time: Column) -> Column:
        names = {"previousStreams": Rows(F.col("_prev")), "totalStreams": Rows(F.col("_in")), "previousGroupTimeTaken": previous_time, "totalTimeTaken": total_time, "queryType": query_type}
        value = Compiler(rows.columns, key, by, names, ())
        return value.truth(value.run(tree))

    condition(F.lit(0), F.lit(0), F.lit(0), F.lit(0))
    return condition


def select_rows(rows: DataFrame, text: str, **more: Any) -> DataFrame:
    """Rows that the expression selects."""
    return rows.withColumn("_in", compile_rows(text, rows, **more)).where("_in").drop("_in")


def mark_passthrough(rows: DataFrame, text: str, key: str = "request_id", by: str = "pos", constants: dict[str, Any] | None = None) -> DataFrame:
    """Rows with what the expression's ``passthrough`` calls say of them, as ``passthrough: struct<all, stages>``.

    A call without stages sets ``all``; a call with stages adds them to the row's stages and takes ``all`` back.
    """
    c = Compiler(rows.columns, key, by, constants)
    c.rows(c.run(Parser(text).parse()))
    kind = "struct<all boolean, stages array<string>>"
    now = F.col("passthrough") if "passthrough" in rows.columns else F.lit(None).cast(kind)
    none = F.array().cast("array<string>")
    for mask, stages in c.marks:
        before = F.coalesce(F.when(~now["all"], now["stages"]), none)
        new = F.struct(F.lit(False).alias("all"), F.array_union(before, F.array(*[F.lit(x) for x in stages])).alias("stages")) if stages else F.struct(F.lit(True).alias("all"), none.alias("stages"))
        now = F.when(F.coalesce(mask, F.lit(False)), new.cast(kind)).otherwise(now)
    return rows.withColumn("passthrough", now)


def passes(stage: str, passthrough: Column, whole_source: Column | None = None) -> Column:
    """Whether a row passes a stage unseen: all of its source does, or the row for all stages or for this one."""
    own = F.coalesce(passthrough["all"] | F.array_contains(passthrough["stages"], stage), F.lit(False))
    return own if whole_source is None else own | F.coalesce(whole_source, F.lit(False))


def exclude_in_turn(rows: DataFrame, rules: list[str], **more: Any) -> DataFrame:
    """Every rule removes its rows from what the rules before it left."""
    for rule in rules:
        rows = rows.withColumn("_out", compile_rows(rule, rows, **more)).where("not _out").drop("_out")
    return rows


def require_any(rows: DataFrame, rules: list[str], **more: Any) -> DataFrame:
    """Union of what the rules select; every rule sees the rows that none before it kept."""
    kept, rest = None, rows
    for rule in rules:
        marked = rest.withColumn("_in", compile_rows(rule, rest, **more))
        got = marked.where("_in").drop("_in")
        kept = got if kept is None else kept.unionByName(got)
        rest = marked.where("not _in").drop("_in")
    return rows if kept is None else kept
