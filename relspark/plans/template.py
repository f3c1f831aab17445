"""The template language, compiled to one string column.

``{section.name::modifier::..}`` shows a value; a conditional modifier followed by ``["yes"||"no"]`` chooses between two
templates, and comparators join several of them strictly from the left. Unknown names and modifiers show themselves.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import formatting as fm

MAX_DEPTH = 5
_JOINERS = ("and", "or", "xor", "neq", "equal", "left", "right")


def _split(text: str, mark: str) -> list[str]:
    """Split at a mark outside quotes, brackets and braces."""
    out, depth, quote, last, i = [], 0, "", 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "[{(":
            depth += 1
        elif c in "]})":
            depth -= 1
        elif depth == 0 and text.startswith(mark, i):
            out.append(text[last:i])
            i += len(mark)
            last = i
            continue
        i += 1
    return [*out, text[last:]]


def _chunks(template: str) -> list[tuple[bool, str]]:
    """Literal runs and the insides of balanced braces."""
    out, depth, start = [], 0, 0
    for i, c in enumerate(template):
        if c == "{":
            if depth == 0:
                out.append((False, template[start:i]))
                start = i + 1
            depth += 1
        elif c == "}" and depth:
            depth -= 1
            if depth == 0:
                out.append((True, template[start:i]))
                start = i + 1
    return [*out, (False, ("{" if depth else "") + template[start:])]


def _rate(x: Column, rounded: bool) -> Column:
    return F.regexp_replace(fm.format_bytes(F.greatest(x, F.lit(0.0)), 1000, rounded), "B$", "bps")


def _stars(x: Column, padded: bool) -> Column:
    """A star for each 20 of 100, half a one from a rest of 10 on, and hollow ones up to five where ``padded``."""
    full, half = F.floor(x / 20).cast("int"), F.when(x % 20 >= 10, 1).otherwise(0)
    marks = [F.repeat(F.lit("★"), full), F.repeat(F.lit("⯪"), half)]
    return F.concat(*marks, *([F.repeat(F.lit("☆"), 5 - full - half)] if padded else []))


class Template:
    """Compiler over a mapping ``section.name -> (column, kind)`` with kind ``text``, ``number``, ``flag`` or ``list``."""

    def __init__(self, fields: dict[str, tuple[Column, str]]):
        self.fields = fields

    def compile(self, template: str, depth: int = 0) -> Column:
        """Column of the rendered text; at depth 0 blank lines go, and so do lines that hold ``{tools.removeLine}``."""
        if depth > MAX_DEPTH:
            raise ValueError("templates are nested too deep")
        text = template.replace("{tools.newLine}", "\n") if depth == 0 else template
        parts = [self.expression(body, depth) if dynamic else F.lit(body) for dynamic, body in _chunks(text) if dynamic or body]
        out = F.concat(*parts) if parts else F.lit("")
        if depth == 0:
            lines = F.filter(F.split(out, "\n"), lambda x: (F.trim(x) != "") & ~x.contains("\u0000"))
            out = F.array_join(lines, "\n")
        return out

    def expression(self, body: str, depth: int) -> Column:
        if body == "tools.removeLine":
            return F.lit("\u0000")
        m = re.fullmatch(r"(.*?)\[\s*([\"'].*)\]\s*", body, re.S)
        choice = None
        if m:
            choice = [c.strip()[1:-1] for c in _split(m[2], "||")]
            body = m[1]
        steps = _split(body, "::")
        values: list[tuple[Column, str]] = []
        joiners: list[str] = []
        for step in steps:
            if step in _JOINERS and values:
                joiners.append(step)
            elif len(values) == len(joiners):
                if step not in self.fields:
                    return F.lit(f"{{unknown_propertyName({step})}}")
                values.append(self.fields[step])
            else:
                changed = self.modify(values[-1], step)
                if changed is None:
                    return F.lit(f"{{unknown_modifier({step})}}")
                values[-1] = changed
        value, kind = values[0]
        for joiner, (other, other_kind) in zip(joiners, values[1:], strict=True):
            value, kind = self.join(joiner, value, other, kind, other_kind)
        if choice is None:
            return self.shown(value, kind)
        yes, no = (self.compile(c, depth + 1) for c in (*choice, "", "")[:2])
        return F.when(F.coalesce(self.truth(value, kind), F.lit(False)), yes).otherwise(no)

    def truth(self, value: Column, kind: str) -> Column:
        if kind == "flag":
            return value
        return F.size(value) > 0 if kind == "list" else F.length(value.cast("string")) > 0

    def shown(self, value: Column, kind: str) -> Column:
        if kind == "list":
            return F.coalesce(F.array_join(value, ", "), F.lit(""))
        if kind == "number":
            whole = value == F.floor(value)
            return F.coalesce(F.when(whole, value.cast("long").cast("string")).otherwise(value.cast("string")), F.lit(""))
        return F.coalesce(value.cast("string"), F.lit(""))

    def join(self, joiner: str, a: Column, b: Column, kind: str, other: str) -> tuple[Column, str]:
        if joiner in ("left", "right"):
            return (a, kind) if joiner == "left" else (b, other)
        if joiner in ("equal", "neq"):
            same = a.cast("string").eqNullSafe(b.cast("string"))
            return (same if joiner == "equal" else ~same), "flag"
        x, y = F.coalesce(self.truth(a, kind), F.lit(False)), F.coalesce(self.truth(b, other), F.lit(False))
        return {"and": x & y, "or": x | y, "xor": x != y}[joiner], "flag"

    def modify(self, field: tuple[Column, str], step: str) -> tuple[Column, str] | None:
        x, kind = field
        call = re.fullmatch(r"(\w+)\((.*)\)", step, re.S)
        if call:
            args = [a.strip() for a in _split(call[2], ",")]
            args = [a[1:-1] if a[:1] in "'\"" else a for a in args]
            return self.modify_with(field, call[1], args)
        name = step.lower()
        if name == "exists":
            there = x.rlike(r"\S") if kind == "text" else self.truth(x, "text" if kind == "flag" else kind)
            return (F.coalesce(there, F.lit(False)), "flag")
        if kind == "flag" and name in ("istrue", "isfalse"):
            flag = F.coalesce(x, F.lit(False))
            return (flag if name == "istrue" else ~flag, "flag")
        if step[:1] in "$^~=><" and step[:1]:
            return self.compare(field, step)
        if kind == "text":
            made = {"upper": F.upper, "lower": F.lower, "title": F.initcap, "reverse": F.reverse, "string": lambda c: c, "smallcaps": fm.small_caps, "base64": lambda c: F.base64(c.cast("binary"))}
            return (made[name](x), "text") if name in made else (F.length(x), "number") if name == "length" else None
        if kind == "list":
            made = {"first": lambda c: F.try_element_at(c, F.lit(1)), "last": lambda c: F.try_element_at(c, F.lit(-1)), "string": lambda c: F.array_join(c, ", "), "random": lambda c: F.try_element_at(c, F.lit(1))}
            lists = {"sort": F.array_sort, "lsort": F.array_sort, "rsort": lambda c: F.sort_array(c, asc=False), "reverse": F.reverse}
            return (made[name](x), "text") if name in made else (lists[name](x), "list") if name in lists else (F.size(x), "number") if name == "length" else None
        if kind == "number":
            n = x.cast("long")
            made = {
                "comma": lambda: F.format_number(n, 0), "hex": lambda: F.lower(F.hex(n)), "octal": lambda: F.conv(n.cast("string"), 10, 8), "binary": lambda: F.bin(n), "string": lambda: self.shown(x, "number"),
                "bytes": lambda: fm.format_bytes(x), "bytes10": lambda: fm.format_bytes(x), "bytes2": lambda: fm.format_bytes(x, 1024), "time": lambda: fm.format_duration(x),
                "rbytes": lambda: fm.format_bytes(x, 1000, True), "rbytes10": lambda: fm.format_bytes(x, 1000, True), "rbytes2": lambda: fm.format_bytes(x, 1024, True),
                "sbytes": lambda: fm.smart_bytes(x), "sbytes10": lambda: fm.smart_bytes(x), "sbytes2": lambda: fm.smart_bytes(x, 1024),
                "bitrate": lambda: _rate(x, False), "rbitrate": lambda: _rate(x, True), "sbitrate": lambda: fm.smart_bitrate(x), "star": lambda: _stars(x, False), "pstar": lambda: _stars(x, True),
            }
            return (made[name](), "text") if name in made else None
        return None

    def modify_with(self, field: tuple[Column, str], name: str, args: list[str]) -> tuple[Column, str] | None:
        x, kind = field
        if name == "join" and kind == "list":
            return F.array_join(x, args[0] if args else ""), "text"
        if name == "slice" and kind == "list":
            return F.slice(x, F.lit(int(args[0]) + 1), F.greatest(F.lit(int(args[1]) - int(args[0])) if len(args) > 1 else F.size(x) - int(args[0]), F.lit(0))), "list"
        if kind != "text":
            return None
        if name == "replace" and len(args) == 2:
            return F.replace(x, F.lit(args[0]), F.lit(args[1])), "text"
        if name == "truncate":
            n = int(args[0])
            return F.when(F.length(x) > n, F.concat(F.left(x, F.lit(n)), F.lit("…"))).otherwise(x), "text"
        if name == "slice":
            return F.substring(x, int(args[0]) + 1, (int(args[1]) - int(args[0])) if len(args) > 1 else 1 << 20), "text"
        return None

    def compare(self, field: tuple[Column, str], step: str) -> tuple[Column, str]:
        x, kind = field
        op = next(o for o in (">=", "<=", ">", "<", "=", "$", "^", "~") if step.startswith(o))
        arg = step[len(op) :]
        if kind == "list":
            hit = F.array_contains(x, arg) if op in ("=", "~") else F.lit(False)
            return F.coalesce(hit, F.lit(False)), "flag"
        text = F.lower(self.shown(x, kind))
        if op in ("$", "^", "~"):
            hit = {"$": text.startswith, "^": text.endswith, "~": text.contains}[op](arg.lower())
            return hit, "flag"
        try:
            number = float(arg)
            left = x.cast("double") if kind == "number" else F.expr("cast(null as double)")
            if kind == "text":
                left = x.try_cast("double")
            hit = {">=": left >= number, "<=": left <= number, ">": left > number, "<": left < number, "=": left == number}[op]
            return F.coalesce(hit, F.lit(False)), "flag"
        except ValueError:
            low = arg.lower()
            return {">=": text >= low, "<=": text <= low, ">": text > low, "<": text < low, "=": text == low}[op], "flag"
