"""A database table read behind a cursor: a data source with partitions by key, pushed filters and stored offsets.

    spark.dataSource.register(KeysetSource)
    spark.read.format("keyset").schema(...).options(module="sqlite3", connect=path, table="torrents", key="created_at,info_hash").load()
    spark.readStream.format("keyset") ...

Rows are ordered by ``key``, whose values together are unique. A read is cut into pages of that order, one partition each, so
every executor pulls its own stretch by an index range and no page is found by counting rows from the start. In a stream the
cursor is Spark's offset: it lies in the query's checkpoint, and a restart reads behind it.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith
from pyspark.sql.types import StructType

#: Rows of a page.
PAGE = 50_000
_COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Page(InputPartition):
    """Rows with ``after < key <= until``; None is no bound."""

    after: tuple | None
    until: tuple | None


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Table:
    """What a reader asks of the database: pages of a table in key order under pushed conditions."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.module, self.target = options["module"], options["connect"]
        self.table, self.size = ".".join(map(_quoted, options["table"].split("."))), int(options.get("page", PAGE))
        self.key = [k.strip() for k in options["key"].split(",")]
        self.columns = [f.name for f in schema.fields]
        self.conditions: list[tuple[str, list]] = []

    def push(self, filters: Iterable[Filter]) -> Iterator[Filter]:
        """Take over what the database can decide as Spark would; the rest goes back to Spark."""
        for f in filters:
            name = getattr(f, "attribute", ())
            column = _quoted(name[0]) if len(name) == 1 and name[0] in self.columns else None
            value = getattr(f, "value", None)
            if column and isinstance(f, IsNotNull):
                self.conditions.append((f"{column} IS NOT NULL", []))
            elif column and isinstance(f, In) and all(isinstance(v, int | str) and not isinstance(v, bool) for v in value) and value:
                self.conditions.append((f"{column} IN ({', '.join('?' * len(value))})", list(value)))
            elif column and type(f) in _COMPARED and isinstance(value, int | str) and not isinstance(value, bool):
                self.conditions.append((f"{column} {_COMPARED[type(f)]} ?", [value]))
            elif column and isinstance(f, StringStartsWith) and value:
                self.conditions.append((f"substr({column}, 1, {len(value)}) = ?", [value]))
            else:
                yield f

    def _where(self, after: tuple | None, until: tuple | None) -> tuple[str, list]:
        keys, marks = ", ".join(map(_quoted, self.key)), ", ".join("?" * len(self.key))
        found = list(self.conditions)
        if after is not None:
            found.append((f"({keys}) > ({marks})", list(after)))
        if until is not None:
            found.append((f"({keys}) <= ({marks})", list(until)))
        return (" WHERE " + " AND ".join(t for t, _ in found) if found else ""), [v for _, vs in found for v in vs]

    def _rows(self, columns: list[str], after: tuple | None, until: tuple | None, tail: str = "") -> Iterator[tuple]:
        module = importlib.import_module(self.module)
        where, values = self._where(after, until)
        text = f"SELECT {', '.join(map(_quoted, columns))} FROM {self.table}{where} ORDER BY {tail or ', '.join(map(_quoted, self.key))}"
        if module.paramstyle in ("format", "pyformat"):
            text = text.replace("%", "%%").replace("?", "%s")
        connection = module.connect(self.target)
        try:
            cursor = connection.cursor()
            cursor.execute(text, values)
            while some := cursor.fetchmany(5_000):
                yield from map(tuple, some)
        finally:
            connection.close()

    def rows(self, page: Page) -> Iterator[tuple]:
        return self._rows(self.columns, page.after, page.until)

    def last(self) -> tuple | None:
        """The greatest key; None in an empty table."""
        order = ", ".join(f"{_quoted(k)} DESC" for k in self.key) + " LIMIT 1"
        return next(self._rows(self.key, None, None, order), None)

    def pages(self, after: tuple | None, until: tuple | None) -> list[Page]:
        """The stretch in pages; each step asks for the key one page on, from the last one."""
        out, order = [], ", ".join(map(_quoted, self.key))
        while True:
            end = next(self._rows(self.key, after, until, f"{order} LIMIT 1 OFFSET {self.size - 1}"), None)
            out.append(Page(after, end or until))
            if end is None or end == until:
                return out
            after = end


class _Reader(DataSourceReader):
    def __init__(self, table: Table):
        self.table = table

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802 (Spark's name)
        return list(self.table.push(filters))

    def partitions(self) -> list[Page]:
        last = self.table.last()
        return self.table.pages(None, last) if last else []

    def read(self, partition: Page) -> Iterator[tuple]:
        return self.table.rows(partition)


class _StreamReader(DataSourceStreamReader):
    """Offsets are cursors ``{"key": [...]}``; the empty list stands before all rows.

    A batch reaches to the greatest key at its start. Rows that are written later with a smaller key are never seen, as with
    any cursor: the key must not fall behind, which a time of writing with an id does not.
    """

    def __init__(self, table: Table):
        self.table = table

    def initialOffset(self) -> dict:  # noqa: N802
        return {"key": []}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"key": list(self.table.last() or ())}

    def partitions(self, start: dict, end: dict) -> list[Page]:
        if start == end:
            return []
        return self.table.pages(tuple(start["key"]) or None, tuple(end["key"]) or None)

    def read(self, partition: Page) -> Iterator[tuple]:
        return self.table.rows(partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds the cursor; the database keeps none."""


class KeysetSource(DataSource):
    """``format("keyset")``; the schema is the caller's and names the columns to read.

    Options: ``module`` (a DB-API module), ``connect`` (its argument), ``table``, ``key`` (columns, in order), ``page`` (rows of
    a partition). Filters are pushed where ``spark.sql.python.filterPushdown.enabled`` is set.
    """

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(Table(self.options, schema))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(Table(self.options, schema))
