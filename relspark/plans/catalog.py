"""All plans of the engine: importing this module fills the registry."""

from __future__ import annotations

from . import aggregates, cascades, catalogs, expressions, identity, lookups, maintenance, matching, ranking, reports, resolution, rows, selection, titles, upkeep  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

FLAGSHIP = "top_releases"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
