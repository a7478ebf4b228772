"""Queries by name over the given tables, and the SQL that returns the same rows."""

from __future__ import annotations

from shelfcast.checks import closed_forms, features, models, profiles, streams, tables, trees
from shelfcast.checks.common import Query

_PARTS = (features, profiles, tables, streams, models, closed_forms, trees)

QUERIES: dict[str, Query] = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: text for part in _PARTS for name, text in part.ORACLES.items()}
