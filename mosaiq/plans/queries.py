"""All registered queries of the engine, and the same in SQL."""

from __future__ import annotations

from .suite import QUERIES, SQL, aggregates, changes, documents, joins, kinds, rows, scalars, services, streams, texts, windows

__all__ = ["QUERIES", "SQL"]
MODULES = (rows, joins, aggregates, windows, scalars, documents, changes, streams, texts, kinds, services)
