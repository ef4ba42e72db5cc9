"""Rewrites that need the catalog's knowledge of keys and inheritance."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame

if TYPE_CHECKING:
    from ..operators.query import Query


def inheritance_join(base: Query, derived: Query, left: str, right: str) -> DataFrame | None:
    """A type's base joined with the type, both whole, on the key: every row of
    the type is a row of the base, so the join is one scan of the type. Only
    for an untouched base and a type whose own rows hold the inherited columns
    (shared or whole tables); None where it does not apply."""
    b, d = base.entity, derived.entity
    if b is None or d is None or d.strategy not in ("TPH", "TPC") or not base.engine.catalog.inherits(d, b):
        return None
    if (left,) != b.key or (right,) != d.key or b.filters:
        return None
    whole = base.engine.catalog.frame(b, filtered=not base._ignoring)
    if not base.df.sameSemantics(whole):
        return None
    return derived.df


def drop_unused_join(query: DataFrame, left: DataFrame, wanted: list[str], unique_right_key: bool) -> DataFrame:
    """A left join to a side whose key is unique, of which no column is wanted, keeps the left rows as they are."""
    if unique_right_key and all(c in left.columns for c in wanted):
        return left.select(*wanted)
    return query.select(*wanted)
