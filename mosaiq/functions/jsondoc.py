"""JSON documents in string columns: paths, values, partial updates, typed materialisation."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .compat import json_path, json_value

__all__ = ["Collection", "array_ops", "document", "json_path", "json_value", "materialize", "set_value", "steps"]


def steps(path: str) -> list[str | int]:
    """``$.a[0].b`` as ['a', 0, 'b']."""
    body = json_path(path)
    if not body.startswith("$"):
        raise ValueError(f"a path starts with $: {path}")
    out: list[str | int] = []
    for m in re.finditer(r"\.(\w+)|\.\"([^\"]*)\"|\[(\d+)\]|\['([^']*)'\]", body[1:]):
        out.append(int(m[3]) if m[3] is not None else next(x for x in (m[1], m[2], m[4]) if x is not None))
    return out


def document(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def materialize(doc: Column, schema: str) -> Column:
    """The document as a struct or an array of a declared schema; null for malformed text."""
    return F.from_json(doc, schema)


def element(doc: Column, schema: str, index: Any) -> Column:
    """An element of a JSON array at an index from 0, which may be a column; null outside."""
    i = index if isinstance(index, Column) else F.lit(index)
    return F.get(F.from_json(doc, schema), i)


def _as_json(value: Column) -> Column:
    """A scalar as JSON text."""
    inside = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(inside, F.lit(2), F.char_length(inside) - 2)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _set(doc: Column, path: list[str | int], new: Column) -> Column:
    """JSON text with the text ``new`` at ``path``; what is not on the path stays."""
    if not path:
        return new
    head, rest = path[0], path[1:]
    inner = lambda v: F.parse_json(_set(F.to_json(v), rest, new) if rest else new)
    if isinstance(head, int):
        items = F.from_json(doc, "array<variant>")
        return F.coalesce(F.to_json(F.transform(items, lambda v, i: F.when(i == head, inner(v)).otherwise(v))), doc)

    def replaced(fields: Column) -> Column:
        there = F.transform_values(fields, lambda k, v: F.when(k == head, inner(v)).otherwise(v))
        absent = F.parse_json(new) if not rest else F.parse_json(_set(F.lit("{}"), rest, new))
        return F.when(F.map_contains_key(fields, head), there).otherwise(F.map_concat(fields, F.create_map(F.lit(head), absent)))

    return F.coalesce(F.to_json(_let(F.from_json(doc, "map<string,variant>"), replaced)), doc)


def set_value(doc: Column, path: str, new: Any) -> Column:
    """The document with the scalar at ``path`` replaced, or added to its
    object; everything else is kept, declared or not. Null documents stay
    null; an index outside an array changes nothing."""
    new = new if isinstance(new, Column) else F.lit(new)
    return F.when(doc.isNotNull(), _set(doc, steps(path), F.coalesce(_as_json(new), F.lit("null"))))


@dataclass(frozen=True)
class Collection:
    """A JSON array inside a document as a collection: its operations stay in
    the row that the document is in."""

    values: Column

    @classmethod
    def of(cls, doc: Column, schema: str, path: str = "$") -> Collection:
        """The array at ``path`` of a declared schema; without one, empty."""
        inside = doc if json_path(path) == "$" else F.get_json_object(doc, json_path(path))
        values = F.from_json(inside, schema)
        return cls(F.coalesce(values, F.array().cast(schema)))

    def where(self, test: Callable[[Column], Column]) -> Collection:
        return Collection(F.filter(self.values, test))

    def select(self, body: Callable[[Column], Column]) -> Collection:
        return Collection(F.transform(self.values, body))

    def select_many(self, body: Callable[[Column], Column]) -> Collection:
        return Collection(F.flatten(F.transform(self.values, body)))

    def distinct(self) -> Collection:
        return Collection(F.array_distinct(self.values))

    def group_by(self, key: Callable[[Column], Column]) -> Collection:
        """(``key``, ``items``) for each key, in the order of their first items."""
        keys = F.array_distinct(F.transform(self.values, key))
        return Collection(F.transform(keys, lambda k: F.struct(k.alias("key"), F.filter(self.values, lambda x: key(x).eqNullSafe(k)).alias("items"))))

    def order_by(self, key: Callable[[Column], Column]) -> Collection:
        pairs = F.transform(self.values, lambda x: F.struct(key(x).alias("key"), x.alias("item")))
        return Collection(F.transform(F.array_sort(pairs), lambda p: p["item"]))

    def skip(self, n: int) -> Collection:
        return Collection(F.slice(self.values, n + 1, F.greatest(F.size(self.values) - n, F.lit(0))))

    def take(self, n: int) -> Collection:
        return Collection(F.slice(self.values, 1, n))

    def any(self, test: Callable[[Column], Column] | None = None) -> Column:
        return F.size(self.values) > 0 if test is None else F.exists(self.values, test)

    def all(self, test: Callable[[Column], Column]) -> Column:
        return F.forall(self.values, test)

    def contains(self, value: Any) -> Column:
        return F.array_contains(self.values, value)

    def count(self) -> Column:
        return F.size(self.values)

    def element_at(self, index: Any) -> Column:
        return F.get(self.values, index if isinstance(index, Column) else F.lit(index))

    def sum(self, body: Callable[[Column], Column] = lambda x: x, kind: str = "bigint") -> Column:
        return F.aggregate(self.values, F.lit(0).cast(kind), lambda a, x: a + F.coalesce(body(x), F.lit(0)).cast(kind))


def array_ops(doc: Column, schema: str) -> dict[str, Column]:
    """Count, sum, largest and distinct elements of a JSON array of numbers."""
    values = F.from_json(doc, schema)
    return {
        "count": F.size(values),
        "sum": F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x),
        "max": F.array_max(values),
        "distinct": F.array_sort(F.array_distinct(values)),
    }
