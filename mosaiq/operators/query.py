"""The fluent builder: immutable queries over DataFrames and what the catalog knows of them."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING, Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import rewrites

if TYPE_CHECKING:
    from ..catalog import Entity, Navigation
    from ..session import Engine

Keys = str | Column | Sequence[str | Column]


def _cols(keys: Keys) -> list[Column]:
    many = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return [F.col(k) if isinstance(k, str) else k for k in many]


class Query:
    """A step gives a new query; ``df`` is its DataFrame. Orders are kept for
    ``skip``, ``take``, ``last`` and ``reverse``, and say where nulls go:
    first ascending, last descending."""

    def __init__(self, engine: Engine, df: DataFrame, entity: Entity | None = None, order: tuple[Column, ...] = (), flipped: tuple[Column, ...] = (), ignoring: bool = False) -> None:
        self.engine, self.df, self.entity = engine, df, entity
        self._order, self._flipped, self._ignoring = order, flipped, ignoring
        #: Of a left join to rows that a key tells apart: the left side alone.
        self._left_side: DataFrame | None = None

    def _with(self, df: DataFrame, *, entity: bool = True, order: bool = True) -> Query:
        return Query(self.engine, df, self.entity if entity else None, self._order if order else (), self._flipped if order else (), self._ignoring)

    def col(self, name: str) -> Column:
        return self.df[name]

    # predicates

    def eq(self, a: Column, b: Any) -> Column:
        """Equality of the fluent surface: null equals null, unless the engine has relational nulls."""
        b = b if isinstance(b, Column) else F.lit(b)
        return a == b if self.engine.relational_nulls else a.eqNullSafe(b)

    def ne(self, a: Column, b: Any) -> Column:
        b = b if isinstance(b, Column) else F.lit(b)
        return a != b if self.engine.relational_nulls else ~a.eqNullSafe(b)

    def where(self, *predicates: Column | str) -> Query:
        df = self.df
        for p in predicates:
            df = df.where(p)
        return self._with(df)

    def ignore_filters(self) -> Query:
        """The entity's rows without its filters; first in a chain."""
        if self.entity is None:
            raise ValueError("only an entity has filters")
        return Query(self.engine, self.engine.catalog.frame(self.entity, filtered=False), self.entity, ignoring=True)

    def tag_with(self, tag: str) -> Query:
        """The same rows; the plan says ``tag``, so a query is found in explanations and in the cluster's listing."""
        return self._with(self.df.alias(tag))

    # projection

    def select(self, *columns: str | Column, **named: Column) -> Query:
        """The given columns. A left join whose right side they leave out, and
        which cannot repeat rows, is not made."""
        if self._left_side is not None and not named and all(isinstance(c, str) for c in columns):
            return self._with(rewrites.drop_unused_join(self.df, self._left_side, list(columns), True), entity=False)
        return self._with(self.df.select(*columns, *[c.alias(n) for n, c in named.items()]), entity=False)

    def extend(self, **named: Column) -> Query:
        return self._with(self.df.withColumns(named))

    def distinct(self) -> Query:
        return self._with(self.df.distinct(), order=False)

    def select_many(self, collection: str | Column, alias: str = "item", keep_empty: bool = False) -> Query:
        """A row for each element; ``keep_empty``: a null one for none."""
        explode = F.explode_outer if keep_empty else F.explode
        return self._with(self.df.select("*", explode(collection).alias(alias)), order=False)

    def default_if_empty(self) -> Query:
        """The rows, or a row of nulls if there are none."""
        one = self.engine.spark.range(1).select(F.lit(1).alias("__one"))
        rows = self.df.withColumn("__one", F.lit(1))
        return self._with(one.join(rows, "__one", "left").drop("__one"), order=False)

    # joins

    def _other(self, other: Query | DataFrame) -> DataFrame:
        return other.df if isinstance(other, Query) else other

    def join(self, other: Query | DataFrame, left: Keys, right: Keys, how: str = "inner") -> Query:
        """Join on pairs of keys, columns or expressions. A type joined on its key
        with its base is one scan of the type (its rows hold the base's)."""
        if how == "inner" and isinstance(other, Query) and isinstance(left, str) and isinstance(right, str):
            merged = rewrites.inheritance_join(self, other, left, right)
            if merged is not None:
                return Query(self.engine, merged, other.entity)
        b = self._other(other)
        lefts = [self.df[k] if isinstance(k, str) else k for k in ([left] if isinstance(left, (str, Column)) else left)]
        rights = [b[k] if isinstance(k, str) else k for k in ([right] if isinstance(right, (str, Column)) else right)]
        if len(lefts) != len(rights):
            raise ValueError("as many keys on either side, please")
        out = self._with(self.df.join(b, [x == y for x, y in zip(lefts, rights)], how), entity=False, order=False)
        if how == "left" and isinstance(other, Query) and other.entity is not None and tuple(_listed(right)) == other.entity.key:
            out._left_side = self.df
        return out

    def left_join(self, other: Query | DataFrame, left: Keys, right: Keys) -> Query:
        return self.join(other, left, right, "left")

    def join_on(self, other: Query | DataFrame, condition: Column, how: str = "inner") -> Query:
        return self._with(self.df.join(self._other(other), condition, how), entity=False, order=False)

    def cross(self, other: Query | DataFrame) -> Query:
        return self._with(self.df.crossJoin(self._other(other)), entity=False, order=False)

    def group_join(self, other: Query | DataFrame, left: str, right: str, into: str = "inners") -> Query:
        """Each row with the array of its matches, sorted, empty for none."""
        b = self._other(other)
        groups = b.groupBy(F.col(right).alias("__key")).agg(F.array_sort(F.collect_list(F.struct(*b.columns))).alias(into))
        joined = self.df.join(groups, self.df[left] == groups["__key"], "left").drop("__key")
        return self._with(joined.withColumn(into, F.coalesce(into, F.array())), order=False)

    def where_exists(self, other: Query | DataFrame, left: Keys, right: Keys, negate: bool = False) -> Query:
        b = self._other(other)
        pairs = [x == y for x, y in zip([self.df[k] if isinstance(k, str) else k for k in _listed(left)], [b[k] if isinstance(k, str) else k for k in _listed(right)])]
        return self._with(self.df.join(b, pairs, "left_anti" if negate else "left_semi"))

    # navigation

    def navigate(self, path: str, keep: bool = False) -> Query:
        """The rows with those that a navigation, or a dotted path of them,
        leads to; ``keep``: also rows that it leads nowhere from. A column whose
        name is taken is named ``<path>_<column>``, with underscores for dots."""
        if self.entity is None:
            raise KeyError(f"no navigation {path!r}")
        out, entity, names = self.df, self.entity, {c: c for c in self.df.columns}
        how, done = "left" if keep else "inner", ""
        for step in path.split("."):
            n = self._navigation(step, entity)
            done = f"{done}_{step}" if done else step
            entity = self.engine.catalog.find(n.target)
            there = self.engine.catalog.frame(entity, filtered=not self._ignoring)
            local = [names[a] for a in n.local]
            names = {c: _name(c, out, done) for c in there.columns}
            if n.through:
                bridge_name, here_keys, there_keys = n.through
                bridge = self.engine.catalog.frame(bridge_name).select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(here_keys)], *[F.col(c).alias(f"__r{i}") for i, c in enumerate(there_keys)]).distinct()
                out = out.join(bridge, [out[a] == bridge[f"__l{i}"] for i, a in enumerate(local)], how)
                local = [f"__r{i}" for i in range(len(n.remote))]
            there = _renamed(there, out, done)
            out = out.join(there, [out[a] == there[names[b]] for a, b in zip(local, n.remote)], how)
            out = out.drop(*[c for c in out.columns if c.startswith(("__l", "__r"))])
        return Query(self.engine, out)

    def include(self, path: str) -> Query:
        """Each row with the rows that a navigation leads to, nested: an array
        for a collection, a struct or null for a reference. A dotted path nests
        what its steps lead to. All that a row leads to comes to one task; where
        only numbers of it are wanted, see :meth:`include_counts`."""
        name, _, rest = path.partition(".")
        n = self._navigation(name, self.entity)
        target = self.engine.catalog.find(n.target)
        there = self.engine.catalog.frame(target, filtered=not self._ignoring)
        if rest:
            there = Query(self.engine, there, target, ignoring=self._ignoring).include(rest).df
        nested = F.struct(*there.columns)
        remote = list(n.remote)
        if n.through:
            there, remote = self._bridged(n, there)
        value = F.array_sort(F.collect_list(nested)) if n.many else F.first(nested)
        groups = there.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(remote)]).agg(value.alias(name))
        joined = self.df.join(groups, [self.df[a] == groups[f"__k{i}"] for i, a in enumerate(n.local)], "left")
        out = joined.drop(*[f"__k{i}" for i in range(len(remote))])
        return self._with(out.withColumn(name, F.coalesce(name, F.array())) if n.many else out)

    def include_counts(self, path: str, **named: str) -> Query:
        """Each row with how many rows the steps of a dotted path lead to, where
        only the numbers of what ``include`` nests are wanted: ``named`` gives a
        column's name to a step's part of the path. No row is nested: rows are
        counted by key, step by step from the last, and the counts summed."""
        steps = path.split(".")
        wanted = {".".join(steps[: i + 1]): None for i in range(len(steps))}
        if not set(named.values()) <= set(wanted):
            raise KeyError(f"only {', '.join(wanted)} can be counted")
        out = self._counted(self.entity, self.df, steps)
        counts = {p: F.col(f"__n{i}") for i, p in enumerate(wanted)}
        kept = out.select(*self.df.columns, *[counts[p].alias(n) for n, p in named.items()])
        return self._with(kept)

    def _counted(self, entity: Entity | None, df: DataFrame, steps: list[str], depth: int = 0) -> DataFrame:
        """``df`` with ``__n<depth>`` and on: how many rows each of the steps leads to."""
        n = self._navigation(steps[0], entity)
        target = self.engine.catalog.find(n.target)
        there = self.engine.catalog.frame(target, filtered=not self._ignoring)
        below = [f"__n{depth + i}" for i in range(1, len(steps))]
        if below:
            there = self._counted(target, there, steps[1:], depth + 1)
        remote = list(n.remote)
        if n.through:
            there, remote = self._bridged(n, there)
        own = F.count(F.lit(1))
        if not n.many:  # a reference nests one row
            there, own = there.dropDuplicates(remote), F.lit(1).cast("bigint")
        counts = [own.alias(f"__n{depth}"), *[F.sum(c).alias(c) for c in below]]
        groups = there.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(remote)]).agg(*counts)
        joined = df.join(groups, [df[a] == groups[f"__k{i}"] for i, a in enumerate(n.local)], "left")
        return joined.select(*df.columns, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in (f"__n{depth}", *below)])

    def _bridged(self, n: Navigation, there: DataFrame) -> tuple[DataFrame, list[str]]:
        """A navigation's far rows by the keys of its bridge, and these."""
        bridge_name, here_keys, there_keys = n.through
        bridge = self.engine.catalog.frame(bridge_name).select(*[F.col(c).alias(f"__l{i}") for i, c in enumerate(here_keys)], *[F.col(c).alias(f"__r{i}") for i, c in enumerate(there_keys)]).distinct()
        return there.join(bridge, [there[b] == bridge[f"__r{i}"] for i, b in enumerate(n.remote)]), [f"__l{i}" for i in range(len(here_keys))]

    def split_include(self, name: str) -> tuple[DataFrame, DataFrame]:
        """The rows, and in a query of its own the rows that the navigation leads to."""
        n = self._navigation(name, self.entity)
        there = self.engine.catalog.frame(n.target)
        keys = self.df.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(n.local)]).distinct()
        related = there.join(keys, [there[b] == keys[f"__k{i}"] for i, b in enumerate(n.remote)], "left_semi")
        return self.df, related

    def _navigation(self, name: str, entity: Entity | None):
        if entity is None or name not in entity.navigations:
            raise KeyError(f"no navigation {name!r}")
        return entity.navigations[name]

    def of_type(self, entity: str) -> Query:
        """The rows that are of a type below this one."""
        e = self.engine.catalog.find(entity)
        if self.entity is None or not (e is self.entity or self.engine.catalog.inherits(e, self.entity)):
            raise ValueError(f"{entity} is not below this type")
        if e.strategy == "TPH" and e.discriminator:
            return Query(self.engine, self.df.where(F.col(e.discriminator[0]) == F.lit(e.discriminator[1])), e)
        return self.engine.set(entity)

    # aggregation

    def group_by(self, *keys: str | Column) -> Grouped:
        return Grouped(self, self.df.groupBy(*keys))

    def rollup(self, *keys: str | Column) -> Grouped:
        return Grouped(self, self.df.rollup(*keys))

    def cube(self, *keys: str | Column) -> Grouped:
        return Grouped(self, self.df.cube(*keys))

    def agg(self, **named: Column) -> Query:
        """Over all rows: one row, also over none."""
        return self._with(self.df.agg(*[c.alias(n) for n, c in named.items()]), entity=False, order=False)

    # order and paging

    def order_by(self, *keys: str | Column, descending: bool = False) -> Query:
        return self._ordered((), (), keys, descending)

    def then_by(self, *keys: str | Column, descending: bool = False) -> Query:
        if not self._order:
            raise ValueError("then_by comes after order_by")
        return self._ordered(self._order, self._flipped, keys, descending)

    def _ordered(self, order: tuple, flipped: tuple, keys: Sequence[str | Column], descending: bool) -> Query:
        up = tuple(c.asc_nulls_first() for c in _cols(list(keys)))
        down = tuple(c.desc_nulls_last() for c in _cols(list(keys)))
        now, turned = (order + down, flipped + up) if descending else (order + up, flipped + down)
        return Query(self.engine, self.df.orderBy(*now), self.entity, now, turned, self._ignoring)

    def reverse(self) -> Query:
        if not self._order:
            raise ValueError("only an ordered query can be reversed")
        return Query(self.engine, self.df.orderBy(*self._flipped), self.entity, self._flipped, self._order, self._ignoring)

    def skip(self, n: int) -> Query:
        return self._with(self.df.offset(n))

    def take(self, n: int) -> Query:
        return self._with(self.df.limit(n))

    def take_by(self, n: int, keys: Sequence[str], *order: Column) -> Query:
        """The first ``n`` rows for each key."""
        w = Window.partitionBy(*keys).orderBy(*order)
        return self._with(self.df.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).drop("__n"), order=False)

    # set operations

    def union(self, *others: Query | DataFrame) -> Query:
        return self.concat(*others).distinct()

    def concat(self, *others: Query | DataFrame) -> Query:
        df = self.df
        for o in others:
            df = df.union(self._other(o))
        return self._with(df, order=False)

    def intersect(self, other: Query | DataFrame, all: bool = False) -> Query:  # noqa: A002
        b = self._other(other)
        return self._with(self.df.intersectAll(b) if all else self.df.intersect(b), order=False)

    def except_(self, other: Query | DataFrame, all: bool = False) -> Query:  # noqa: A002
        b = self._other(other)
        return self._with(self.df.exceptAll(b) if all else self.df.subtract(b), order=False)

    # ends

    def count(self) -> int:
        return self.df.count()

    def any(self, predicate: Column | None = None) -> bool:
        return not (self.df if predicate is None else self.df.where(predicate)).isEmpty()

    def all(self, predicate: Column) -> bool:
        return self.df.where(~F.coalesce(predicate, F.lit(False))).isEmpty()

    def contains(self, column: str, value: Any) -> bool:
        return self.any(self.eq(self.df[column], value))

    def first(self) -> Any:
        rows = self.take(1).rows()
        if not rows:
            raise LookupError("no rows")
        return rows[0]

    def first_or_default(self) -> Any:
        rows = self.take(1).rows()
        return rows[0] if rows else None

    def single(self) -> Any:
        rows = self.take(2).rows()
        if len(rows) != 1:
            raise LookupError("no rows" if not rows else "more than one row")
        return rows[0]

    def last(self) -> Any:
        return self.reverse().first()

    def element_at(self, n: int) -> Any:
        return self.skip(n).first()

    def rows(self) -> list:
        return [self.engine.materialized(r) for r in self.df.collect()]

    def stream(self):
        """Rows one partition at a time."""
        return (self.engine.materialized(r) for r in self.df.toLocalIterator())


def _listed(keys: Keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def _name(column: str, other: DataFrame, prefix: str) -> str:
    return f"{prefix}_{column}" if column in other.columns else column


def _renamed(df: DataFrame, other: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(_name(c, other, prefix)) for c in df.columns])


class Grouped:
    def __init__(self, query: Query, grouped: Any) -> None:
        self.query, self.grouped = query, grouped

    def agg(self, **named: Column) -> Query:
        return self.query._with(self.grouped.agg(*[c.alias(n) for n, c in named.items()]), entity=False, order=False)
