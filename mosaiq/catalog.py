"""The catalog: schemas of entities with keys, inheritance, navigations and filters."""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.paging import position
from .sources import files

Load = Callable[[SparkSession], DataFrame]
MAX_IDENTIFIER = 128
#: Never listed among a catalog's schemas.
SYSTEM_SCHEMAS = frozenset({"metadata"})


@dataclass(frozen=True)
class Navigation:
    """From an entity to another by equal columns; ``many``: to a collection.
    ``through``: (bridge entity, its columns to this side, its columns to the other)."""

    name: str
    target: str
    local: tuple[str, ...]
    remote: tuple[str, ...]
    many: bool = False
    through: tuple[str, tuple[str, ...], tuple[str, ...]] | None = None


@dataclass
class Entity:
    """A table with what is known of it.

    ``base`` and ``strategy`` tell of inheritance: ``TPH`` rows of all types
    share the base's table, told apart by ``discriminator`` (column, value);
    ``TPT`` own columns are in a table of their own, joined on the key; ``TPC``
    every concrete type has a whole table.
    """

    schema: str
    name: str
    load: Load | None = None
    sql: str | None = None
    columns: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    base: str | None = None
    strategy: str = "TPT"
    discriminator: tuple[str, Any] | None = None
    filters: list[Callable[[DataFrame], Column]] = field(default_factory=list)
    navigations: dict[str, Navigation] = field(default_factory=dict)
    abstract: bool = False
    #: The columns that say from when to when a row is valid.
    period: tuple[str, str] | None = None

    @property
    def view(self) -> str:
        return f"{self.schema}__{self.name}"


class Catalog:
    def __init__(self, spark: SparkSession, default_schema: str = "main") -> None:
        self.spark = spark
        self.default_schema = default_schema
        self.entities: dict[tuple[str, str], Entity] = {}
        self.functions: dict[str, Callable[..., Column]] = {}
        self._views: set[str] = set()

    # registration

    def add(self, entity: Entity) -> Entity:
        """Register an entity and its view. Names are unique without regard to
        case; overlong ones are cut and numbered."""
        entity.name = self._fit(entity.schema, entity.name)
        if (entity.schema.lower(), entity.name.lower()) in self.entities:
            raise ValueError(f"{entity.schema}.{entity.name} is already there")
        self.entities[entity.schema.lower(), entity.name.lower()] = entity
        return entity

    def table(self, name: str, load: Load, *, schema: str | None = None, **about: Any) -> Entity:
        return self.add(Entity(schema or self.default_schema, name, load=load, **about))

    def parquet(self, name: str, path: str, **about: Any) -> Entity:
        return self.table(name, lambda spark: spark.read.parquet(path), **about)

    def view_sql(self, name: str, sql: str, *, schema: str | None = None, **about: Any) -> Entity:
        """A view by its SQL text, which may name entities of any schema."""
        return self.add(Entity(schema or self.default_schema, name, sql=sql, **about))

    def _fit(self, schema: str, name: str) -> str:
        if len(name) <= MAX_IDENTIFIER:
            return name
        for n in range(1, 10_000):
            cut = name[: MAX_IDENTIFIER - len(str(n)) - 1] + f"~{n}"
            if (schema.lower(), cut.lower()) not in self.entities:
                return cut
        raise ValueError(f"no free name for {name[:40]}...")

    # resolution

    def find(self, name: str | Sequence[str]) -> Entity:
        parts = name.split(".") if isinstance(name, str) else list(name)
        schema, table = (".".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (self.default_schema, parts[0])
        found = self.entities.get((schema.lower(), table.lower()))
        if found is None:
            raise KeyError(f"no entity {schema}.{table}")
        return found

    def view_of(self, parts: list[str]) -> str | None:
        """The name of an entity's view, which is made when first asked for;
        None for names that are no entity's."""
        try:
            e = self.find(parts)
        except KeyError:
            return None
        if e.view.lower() not in self._views:
            self._views.add(e.view.lower())
            self.frame(e, filtered=False, narrow=True).createOrReplaceTempView(e.view)
        return e.view

    def positioned(self, view: str) -> str | None:
        """A view beside an entity's, with the rows' places in their files as
        ``__at``; None for entities that are not read from files as they are."""
        e = next((e for e in self.entities.values() if e.view.lower() == view.lower()), None)
        if e is None:
            return None
        name = f"{e.view}__placed"
        if name.lower() not in self._views:
            try:
                self.frame(e, filtered=False, narrow=True).withColumn("__at", position()).createOrReplaceTempView(name)
            except AnalysisException:
                return None
            self._views.add(name.lower())
        return name

    def period_of(self, parts: list[str]) -> tuple[str, str] | None:
        try:
            return self.find(parts).period
        except KeyError:
            return None

    def frame(self, entity: Entity | str, *, filtered: bool = True, narrow: bool = False) -> DataFrame:
        """The rows of an entity: its own and inherited columns (``narrow``:
        the declared ones only), under its filters and its base's."""
        e = self.find(entity) if isinstance(entity, str) else entity
        if e.sql is not None:
            from .plans.dialect import translate

            df = self.spark.sql(translate(e.sql, self.view_of, self.period_of))
        elif e.base is not None and e.strategy == "TPH":
            base = self.find(e.base)
            df = self.frame(base, filtered=filtered)
            if e.discriminator:
                column, value = e.discriminator
                df = df.where(F.col(column) == F.lit(value))
        elif e.load is None:
            raise ValueError(f"{e.schema}.{e.name} has no rows of its own")
        else:
            df = e.load(self.spark)
            if e.base is not None and e.strategy == "TPT" and not narrow:
                base = self.find(e.base)
                above = self.frame(base, filtered=filtered)
                own = [c for c in df.columns if c in e.key or c not in above.columns]
                df = above.join(df.select(*own), list(e.key), "inner")
        if e.columns and narrow:
            df = df.select(*e.columns)
        if filtered:
            for rule in e.filters:
                df = df.where(rule(df))
        return df

    def derived(self, entity: Entity | str) -> list[Entity]:
        """The concrete types below an entity, itself included unless abstract."""
        e = self.find(entity) if isinstance(entity, str) else entity
        below = [d for x in self.entities.values() if x.base and self.find(x.base) is e for d in self.derived(x)]
        return ([] if e.abstract else [e]) + below

    def hierarchy(self, entity: Entity | str, discriminator: str = "Discriminator") -> DataFrame:
        """All rows of a type and the types below it (TPC), told apart by ``discriminator``."""
        parts = [self.frame(d).withColumn(discriminator, F.lit(d.name)) for d in self.derived(entity)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def inherits(self, entity: Entity, base: Entity) -> bool:
        while entity.base is not None:
            entity = self.find(entity.base)
            if entity is base:
                return True
        return False

    # introspection

    def schemas(self) -> list[str]:
        return sorted({e.schema for e in self.entities.values()} - SYSTEM_SCHEMAS)

    def has_tables(self) -> bool:
        return any(e.schema not in SYSTEM_SCHEMAS for e in self.entities.values())

    def describe(self) -> DataFrame:
        """(schema, table, column, position, type, nullable, key position) of every entity."""
        rows = []
        for e in self.entities.values():
            if e.schema in SYSTEM_SCHEMAS:
                continue
            for i, f in enumerate(self.frame(e, filtered=False, narrow=e.sql is None).schema):
                rows.append((e.schema, e.name, f.name, i, f.dataType.simpleString(), f.nullable, e.key.index(f.name) if f.name in e.key else None))
        return self.spark.createDataFrame(rows, "table_schema string, table_name string, column_name string, position int, data_type string, nullable boolean, key_position int")

    # models

    @classmethod
    def from_model(cls, spark: SparkSession, model: str | dict[str, Any]) -> Catalog:
        """A catalog by its model: a dict, JSON text after ``inline:``, or a path.

        ``{"version", "defaultSchema", "schemas": [{"name", "type": "custom",
        "source", "operand", "tables": [...], "functions": "module:callable"}]}``;
        tables have ``name`` and either ``type: view`` with ``sql``, or
        ``operand`` for the schema's source."""
        if isinstance(model, str):
            model = json.loads(model[7:] if model.startswith("inline:") else Path(model).read_text())
        if "schemas" not in model:
            raise ValueError("a model needs schemas")
        catalog = cls(spark, model.get("defaultSchema") or model["schemas"][0]["name"])
        views: list[tuple[str, dict[str, Any]]] = []
        for s in model["schemas"]:
            operand = s.get("operand", {})
            if "functions" in s:
                module, _, attribute = s["functions"].partition(":")
                catalog.functions |= getattr(importlib.import_module(module), attribute)()
            for t in s.get("tables", []):
                if t.get("type") == "view":
                    views.append((s["name"], t))
                    continue
                kind = t.get("source", s.get("source", "parquet"))
                options = operand | t.get("operand", {})
                if "directory" in options and "path" not in options:
                    options["path"] = f"{options['directory']}/{t['name']}.{options.get('suffix', kind)}"
                about = {"key": tuple(t.get("key", ())), "base": t.get("base"), "strategy": t.get("strategy", "TPT")}
                catalog.table(t["name"], lambda spark, k=kind, o=options: files.read(spark, k, o), schema=s["name"], **about)
        for schema, t in views:
            sql = t["sql"] if isinstance(t["sql"], str) else "\n".join(t["sql"])
            catalog.view_sql(t["name"], sql, schema=schema)
        return catalog

    def relate(self, entity: str, navigations: Iterable[Navigation]) -> None:
        e = self.find(entity)
        e.navigations |= {n.name: n for n in navigations}
