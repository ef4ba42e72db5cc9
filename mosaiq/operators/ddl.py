"""Schemas and tables: creation, an ordered migration runner, and what is accepted without effect."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..types import spark_type
from .dml import ManagedTable, Store

#: The folder of what is recorded beside the schemas.
RECORDS = "_records"

#: Operations that the engine accepts and skips with a warning.
IGNORED = frozenset(
    "alter_column alter_sequence create_index drop_index rename_index add_foreign_key drop_foreign_key add_primary_key drop_primary_key "
    "add_unique_constraint drop_unique_constraint add_check_constraint drop_check_constraint create_sequence drop_sequence".split()
)


@dataclass
class Database:
    """Managed tables in folders below ``root``, by schema. Tables that are
    there already, from another process, are opened."""

    spark: SparkSession
    root: str
    tables: dict[tuple[str, str], ManagedTable] = field(default_factory=dict)
    schemas: set[str] = field(default_factory=lambda: {"main"})

    def __post_init__(self) -> None:
        self.store = Store(self.spark)
        dropped = set(self.store.names(f"{self.root}/{RECORDS}/dropped"))
        for schema in self.store.names(self.root):
            if schema == RECORDS:
                continue
            self.schemas.add(schema)
            for name in self.store.names(f"{self.root}/{schema}"):
                if f"{schema}.{name}" not in dropped and self.store.names(f"{self.root}/{schema}/{name}/manifests"):
                    self.tables[schema, name] = ManagedTable(self.spark, f"{self.root}/{schema}/{name}")

    def table(self, name: str, schema: str = "main") -> ManagedTable:
        try:
            return self.tables[schema, name]
        except KeyError:
            raise LookupError(f"no table {schema}.{name}") from None

    def create_schema(self, name: str) -> None:
        """Create a schema if it is not there."""
        self.schemas.add(name)

    def create_table(self, name: str, columns: Sequence[tuple[str, str] | tuple[str, str, bool]], *, schema: str = "main", key: Sequence[str] = (), token: str | None = None, **constraints: Any) -> ManagedTable:
        """Create a table of (name, type[, nullable]) columns. Other constraints than the key are ignored."""
        for c in constraints:
            warnings.warn(f"{c} of {name} is not enforced", stacklevel=2)
        if (schema, name) in self.tables:
            raise ValueError(f"table {schema}.{name} is already there")
        self.schemas.add(schema)
        fields = ", ".join(f"`{c[0]}` {spark_type(c[1])}" for c in columns)
        empty = self.spark.createDataFrame([], fields).schema
        made = T.StructType([T.StructField(f.name, f.dataType, c[2] if len(c) > 2 else True) for f, c in zip(empty, columns)])
        table = ManagedTable(self.spark, f"{self.root}/{schema}/{name}", made, key=tuple(key), token=token)
        self.tables[schema, name] = table
        return table

    def drop_table(self, name: str, schema: str = "main") -> None:
        """Forget a table, for good; its files stay."""
        del self.tables[schema, name]
        self.store.create(f"{self.root}/{RECORDS}/dropped/{schema}.{name}", "")

    def add_column(self, name: str, column: str, kind: str, schema: str = "main") -> None:
        """Add a nullable column; rows that are there hold null."""
        t = self.tables[schema, name]
        added = self.spark.createDataFrame([], f"`{column}` {spark_type(kind)}").schema
        t.schema = T.StructType([*t.schema.fields, *added.fields])
        t._commit(t.files)

    def exists(self) -> bool:
        return True

    def has_tables(self) -> bool:
        return any(s != "metadata" for s, _ in self.tables)

    def scaffold(self) -> list[dict[str, Any]]:
        """Every table as a model: columns, types and key."""
        return [
            {"schema": s, "name": n, "columns": [(f.name, f.dataType.simpleString(), f.nullable) for f in t.schema], "key": list(t.key)}
            for (s, n), t in sorted(self.tables.items())
        ]


@dataclass
class Migration:
    name: str
    operations: list[tuple[str, dict[str, Any]]]


@dataclass
class Runner:
    """Runs the operations of migrations in order. What is done is recorded
    beside the tables, one file for each operation, so a run that failed, also
    in another process, goes on from the operation that failed."""

    database: Database
    log: list[str] = field(default_factory=list)

    def done(self, migration: str) -> int:
        return len(self.database.store.names(f"{self.database.root}/{RECORDS}/migrations/{migration}"))

    def run(self, migrations: Iterable[Migration]) -> None:
        for m in migrations:
            done = self.done(m.name)
            for i, (kind, options) in enumerate(m.operations):
                if i < done:
                    continue
                self._apply(kind, options)
                self.database.store.create(f"{self.database.root}/{RECORDS}/migrations/{m.name}/{i:06d}", kind)
                self.log.append(f"{m.name}:{kind}")

    def _apply(self, kind: str, options: dict[str, Any]) -> None:
        if kind in IGNORED:
            warnings.warn(f"{kind} has no effect", stacklevel=3)
            return
        if kind == "insert":
            options = dict(options)
            self.database.tables[options.pop("schema", "main"), options.pop("table")].insert(options["rows"])
            return
        step: Callable[..., Any] | None = {
            "create_schema": self.database.create_schema,
            "create_table": self.database.create_table,
            "drop_table": self.database.drop_table,
            "add_column": self.database.add_column,
        }.get(kind)
        if step is None:
            raise ValueError(f"unknown operation {kind}")
        step(**options)
