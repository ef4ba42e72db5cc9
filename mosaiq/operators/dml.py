"""Row changes on engine-managed tables: file-level copy-on-write with a manifest for each version.

A table is a folder: ``data`` with Parquet files and ``manifests`` with one
JSON file for each version, which lists the files that the version is made of.
A change reads the key columns to find the files that hold affected rows,
rewrites those only, and publishes a manifest under the next number. The
manifest is written aside and renamed, which fails if another writer was faster
and is then a conflict; readers always see one whole version. Paths go through
Hadoop's file systems, so a table can lie where only Spark reaches; the rename
is atomic where the file system's is (HDFS; not object stores).
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import written


class ConcurrencyError(Exception):
    """A change met other rows, or another version, than it was made for."""


class KeyGenerationError(Exception):
    """A key that the engine does not generate was left out."""


class Store:
    """Files by way of Hadoop's file systems."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.jvm = spark._jvm
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str) -> tuple[Any, Any]:
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(n for s in fs.listStatus(p) if not (n := s.getPath().getName()).startswith(".")) if fs.exists(p) else []

    def paths(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file, there with its whole text or not at all; fails if it is there."""
        fs, p = self._at(path)
        aside = self.jvm.org.apache.hadoop.fs.Path(f"{p.getParent()}/.{p.getName()}.{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        gateway = self.spark.sparkContext._gateway
        options = gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        target = fs.makeQualified(p)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf).rename(fs.makeQualified(aside), target, options)
        except Exception:
            fs.delete(aside, False)
            raise


class ManagedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, *, key: tuple[str, ...] = (), token: str | None = None) -> None:
        """Open a table, or make it if ``schema`` is given and it is not there.
        ``token``: a column that tells of other writers' changes."""
        self.spark, self.path, self.key, self.token = spark, path.rstrip("/"), key, token
        self.store = Store(spark)
        if not self.versions():
            if schema is None:
                raise LookupError(f"no table in {path}")
            self._publish(0, schema, [])
        self._load()

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.store.names(f"{self.path}/manifests") if n.endswith(".json")]

    def _load(self) -> None:
        self.version = max(self.versions())
        m = json.loads(self.store.read(f"{self.path}/manifests/{self.version:010d}.json"))
        self.schema, self.files = T.StructType.fromJson(m["schema"]), m["files"]
        self.key = tuple(m.get("key") or self.key)

    def _publish(self, version: int, schema: T.StructType, files: list[str]) -> None:
        text = json.dumps({"schema": json.loads(schema.json()), "files": files, "key": list(self.key)})
        try:
            self.store.create(f"{self.path}/manifests/{version:010d}.json", text)
        except Exception as e:
            if "already exists" in str(e) or "FileAlreadyExists" in str(e):
                raise ConcurrencyError(f"version {version} was written by another") from e
            raise

    def df(self, version: int | None = None) -> DataFrame:
        """The rows, now or as of an older version."""
        files = self.files
        if version is not None and version != self.version:
            files = json.loads(self.store.read(f"{self.path}/manifests/{version:010d}.json"))["files"]
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def _write(self, df: DataFrame) -> list[str]:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.parquet(folder)
        return [p for p in self.store.paths(folder) if p.endswith(".parquet")]

    def _commit(self, files: list[str]) -> None:
        self._publish(self.version + 1, self.schema, files)
        self.version, self.files = self.version + 1, files

    def insert(self, rows: DataFrame | Iterable[dict[str, Any]]) -> int:
        """Append; missing columns are null. Returns the rows."""
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame([tuple(r.get(f.name) for f in self.schema) for r in rows], self.schema)
        there = {c.lower() for c in rows.columns}
        rows = rows.select(*[F.col(f.name) if f.name.lower() in there else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])
        new = self._write(rows)
        n = self.spark.read.schema(self.schema).parquet(*new).count() if new else 0
        if n:
            self._commit(self.files + new)
        return n

    def _touched(self, condition: Column) -> tuple[list[str], int]:
        rows = self.df().where(condition).groupBy(F.input_file_name().alias("file")).count().collect() if self.files else []
        by_name = {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1]: f for f in self.files}
        return [by_name["/".join(r["file"].rsplit("/", 2)[-2:])] for r in rows], sum(r["count"] for r in rows)

    def _rewrite(self, files: list[str], change: Callable[[DataFrame], DataFrame]) -> None:
        old = self.spark.read.schema(self.schema).parquet(*files)
        new = self._write(change(old))
        self._commit([f for f in self.files if f not in set(files)] + new)

    def update(self, changes: dict[str, Any], where: Column | None = None) -> int:
        """Set columns to values or expressions of the old row. Returns the affected rows."""
        condition = F.lit(True) if where is None else where
        files, n = self._touched(condition)
        if n:
            new = {c: F.when(condition, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)) for c, v in changes.items()}
            self._rewrite(files, lambda old: old.withColumns(new))
        return n

    def delete(self, where: Column | None = None) -> int:
        condition = F.lit(True) if where is None else where
        files, n = self._touched(condition)
        if n:
            self._rewrite(files, lambda old: old.where(~F.coalesce(condition, F.lit(False))))
        return n

    def _row(self, key: dict[str, Any], original: dict[str, Any] | None) -> Column:
        condition = F.lit(True)
        for c, v in (key | ({self.token: original[self.token]} if self.token and original and self.token in original else {})).items():
            condition = condition & F.col(c).eqNullSafe(F.lit(v))
        return condition

    def update_row(self, key: dict[str, Any], changes: dict[str, Any], original: dict[str, Any] | None = None) -> None:
        """Change the row of a key, if its token is still the original's."""
        where = self._row(key, original)
        _, n = self._touched(where)
        if n != 1:
            raise ConcurrencyError(f"expected to change one row, found {n}")
        self.update(changes, where)

    def delete_row(self, key: dict[str, Any], original: dict[str, Any] | None = None) -> None:
        where = self._row(key, original)
        _, n = self._touched(where)
        if n != 1:
            raise ConcurrencyError(f"expected to delete one row, found {n}")
        self.delete(where)

    def merge(self, source: DataFrame, on: tuple[str, ...] | None = None) -> tuple[int, int]:
        """Replace the rows whose key ``source`` has and add its others.
        (updated, inserted): rows that were there, keys that were not. A key
        that ``source`` has twice is refused."""
        on = on or self.key
        new = self._write(source.select(*self.schema.names))
        if not new:
            return 0, 0
        # the rows as written: the source is made once, whatever it is
        written = self.spark.read.schema(self.schema).parquet(*new)
        if not written.groupBy(*on).count().where("count > 1").isEmpty():
            raise ValueError(f"several rows of one key ({', '.join(on)}) to merge")
        keys = written.select(*[F.col(c).alias(f"__{c}") for c in on])
        same = lambda df: [df[c].eqNullSafe(keys[f"__{c}"]) for c in on]
        files, updated, replaced = [], 0, 0
        if self.files:
            named = self.df().withColumn("__file", F.input_file_name())
            hits = named.join(keys, same(named), "left_semi")
            counted = hits.groupBy("__file").count().collect()
            by_name = {"/".join(f.rsplit("/", 2)[-2:]): f for f in self.files}
            files = [by_name["/".join(r["__file"].rsplit("/", 2)[-2:])] for r in counted]
            updated, replaced = sum(r["count"] for r in counted), hits.select(*on).distinct().count()
        if files:
            old = self.spark.read.schema(self.schema).parquet(*files)
            new = new + self._write(old.join(keys, same(old), "left_anti"))
        inserted = written.count() - replaced
        self._commit([f for f in self.files if f not in set(files)] + new)
        return updated, inserted


def new_guid() -> str:
    """A key made by the client: random, with the time in front, so that keys come in order."""
    import time

    stamp = int(time.time() * 1000).to_bytes(6, "big")
    raw = bytearray(stamp + uuid.uuid4().bytes[6:])
    raw[6] = (raw[6] & 0x0F) | 0x70
    raw[8] = (raw[8] & 0x3F) | 0x80
    return str(uuid.UUID(bytes=bytes(raw)))


def generate_key(kind: str) -> str:
    """A generated key of a type; numbers are refused, as nothing hands them out."""
    if kind.upper() in ("UUID", "STRING", "VARCHAR"):
        return new_guid()
    raise KeyGenerationError(f"keys of type {kind} are not generated; give a value, or number the rows with max_seeded_keys")


def max_seeded_keys(rows: DataFrame, existing: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with ``key`` numbered on from the largest existing key, in the
    order of ``order``. Rows are dealt by ranges of the order and counted by
    range where they lie; the driver sees one count for each range."""
    start = existing.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]
    ranged = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    placed = written(ranged.select("*", F.spark_partition_id().alias("__range"), F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias("__at")))
    before, counts = {}, sorted((r["__range"], r["count"]) for r in placed.groupBy("__range").count().collect())
    for part, n in counts:
        before[part], start = start + 1, start + n
    if not before:
        return rows.withColumn(key, F.lit(None).cast("long"))
    first = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("__range"))
    return placed.withColumn(key, first + F.col("__at")).drop("__range", "__at")


@dataclass
class HiLo:
    """Keys from a sequence row ``(Name, NextValue)`` of a managed table, ``block`` at a time."""

    table: ManagedTable
    name: str
    block: int = 10
    _next: int = 0
    _end: int = 0

    def next(self) -> int:
        if self._next >= self._end:
            row = self.table.df().where(F.col("Name") == self.name).first()
            if row is None:
                self.table.insert([{"Name": self.name, "NextValue": 1}])
                low = 1
            else:
                low = row["NextValue"]
            self.table.token = "NextValue"
            self.table.update_row({"Name": self.name}, {"NextValue": low + self.block}, {"NextValue": low})
            self._next, self._end = low, low + self.block
        self._next += 1
        return self._next - 1


@dataclass
class UnitOfWork:
    """Changes gathered and applied in order by :meth:`save`, which reports the
    rows changed. If one fails, the tables go back to what they were and all
    changes stay, to be saved again or cleared."""

    changes: list[tuple[ManagedTable, Callable[[], int]]] = field(default_factory=list)
    interceptors: list[Callable[[int], None]] = field(default_factory=list)

    def add(self, table: ManagedTable, row: dict[str, Any]) -> dict[str, Any]:
        for c in table.key:
            if row.get(c) is None:
                row = row | {c: generate_key(table.schema[c].dataType.simpleString())}
        self.changes.append((table, lambda: table.insert([row])))
        return row

    def update(self, table: ManagedTable, key: dict[str, Any], changes: dict[str, Any], original: dict[str, Any] | None = None) -> None:
        self.changes.append((table, lambda: table.update_row(key, changes, original) or 1))

    def remove(self, table: ManagedTable, key: dict[str, Any], original: dict[str, Any] | None = None) -> None:
        self.changes.append((table, lambda: table.delete_row(key, original) or 1))

    def clear(self) -> None:
        self.changes.clear()

    def save(self) -> int:
        n = 0
        before = {id(t): (t, t.version, list(t.files)) for t, _ in self.changes}
        try:
            for _, change in self.changes:
                n += change()
        except Exception:
            for table, version, files in before.values():
                if table.version != version:
                    table._commit(files)
            raise
        self.changes.clear()
        for fn in self.interceptors:
            fn(n)
        return n

    def begin_transaction(self) -> None:
        warnings.warn("transactions are accepted and ignored: every change is a version of its own", stacklevel=2)
