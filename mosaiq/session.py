"""The engine: a Spark session with the catalog, SQL in the accepted dialect and the fluent builder."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING, Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog, Entity
from .functions.registry import Registry
from .operators.paging import first_stored
from .operators.query import Query
from .plans.dialect import Sql, join, literal, translate
from .plans.patterns import expand

if TYPE_CHECKING:
    from .operators.ddl import Database
    from .operators.dml import HiLo, ManagedTable

#: Settings that the dialect relies on.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}
#: Taken over from the session that the engine is made of.
INHERITED = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")

#: A limit at the end of Spark SQL, and words of texts whose rows are not those of one table.
_LIMIT = re.compile(r"\bLIMIT\s+(\?|:\s*\w+|\d+)(?:\s+OFFSET\s+(\?|:\s*\w+|\d+))?\s*$", re.I)
_SIMPLE = frozenset("DISTINCT GROUP HAVING ORDER SORT CLUSTER DISTRIBUTE JOIN LATERAL UNION INTERSECT EXCEPT MINUS TABLESAMPLE PIVOT UNPIVOT WITH VALUES QUALIFY WINDOW".split())

Hook = Callable[[str, DataFrame], None]


class Interceptor:
    """What users may see and change on the way; each method as it is changes nothing."""

    def command(self, plan: str) -> str:
        """Spark SQL before it runs."""
        return plan

    def changed(self, text: str, rows: int) -> None:
        """A statement that changed a table."""

    def materialized(self, row: Any) -> Any:
        """A row on its way to the caller."""
        return row


class Engine:
    """Works in a session of its own (same cluster, views and settings apart),
    so that it changes nothing for others."""

    def __init__(self, spark: SparkSession, catalog: Catalog | None = None, *, default_schema: str = "main", relational_nulls: bool = False) -> None:
        self.spark = spark.newSession()
        for k in INHERITED:
            if (v := spark.conf.get(k, None)) is not None:
                self.spark.conf.set(k, v)
        for k, v in SETTINGS.items():
            self.spark.conf.set(k, v)
        self.catalog = catalog or Catalog(self.spark, default_schema)
        self.functions = Registry()
        self.translator: Callable[..., str] = translate
        self.relational_nulls = relational_nulls
        self.hooks: list[Hook] = []
        self.interceptors: list[Interceptor] = []
        #: Tables that statements change; see :meth:`attach`.
        self.database: Database | None = None
        #: Sequences by name; see :meth:`_numbered`.
        self.sequences: dict[str, HiLo] = {}
        self._current: dict[str, int] = {}

    @classmethod
    def over_parquet(cls, spark: SparkSession, folder: str, tables: list[str] | tuple[str, ...], **options: Any) -> Engine:
        engine = cls(spark, **options)
        for t in tables:
            engine.catalog.parquet(t, f"{folder}/{t}.parquet")
        return engine

    @classmethod
    def from_model(cls, spark: SparkSession, model: str | dict[str, Any], **options: Any) -> Engine:
        engine = cls(spark, **options)
        engine.catalog = Catalog.from_model(engine.spark, model)
        for name, fn in engine.catalog.functions.items():
            engine.functions.register(name, fn)
        return engine

    def translated(self, text: str) -> str:
        """The Spark SQL of a text in the accepted dialect."""
        return self.translator(text, self.catalog.view_of, self.catalog.period_of)

    def sql(self, text: str, *args: Any, **named: Any) -> DataFrame:
        """A query in the accepted dialect. ``?`` takes the positional, ``:name``
        the named arguments; both may stand in LIMIT and OFFSET."""
        plan = self.translated(expand(self, self._numbered(text)))
        for x in self.interceptors:
            plan = x.command(plan)
        df = self._result(plan, args, named)
        for hook in self.hooks:
            hook(plan, df)
        return df

    def _result(self, plan: str, args: Sequence[Any], named: dict[str, Any]) -> DataFrame:
        """Spark SQL's rows. Of a table in files, a limit without an order takes
        the rows that are stored first, so reruns and other engines agree."""
        df = self.spark.sql(plan, args=list(args) if args else named or None)
        m, s = _LIMIT.search(plan), Sql(plan)
        words = [w.upper() for w, kind in zip(s.tokens, s.kinds) if kind == "word"]
        if not m or words.count("SELECT") != 1 or words.count("FROM") != 1 or not _SIMPLE.isdisjoint(words):
            return df
        at = next(i for i in range(len(s.tokens)) if s.is_word(i, "FROM"))
        view = self.catalog.positioned(s.tokens[at + 1].strip("`"))
        if view is None or any(s.is_op(i, "(", ",") for i in range(at, at + 5)):
            return df
        head = Sql(plan[: m.start()])
        head.put(at + 1, at + 2, f"`{view}`")
        head.put(at, at, ", `__at` AS `__stored`")
        text = join(head.tokens)
        given = list(args)[: sum(head.is_op(i, "?") for i in range(len(head.tokens)))]
        rest = list(args)[len(given) :]
        take, skip = (0 if x is None else rest.pop(0) if x == "?" else named[x[1:].strip()] if x[0] == ":" else int(x) for x in m.groups())
        try:
            rows = self.spark.sql(text, args=given or named or None)
        except AnalysisException:  # aggregates have no place
            return df
        return first_stored(rows, "__stored", take, skip).select(*df.columns)

    def _numbered(self, text: str) -> str:
        """``NEXT VALUE FOR s`` and ``CURRENT VALUE FOR s`` as the numbers that
        the sequence hands out, one each time it is written."""
        if not self.sequences or " VALUE " not in f" {text.upper()} ":
            return text
        s, i = Sql(text), 0
        while i < len(s.tokens):
            if s.is_word(i, "NEXT", "CURRENT") and s.is_word(i + 1, "VALUE") and s.is_word(i + 2, "FOR"):
                name = s.tokens[i + 3].strip('"`')
                if s.is_word(i, "NEXT"):
                    self._current[name] = self.sequences[name].next()
                s.put(i, i + 4, f"CAST({self._current[name]} AS BIGINT)")
            i += 1
        return join(s.tokens)

    def attach(self, database: Database) -> None:
        """Make a database's tables readable by name and open to :meth:`execute`."""
        self.database = database
        for schema, name in database.tables:
            self._readable(schema, name)

    def _readable(self, schema: str, name: str) -> None:
        if (schema.lower(), name.lower()) not in self.catalog.entities:
            table = self.database.table(name, schema)  # type: ignore[union-attr]
            self.catalog.table(name, lambda _: table.df(), schema=schema, key=table.key)

    def _target(self, s: Sql, i: int) -> tuple[ManagedTable, int]:
        """The managed table named at ``i``, and the place after its name."""
        parts = []
        while True:
            parts.append(s.tokens[i].strip('"`'))
            if not s.is_op(i + 1, "."):
                break
            i += 2
        if self.database is None:
            raise LookupError("no database is attached")
        return self.database.table(parts[-1], parts[0] if len(parts) > 1 else "main"), i + 1

    def execute(self, text: str, *args: Any) -> int:
        """INSERT, UPDATE or DELETE on a managed table, in the accepted dialect;
        ``?`` takes the arguments in turn. Returns the rows changed."""
        s = Sql(self._numbered(text))
        for k in [k for k in range(len(s.tokens)) if s.is_op(k, "?")][::-1]:
            s.put(k, k + 1, literal(args[sum(s.is_op(j, "?") for j in range(k))]))
        spark_sql = lambda a, b: self.translated(join(s.tokens[a:b]))
        if s.is_word(0, "INSERT") and s.is_word(1, "INTO"):
            table, k = self._target(s, 2)
            names = [f.name for f in table.schema]
            if s.is_op(k, "("):
                names, end = s.arguments(k)
                names, k = [n.strip('"`') for n in names], end + 1
            for d in range(k, len(s.tokens)):
                if s.is_word(d, "DEFAULT"):
                    s.tokens[d] = "NULL"
            changed = table.insert(self.spark.sql(spark_sql(k, len(s.tokens))).toDF(*names))
        elif s.is_word(0, "UPDATE"):
            table, k = self._target(s, 1)
            if not s.is_word(k, "SET"):
                raise ValueError("UPDATE t SET column = value, ... [WHERE ...]")
            depth, where, cuts = 0, len(s.tokens), [k]
            for j in range(k + 1, len(s.tokens)):
                depth += s.is_op(j, "(", "[") - s.is_op(j, ")", "]")
                if not depth and s.is_word(j, "WHERE"):
                    where = j
                    break
                if not depth and s.is_op(j, ","):
                    cuts.append(j)
            changes: dict[str, Any] = {}
            for a, b in zip(cuts, [*cuts[1:], where]):
                changes[s.tokens[a + 1].strip('"`')] = F.lit(None) if s.is_word(a + 3, "DEFAULT") else F.expr(spark_sql(a + 3, b))
            changed = table.update(changes, F.expr(spark_sql(where + 1, len(s.tokens))) if where < len(s.tokens) else None)
        elif s.is_word(0, "DELETE") and s.is_word(1, "FROM"):
            table, k = self._target(s, 2)
            changed = table.delete(F.expr(spark_sql(k + 1, len(s.tokens))) if s.is_word(k, "WHERE") else None)
        else:
            raise ValueError("only INSERT, UPDATE and DELETE change tables")
        self.catalog._views.clear()
        for x in self.interceptors:
            x.changed(text, changed)
        return changed

    def materialized(self, row: Any) -> Any:
        for x in self.interceptors:
            row = x.materialized(row)
        return row

    def register_function(self, name: str, builder: Callable[..., Column]) -> None:
        """A function of the fluent surface, composed of others."""
        self.functions.register(name, builder)

    def register_aggregate(self, name: str, fn: Callable[..., Any], returns: str) -> None:
        """An aggregate of one's own, in SQL text and the fluent surface: ``fn``
        gets a group's values as pandas Series and gives one value. A group
        comes to one task whole, so it is for groups of bounded size."""
        udf = F.pandas_udf(fn, returns, F.PandasUDFType.GROUPED_AGG)
        self.spark.udf.register(name, udf)
        self.functions.register(name, udf)

    def register_table_function(self, name: str, handler: type, returns: str) -> None:
        """A table function of one's own for SQL text: ``handler.eval`` yields rows."""
        self.spark.udtf.register(name, F.udtf(handler, returnType=returns))

    def prepare(self, text: str) -> Callable[..., DataFrame]:
        """A query that is translated once and run with different arguments."""
        plan = self.translated(text)
        return lambda *args, **named: self._result(plan, args, named)

    def from_sql(self, text: str, *args: Any, **named: Any) -> Query:
        """SQL text as a source of the fluent builder."""
        return Query(self, self.sql(text, *args, **named))

    def set(self, entity: str) -> Query:
        """The rows of an entity, under its filters."""
        e: Entity = self.catalog.find(entity)
        return Query(self, self.catalog.frame(e), e)

    def explain(self, df: DataFrame) -> str:
        return df._jdf.queryExecution().toString()
