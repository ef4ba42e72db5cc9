"""What stands around queries: keys, streams of rows, hooks, interceptors, compiled queries, conventions."""

from __future__ import annotations

import warnings

from pyspark.sql import Row
from pyspark.sql import functions as F

from ...catalog import MAX_IDENTIFIER, Entity
from ...operators.ddl import Database, Migration, Runner
from ...operators.dml import UnitOfWork
from ...session import Interceptor
from ...storage import shared_folder
from . import query

c = F.col


@query("meta_keys", "SELECT table_name, column_name, CAST(k AS INTEGER) AS key_position FROM (VALUES ('lineitem', 'l_orderkey', 0), ('lineitem', 'l_linenumber', 1), ('nation', 'n_nationkey', 0), ('region', 'r_regionkey', 0)) t(table_name, column_name, k)")
def meta_keys(e):
    """The keys that the catalog knows, which decide what joins can be left out."""
    return e.catalog.describe().where("key_position IS NOT NULL").where(c("table_name").isin("lineitem", "nation", "region")).select("table_name", "column_name", "key_position")


@query("meta_exists", "SELECT TRUE AS there, FALSE AS empty_has_tables, TRUE AS has_tables")
def meta_exists(e):
    db = Database(e.spark, shared_folder(e.spark))
    before = db.has_tables()
    db.create_table("t", [("Id", "BIGINT")])
    return e.spark.createDataFrame([(db.exists(), before, db.has_tables())], "there boolean, empty_has_tables boolean, has_tables boolean")


@query("row_stream", "SELECT COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS s FROM customer")
def row_stream(e):
    """Rows that come one partition at a time, in the order asked for."""
    n = s = 0
    for row in e.set("customer").select("c_custkey").order_by("c_custkey").stream():
        n, s = n + 1, s + row["c_custkey"]
    return e.spark.createDataFrame([(n, s)], "n long, s long")


@query("fallback_scan", "SELECT n_name, length(n_name) AS letters FROM nation")
def fallback_scan(e):
    """A table of which no column is declared is read whole, and only as a query asks for it."""
    rows = [tuple(r) for r in e.set("nation").select("n_name").rows()]
    e.catalog.table("loose", lambda spark: spark.createDataFrame(rows, "n_name string"))
    return e.set("loose").select("n_name", letters=F.char_length("n_name").cast("bigint"))


@query("plan_hooks", "SELECT CAST(1 AS INTEGER) AS seen, TRUE AS translated, CAST(25 AS BIGINT) AS n")
def plan_hooks(e):
    seen = []
    e.hooks.append(lambda plan, df: seen.append(plan))
    n = e.sql('SELECT "n_name" FROM nation FETCH FIRST 100 ROWS ONLY').count()
    return e.spark.createDataFrame([(len(seen), "LIMIT 100" in seen[0], n)], "seen int, translated boolean, n long")


class Watching(Interceptor):
    def __init__(self) -> None:
        self.commands: list[str] = []
        self.changes: list[int] = []

    def command(self, plan: str) -> str:
        self.commands.append(plan)
        return plan.replace("n_regionkey = 1", "n_regionkey = 2")

    def changed(self, text: str, rows: int) -> None:
        self.changes.append(rows)

    def materialized(self, row: Row) -> Row:
        return Row(**{k: v.lower() if isinstance(v, str) else v for k, v in row.asDict().items()})


@query("interceptors", "SELECT lower(n_name) AS n_name, CAST(1 AS INTEGER) AS commands, CAST(5 AS BIGINT) AS changed, CAST(2 AS BIGINT) AS saved FROM nation WHERE n_regionkey = 2")
def interceptors(e):
    """Commands, changes, saves and rows pass by those who watch, who may change them."""
    watching, saved = Watching(), []
    e.interceptors.append(watching)
    rows = e.from_sql("SELECT n_name FROM nation WHERE n_regionkey = 1").rows()
    db = Database(e.spark, shared_folder(e.spark))
    land = db.create_table("land", [("k", "INTEGER", False), ("v", "VARCHAR")], key=["k"])
    e.attach(db)
    commands = len(watching.commands)
    e.execute("INSERT INTO land SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 3")
    work = UnitOfWork(interceptors=[saved.append])
    work.update(land, {"k": 3}, {"v": "x"})
    work.remove(land, {"k": 8})
    work.save()
    return e.spark.createDataFrame([(r["n_name"], commands, watching.changes[0], saved[0]) for r in rows], "n_name string, commands int, changed long, saved long")


@query("compiled_query", "SELECT r, COUNT(*) AS n FROM (SELECT n_regionkey AS r FROM nation WHERE n_regionkey IN (1, 3)) t GROUP BY r")
def compiled_query(e):
    """Translated once, run with different arguments."""
    run = e.prepare("SELECT n_regionkey AS r, COUNT(*) AS n FROM nation WHERE n_regionkey = ? GROUP BY n_regionkey")
    return run(1).unionByName(run(3))


query("funky_wildcards", "SELECT n_nationkey, contains(s, '%') AS percent, contains(s, '_') AS line, starts_with(s, 'N_') AS begins, ends_with(s, '%x') AS ends, contains(s, '') AS nothing FROM (SELECT n_nationkey, replace(n_name, 'ATION', '') || CASE WHEN n_regionkey = 1 THEN '%x' ELSE '' END AS s FROM nation) t")(
    lambda e: e.set("nation").extend(s=F.concat(F.replace(c("n_name"), F.lit("ATION"), F.lit("")), F.when(c("n_regionkey") == 1, "%x").otherwise(""))).select(
        "n_nationkey", percent=e.functions.contains(c("s"), F.lit("%")), line=e.functions.contains(c("s"), F.lit("_")), begins=e.functions.starts_with(c("s"), F.lit("N_")), ends=e.functions.ends_with(c("s"), F.lit("%x")), nothing=e.functions.contains(c("s"), F.lit(""))
    )
)


@query("ddl_ignored", "SELECT TRUE AS warned, TRUE AS transaction_warned, CAST(2 AS INTEGER) AS columns")
def ddl_ignored(e):
    """Indexes, constraints and transactions are accepted with a warning."""
    db = Database(e.spark, shared_folder(e.spark))
    steps = [("create_table", {"name": "t", "columns": [("Id", "BIGINT", False), ("Name", "VARCHAR")], "key": ["Id"]})]
    steps += [(kind, {"name": "x", "table": "t"}) for kind in ("create_index", "add_foreign_key", "add_unique_constraint", "add_check_constraint", "alter_sequence", "drop_index")]
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        Runner(db).run([Migration("m", steps)])
        count = sum("no effect" in str(w.message) for w in seen)
        UnitOfWork().begin_transaction()
    return e.spark.createDataFrame([(count == 6, "ignored" in str(seen[-1].message), len(db.table("t").schema))], "warned boolean, transaction_warned boolean, columns int")


@query("long_identifiers", "SELECT CAST(128 AS INTEGER) AS longest, CAST(2 AS INTEGER) AS kinds, CAST(25 AS BIGINT) AS n")
def long_identifiers(e):
    """Overlong names are cut and told apart."""
    rows = e.set("nation").df
    made = [e.catalog.add(Entity("main", "x" * 200, load=lambda _: rows)) for _ in range(2)]
    return e.spark.createDataFrame([(max(len(x.name) for x in made), len({x.name for x in made}), e.set(made[1].name).count())], "longest int, kinds int, n long").where(F.lit(MAX_IDENTIFIER) == 128)


@query("arith_overflow", "SELECT n_nationkey, CAST(NULL AS INTEGER) AS checked, TRUE AS raised FROM nation")
def arith_overflow(e):
    """Checked arithmetic throws where the result has no room, its try form gives null."""
    from pyspark.errors import ArithmeticException

    try:
        e.sql("SELECT n_nationkey + 2147483647 + 1 AS x FROM nation").collect()
        raised = False
    except ArithmeticException:
        raised = True
    return e.set("nation").select("n_nationkey", checked=F.try_add(c("n_nationkey") + 2147483600, F.lit(2147483600)), raised=F.lit(raised))


@query("mixed_wide", """
WITH big AS (SELECT c_custkey, c_name, c_nationkey, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer)
SELECT n_name, r_name, COUNT(*) AS customers, CAST(SUM(orders) AS BIGINT) AS orders, MAX(CASE WHEN orders > 10 THEN c_name ELSE lower(c_name) END) AS top, COUNT(*) FILTER (WHERE orders IN (0, 1) OR c_name LIKE '%7') AS few
FROM big JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'x'
WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 9990) GROUP BY n_name, r_name HAVING COUNT(*) > 1 ORDER BY orders DESC, n_name""")
def mixed_wide(e):
    """Many operators in one: group join, chain of navigations, anti join, conditional aggregates, order."""
    q = e.set("customer").group_join(e.set("orders").select("o_custkey", "o_orderkey"), "c_custkey", "o_custkey", "own")
    q = q.extend(orders=F.size("own").cast("bigint")).where_exists(e.set("supplier").where("s_acctbal > 9990"), "c_nationkey", "s_nationkey", negate=True)
    q = q.navigate("nation.region", keep=True)
    few = F.count_if(c("orders").isin(0, 1) | c("c_name").like("%7"))
    top = F.max(F.when(c("orders") > 10, c("c_name")).otherwise(F.lower("c_name")))
    return q.group_by("n_name", "r_name").agg(customers=F.count(F.lit(1)), orders=F.sum("orders"), top=top, few=few).where("customers > 1").order_by("orders", descending=True).then_by("n_name")
