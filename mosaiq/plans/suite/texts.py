"""Forms of SQL text: window tables, period and system time, casts by format, changes, functions of one's own."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import functions as F

from ...operators.ddl import Database
from ...storage import shared_folder
from . import SQL, documents, query, windows  # noqa: F401  the fluent forms' SQL is the texts' too

query("sql_tumble", SQL["tumble_events"])(lambda e: e.sql("SELECT window_start, window_end, event_type, COUNT(*) AS n FROM TABLE(TUMBLE(TABLE events, DESCRIPTOR(ts), INTERVAL '1' HOUR)) AS w GROUP BY window_start, window_end, event_type"))
query("sql_hop", SQL["hop_events"])(lambda e: e.sql("SELECT window_start, window_end, COUNT(*) AS n FROM TABLE(HOP(TABLE events, DESCRIPTOR(ts), INTERVAL '30' MINUTE, INTERVAL '1' HOUR)) AS w GROUP BY window_start, window_end"))
query("sql_session", SQL["session_events"])(lambda e: e.sql("SELECT user_id, window_start, window_end, COUNT(*) AS n FROM TABLE(SESSION(TABLE events, DESCRIPTOR(ts), DESCRIPTOR(user_id), INTERVAL '30' MINUTE)) AS w GROUP BY user_id, window_start, window_end"))
query("sql_extract", "SELECT o_orderkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS y, trim(BOTH 'O' FROM o_orderstatus) AS s FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'")(
    lambda e: e.sql("SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate) AS y, TRIM(BOTH 'O' FROM o_orderstatus) AS s FROM orders WHERE o_orderstatus IS DISTINCT FROM 'P'")
)
query("sql_json_objectagg", SQL["json_objectagg"])(lambda e: e.sql("SELECT n_regionkey, JSON_OBJECTAGG(KEY n_name VALUE n_nationkey) AS j FROM nation GROUP BY n_regionkey"))
query("sql_group_id", "SELECT n_regionkey, COUNT(*) AS n, CAST(0 AS BIGINT) AS g FROM nation GROUP BY GROUPING SETS ((n_regionkey), ())")(lambda e: e.sql("SELECT n_regionkey, COUNT(*) AS n, GROUP_ID() AS g FROM nation GROUP BY GROUPING SETS ((n_regionkey), ())"))
query("sql_escapes", "SELECT n_nationkey, lower(n_name) AS n, DATE '2020-02-03' AS d FROM nation")(lambda e: e.sql("SELECT n_nationkey, {fn LOWER(n_name)} AS n, {d '2020-02-03'} AS d FROM nation"))
query("sql_query_collections", "SELECT r_name, (SELECT list_sort(list(n_nationkey)) FROM nation) AS ks FROM region")(lambda e: e.sql("SELECT r_name, SORT_ARRAY(ARRAY(SELECT n_nationkey FROM nation)) AS ks FROM region"))
query("sql_periods", "SELECT l_orderkey, l_linenumber, o_orderdate < TIMESTAMP '1996-01-01' AND TIMESTAMP '1995-01-01' < l_shipdate AS overlapping, l_shipdate <= TIMESTAMP '1995-01-01' AS before FROM lineitem JOIN orders ON l_orderkey = o_orderkey")(
    lambda e: e.sql("SELECT l_orderkey, l_linenumber, (o_orderdate, l_shipdate) OVERLAPS (TIMESTAMP_NTZ '1995-01-01', TIMESTAMP_NTZ '1996-01-01') AS overlapping, (o_orderdate, l_shipdate) PRECEDES (TIMESTAMP_NTZ '1995-01-01', TIMESTAMP_NTZ '1996-01-01') AS before FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
)
query("sql_cast_format", "SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS s, CAST(o_orderdate AS DATE) AS d, strptime(strftime(o_orderdate, '%d-%m-%Y %H:%M'), '%d-%m-%Y %H:%M') AS t FROM orders")(
    lambda e: e.sql("SELECT o_orderkey, CAST(o_orderdate AS VARCHAR FORMAT 'YYYY/MM/DD') AS s, CAST(CAST(o_orderdate AS VARCHAR FORMAT 'YYYY/MM/DD') AS DATE FORMAT 'YYYY/MM/DD') AS d, CAST(CAST(o_orderdate AS VARCHAR FORMAT 'DD-MM-YYYY HH24:MI') AS TIMESTAMP FORMAT 'DD-MM-YYYY HH24:MI') AS t FROM orders")
)
query("sql_cast_time", "SELECT n_nationkey, '0' || (n_nationkey % 10) || ':15:00' AS t, n_nationkey % 10 < 5 AS early FROM nation")(
    lambda e: e.sql("SELECT n_nationkey, CAST(t AS VARCHAR) AS t, t < TIME '05:00:00' AS early FROM (SELECT n_nationkey, CAST('0' || CAST(n_nationkey % 10 AS VARCHAR) || ':15:00' AS TIME) AS t FROM nation) AS x")
)


query("sql_match_recognize", SQL["match_pattern"].replace("repeat('UP', CAST(length AS INTEGER)) AS classifiers", "'UP' AS last_classifier"))(
    lambda e: e.sql("""
    SELECT * FROM orders MATCH_RECOGNIZE (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      MEASURES FIRST(UP.o_orderkey) AS first_o_orderkey, LAST(UP.o_orderkey) AS last_o_orderkey, COUNT(*) AS length, MATCH_NUMBER() AS match_number, CLASSIFIER() AS last_classifier
      ONE ROW PER MATCH AFTER MATCH SKIP PAST LAST ROW
      PATTERN (UP{2,}) DEFINE UP AS UP.o_totalprice > PREV(UP.o_totalprice))""")
)
query("sql_match_running", """
WITH m AS (SELECT *, LAG(o_totalprice) OVER w AS before, ROW_NUMBER() OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
f AS (SELECT *, coalesce(o_totalprice > before, FALSE) AS up FROM m), g AS (SELECT *, n - ROW_NUMBER() OVER (PARTITION BY o_custkey, up ORDER BY n) AS r FROM f),
k AS (SELECT *, MIN(n) OVER (PARTITION BY o_custkey, r) AS b, MAX(n) OVER (PARTITION BY o_custkey, r) AS z FROM g WHERE up)
SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey, r ORDER BY n) AS so_far, z - b + 1 AS in_all, FIRST_VALUE(o_orderkey) OVER (PARTITION BY o_custkey, r ORDER BY n) AS began FROM k""")(
    lambda e: e.sql("""
    SELECT o_orderkey, so_far, in_all, began FROM orders MATCH_RECOGNIZE (
      PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
      MEASURES RUNNING COUNT(UP.*) AS so_far, FINAL COUNT(*) AS in_all, FIRST(o_orderkey) AS began
      ALL ROWS PER MATCH AFTER MATCH SKIP PAST LAST ROW PATTERN (UP+) DEFINE UP AS o_totalprice > PREV(o_totalprice)) AS runs""")
)


@query("sql_system_time", SQL["snapshot_rows"])
def sql_system_time(e):
    """The rows of a table with periods as they were at a time."""
    lines = e.catalog.view_sql("line_history", "SELECT l_orderkey, l_linenumber, o_orderdate AS valid_from, l_shipdate AS valid_to FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    lines.period = ("valid_from", "valid_to")
    return e.sql("SELECT l_orderkey, l_linenumber FROM line_history FOR SYSTEM_TIME AS OF TIMESTAMP_NTZ '1997-01-01 00:00:00'")


@query("sql_changes", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name, CASE WHEN n_regionkey = 1 THEN n_regionkey + 10 ELSE n_regionkey END AS n_regionkey FROM nation WHERE n_nationkey <> 7 UNION ALL SELECT 100, 'O''Hara', NULL UNION ALL SELECT n_nationkey + 200, n_name, n_regionkey FROM nation WHERE n_regionkey = 2")
def sql_changes(e):
    db = Database(e.spark, shared_folder(e.spark))
    db.create_table("land", [("n_nationkey", "INTEGER", False), ("n_name", "VARCHAR"), ("n_regionkey", "INTEGER")], key=["n_nationkey"]).insert(e.set("nation").df)
    e.attach(db)
    e.execute("UPDATE land SET n_name = LOWER(n_name), n_regionkey = n_regionkey + ? WHERE n_regionkey = 1", 10)
    e.execute("DELETE FROM land WHERE n_nationkey = ?", 7)
    e.execute("INSERT INTO land (n_nationkey, n_name, n_regionkey) VALUES (100, ?, DEFAULT)", "O'Hara")
    e.execute("INSERT INTO land SELECT n_nationkey + 200, n_name, n_regionkey FROM nation WHERE n_regionkey = 2")
    return e.sql("SELECT * FROM land")


@query("sql_sequence", "SELECT CAST(k AS BIGINT) AS k, CAST(last AS BIGINT) AS last FROM (VALUES (1, 1), (2, 2), (3, 3), (4, 4)) t(k, last)")
def sql_sequence(e):
    """Numbers of a sequence in changes and in queries."""
    from ...operators.dml import HiLo

    db = Database(e.spark, shared_folder(e.spark))
    e.sequences["ids"] = HiLo(db.create_table("sequences", [("Name", "VARCHAR"), ("NextValue", "BIGINT")], key=["Name"]), "ids", block=2)
    db.create_table("got", [("k", "BIGINT", False), ("last", "BIGINT")], key=["k"])
    e.attach(db)
    for _ in range(3):
        e.execute("INSERT INTO got VALUES (NEXT VALUE FOR ids, CURRENT VALUE FOR ids)")
    return e.sql("SELECT k, last FROM got").unionByName(e.sql("SELECT NEXT VALUE FOR ids AS k, CURRENT VALUE FOR ids AS last"))


query("sql_collection_table", "SELECT n_nationkey, CAST(i AS BIGINT) AS i FROM nation, (SELECT unnest(range(3)) AS i) t")(lambda e: e.sql("SELECT n_nationkey, r.id AS i FROM nation CROSS JOIN TABLE(range(3)) AS r"))


@query("ext_aggregate", "SELECT n_regionkey, CAST(MAX(n_nationkey) - MIN(n_nationkey) AS DOUBLE) AS spread FROM nation GROUP BY n_regionkey")
def ext_aggregate(e):
    e.register_aggregate("spread", lambda x: float(x.max() - x.min()), "double")
    return e.sql("SELECT n_regionkey, spread(n_nationkey) AS spread FROM nation GROUP BY n_regionkey")


class Letters:
    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        yield from enumerate(text, 1)


@query("ext_table_function", "SELECT n_nationkey, CAST(i AS INTEGER) AS place, n_name[i] AS letter FROM (SELECT n_nationkey, n_name, unnest(range(1, len(n_name) + 1)) AS i FROM nation) t")
def ext_table_function(e):
    e.register_table_function("letters_of", Letters, "place int, letter string")
    return e.sql("SELECT n_nationkey, l.place, l.letter FROM nation, LATERAL letters_of(n_name) AS l")


@query("ext_translator", "SELECT n_nationkey, n_nationkey * 2 AS twice FROM nation")
def ext_translator(e):
    """A call that users translate, through every part of a statement."""
    from ..dialect import Translator

    e.translator = Translator({"TWICE": lambda a: f"(({a[0]}) * 2)"})
    return e.sql("SELECT n_nationkey, TWICE(n_nationkey) AS twice FROM nation WHERE TWICE(n_nationkey) >= 0")


@query("src_rows", "SELECT CAST(1 AS INTEGER) AS a, 'x' AS b UNION ALL SELECT 2, NULL")
def src_rows(e):
    model = {"version": "1", "defaultSchema": "m", "schemas": [{"name": "m", "type": "custom", "source": "rows", "tables": [{"name": "T", "operand": {"rows": [[1, "x"], [2, None]], "schema": "a int, b string"}}]}]}
    return type(e).from_model(e.spark, model).set("T")


@query("src_datasource", "SELECT CAST(range AS INTEGER) AS i, CAST(range * range AS INTEGER) AS square FROM range(20)")
def src_datasource(e):
    """A Python data source, read by partitions."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    from ...sources.files import read

    class Squares(DataSource):
        @classmethod
        def name(cls) -> str:
            return "squares"

        def schema(self) -> str:
            return "i int, square int"

        def reader(self, schema: object) -> DataSourceReader:
            end = int(self.options["end"])

            class Reader(DataSourceReader):
                def partitions(self) -> list[InputPartition]:
                    return [InputPartition(k) for k in range(4)]

                def read(self, partition: InputPartition) -> Iterator[tuple[int, int]]:
                    yield from ((i, i * i) for i in range(partition.value, end, 4))

            return Reader()

    e.spark.dataSource.register(Squares)
    return read(e.spark, "datasource", {"format": "squares", "end": 20})


@query("dml_concurrent", "SELECT CAST(1 AS INTEGER) AS won, CAST(1 AS INTEGER) AS lost, CAST(26 AS BIGINT) AS left_rows")
def dml_concurrent(e):
    """Two writers of one version: one wins, the other's change is refused whole."""
    from ...operators.dml import ConcurrencyError, ManagedTable

    root = shared_folder(e.spark)
    table = Database(e.spark, root).create_table("land", [("n_nationkey", "INTEGER", False), ("n_name", "VARCHAR")], key=["n_nationkey"])
    table.insert(e.set("nation").df.select("n_nationkey", "n_name"))
    writers = [ManagedTable(e.spark, table.path) for _ in range(2)]
    won = lost = 0
    for i, w in enumerate(writers):
        try:
            w.insert([{"n_nationkey": 100 + i, "n_name": "new"}])
            won += 1
        except ConcurrencyError:
            lost += 1
    return e.spark.createDataFrame([(won, lost, ManagedTable(e.spark, table.path).df().count())], "won int, lost int, left_rows long")


@query("ddl_reopened", "SELECT CAST(2 AS BIGINT) AS rows_in, TRUE AS resumed, TRUE AS dropped_stays FROM (SELECT 1) t")
def ddl_reopened(e):
    """Tables and finished migrations outlive the process that made them."""
    from ...operators.ddl import Migration, Runner

    root = shared_folder(e.spark)
    make = ("create_table", {"name": "t", "columns": [("Id", "BIGINT", False)], "key": ["Id"]})
    rows = ("insert", {"table": "t", "rows": [{"Id": 1}, {"Id": 2}]})
    broken = Migration("m", [make, rows, ("create_table", {"name": "t", "columns": [("Id", "BIGINT")]})])
    try:
        Runner(Database(e.spark, root)).run([broken])
    except ValueError:
        pass
    again = Runner(Database(e.spark, root))
    again.run([Migration("m", [make, rows, ("create_table", {"name": "u", "columns": [("Id", "BIGINT")]}), ("drop_table", {"name": "u"})])])
    last = Database(e.spark, root)
    return e.spark.createDataFrame([(last.table("t").df().count(), again.log == ["m:create_table", "m:drop_table"], ("main", "u") not in last.tables)], "rows_in long, resumed boolean, dropped_stays boolean")
