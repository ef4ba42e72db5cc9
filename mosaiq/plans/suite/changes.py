"""Sources, catalog, row changes, definitions and keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.ddl import Database, Migration, Runner
from ...operators.dml import ConcurrencyError, HiLo, UnitOfWork, generate_key, max_seeded_keys
from ...storage import shared_folder
from . import query

c = F.col


def _folder(e) -> str:
    return shared_folder(e.spark)


def _nations(e):
    db = Database(e.spark, _folder(e))
    t = db.create_table("nation", [("n_nationkey", "INTEGER", False), ("n_name", "VARCHAR"), ("n_regionkey", "INTEGER")], key=["n_nationkey"], token="n_regionkey")
    t.insert(e.set("nation").df)
    return db, t


@query("dml_insert", "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 100, 'ATLANTIS', NULL")
def dml_insert(e):
    _, t = _nations(e)
    t.insert([{"n_nationkey": 100, "n_name": "ATLANTIS"}])
    return t.df()


@query("dml_update", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) ELSE n_name END AS n_name, n_regionkey FROM nation")
def dml_update(e):
    _, t = _nations(e)
    t.update({"n_name": F.lower("n_name")}, c("n_regionkey") == 1)
    return t.df()


@query("dml_delete", "SELECT * FROM nation WHERE n_nationkey <> 7")
def dml_delete(e):
    _, t = _nations(e)
    t.delete_row({"n_nationkey": 7})
    return t.df()


@query("dml_bulk_update", "SELECT n_nationkey, n_name, n_regionkey + 10 AS n_regionkey FROM nation WHERE n_regionkey < 3")
def dml_bulk_update(e):
    _, t = _nations(e)
    t.delete(c("n_regionkey") >= 3)
    t.update({"n_regionkey": c("n_regionkey") + 10})
    return t.df()


@query("dml_conflict", "SELECT TRUE AS stale_update, TRUE AS deleted_update, TRUE AS deleted_delete, FALSE AS normal")
def dml_conflict(e):
    _, t = _nations(e)

    def fails(fn) -> bool:
        try:
            fn()
        except ConcurrencyError:
            return True
        return False

    t.update_row({"n_nationkey": 1}, {"n_regionkey": 9}, {"n_regionkey": e.set("nation").where("n_nationkey = 1").first()["n_regionkey"]})
    stale = fails(lambda: t.update_row({"n_nationkey": 1}, {"n_name": "x"}, {"n_regionkey": 1}))
    t.delete_row({"n_nationkey": 2})
    gone = fails(lambda: t.update_row({"n_nationkey": 2}, {"n_name": "x"}))
    again = fails(lambda: t.delete_row({"n_nationkey": 2}))
    normal = fails(lambda: t.update_row({"n_nationkey": 3}, {"n_name": "x"}))
    return e.spark.createDataFrame([(stale, gone, again, normal)], "stale_update boolean, deleted_update boolean, deleted_delete boolean, normal boolean")


@query("dml_merge", "SELECT n_nationkey, CASE WHEN n_nationkey < 5 THEN 'new ' || n_name ELSE n_name END AS n_name, n_regionkey FROM nation UNION ALL SELECT n_nationkey + 1000, n_name, n_regionkey FROM nation WHERE n_nationkey < 5")
def dml_merge(e):
    _, t = _nations(e)
    few = e.set("nation").where("n_nationkey < 5").df
    t.merge(few.withColumn("n_name", F.concat(F.lit("new "), "n_name")).unionByName(few.withColumn("n_nationkey", (c("n_nationkey") + 1000).cast("int"))))
    return t.df()


@query("dml_unit_of_work", "SELECT CAST(3 AS BIGINT) AS changed, CAST(25 AS BIGINT) AS left_rows")
def dml_unit_of_work(e):
    _, t = _nations(e)
    work = UnitOfWork()
    work.add(t, {"n_nationkey": 50, "n_name": "NEW", "n_regionkey": 1})
    work.update(t, {"n_nationkey": 50}, {"n_name": "NEWER"})
    work.remove(t, {"n_nationkey": 0})
    n = work.save()
    return e.spark.createDataFrame([(n, t.df().count())], "changed long, left_rows long")


@query("dml_time_travel", "SELECT * FROM nation")
def dml_time_travel(e):
    """An older version of a table is still whole."""
    _, t = _nations(e)
    version = t.version
    t.delete(c("n_nationkey") > 3)
    return t.df(version)


@query("keygen_guid", "SELECT CAST(5 AS BIGINT) AS n, TRUE AS distinct_keys, TRUE AS long_enough")
def keygen_guid(e):
    keys = [generate_key("UUID") for _ in range(5)]
    return e.spark.createDataFrame([(len(keys), len(set(keys)) == 5, all(len(k) == 36 for k in keys))], "n long, distinct_keys boolean, long_enough boolean")


@query("keygen_max_seeded", "SELECT s_name, (SELECT MAX(c_custkey) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_name) AS k FROM supplier")
def keygen_max_seeded(e):
    return max_seeded_keys(e.set("supplier").df.select("s_name"), e.set("customer").df.select(c("c_custkey").alias("k")), "k", "s_name")


@query("keygen_hilo", "SELECT unnest(range(1, 6)) AS k")
def keygen_hilo(e):
    db = Database(e.spark, _folder(e))
    seq = HiLo(db.create_table("sequences", [("Name", "VARCHAR"), ("NextValue", "BIGINT")], key=["Name"]), "products", block=3)
    return e.spark.createDataFrame([(seq.next(),) for _ in range(5)], "k long")


@query("ddl_create", "SELECT 'shop' AS s, 'product' AS t, CAST(4 AS INTEGER) AS columns, CAST(2 AS BIGINT) AS rows_in")
def ddl_create(e):
    db = Database(e.spark, _folder(e))
    runner = Runner(db)
    steps = [
        ("create_schema", {"name": "shop"}),
        ("create_table", {"schema": "shop", "name": "product", "columns": [("Id", "BIGINT", False), ("Name", "VARCHAR"), ("Price", "DECIMAL(19,4)")], "key": ["Id"]}),
        ("add_column", {"schema": "shop", "name": "product", "column": "InStock", "kind": "BOOLEAN"}),
        ("insert", {"schema": "shop", "table": "product", "rows": [{"Id": 1, "Name": "Widget"}, {"Id": 2, "Name": "Gadget", "InStock": True}]}),
    ]
    runner.run([Migration("first", steps)])
    (t,) = db.scaffold()
    return e.spark.createDataFrame([(t["schema"], t["name"], len(t["columns"]), db.tables["shop", "product"].df().count())], "s string, t string, columns int, rows_in long")


@query("catalog_columns", "SELECT table_name, column_name, CAST(ordinal_position - 1 AS INTEGER) AS position FROM information_schema.columns WHERE table_name IN ('nation', 'region')")
def catalog_columns(e):
    return e.catalog.describe().where(c("table_name").isin("nation", "region")).select("table_name", "column_name", "position")


@query("src_csv", "SELECT 10 AS DEPTNO, 'Sales' AS NAME, DATE '2001-01-31' AS SINCE, TRUE AS OPEN UNION ALL SELECT 20, 'Marketing', NULL, FALSE UNION ALL SELECT 30, NULL, DATE '2010-12-01', NULL")
def src_csv(e):
    folder = _folder(e)
    lines = ["DEPTNO:int,NAME:string,SINCE:date,OPEN:boolean", "10,Sales,2001-01-31,true", "20,Marketing,,false", "30,,2010-12-01,"]
    e.spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(folder)
    return type(e).from_model(e.spark, {"version": "1", "defaultSchema": "s", "schemas": [{"name": "s", "type": "custom", "source": "csv", "tables": [{"name": "DEPTS", "operand": {"path": folder}}]}]}).set("DEPTS")


@query("src_json", "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name FROM nation")
def src_json(e):
    from ...sources.files import read

    folder = _folder(e)
    e.set("nation").df.select("n_nationkey", "n_name").write.json(folder)
    return read(e.spark, "json", {"path": folder, "schema": "n_nationkey int, n_name string"})


@query("src_orc", "SELECT * FROM region")
def src_orc(e):
    from ...sources.files import read

    folder = _folder(e)
    e.set("region").df.write.orc(folder)
    return read(e.spark, "orc", {"path": folder})
