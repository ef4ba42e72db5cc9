"""Scans, projections, filters, predicates, order, paging and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...sources.files import values
from . import query, same

FLAGSHIP = """
SELECT n_name, o_orderpriority, COUNT(*) AS order_cnt,
       CAST(SUM(l_extendedprice * (1 - l_discount)) AS DECIMAL(18,2)) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE l_quantity BETWEEN 5 AND 30 AND o_orderstatus IN ('F','O')
GROUP BY n_name, o_orderpriority HAVING COUNT(*) >= 2
"""


@query("flagship", FLAGSHIP)
def flagship(e):
    lines = e.set("lineitem").where(F.col("l_quantity").between(5, 30))
    orders = e.set("orders").where(F.col("o_orderstatus").isin("F", "O"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,2)")
    joined = lines.join(orders, "l_orderkey", "o_orderkey").join(e.set("customer"), "o_custkey", "c_custkey").join(e.set("nation"), "c_nationkey", "n_nationkey")
    return joined.group_by("n_name", "o_orderpriority").agg(order_cnt=F.count(F.lit(1)), revenue=revenue).where("order_cnt >= 2")


query("scan_full", "SELECT * FROM nation")(lambda e: e.set("nation"))
query("scan_narrow", "SELECT c_custkey, c_name FROM customer")(lambda e: e.set("customer").select("c_custkey", "c_name"))


@query("values_rows", "SELECT * FROM (VALUES (1, 'one', TRUE), (2, 'two', FALSE), (3, NULL, NULL)) AS v(id, name, flag)")
def values_rows(e):
    return values(e.spark, [(1, "one", True), (2, "two", False), (3, None, None)], "id int, name string, flag boolean")


@query("collection_scan", "SELECT vec_id, CAST(pos - 1 AS INTEGER) AS pos, embedding[pos] AS v FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings) t")
def collection_scan(e):
    return e.set("embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))


query("federated_view", "SELECT c_custkey AS id, c_name AS name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT s_suppkey AS id, s_name AS name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")(
    lambda e, d: _federated(e, d)
)


def _federated(e, folder):
    """A view over two schemas that each have a source of their own."""
    model = {
        "version": "1.0",
        "defaultSchema": "shop",
        "schemas": [
            {"name": "sales", "type": "custom", "source": "parquet", "operand": {"directory": folder}, "tables": [{"name": "customer", "key": ["c_custkey"]}, {"name": "nation"}]},
            {"name": "supply", "type": "custom", "source": "parquet", "operand": {"directory": folder}, "tables": [{"name": "supplier", "key": ["s_suppkey"]}]},
            {"name": "shop", "type": "custom", "tables": [{"name": "partner", "type": "view", "sql": [
                'SELECT c_custkey AS id, c_name AS name, n_name FROM "sales"."customer" JOIN "sales"."nation" ON c_nationkey = n_nationkey',
                'UNION ALL SELECT s_suppkey AS id, s_name AS name, n_name FROM "supply"."supplier" JOIN "sales"."nation" ON s_nationkey = n_nationkey']}]},
        ],
    }
    return type(e).from_model(e.spark, model).sql('SELECT * FROM "shop"."partner"')


@query("view_def", "SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def view_def(e):
    e.catalog.view_sql("customers_by_nation", 'SELECT n_name, COUNT(*) AS customers FROM "customer" JOIN "nation" ON c_nationkey = n_nationkey GROUP BY n_name')
    return e.sql("SELECT * FROM customers_by_nation")


@query("from_sql_composed", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def from_sql_composed(e):
    return e.from_sql("SELECT * FROM orders WHERE o_totalprice > ?", 100000.0).where(F.col("o_orderstatus") == "F").order_by("o_totalprice", descending=True).then_by("o_orderkey").take(20).select("o_orderkey", "o_totalprice")


same("filter_compare", "SELECT o_orderkey FROM orders WHERE o_totalprice >= 50000 AND o_totalprice < 150000 AND o_orderstatus <> 'P' AND o_custkey <= 1000 AND o_orderkey > 10")
same("project_subset", "SELECT p_partkey, p_name, p_size FROM part")


@query("calc_filter_project", "SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40")
def calc(e):
    rows = e.set("lineitem").where(F.col("l_returnflag") == "R", F.col("l_quantity") > 40)
    return rows.select("l_orderkey", "l_linenumber", net=F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4))


query("distinct_cols", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")(lambda e: e.set("orders").select("o_orderstatus", "o_orderpriority").distinct())


@query("literals_all", "SELECT CAST(1 AS INTEGER) AS i, CAST(2 AS BIGINT) AS l, CAST(1.5 AS DOUBLE) AS d, CAST(12.3400 AS DECIMAL(19,4)) AS m, 'it''s' AS s, TRUE AS b, DATE '2024-06-15' AS dt, TIMESTAMP '2024-06-15 12:30:00.123' AS ts, CAST(NULL AS VARCHAR) AS n")
def literals(e):
    import datetime as dt
    import decimal

    from ...types import literal, spark_type

    items = [("i", 1, "INTEGER"), ("l", 2, "BIGINT"), ("d", 1.5, "DOUBLE"), ("m", decimal.Decimal("12.34"), "DECIMAL"), ("s", "it's", "VARCHAR"), ("b", True, "BOOLEAN"),
             ("dt", dt.date(2024, 6, 15), "DATE"), ("ts", dt.datetime(2024, 6, 15, 12, 30, 0, 123000), "TIMESTAMP"), ("n", None, "VARCHAR")]
    return e.spark.sql("SELECT " + ", ".join(f"CAST({literal(v)} AS {spark_type(t)}) AS {n}" for n, v, t in items))


query("param_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 200000 LIMIT 1000000")(
    lambda e: e.sql("SELECT o_orderkey FROM orders WHERE o_orderstatus = ? AND o_totalprice > CAST(? AS DOUBLE) FETCH FIRST ? ROWS ONLY", "O", 200000, 1000000)
)
same("filter_bool", "SELECT p_partkey FROM part WHERE (p_size > 10 AND p_size < 20 AND p_retailprice > 1000) OR (p_size = 50 AND NOT p_brand = 'Brand#11') OR p_size = 1")


@query("filter_null", "SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 250000 WHERE o_orderkey IS NULL AND c_name IS NOT NULL")
def filter_null(e):
    return e.set("customer").left_join(e.set("orders").where("o_totalprice > 250000"), "c_custkey", "o_custkey").where(F.col("o_orderkey").isNull(), F.col("c_name").isNotNull()).select("c_custkey")


@query("bool_tests", "SELECT p_partkey, f IS TRUE AS t, f IS NOT TRUE AS nt, f IS FALSE AS fa, f IS NOT FALSE AS nf, f IS NULL AS u FROM (SELECT p_partkey, CASE WHEN p_size > 30 THEN TRUE WHEN p_size > 10 THEN FALSE END AS f FROM part) x")
def bool_tests(e):
    f, x = e.functions, F.when(F.col("p_size") > 30, True).when(F.col("p_size") > 10, False)
    return e.set("part").extend(f=x).select("p_partkey", t=f.is_true(F.col("f")), nt=f.is_not_true(F.col("f")), fa=f.is_false(F.col("f")), nf=f.is_not_false(F.col("f")), u=f.is_unknown(F.col("f")))


query("filter_between", "SELECT o_orderkey FROM orders WHERE o_totalprice BETWEEN 1000 AND 60000")(lambda e: e.set("orders").where(F.col("o_totalprice").between(1000, 60000)).select("o_orderkey"))
query("filter_in", "SELECT n_name FROM nation WHERE n_regionkey IN (0, 2, 4)")(lambda e: e.set("nation").where(F.col("n_regionkey").isin(0, 2, 4)).select("n_name"))
query("filter_not_in", "SELECT n_name FROM nation WHERE n_regionkey NOT IN (0, 2, 4)")(lambda e: e.set("nation").where(~F.col("n_regionkey").isin(0, 2, 4)).select("n_name"))
same("filter_ranges", "SELECT p_partkey FROM part WHERE (p_size > 5 AND p_size <= 10) OR (p_size >= 20 AND p_size < 25) OR p_size IN (30, 31) OR p_size > 48")
query("filter_like", r"SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%a_e%' OR p_name LIKE 'x!%%' ESCAPE '!'")(lambda e: e.set("part").where(F.col("p_name").like("%a_e%") | F.like(F.col("p_name"), F.lit("x!%%"), F.lit("!"))).select("p_partkey", "p_name"))
query("filter_boolcol", "SELECT l_orderkey, l_linenumber FROM (SELECT *, l_discount > 0.05 AS cheap FROM lineitem) t WHERE cheap")(lambda e: e.set("lineitem").extend(cheap=F.col("l_discount") > 0.05).where(F.col("cheap")).select("l_orderkey", "l_linenumber"))


@query("struct_equality", "SELECT a.c_custkey AS a_key, b.c_custkey AS b_key FROM customer a JOIN customer b ON a.c_nationkey IS NOT DISTINCT FROM b.c_nationkey AND a.c_mktsegment IS NOT DISTINCT FROM b.c_mktsegment AND a.c_custkey < b.c_custkey")
def struct_equality(e):
    pairs = _pairs(e.set("customer").select(key=F.col("c_custkey"), group=F.struct("c_nationkey", "c_mktsegment")).df)
    return pairs.select(F.col("a").alias("a_key"), F.col("b").alias("b_key"))


def _pairs(df, size=1024):
    """``a`` and ``b``: every two keys of a group, the lesser first. Structs are
    alike if their fields are, nulls too. Pairs grow with the square of a group, but
    a join is dealt by groups and bytes, so few tasks would make them all. So the
    keys of a group are cut into blocks, and each block is dealt with all keys from
    its own on; no broadcast, as that leaves all pairs to the other side's tasks."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy("key"))
    blocks = df.where("key IS NOT NULL").select("group", F.col("key").alias("a"), ((rank - 1) / size).cast("long").alias("block"))
    later = blocks.select("group", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("block"), F.col("a").alias("b"))
    return later.repartition(parts, "group", "block").join(blocks.hint("merge"), ["group", "block"]).where("a < b")


@query("query_filter", "SELECT c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'")
def query_filter(e):
    e.catalog.find("customer").filters.append(lambda df: df["c_acctbal"] > 0)
    return e.set("customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")


query("query_filter_ignored", "SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'")(lambda e: _unfiltered(e))


def _unfiltered(e):
    e.catalog.find("customer").filters.append(lambda df: df["c_acctbal"] > 0)
    return e.set("customer").ignore_filters().where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")


query("null_filtered_view", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")(lambda e: _filtered_view(e))


def _filtered_view(e):
    e.catalog.view_sql("rich", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")
    return e.sql("SELECT c_custkey FROM rich")


query("initcap_fallback", "SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS name FROM customer")(lambda e: e.set("customer").select("c_custkey", name=F.initcap(F.lower("c_mktsegment"))))

# order and paging

query("sort_multi", "SELECT c_mktsegment, c_custkey FROM customer ORDER BY c_mktsegment ASC NULLS FIRST, c_custkey DESC NULLS LAST LIMIT 100")(
    lambda e: e.set("customer").order_by("c_mktsegment").then_by("c_custkey", descending=True).take(100).select("c_mktsegment", "c_custkey")
)
query("limit_offset", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25 OFFSET 50")(lambda e: e.sql('SELECT "o_orderkey" FROM orders ORDER BY o_orderkey OFFSET 50 ROWS FETCH NEXT 25 ROWS ONLY'))
query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")(lambda e: e.set("orders").order_by("o_totalprice", descending=True).then_by("o_orderkey").take(10).select("o_orderkey", "o_totalprice"))
query("limit_nested", "SELECT o_orderkey FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 30) t ORDER BY o_orderkey LIMIT 7")(lambda e: e.set("orders").order_by("o_orderkey").take(30).take(7).select("o_orderkey"))
query("limit_filter_order", "SELECT o_orderkey FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 40 OFFSET 5) t WHERE o_orderstatus = 'F'")(lambda e: e.set("orders").order_by("o_orderkey").skip(5).take(40).where(F.col("o_orderstatus") == "F").select("o_orderkey"))
query("sort_reverse", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey DESC NULLS LAST LIMIT 5")(lambda e: e.set("part").order_by("p_retailprice", "p_partkey").reverse().take(5).select("p_partkey"))
query("sort_expr", "SELECT s_suppkey FROM supplier ORDER BY abs(s_acctbal) DESC, s_suppkey LIMIT 15")(lambda e: e.set("supplier").order_by(F.abs("s_acctbal"), descending=True).then_by("s_suppkey").take(15).select("s_suppkey"))

# set operations

_C, _S = "SELECT c_nationkey AS k FROM customer", "SELECT s_nationkey AS k FROM supplier"


def _sides(e):
    return e.set("customer").select(k=F.col("c_nationkey")), e.set("supplier").select(k=F.col("s_nationkey"))


query("set_union", f"{_C} UNION {_S}")(lambda e: (lambda a, b: a.union(b))(*_sides(e)))
query("set_union_all", f"{_C} UNION ALL {_S}")(lambda e: (lambda a, b: a.concat(b))(*_sides(e)))
query("set_intersect", f"{_C} INTERSECT {_S}")(lambda e: (lambda a, b: a.intersect(b))(*_sides(e)))
query("set_except", f"{_C} EXCEPT SELECT s_nationkey AS k FROM supplier WHERE s_acctbal < 3000")(lambda e: _sides(e)[0].except_(e.set("supplier").where("s_acctbal < 3000").select(k=F.col("s_nationkey"))))
query("set_intersect_all", f"{_C} INTERSECT ALL {_S}")(lambda e: (lambda a, b: a.intersect(b, all=True))(*_sides(e)))
query("set_except_all", f"{_C} EXCEPT ALL {_S}")(lambda e: (lambda a, b: a.except_(b, all=True))(*_sides(e)))
same("set_minus", "SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")


@query("set_union_ordered", "(SELECT o_orderkey AS id, o_totalprice AS v FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5) UNION ALL (SELECT c_custkey AS id, c_acctbal AS v FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5)")
def set_union_ordered(e):
    a = e.set("orders").order_by("o_totalprice", descending=True).then_by("o_orderkey").take(5).select(id=F.col("o_orderkey"), v=F.col("o_totalprice"))
    return a.concat(e.set("customer").order_by("c_acctbal", descending=True).then_by("c_custkey").take(5).select(id=F.col("c_custkey"), v=F.col("c_acctbal")))
