"""Grouping, aggregates and terminal operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import query, same

same("agg_group_one", "SELECT o_orderstatus, COUNT(*) AS n, MAX(o_totalprice) AS top FROM orders GROUP BY o_orderstatus")
query("agg_group_multi", "SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS qty, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus")(
    lambda e: e.set("lineitem").group_by("l_returnflag", "l_linestatus").agg(qty=F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(38,2)"), n=F.count(F.lit(1)))
)
query("agg_global", "SELECT COUNT(*) AS n, MIN(o_orderdate) AS first_day, MAX(o_orderdate) AS last_day FROM orders")(lambda e: e.set("orders").agg(n=F.count(F.lit(1)), first_day=F.min("o_orderdate"), last_day=F.max("o_orderdate")))
query("agg_global_empty", "SELECT COUNT(*) AS n, SUM(o_totalprice) AS s FROM orders WHERE o_totalprice < 0")(lambda e: e.set("orders").where("o_totalprice < 0").agg(n=F.count(F.lit(1)), s=F.sum("o_totalprice")))
same("agg_count", "SELECT COUNT(*) AS n FROM lineitem WHERE l_discount > 0.03")
same("agg_count_col", "SELECT c_mktsegment, COUNT(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment")
query("agg_count_distinct", "SELECT l_shipmonth, COUNT(DISTINCT l_suppkey) AS suppliers, COUNT(DISTINCT l_partkey) AS parts FROM (SELECT *, CAST(month(l_shipdate) AS INTEGER) AS l_shipmonth FROM lineitem) t GROUP BY l_shipmonth")(
    lambda e: e.set("lineitem").extend(l_shipmonth=F.month("l_shipdate")).group_by("l_shipmonth").agg(suppliers=F.count_distinct("l_suppkey"), parts=F.count_distinct("l_partkey"))
)
query("agg_sum", "SELECT p_brand, CAST(SUM(p_size) AS BIGINT) AS sizes, ROUND(SUM(p_retailprice), 2) AS prices FROM part GROUP BY p_brand")(lambda e: e.set("part").group_by("p_brand").agg(sizes=F.sum("p_size"), prices=F.round(F.sum("p_retailprice"), 2)))
query("agg_sum0", "SELECT COALESCE(CAST(SUM(p_size) AS BIGINT), 0) AS s FROM part WHERE p_size > 1000")(lambda e: e.set("part").where("p_size > 1000").agg(s=e.functions.sum0(F.col("p_size"))))
same("agg_minmax", "SELECT p_type, MIN(p_name) AS lo, MAX(p_name) AS hi, MIN(p_size) AS small, MAX(p_size) AS big FROM part GROUP BY p_type")
query("agg_avg", "SELECT c_mktsegment, ROUND(AVG(c_acctbal), 4) AS bal, ROUND(CAST(AVG(c_nationkey) AS DOUBLE), 6) AS k FROM customer GROUP BY c_mktsegment")(lambda e: e.set("customer").group_by("c_mktsegment").agg(bal=F.round(F.avg("c_acctbal"), 4), k=F.round(F.avg("c_nationkey"), 6)))
same("agg_having", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12")
query("agg_sum_distinct", "SELECT p_brand, CAST(SUM(DISTINCT p_size) AS BIGINT) AS s, ROUND(AVG(DISTINCT p_size), 6) AS a FROM part GROUP BY p_brand")(lambda e: e.sql("SELECT p_brand, SUM(DISTINCT p_size) AS s, ROUND(AVG(DISTINCT p_size), 6) AS a FROM part GROUP BY p_brand"))
same("agg_filter", "SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS f, COUNT(*) FILTER (WHERE o_totalprice > 100000) AS big, MAX(o_totalprice) FILTER (WHERE o_orderstatus = 'O') AS top FROM orders GROUP BY o_orderpriority")
query("agg_rollup", "SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, CAST(GROUPING(o_orderstatus) * 2 + GROUPING(o_orderpriority) AS BIGINT) AS g FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")(
    lambda e: e.set("orders").rollup("o_orderstatus", "o_orderpriority").agg(n=F.count(F.lit(1)), g=F.grouping_id())
)
query("agg_cube", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")(lambda e: e.set("lineitem").cube("l_returnflag", "l_linestatus").agg(n=F.count(F.lit(1))))
query("agg_grouping_sets", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(GROUPING(l_returnflag) AS INTEGER) AS g FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")(
    lambda e: e.sql("SELECT l_returnflag, l_linestatus, COUNT(*) AS n, CAST(GROUPING(l_returnflag) AS INT) AS g FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())")
)
same("agg_long_count", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey")
same("agg_expr", "SELECT l_returnflag, ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS charge FROM lineitem GROUP BY l_returnflag")
same("agg_over_subquery", "SELECT MAX(n) AS most, MIN(n) AS least, COUNT(*) AS customers FROM (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) t")
query("agg_group_expr", "SELECT CAST(year(o_orderdate) AS INTEGER) AS y, COUNT(*) AS n FROM orders GROUP BY 1")(lambda e: e.set("orders").group_by(F.year("o_orderdate").alias("y")).agg(n=F.count(F.lit(1))))
query("agg_group_join", "SELECT c_name, n FROM customer JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) t ON c_custkey = o_custkey WHERE n > 10")(
    lambda e: e.set("customer").join(e.set("orders").group_by("o_custkey").agg(n=F.count(F.lit(1))).where("n > 10"), "c_custkey", "o_custkey").select("c_name", "n")
)
same("agg_distinct_multi", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS p, COUNT(DISTINCT l_suppkey) AS s, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag")

query("term_all", "SELECT COUNT(*) FILTER (WHERE NOT (o_totalprice > 0)) = 0 AS yes FROM orders")(lambda e: e.set("orders").agg(yes=F.bool_and(F.col("o_totalprice") > 0)))
query("term_any", "SELECT COUNT(*) FILTER (WHERE o_orderstatus = 'P') > 0 AS yes FROM orders")(lambda e: e.set("orders").agg(yes=F.bool_or(F.col("o_orderstatus") == "P")))
query("term_first", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 1")(lambda e: e.set("orders").order_by("o_orderdate", "o_orderkey").take(1).select("o_orderkey", "o_custkey"))
query("term_last", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")(lambda e: e.set("orders").order_by("o_orderdate", "o_orderkey").reverse().take(1).select("o_orderkey"))
query("term_element_at", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1 OFFSET 4")(lambda e: e.set("orders").order_by("o_orderkey").skip(4).take(1).select("o_orderkey"))

_STATS = "SELECT p_brand, ROUND(STDDEV_POP(p_size), 6) AS sp, ROUND(STDDEV_SAMP(p_size), 6) AS ss, ROUND(VAR_POP(p_size), 6) AS vp, ROUND(VAR_SAMP(p_size), 6) AS vs FROM part GROUP BY p_brand"
same("agg_stddev_var", _STATS)
query("agg_covar_regr", "SELECT p_brand, ROUND(COVAR_POP(p_retailprice, p_size), 4) AS cp, ROUND(COVAR_SAMP(p_retailprice, p_size), 4) AS cs, CAST(REGR_COUNT(p_retailprice, p_size) AS BIGINT) AS rc, ROUND(REGR_SXX(p_retailprice, p_size), 3) AS sxx, ROUND(REGR_SYY(p_retailprice, p_size), 1) AS syy FROM part GROUP BY p_brand")(
    lambda e: e.set("part").group_by("p_brand").agg(
        cp=F.round(F.covar_pop("p_retailprice", "p_size"), 4), cs=F.round(F.covar_samp("p_retailprice", "p_size"), 4), rc=F.regr_count("p_retailprice", "p_size"),
        sxx=F.round(F.regr_sxx("p_retailprice", "p_size"), 3), syy=F.round(F.regr_syy("p_retailprice", "p_size"), 1))
)
query("agg_listagg", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")(lambda e: e.sql("SELECT n_regionkey, LISTAGG(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey"))
query("agg_array_agg", "SELECT n_regionkey, list_sort(list(n_nationkey)) AS ks FROM nation GROUP BY n_regionkey")(lambda e: e.set("nation").group_by("n_regionkey").agg(ks=F.sort_array(e.functions.array_agg("n_nationkey"))))
query("agg_mode", "SELECT s, MAX(n) AS n FROM (SELECT c_mktsegment AS s, COUNT(*) AS n FROM customer GROUP BY 1) t WHERE n = (SELECT MAX(n) FROM (SELECT COUNT(*) AS n FROM customer GROUP BY c_mktsegment) u) GROUP BY s ORDER BY s LIMIT 1")(lambda e: _mode(e))


def _mode(e):
    """The most frequent value; of several the smallest."""
    mode = e.set("customer").agg(s=F.expr("mode() WITHIN GROUP (ORDER BY c_mktsegment)"))
    counts = e.set("customer").group_by("c_mktsegment").agg(n=F.count(F.lit(1)))
    return mode.join(counts, "s", "c_mktsegment").select("s", "n")


query("agg_arg_minmax", "SELECT n_regionkey, arg_max(n_name, n_nationkey) AS hi, arg_min(n_name, n_nationkey) AS lo FROM nation GROUP BY n_regionkey")(lambda e: e.sql("SELECT n_regionkey, ARG_MAX(n_name, n_nationkey) AS hi, ARG_MIN(n_name, n_nationkey) AS lo FROM nation GROUP BY n_regionkey"))
query("agg_percentile", "SELECT p_brand, ROUND(quantile_cont(p_retailprice, 0.25), 4) AS q1, quantile_disc(p_size, 0.5) AS med FROM part GROUP BY p_brand")(
    lambda e: e.sql("SELECT p_brand, ROUND(PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY p_retailprice), 4) AS q1, CAST(PERCENTILE_DISC(0.5) WITHIN GROUP (ORDER BY p_size) AS INT) AS med FROM part GROUP BY p_brand")
)
query("agg_count_if", "SELECT o_orderstatus, CAST(COUNT(*) FILTER (WHERE o_totalprice > 100000) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus")(lambda e: e.sql("SELECT o_orderstatus, COUNTIF(o_totalprice > 100000) AS n FROM orders GROUP BY o_orderstatus"))
same("agg_bit", "SELECT n_regionkey, BIT_AND(n_nationkey) AS a, BIT_OR(n_nationkey) AS o, BIT_XOR(n_nationkey) AS x FROM nation GROUP BY n_regionkey")
query("agg_bool", "SELECT o_orderstatus, BOOL_AND(o_totalprice > 2000) AS a, BOOL_OR(o_totalprice > 400000) AS o FROM orders GROUP BY o_orderstatus")(lambda e: e.sql("SELECT o_orderstatus, EVERY(o_totalprice > 2000) AS a, SOME(o_totalprice > 400000) AS o FROM orders GROUP BY o_orderstatus"))
query("agg_array_concat", "SELECT label, CAST(COUNT(*) AS INTEGER) AS n, list_sort(list(x)) AS xs FROM (SELECT label, unnest([vec_id, -vec_id]) AS x FROM embeddings) t GROUP BY label")(
    lambda e: e.set("embeddings").extend(a=F.array(F.col("vec_id"), -F.col("vec_id"))).group_by("label").agg(n=F.size(e.functions.array_concat_agg(F.col("a"))), xs=F.sort_array(e.functions.fusion(F.col("a"))))
)
query("agg_intersection", "SELECT n_regionkey, list_sort(list_filter([chr(CAST(c AS INTEGER)) FOR c IN range(65, 91)], lambda l: len(list_filter(names, lambda s: contains(s, l))) = len(names))) AS xs FROM (SELECT n_regionkey, list(n_name) AS names FROM nation GROUP BY n_regionkey) u")(
    lambda e: e.set("nation").extend(xs=F.array_distinct(F.regexp_extract_all("n_name", F.lit("[A-Z]"), F.lit(0)))).group_by("n_regionkey").agg(xs=F.sort_array(e.functions.intersection(F.col("xs"))))
)
query("agg_within_distinct", "SELECT o_orderstatus, CAST(SUM(v) AS DOUBLE) AS s, COUNT(v) AS n FROM (SELECT DISTINCT o_orderstatus, o_custkey, o_custkey % 7 AS v FROM orders) t GROUP BY o_orderstatus")(
    lambda e: e.sql("SELECT o_orderstatus, SUM(o_custkey % 7) WITHIN DISTINCT (o_custkey) AS s, CAST(COUNT(o_custkey % 7) WITHIN DISTINCT (o_custkey) AS BIGINT) AS n FROM orders GROUP BY o_orderstatus")
)
query("agg_single_value", "SELECT r_name, (SELECT n_name FROM nation WHERE n_nationkey = r_regionkey) AS n FROM region")(
    lambda e: e.set("region").join(e.set("nation"), "r_regionkey", "n_nationkey").group_by("r_name").agg(n=e.functions.single_value(F.col("n_name")))
)
same("agg_group_id", "SELECT n_regionkey, COUNT(*) AS n FROM nation GROUP BY GROUPING SETS ((n_regionkey), ())")
