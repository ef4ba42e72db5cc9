"""Functions and operators by their SQL names, each through the registry or the dialect."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.matching import match_recognize
from ...operators.windows import over
from . import query

c = F.col
_N = (lambda e: e.set("nation"))
_XS = "[n_nationkey, n_regionkey, 0]"


def _xs(e):
    return _N(e).extend(xs=F.array("n_nationkey", "n_regionkey", F.lit(0)))


query("kind_arrays", f"SELECT n_nationkey, list_filter([n_nationkey, NULL, 1], lambda x: x IS NOT NULL) AS compacted, list_sort(list_distinct(list_filter({_XS}, lambda x: x <> 1))) AS excepted, list_concat([n_nationkey, 7], [n_regionkey, 0]) AS inserted, ['a', 'a', 'a'] AS repeated, [n_nationkey || '-' || n_regionkey, n_regionkey || '-' || n_nationkey] AS zipped, list_sort({_XS}) AS sorted FROM nation")(
    lambda e: _xs(e).select(
        "n_nationkey",
        compacted=e.functions.array_compact(F.array(c("n_nationkey"), F.lit(None).cast("int"), F.lit(1))),
        excepted=e.functions.sort_array(e.functions.array_except(c("xs"), F.array(F.lit(1)))),
        inserted=e.functions.array_insert(c("xs"), F.lit(2), F.lit(7)),
        repeated=e.functions.array_repeat(F.lit("a"), 3),
        zipped=F.transform(e.functions.arrays_zip(F.array("n_nationkey", "n_regionkey").alias("a"), F.array("n_regionkey", "n_nationkey").alias("b")), lambda z: F.concat_ws("-", z["a"], z["b"])),
        sorted=e.functions.sort_array(c("xs")),
    )
)
query("kind_maps", "SELECT n_nationkey, ['a', 'b'] AS ks, [n_nationkey, n_regionkey] AS vs, ['a' || n_nationkey, 'b' || n_regionkey] AS es, TRUE AS has_a, FALSE AS has_z, n_regionkey AS from_entries, 'x' || n_nationkey AS from_text, CAST(3 AS INTEGER) AS joined FROM nation")(
    lambda e: _N(e).extend(m=e.functions.map_value_constructor(F.lit("a"), c("n_nationkey"), F.lit("b"), c("n_regionkey"))).select(
        "n_nationkey",
        ks=e.functions.map_keys(c("m")), vs=e.functions.map_values(c("m")),
        es=F.transform(e.functions.map_entries(c("m")), lambda x: F.concat(x["key"], x["value"])),
        has_a=e.functions.map_contains_key(c("m"), "a"), has_z=e.functions.map_contains_key(c("m"), "z"),
        from_entries=e.functions.item(e.functions.map_from_entries(F.array(F.struct(F.lit("k"), c("n_regionkey")))), F.lit("k")),
        from_text=e.functions.item(e.functions.str_to_map(F.concat(F.lit("p:x"), c("n_nationkey"))), F.lit("p")),
        joined=F.size(e.functions.map_concat(c("m"), F.create_map(F.lit("c"), F.lit(1)))),
    )
)
query("kind_strings", "SELECT n_nationkey, n_name AS converted, n_name AS converted_oracle, n_name || '/' || n_nationkey AS ws_pg, n_name || '/' || n_nationkey AS ws_spark, reverse(n_name) AS reversed, substr(n_name, 2, 3) AS s1, substr(n_name, 2) AS s2, substr(n_name, 1, 2) AS s3, substr(n_name, 3, 1) AS s4, left(n_name, 1) AS sounds, 'a' || n_name || 'b' AS chained, n_name AS strict, 'AND' = upper(substr(n_name, 1, 3)) OR contains(n_name, 'A') AS posix, contains(upper(n_name), 'IN') AS posix_i FROM nation")(
    lambda e: _N(e).select(
        "n_nationkey",
        converted=e.functions.convert(c("n_name"), "UTF-8"), converted_oracle=e.functions.convert_oracle(c("n_name"), "UTF-8"),
        ws_pg=e.functions.concat_ws_postgresql("/", c("n_name"), c("n_nationkey").cast("string")), ws_spark=e.functions.concat_ws_spark("/", c("n_name"), c("n_nationkey").cast("string")),
        reversed=e.functions.reverse_spark(c("n_name")),
        s1=e.functions.substr_big_query(c("n_name"), F.lit(2), F.lit(3)), s2=e.functions.substr_mysql(c("n_name"), F.lit(2)), s3=e.functions.substr_oracle(c("n_name"), F.lit(1), F.lit(2)), s4=e.functions.substr_postgresql(c("n_name"), F.lit(3), F.lit(1)),
        sounds=F.substring(e.functions.soundex_spark(c("n_name")), 1, 1),
        chained=e.functions.literal_chain(F.lit("a"), c("n_name"), F.lit("b")), strict=e.functions.cast_not_null(c("n_name"), "string"),
        posix=e.functions.posix_regex_case_sensitive(c("n_name"), "A"), posix_i=e.functions.posix_regex_case_insensitive(c("n_name"), "in"),
    )
)
query("kind_times", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + 3 AS DATE) AS added, CAST(CAST(o_orderdate AS DATE) - 3 AS DATE) AS taken, CAST(CAST(o_orderdate AS DATE) + INTERVAL 2 MONTH AS DATE) AS months, o_orderdate + INTERVAL 5 HOUR AS later, o_orderdate - INTERVAL 5 HOUR AS sooner, o_orderdate + INTERVAL 4 DAY AS ts_added, o_orderdate - INTERVAL 4 DAY AS ts_taken FROM orders")(
    lambda e: e.set("orders").select(
        "o_orderkey",
        added=e.functions.date_add(c("o_orderdate").cast("date"), 3), taken=e.functions.date_sub(c("o_orderdate").cast("date"), 3), months=e.functions.add_months(c("o_orderdate").cast("date"), 2),
        later=e.functions.time_add(c("o_orderdate"), e.functions.interval(hours=5)), sooner=e.functions.time_sub(c("o_orderdate"), e.functions.interval(hours=5)),
        ts_added=e.functions.timestamp_add("DAY", F.lit(4), c("o_orderdate")), ts_taken=e.functions.timestamp_sub(c("o_orderdate"), e.functions.interval(days=4)),
    )
)
query("kind_values", "SELECT n_nationkey, least(n_nationkey, n_regionkey) AS least_pg, n_nationkey AS spec, n_regionkey AS row_second, [n_nationkey, n_regionkey] AS multiset, CAST(n_nationkey AS BIGINT) AS reinterpreted, n_regionkey IN (1, 2) AS druid, n_regionkey NOT IN (1, 2) AS not_druid, 7 AS constant, n_nationkey AS expr FROM nation")(
    lambda e: _N(e).select(
        "n_nationkey",
        least_pg=e.functions.least_pg(c("n_nationkey"), c("n_regionkey")),
        spec=e.functions.dot(e.functions.new_specification(c("n_nationkey").alias("a")), "a"), row_second=e.functions.dot(e.functions.row(c("n_nationkey").alias("a"), c("n_regionkey").alias("b")), "b"),
        multiset=e.functions.multiset_value_constructor(c("n_nationkey"), c("n_regionkey")), reinterpreted=e.functions.reinterpret(c("n_nationkey"), "bigint"),
        druid=e.functions.druid_in(c("n_regionkey"), 1, 2), not_druid=e.functions.druid_not_in(c("n_regionkey"), 1, 2), constant=e.functions.literal_agg(7),
        expr=F.variant_get(e.functions.json_value_expression(F.concat(F.lit('{"v":'), c("n_nationkey"), F.lit("}"))), "$.v", "int"),
    )
)
query("kind_aggregates", "SELECT n_regionkey, n_regionkey AS anyone, string_agg(n_name, ',' ORDER BY n_name) AS names, list_sort(list(n_nationkey)) AS arrayed, list_sort(list(n_nationkey)) AS multiset, list_sort(list(n_nationkey)) AS collected, CAST(COUNT(*) AS INTEGER) AS entries, MIN(n_nationkey) AS lowest, quantile_disc(n_nationkey, 0.5) AS middle FROM nation GROUP BY n_regionkey")(
    lambda e: _N(e).group_by("n_regionkey").agg(
        anyone=e.functions.any_value(c("n_regionkey")), names=F.array_join(F.array_sort(F.split(e.functions.group_concat(c("n_name"), F.lit(",")), ",")), ","),
        arrayed=F.sort_array(e.functions.array_query_constructor(c("n_nationkey"))), multiset=F.sort_array(e.functions.multiset_query_constructor(c("n_nationkey"))), collected=F.sort_array(e.functions.collect(c("n_nationkey"))),
        entries=F.size(e.functions.map_query_constructor(c("n_name"), c("n_nationkey"))), lowest=e.functions.min(c("n_nationkey")), middle=e.functions.percentile_disc(c("n_nationkey"), 0.5).cast("int"),
    )
)
_PERIODS = "(SELECT l_orderkey, l_linenumber, o_orderdate AS a, l_shipdate AS b, TIMESTAMP '1995-01-01' AS x, TIMESTAMP '1996-01-01' AS y FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
query("kind_periods", f"SELECT l_orderkey, l_linenumber, a <= x AND b >= y AS contains, b <= x AS precedes, a >= y AS succeeds, b = x AS precedes_now, a = y AS succeeds_now, a = x AND b = y AS equals, a < y AND x < b AS overlaps FROM {_PERIODS} t")(
    lambda e: (lambda f, p: e.set("lineitem").join(e.set("orders"), "l_orderkey", "o_orderkey").extend(a=c("o_orderdate"), b=c("l_shipdate"), x=F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"), y=F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", contains=f.period_contains(*p), precedes=f.precedes(*p), succeeds=f.succeeds(*p), precedes_now=f.immediately_precedes(*p), succeeds_now=f.immediately_succeeds(*p), equals=f.period_equals(*p), overlaps=f.overlaps(*p)
    ))(e.functions, [c(k) for k in "abxy"])
)
_W = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
query("kind_neighbours", f"SELECT o_orderkey, LAG(o_totalprice) {_W} AS before, LEAD(o_totalprice, 2) {_W} AS after, LAST_VALUE(o_orderstatus RESPECT NULLS) {_W} AS respected FROM orders")(
    lambda e: (lambda w: e.set("orders").select("o_orderkey", before=e.functions.prev(c("o_totalprice")).over(w), after=e.functions.next(c("o_totalprice"), 2).over(w), respected=F.expr("last_value(o_orderstatus) RESPECT NULLS OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")))(over(["o_custkey"], ["o_orderdate", "o_orderkey"]))
)

_STATUS = "(SELECT o_custkey, o_orderkey, o_orderstatus AS s, LEAD(o_orderstatus) OVER w AS s1, LEAD(o_orderkey) OVER w AS k1 FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey))"


def _pairs(e, pattern: str, after: str = "to next row"):
    rows = e.set("orders").df.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    define = {"O": c("o_orderstatus") == "O", "F": c("o_orderstatus") == "F"}
    return match_recognize(rows, partition=["o_custkey"], order=["o_orderdate", "o_orderkey"], pattern=pattern, define=define, after=after)


query("kind_pattern_permute", f"SELECT o_custkey, o_orderkey AS first_o_orderkey, k1 AS last_o_orderkey, s || s1 AS classifiers FROM {_STATUS} t WHERE (s = 'O' AND s1 = 'F') OR (s = 'F' AND s1 = 'O')")(
    lambda e: _pairs(e, "PERMUTE(O, F)").select("o_custkey", "first_o_orderkey", "last_o_orderkey", "classifiers")
)
query("kind_pattern_alter", f"SELECT o_custkey, o_orderkey AS first_o_orderkey, s || s1 AS classifiers FROM {_STATUS} t WHERE s IN ('O', 'F') AND s1 IN ('O', 'F')")(lambda e: _pairs(e, "(O | F) (O | F)").select("o_custkey", "first_o_orderkey", "classifiers"))
query("kind_pattern_excluded", f"SELECT o_custkey, o_orderkey AS first_o_orderkey, 'O' AS classifiers, CAST(1 AS BIGINT) AS length FROM {_STATUS} t WHERE s = 'O' AND s1 = 'F'")(lambda e: _pairs(e, "O {- F -}").select("o_custkey", "first_o_orderkey", "classifiers", "length"))
query("kind_pattern_skip", f"SELECT o_custkey, o_orderkey AS first_o_orderkey FROM {_STATUS} t WHERE s = 'O' AND s1 = 'F'")(lambda e: _pairs(e, "O F", "to last F").select("o_custkey", "first_o_orderkey"))


@query("src_jdbc", "SELECT CAST(n_nationkey AS INTEGER) AS n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def src_jdbc(e):
    """A table of a JDBC store, read in parts, the filter pushed to the store."""
    from ...sources.files import derby_store, read

    store = derby_store(e.set("nation").df, "nation")
    options = {**store, "dbtable": "nation", "partitionColumn": "N_NATIONKEY", "lowerBound": 0, "upperBound": 25, "numPartitions": 3}
    rows = read(e.spark, "jdbc", options)
    return rows.toDF(*[x.lower() for x in rows.columns]).where("n_regionkey = 2").select("n_nationkey", "n_name")
