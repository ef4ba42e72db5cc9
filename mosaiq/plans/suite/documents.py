"""JSON documents, arrays and maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import jsondoc
from . import query

c = F.col
_EV = (lambda e: e.set("events"))
_EM = (lambda e: e.set("embeddings").select("vec_id", a=F.transform(F.slice("embedding", 1, 6), lambda x: F.floor(x.cast("double") * 3).cast("int"))))
_A = "(SELECT vec_id, list_transform(embedding[1:6], lambda x: CAST(floor(CAST(x AS DOUBLE) * 3) AS INTEGER)) AS a FROM embeddings)"

query("json_query", "SELECT event_id, json_extract(props, '$') ->> '$.k' AS k FROM events")(lambda e: e.sql("SELECT event_id, JSON_QUERY(props, 'strict $.k') AS k FROM events"))
query("json_value", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")(lambda e: e.sql("SELECT event_id, JSON_VALUE(props, 'strict $.k' RETURNING INTEGER) AS k FROM events"))
query("json_nested", "SELECT event_id, json_extract_string(d, '$.r.n[1].t') AS t, CAST(json_extract_string(d, '$.r.v') AS INTEGER) AS v FROM (SELECT event_id, '{\"r\":{\"v\":' || user_id || ',\"n\":[{\"t\":\"a\"},{\"t\":\"b' || event_id || '\"}]}}' AS d FROM events) x")(
    lambda e: _EV(e).extend(d=F.concat(F.lit('{"r":{"v":'), c("user_id"), F.lit(',"n":[{"t":"a"},{"t":"b'), c("event_id"), F.lit('"}]}}'))).select("event_id", t=jsondoc.json_value(c("d"), "strict $.r.n[1].t"), v=jsondoc.json_value(c("d"), "$.r.v", "int"))
)
query("json_dynamic_index", "SELECT event_id, CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' END AS x FROM events")(
    lambda e: _EV(e).select("event_id", x=jsondoc.element(F.lit('["a","b","c"]'), "array<string>", (c("event_id") % 4).cast("int")))
)
query("json_set", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, user_id AS added, CAST(7 AS INTEGER) AS inner_value, 'kept' AS other, 'b' AS second FROM events")(lambda e: _json_set(e))
query("json_set_value", "SELECT event_id, CAST(user_id + 1 AS BIGINT) AS k FROM events")(lambda e: _EV(e).select("event_id", k=jsondoc.json_value(jsondoc.set_value(c("props"), "$.k", c("user_id") + 1), "$.k", "bigint")))


def _json_set(e):
    """Values set in and beside what is there; the rest of the document stays."""
    doc = F.concat(F.lit('{"a":'), c("props"), F.lit(',"o":"kept","n":[{"t":"a"},{"t":"b","v":1}]}'))
    for path, value in (("$.added", c("user_id")), ("$.n[1].v", F.lit(7))):
        doc = jsondoc.set_value(doc, path, value)
    get = lambda path, kind: jsondoc.json_value(c("d"), path, kind)
    return _EV(e).extend(d=doc).select("event_id", k=get("$.a.k", "int"), added=get("$.added", "bigint"), inner_value=get("$.n[1].v", "int"), other=get("$.o", "string"), second=get("$.n[1].t", "string"))


_LINES = "(SELECT o_orderkey, list({'n': l_linenumber, 'q': CAST(l_quantity AS BIGINT), 'f': l_returnflag} ORDER BY l_linenumber, CAST(l_quantity AS BIGINT), l_returnflag) AS xs FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)"


def _lines(e):
    """Orders with their lines as a JSON document, and the collection in it."""
    line = F.struct(c("l_linenumber").alias("n"), c("l_quantity").cast("bigint").alias("q"), c("l_returnflag").alias("f"))
    docs = e.set("orders").join(e.set("lineitem"), "o_orderkey", "l_orderkey").group_by("o_orderkey").agg(doc=F.to_json(F.struct(F.array_sort(F.collect_list(line)).alias("lines"))))
    return docs, jsondoc.Collection.of(c("doc"), "array<struct<n:int,q:bigint,f:string>>", "$.lines")


def _collection(name: str, sql: str, make) -> None:
    query(name, sql)(lambda e: (lambda docs, xs: docs.select("o_orderkey", **make(xs)))(*_lines(e)))


_collection("json_where", f"SELECT o_orderkey, list_transform(list_filter(xs, lambda x: x.q > 20), lambda x: x.n) AS ns, CAST(len(list_filter(xs, lambda x: x.q > 20)) AS INTEGER) AS m FROM {_LINES} t", lambda xs: {"ns": xs.where(lambda x: x["q"] > 20).select(lambda x: x["n"]).values, "m": xs.where(lambda x: x["q"] > 20).count()})
_collection("json_any_all", f"SELECT o_orderkey, len(list_filter(xs, lambda x: x.f = 'R')) > 0 AS some_r, len(list_filter(xs, lambda x: x.q > 5)) = len(xs) AS all_big, len(xs) > 0 AS any_line FROM {_LINES} t", lambda xs: {"some_r": xs.any(lambda x: x["f"] == "R"), "all_big": xs.all(lambda x: x["q"] > 5), "any_line": xs.any()})
_collection("json_group_by", f"SELECT o_orderkey, list_sort(list_transform(list_distinct(list_transform(xs, lambda x: x.f)), lambda k: k || ':' || CAST(list_sum(list_transform(list_filter(xs, lambda x: x.f = k), lambda x: x.q)) AS BIGINT))) AS sums FROM {_LINES} t", lambda xs: {"sums": F.array_sort(xs.group_by(lambda x: x["f"]).select(lambda g: F.concat_ws(":", g["key"], F.aggregate(g["items"], F.lit(0).cast("bigint"), lambda a, x: a + x["q"]))).values)})
_collection("json_select_many", f"SELECT o_orderkey, flatten(list_transform(xs, lambda x: [CAST(x.n AS BIGINT), x.q])) AS v FROM {_LINES} t", lambda xs: {"v": xs.select_many(lambda x: F.array(x["n"].cast("bigint"), x["q"])).values})
_collection("json_paging", f"SELECT o_orderkey, list_transform(xs[2:3], lambda x: x.n) AS ns, xs[1].f AS first_flag, CAST(list_sum(list_transform(xs, lambda x: x.q)) AS BIGINT) AS total FROM {_LINES} t", lambda xs: {"ns": xs.order_by(lambda x: x["n"]).skip(1).take(2).select(lambda x: x["n"]).values, "first_flag": xs.element_at(0)["f"], "total": xs.sum(lambda x: x["q"])})
query("json_materialize", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) * 2 AS k2 FROM events")(
    lambda e: _EV(e).extend(d=jsondoc.materialize(c("props"), "k int")).select("event_id", k=c("d.k"), k2=c("d.k") * 2)
)
query("json_array_ops", "SELECT event_id, CAST(3 AS INTEGER) AS n, CAST(user_id * 2 + 5 AS BIGINT) AS s, CASE WHEN user_id = 5 THEN CAST(1 AS INTEGER) ELSE 2 END AS d FROM events")(lambda e: _array_ops(e))


def _array_ops(e):
    doc = F.concat(F.lit("["), c("user_id"), F.lit(","), c("user_id"), F.lit(",5]"))
    ops = jsondoc.array_ops(doc, "array<bigint>")
    return _EV(e).select("event_id", n=ops["count"], s=ops["sum"], d=F.size(ops["distinct"]))


query("json_arrayagg", "SELECT n_regionkey, '[' || string_agg(CAST(n_nationkey AS VARCHAR), ',' ORDER BY n_nationkey) || ']' AS j FROM nation GROUP BY n_regionkey")(
    lambda e: e.set("nation").group_by("n_regionkey").agg(j=F.to_json(F.sort_array(F.collect_list("n_nationkey"))))
)
query("json_objectagg", "SELECT n_regionkey, '{' || string_agg('\"' || n_name || '\":' || n_nationkey, ',' ORDER BY n_name) || '}' AS j FROM nation GROUP BY n_regionkey")(
    lambda e: e.set("nation").group_by("n_regionkey").agg(j=e.functions.json_objectagg(c("n_name"), c("n_nationkey")))
)
query("json_type", "SELECT event_id, CASE CAST(event_id % 3 AS INTEGER) WHEN 0 THEN 'OBJECT<k: BIGINT>' WHEN 1 THEN 'ARRAY<BIGINT>' ELSE 'STRING' END AS t FROM events")(
    lambda e: _EV(e).select("event_id", t=e.functions.json_type(F.when(c("event_id") % 3 == 0, F.lit('{"k": 1}')).when(c("event_id") % 3 == 1, F.lit("[1, 2]")).otherwise(F.lit('"x"'))))
)

query("array_ops", f"SELECT vec_id, CAST(len(a) AS INTEGER) AS n, list_contains(a, 1) AS has, CAST(list_position(a, 1) AS BIGINT) AS pos, list_min(a) AS lo, list_max(a) AS hi, list_sort(list_distinct(a)) AS d, list_reverse(a) AS r, a[2:3] AS s FROM {_A} t")(
    lambda e: _EM(e).select("vec_id", n=F.size("a"), has=F.array_contains("a", 1), pos=F.when(F.array_contains("a", 1), F.array_position("a", 1)), lo=F.array_min("a"), hi=F.array_max("a"), d=F.sort_array(F.array_distinct("a")), r=F.reverse("a"), s=F.slice("a", 2, 2))
)
query("array_build", f"SELECT vec_id, list_append(a, 9) AS ap, list_prepend(9, a) AS pr, list_concat(a, [7, 8]) AS cc, list_filter(a, lambda x: x <> 1) AS rm, [vec_id, 0] AS mk FROM {_A} t")(
    lambda e: _EM(e).select("vec_id", ap=F.array_append("a", 9), pr=F.array_prepend("a", 9), cc=F.concat("a", F.array(F.lit(7), F.lit(8))), rm=F.array_remove("a", 1), mk=F.array("vec_id", F.lit(0).cast("bigint")))
)
query("array_sets", f"SELECT vec_id, list_sort(list_intersect(a, [0, 1, 2])) AS i, list_sort(list_distinct(list_concat(a, [5]))) AS u, list_has_any(a, [2, 3]) AS ov FROM {_A} t")(
    lambda e: _EM(e).select("vec_id", i=F.sort_array(F.array_intersect("a", F.array(F.lit(0), F.lit(1), F.lit(2)))), u=F.sort_array(F.array_union("a", F.array(F.lit(5)))), ov=F.arrays_overlap("a", F.array(F.lit(2), F.lit(3))))
)
query("array_join_str", f"SELECT vec_id, array_to_string(a, '-') AS s, CAST(list_sum(a) AS BIGINT) AS t FROM {_A} t")(
    lambda e: _EM(e).select("vec_id", s=F.array_join(F.transform("a", lambda x: x.cast("string")), "-"), t=F.aggregate("a", F.lit(0).cast("bigint"), lambda a, x: a + x))
)
query("array_hof", f"SELECT vec_id, list_transform(a, lambda x: x * 2) AS m, list_filter(a, lambda x: x > 0) AS f, len(list_filter(a, lambda x: x > 5)) > 0 AS ex, len(list_filter(a, lambda x: x >= -9)) = len(a) AS fa FROM {_A} t")(
    lambda e: _EM(e).select("vec_id", m=F.transform("a", lambda x: x * 2), f=F.filter("a", lambda x: x > 0), ex=F.exists("a", lambda x: x > 5), fa=F.forall("a", lambda x: x >= -9))
)
query("array_split", "SELECT p_partkey, string_split(p_type, ' ') AS w, CAST(len(string_split(p_type, ' ')) AS INTEGER) AS n FROM part")(lambda e: e.set("part").select("p_partkey", w=e.functions.string_to_array(c("p_type"), " "), n=F.size(F.split("p_type", " "))))
query("array_value", "SELECT n_nationkey, [n_nationkey, n_regionkey] AS a FROM nation")(lambda e: e.sql("SELECT n_nationkey, ARRAY[n_nationkey, n_regionkey] AS a FROM nation"))
query("array_more", f"SELECT vec_id, list_concat(list_concat(a[1:1], [9]), a[2:]) AS ins, list_filter(a, lambda x: x IS NOT NULL) AS comp, list_sort(list_distinct(list_filter(a, lambda x: x <> 0))) AS exc, [1, 1] AS rep, list_transform(a, lambda x: CAST(x AS VARCHAR) || '/' || CAST(x + 1 AS VARCHAR)) AS zp, list_reverse_sort(a) AS so, list_concat(a, a) AS fl FROM {_A} t")(
    lambda e: _EM(e).extend(b=F.transform("a", lambda x: x + 1)).select("vec_id", ins=F.array_insert("a", 2, F.lit(9)), comp=F.array_compact("a"), exc=F.sort_array(F.array_except("a", F.array(F.lit(0)))), rep=F.array_repeat(F.lit(1), 2), zp=F.transform(F.arrays_zip("a", "b"), lambda z: F.concat_ws("/", z["a"], z["b"])), so=F.sort_array("a", False), fl=F.flatten(F.array("a", "a")))
)
query("unnest", f"SELECT vec_id, unnest(a) AS x FROM {_A} t")(lambda e: e.from_sql("SELECT vec_id, x FROM (SELECT vec_id, TRANSFORM(SLICE(embedding, 1, 6), v -> CAST(FLOOR(CAST(v AS DOUBLE) * 3) AS INT)) AS a FROM embeddings) t, LATERAL EXPLODE(a) AS u(x)"))
query("vector_norm", "SELECT vec_id, ROUND(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 5) AS n FROM embeddings")(
    lambda e: e.set("embeddings").select("vec_id", n=F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))), 5))
)
query("map_ops", "SELECT n_nationkey, ['k', 'r'] AS ks, [n_nationkey, n_regionkey] AS vs, ['k=' || n_nationkey, 'r=' || n_regionkey] AS es, TRUE AS has, FALSE AS lacks, CAST(3 AS INTEGER) AS cat, n_name AS st FROM nation")(
    lambda e: e.set("nation").extend(m=F.create_map(F.lit("k"), c("n_nationkey"), F.lit("r"), c("n_regionkey"))).select(
        "n_nationkey", ks=F.map_keys("m"), vs=F.map_values("m"), es=F.transform(F.map_entries("m"), lambda x: F.concat_ws("=", x["key"], x["value"])), has=F.map_contains_key("m", "k"), lacks=F.map_contains_key("m", "z"),
        cat=F.size(F.map_concat("m", F.create_map(F.lit("z"), F.lit(1)))), st=F.element_at(F.str_to_map(F.concat(F.lit("a:1,b:"), c("n_name"))), "b"))
)
query("map_lookup", "SELECT n_nationkey, n_nationkey AS k, n_regionkey AS r, CAST(NULL AS INTEGER) AS absent FROM nation")(
    lambda e: e.set("nation").extend(m=F.map_from_arrays(F.array(F.lit("k"), F.lit("r")), F.array("n_nationkey", "n_regionkey"))).select("n_nationkey", k=e.functions.item(c("m"), F.lit("k")), r=e.functions.item(c("m"), F.lit("r")), absent=F.try_element_at(c("m"), F.lit("z")).cast("int"))
)
query("struct_fields", "SELECT n_nationkey, n_name AS b FROM nation")(lambda e: e.set("nation").extend(s=F.struct(c("n_nationkey").alias("a"), c("n_name").alias("b"))).select("n_nationkey", b=e.functions.dot(c("s"), "b")))
