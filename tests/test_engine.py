"""Golden results of the small shop, the builder, catalog, types, changes and streams."""

from __future__ import annotations

import datetime as dt
import decimal
import re
import warnings

import pytest
from pyspark.sql import functions as F

from mosaiq.catalog import Catalog, Entity, Navigation
from mosaiq.functions import compat, jsondoc
from mosaiq.operators.ddl import Database, Migration, Runner
from mosaiq.operators.dml import ConcurrencyError, KeyGenerationError, ManagedTable, UnitOfWork, generate_key
from mosaiq.plans.rewrites import drop_unused_join
from mosaiq.session import Engine
from mosaiq.sources.files import derby_store, typed_header, values
from mosaiq.types import checked, literal, logical, milliseconds, spark_type, widen

PRODUCTS = [(1, "Widget", "9.99", True, 1), (2, "Gadget", "24.95", False, 1), (3, "Doohickey", "4.50", True, 2), (4, "Thingamajig", "14.99", False, 2), (5, "Whatsit", "2.99", True, 3), (6, "Gizmo", "49.99", False, None)]


@pytest.fixture
def shop(spark):
    e = Engine(spark)
    rows = [(i, n, decimal.Decimal(p), s, c) for i, n, p, s, c in PRODUCTS]
    products = values(e.spark, rows, "Id int, Name string, Price decimal(28,4), InStock boolean, CategoryId int")
    categories = values(e.spark, [(1, "Electronics"), (2, "Household"), (3, "Toys")], "Id int, Name string")
    e.catalog.table("Product", lambda _: products, key=("Id",))
    e.catalog.table("Category", lambda _: categories, key=("Id",))
    e.catalog.relate("Product", [Navigation("category", "Category", ("CategoryId",), ("Id",))])
    e.catalog.relate("Category", [Navigation("products", "Product", ("Id",), ("CategoryId",), many=True)])
    return e


def one(df):
    return df.first()[0]


def test_shop_aggregates(shop):
    sql = shop.sql
    assert one(sql('SELECT COUNT(*) FROM "Product"')) == 6
    assert one(sql('SELECT COUNT(*) FROM "Product" WHERE "InStock"')) == 3
    assert one(sql('SELECT COUNT(*) FROM "Product" WHERE "Price" > 10')) == 3
    assert one(sql('SELECT SUM("Price") FROM "Product"')) == decimal.Decimal("107.41")
    assert one(sql('SELECT MAX("Price") FROM "Product"')) == decimal.Decimal("49.99")
    assert float(one(sql('SELECT AVG("Price") FROM "Product"'))) == pytest.approx(17.90, abs=0.01)
    assert one(sql("SELECT COUNT(*) FROM Product WHERE Name LIKE 'G%'")) == 2
    assert one(sql('SELECT COUNT(DISTINCT "CategoryId") FROM "Product"')) == 3
    assert one(sql("SELECT COUNT(*) FROM Product WHERE CategoryId IS NULL")) == 1


def test_shop_joins(shop):
    assert shop.sql('SELECT p."Name" FROM "Product" p JOIN "Category" c ON p."CategoryId" = c."Id"').count() == 5
    assert shop.sql('SELECT p."Name" FROM "Product" p LEFT JOIN "Category" c ON p."CategoryId" = c."Id"').count() == 6
    assert shop.set("Product").navigate("category").count() == 5
    assert shop.set("Product").navigate("category", keep=True).count() == 6
    assert {r["Id"]: len(r["products"]) for r in shop.set("Category").include("products").rows()} == {1: 2, 2: 2, 3: 1}
    grouped = {r["Id"]: len(r["inners"]) for r in shop.set("Category").group_join(shop.set("Product").select("CategoryId", product=F.col("Name")), "Id", "CategoryId").rows()}
    assert grouped == {1: 2, 2: 2, 3: 1}


def test_shop_case(shop):
    label = F.when(F.col("Price") < 5, "Cheap").when(F.col("Price") < 15, "Mid").otherwise("Expensive")
    got = [r["label"] for r in shop.set("Product").order_by("Id").select(label=label).rows()]
    assert got == ["Mid", "Expensive", "Cheap", "Mid", "Cheap", "Expensive"]


def test_null_semantics(shop, spark):
    q = shop.set("Product")
    assert q.where(q.eq(F.col("CategoryId"), None)).count() == 1
    assert q.where(q.ne(F.col("CategoryId"), 1)).count() == 4
    relational = Engine(spark, relational_nulls=True)
    relational.catalog = shop.catalog
    r = relational.set("Product")
    assert r.where(r.ne(F.col("CategoryId"), 1)).count() == 3


def test_terminals(shop):
    q = shop.set("Product").order_by("Id")
    assert q.first()["Name"] == "Widget" and q.last()["Name"] == "Gizmo" and q.element_at(2)["Name"] == "Doohickey"
    assert q.any(F.col("Price") > 40) and not q.all(F.col("InStock")) and q.contains("Name", "Gadget")
    with pytest.raises(LookupError):
        q.single()
    assert q.where("Id = 3").single()["Name"] == "Doohickey"
    assert shop.set("Product").where("Id < 0").first_or_default() is None
    assert shop.set("Product").where("Id < 0").default_if_empty().count() == 1
    assert [r["Id"] for r in q.skip(1).take(2).rows()] == [2, 3]


def test_sessions_are_apart(spark, shop):
    before = spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers", None)
    shop.sql('SELECT "Name" FROM "Product"').count()
    assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers", None) == before


def test_inheritance_join_is_one_scan(spark, tmp_path):
    e = Engine(spark)
    path = f"{tmp_path}/animals"
    e.spark.createDataFrame([(1, "Rex", "Dog", 3), (2, "Tom", "Cat", None)], "Id int, Name string, Kind string, Extra int").write.parquet(path)
    e.catalog.parquet("Animal", path, key=("Id",))
    e.catalog.add(Entity("main", "Dog", base="Animal", strategy="TPH", discriminator=("Kind", "Dog"), key=("Id",)))
    joined = e.set("Animal").join(e.set("Dog"), "Id", "Id")
    plan = e.explain(joined.df)
    assert "Join" not in plan and [r["Name"] for r in joined.rows()] == ["Rex"]
    # a narrowed base is no longer all of it
    assert "Join" in e.explain(e.set("Animal").where("Id > 1").join(e.set("Dog"), "Id", "Id").df)
    assert e.set("Animal").of_type("Dog").count() == 1


def test_unused_join_goes(shop):
    left, right = shop.set("Product").df, shop.set("Category").df.select(F.col("Id").alias("cid"))
    out = drop_unused_join(left.join(right, left["CategoryId"] == right["cid"], "left"), left, ["Id", "Name"], True)
    assert "Join" not in shop.explain(out) and out.count() == 6


def test_model_federation_and_names(spark):
    model = {"version": "1.0", "defaultSchema": "fake", "schemas": [
        {"name": "real1", "type": "custom", "source": "rows", "tables": [{"name": "P1", "operand": {"rows": [[1, "Widget"], [2, "Gadget"], [3, "Doohickey"]], "schema": "Id int, Name string"}}]},
        {"name": "real2", "type": "custom", "source": "rows", "tables": [{"name": "P2", "operand": {"rows": [[1, 30.0], [2, 20.0], [3, 1.22]], "schema": "Id int, Price double"}}]},
        {"name": "fake", "type": "custom", "tables": [{"name": "P", "type": "view", "sql": 'SELECT a."Id", a."Name", b."Price" FROM "real1"."P1" a JOIN "real2"."P2" b ON a."Id" = b."Id"'}]}]}
    e = Engine.from_model(spark, model)
    assert e.set("P").count() == 3 and e.catalog.schemas() == ["fake", "real1", "real2"]
    assert e.sql('SELECT "Price" FROM fake."P" WHERE "Id" = 3').first()[0] == 1.22
    c = Catalog(e.spark)
    long = "x" * 200
    assert len(c.add(Entity("s", long)).name) == 128 and c.add(Entity("s", long)).name.endswith("~2")
    with pytest.raises(ValueError):
        c.add(Entity("s", "a")) and c.add(Entity("s", "A"))
    with pytest.raises(KeyError):
        e.set("nothing")


def test_types():
    assert spark_type("varchar(20)") == "string" and spark_type("TINYINT UNSIGNED") == "smallint" and spark_type("decimal(12, 2)") == "decimal(12,2)"
    assert logical("GEOMETRY")[0] == "VARCHAR" and widen("INT", "BIGINT", "SMALLINT") == "BIGINT" and widen("DOUBLE", "DECIMAL") == "DECIMAL"
    assert literal("it's") == "'it\\'s'" and literal(b"\x01\xff") == "X'01FF'" and literal(dt.date(2024, 6, 15)) == "DATE '2024-06-15'"
    assert typed_header("EMPNO:int,NAME:string,JOINED:date,X") == "`EMPNO` int, `NAME` string, `JOINED` date, `X` string"


def test_unsigned_and_milliseconds(spark):
    df = spark.createDataFrame([(200,)], "a int")
    assert df.select(checked(F.col("a"), "UTINYINT")).first()[0] == 200
    with pytest.raises(Exception, match="out of range"):
        df.select(checked(F.col("a") + 100, "UTINYINT")).collect()
    t = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00.123456' AS t")
    assert t.select(milliseconds(F.col("t"))).first()[0] == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


@pytest.fixture
def row(spark):
    return spark.createDataFrame([(7, "  Widget ", decimal.Decimal("9.99"), True, 2.5, None)], "Id int, Name string, Price decimal(28,4), InStock boolean, Score double, Nothing string")


@pytest.mark.parametrize(
    ("build", "want"),
    [
        (lambda f: f.upper(F.trim("Name")), "WIDGET"),
        (lambda f: f.character_length(F.col("Name")), 9),
        (lambda f: f.index_of(F.trim("Name"), "d"), 2),
        (lambda f: f.index_of(F.trim("Name"), "z"), -1),
        (lambda f: f.substring0(F.trim("Name"), 0, 3), "Wid"),
        (lambda f: f.trim_chars(F.lit("xxaxx"), "x", "LEADING"), "axx"),
        (lambda f: f.concat2(F.col("Nothing"), F.lit("b")), "b"),
        (lambda f: f.is_null_or_empty(F.col("Nothing")), True),
        (lambda f: f.is_null_or_white_space(F.lit(" \t")), True),
        (lambda f: f.first_char(F.trim("Name")), "W"),
        (lambda f: f.last_char(F.lit("")), None),
        (lambda f: f.truncate(F.lit(-2.7)), -2.0),
        (lambda f: f.sign(F.lit(-3.5)), -1),
        (lambda f: f.divide(F.lit(-7), 2), -3),
        (lambda f: f.greatest(F.col("Id"), None), None),
        (lambda f: f.greatest(F.col("Id"), 9), 9),
        (lambda f: f.bitnot(F.col("Id")), -8),
        (lambda f: f.shift_right(F.lit(-8), 1), -4),
        (lambda f: f.nvl2(F.col("Nothing"), F.lit(1), F.lit(2)), 2),
        (lambda f: f.decode(F.col("Id"), 7, "seven", "other"), "seven"),
        (lambda f: f.safe_cast(F.lit("x"), "int"), None),
        (lambda f: f.is_not_true(F.col("Nothing").cast("boolean")), True),
        (lambda f: f.similar(F.lit("abc"), "a%"), True),
        (lambda f: f.has_flag(F.lit(7), F.lit(2)), True),
        (lambda f: f.posix_regex_case_insensitive(F.lit("ABC"), "b"), True),
        (lambda f: f.string_to_array(F.lit("a.b"), "."), ["a", "b"]),
        (lambda f: f.item(F.array(F.lit(4), F.lit(5)), F.lit(1)), 4),
        (lambda f: compat.part(F.lit(dt.datetime(2024, 6, 16, 1, 2, 3, 4005)), "DayOfWeek"), 0),
        (lambda f: compat.part(F.lit(dt.datetime(2024, 6, 16, 1, 2, 3, 4005)), "Microsecond"), 5),
        (lambda f: jsondoc.json_value(F.lit('{"a":[{"b":5}]}'), "strict $.a[0].b", "int"), 5),
        (lambda f: jsondoc.set_value(F.lit('{"a":{"b":1},"c":2}'), "$.a.b", F.lit(9)), '{"a":{"b":9},"c":2}'),
        (lambda f: F.size(jsondoc.materialize(F.lit("[1,2]"), "array<int>")), 2),
    ],
)
def test_functions(engine, row, build, want):
    got = row.select(build(engine.functions).alias("x")).first()["x"]
    assert got == want


def test_registry(engine):
    assert "ARRAY_APPEND" in engine.functions and "no_such_thing" not in engine.functions
    assert jsondoc.steps("strict $.a[0].b") == ["a", 0, "b"]


@pytest.mark.parametrize(
    ("pattern", "text", "want"),
    [
        ("A B+ C", "xabbcab", ["ABBC"]),
        ("A (B | C)* D?", "abcdad", ["ABCD", "AD"]),
        ("A{2}", "aaaaa", ["AA", "AA"]),
        ("A B*? C?", "abbc", ["A"]),
        ("PERMUTE(A, B)", "abba", ["AB", "BA"]),
        ("A {- B -} C", "abc", ["AC"]),
        ("A{2,3} B", "aaaab", ["AAAB"]),
        ("D*", "abc", []),
    ],
)
def test_row_patterns(engine, pattern, text, want):
    from mosaiq.operators.matching import match_recognize

    df = engine.spark.createDataFrame([(1, i, c) for i, c in enumerate(text)], "k int, at int, c string")
    define = {s: F.col("c") == s.lower() for s in "ABCD"}
    got = match_recognize(df, partition=["k"], order=["at"], pattern=pattern, define=define).orderBy("match_number").collect()
    assert [r["classifiers"] for r in got] == want


def test_pattern_skips(engine):
    from mosaiq.operators.matching import match_recognize, parse

    df = engine.spark.createDataFrame([(1, i, c) for i, c in enumerate("abab")], "k int, at int, c string")
    define = {s: F.col("c") == s.lower() for s in "AB"}
    count = lambda after, pattern: match_recognize(df, partition=["k"], order=["at"], pattern=pattern, define=define, after=after).count()
    assert count("past last row", "A B A?") == 1 and count("to next row", "A B A?") == 2 and count("to last A", "A B A") == 1
    rows = match_recognize(df, partition=["k"], order=["at"], pattern="A B", define=define, all_rows=True).orderBy("at").collect()
    assert [(r["at"], r["match_number"], r["classifier"]) for r in rows] == [(0, 1, "A"), (1, 1, "B"), (2, 2, "A"), (3, 2, "B")]
    with pytest.raises(ValueError):
        parse("A (B")


def test_more_kinds(engine):
    f, df = engine.functions, engine.spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 2.0)], "a int, x double")
    row = df.agg(f.percentile_cont("x", 0.5).alias("c"), f.percentile_disc(F.col("x"), 0.34).alias("d"), f.map_query_constructor(F.col("a"), F.col("x")).alias("m")).first()
    assert (row["c"], row["d"], row["m"]) == (2.0, 2.0, {1: 3.0, 2: 1.0, 3: 2.0})
    assert df.select(f.json_type(F.lit('{"a": 1}')).alias("t")).first()["t"] == "OBJECT<a: BIGINT>"
    assert df.where(f.not_in(F.col("a"), 1, 2)).count() == 1
    with pytest.raises(Exception, match="more than one value"):
        df.agg(f.single_value(F.col("a"))).collect()


def test_managed_table(engine, tmp_path):
    db = Database(engine.spark, str(tmp_path))
    t = db.create_table("gadget", [("Id", "INTEGER", False), ("Name", "VARCHAR"), ("Version", "INTEGER")], key=["Id"], token="Version")
    assert t.insert([{"Id": i, "Name": f"n{i}", "Version": 1} for i in range(3)]) == 3
    assert t.insert([{"Id": 9}]) == 1
    t.update_row({"Id": 1}, {"Name": "x", "Version": 2}, {"Version": 1})
    with pytest.raises(ConcurrencyError):
        t.update_row({"Id": 1}, {"Name": "y"}, {"Version": 1})
    t.delete_row({"Id": 2})
    with pytest.raises(ConcurrencyError):
        t.delete_row({"Id": 2})
    assert t.update({"Name": F.concat(F.lit("a"), "Name")}, F.col("Id") < 2) == 2
    assert t.delete(F.col("Id") > 100) == 0
    again = ManagedTable(engine.spark, t.path)
    assert sorted((r["Id"], r["Name"]) for r in again.df().collect()) == [(0, "an0"), (1, "ax"), (9, None)]
    # another writer was faster
    again.insert([{"Id": 50}])
    with pytest.raises(ConcurrencyError):
        t.insert([{"Id": 51}])


def test_only_touched_files_are_rewritten(engine, tmp_path):
    t = Database(engine.spark, str(tmp_path)).create_table("t", [("Id", "BIGINT"), ("V", "BIGINT")], key=["Id"])
    t.insert(engine.spark.range(0, 10).select(F.col("id").alias("Id"), F.lit(0).cast("long").alias("V")).coalesce(1))
    t.insert(engine.spark.range(10, 20).select(F.col("id").alias("Id"), F.lit(0).cast("long").alias("V")).coalesce(1))
    first = set(t.files)
    t.update({"V": F.lit(1).cast("long")}, F.col("Id") == 15)
    assert len(first & set(t.files)) == 1 and t.df().agg(F.sum("V")).first()[0] == 1
    assert t.merge(engine.spark.createDataFrame([(3, 7), (99, 8)], "Id long, V long")) == (1, 1)


def test_unit_of_work_and_keys(engine, tmp_path):
    db = Database(engine.spark, str(tmp_path))
    t = db.create_table("g", [("Id", "UUID", False), ("Name", "VARCHAR")], key=["Id"])
    work, seen = UnitOfWork(), []
    work.interceptors.append(seen.append)
    row = work.add(t, {"Name": "a"})
    assert len(row["Id"]) == 36 and work.save() == 1 and seen == [1]
    with pytest.raises(KeyGenerationError):
        generate_key("INTEGER")
    with pytest.warns(UserWarning):
        work.begin_transaction()


def test_migrations_resume(engine, tmp_path):
    db = Database(engine.spark, str(tmp_path))
    runner = Runner(db)
    steps = [("create_table", {"name": "t", "columns": [("Id", "INTEGER")]}), ("create_index", {"name": "i"}), ("nonsense", {})]
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        with pytest.raises(ValueError, match="nonsense"):
            runner.run([Migration("m", steps)])
    assert any("no effect" in str(w.message) for w in seen) and runner.done("m") == 2
    runner.run([Migration("m", steps[:2] + [("drop_table", {"name": "t"})])])
    assert not db.has_tables() and runner.log[-1] == "m:drop_table"


def test_pushdown_and_pruning(spark, data):
    e = Engine.over_parquet(spark, data, ["lineitem"])
    plan = e.explain(e.set("lineitem").where("l_quantity > 40").select("l_orderkey").df)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_sessions_join_whatever_order_rows_come_in():
    from mosaiq.streaming.windows import merged_sessions

    m = 60
    assert merged_sessions([(10 * m, 10 * m, 1), (9 * m, 9 * m, 1)], 30) == [(9 * m, 9 * m, 1), (10 * m, 10 * m, 1)]
    assert merged_sessions([(0, 10, 2), (40, 50, 1), (30, 30, 1), (70, 70, 1)], 21) == [(0, 70, 5)]
    assert merged_sessions([(0, 0, 1), (20, 20, 1)], 20) == [(0, 0, 1), (20, 20, 1)]


def test_late_rows_open_sessions_of_their_own(spark, tmp_path):
    """Events at 10:00 and then, in a later batch, 09:00 are two sessions."""
    import datetime

    from mosaiq.streaming.windows import follow, run_to, sessions_with_state

    at = lambda h, mi=0: datetime.datetime(2024, 1, 1, h, mi)
    schema = "user long, ts timestamp"
    for i, rows in enumerate([[(1, at(10))], [(1, at(9)), (1, at(9, 40)), (1, at(9, 20))], [(1, at(20))], [(2, at(23))]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/b{i}")
    files = sorted((tmp_path / "in").glob("b*/*.parquet"))
    (tmp_path / "flat").mkdir()
    for i, f in enumerate(files):
        f.rename(tmp_path / "flat" / f"{i}.parquet")
    stream = follow(spark, f"file://{tmp_path}/flat", schema, files_per_batch=1)
    run_to(sessions_with_state(stream, "user", "ts", 1800, "3 hours"), f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint")
    got = sorted((r["n"], (r["last_us"] - r["first_us"]) // 60_000_000) for r in spark.read.schema("user long, first_us long, last_us long, n long").parquet(f"file://{tmp_path}/out").collect())
    assert got == [(4, 60)] or got == [(1, 0), (3, 40)]
    assert sum(n for n, _ in got) == 4


def make_table(spark, tmp_path, rows):
    from mosaiq.operators.ddl import Database

    table = Database(spark, f"file://{tmp_path}/db").create_table("t", [("k", "INTEGER", False), ("v", "VARCHAR")], key=["k"])
    table.insert([{"k": k, "v": v} for k, v in rows])
    return table


def test_merge_refuses_repeated_keys_and_counts_keys(spark, tmp_path):
    import pytest

    table = make_table(spark, tmp_path, [(1, "a"), (2, "b")])
    version = table.version
    with pytest.raises(ValueError, match="several rows"):
        table.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"))
    assert table.version == version and sorted(map(tuple, table.df().collect())) == [(1, "a"), (2, "b")]
    assert table.merge(spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")) == (1, 2)
    assert sorted(map(tuple, table.df().collect())) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_failed_save_leaves_tables_as_they_were(spark, tmp_path):
    import pytest

    from mosaiq.operators.dml import ConcurrencyError, UnitOfWork

    table = make_table(spark, tmp_path, [(1, "a")])
    work = UnitOfWork()
    work.add(table, {"k": 2, "v": "b"})
    work.update(table, {"k": 9}, {"v": "none"})
    for _ in range(2):
        with pytest.raises(ConcurrencyError):
            work.save()
        assert [tuple(r) for r in table.df().collect()] == [(1, "a")]
    work.changes.pop()
    assert work.save() == 1 and sorted(map(tuple, table.df().collect())) == [(1, "a"), (2, "b")] and not work.changes


def test_manifests_are_whole_or_absent(spark, tmp_path):
    import pytest

    table = make_table(spark, tmp_path, [(1, "a")])
    with pytest.raises(Exception, match="already exists|FileAlreadyExists"):
        table.store.create(f"{table.path}/manifests/{table.version:010d}.json", "{}")
    assert all(n.endswith(".json") for n in table.store.names(f"{table.path}/manifests"))


def test_long_runs_match_in_linear_time(spark):
    import time

    from mosaiq.operators import matching

    part = matching.parse("A+ B")
    rows = {"A": [True] * 20_000 + [False], "B": [False] * 20_000 + [True]}
    began = time.process_time()
    end, path = next(matching.matches(part, rows, 0, 20_001))
    assert end == 20_001 and len(matching.listed(path)) == 20_001 and time.process_time() - began < 2


def test_matches_count_on_across_rows_that_no_symbol_fits(spark):
    from pyspark.sql import functions as F

    from mosaiq.operators.matching import match_recognize

    rows = [("p", i, x) for i, x in enumerate("AABxABxxAAAB")]
    df = spark.createDataFrame(rows, "k string, i int, x string")
    got = match_recognize(df, partition=["k"], order=["i"], pattern="A+ B", define={s: F.col("x") == s for s in "AB"}).orderBy("match_number").collect()
    assert [(r["match_number"], r["first_i"], r["last_i"], r["length"]) for r in got] == [(1, 0, 2, 3), (2, 4, 5, 2), (3, 8, 11, 4)]


def test_matching_shuffles_once_whatever_the_batches(engine):
    from mosaiq.operators.matching import match_recognize

    texts = {1: "AABxABxxAAAB", 2: "", 3: "BBB", 4: "AB" * 9, None: "xAABAB", 5: "A" * 80 + "B", 6: "ABAB"}
    df = engine.spark.createDataFrame([(k, i, x) for k, t in texts.items() for i, x in enumerate(t)], "k int, i int, x string")
    define = {s: F.col("x") == s for s in "AB"}
    want = [(k, n, m.start(), m.end() - 1, m[0]) for k, t in texts.items() for n, m in enumerate(re.finditer("A+B", t), 1)]
    engine.spark.conf.set("spark.sql.shuffle.partitions", 2)
    for batch in (1, 3, 10_000):
        engine.spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = match_recognize(df, partition=["k"], order=["i"], pattern="A+ B", define=define)
        # a group for each stretch, and joins back to the rows, take minutes on millions of partitions
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "FlatMapGroupsInPandas" not in plan
        found = [(r["k"], r["match_number"], r["first_i"], r["last_i"], r["classifiers"]) for r in got.collect()]
        assert sorted(found, key=str) == sorted(want, key=str)
        rows = match_recognize(df, partition=["k"], order=["i"], pattern="A+ B", define=define, all_rows=True).collect()
        found = [(r["k"], r["match_number"], r["i"], r["classifier"]) for r in rows]
        assert sorted(found, key=str) == sorted(((k, n, a + j, s) for k, n, a, _, text in want for j, s in enumerate(text)), key=str)


def test_jdbc_store_is_read_by_other_processes(spark, data):
    """An executor of a cluster has neither the driver's memory nor its Derby."""
    import subprocess
    import sys

    from mosaiq.plans.queries import QUERIES

    read = """
from pyspark.sql import SparkSession
import sys
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
n = spark.read.format("jdbc").options(url=sys.argv[1], driver="org.apache.derby.jdbc.EmbeddedDriver", dbtable="nation").load().count()
print("rows", n)
"""
    df = QUERIES["src_jdbc"](spark, data)
    assert "PushedFilters: [*IsNotNull(N_REGIONKEY), *EqualTo(N_REGIONKEY,2)]" in df._jdf.queryExecution().toString()
    store = derby_store(spark.createDataFrame([(1, "a"), (None, None)], "n int, s string"), "nation")
    out = subprocess.run([sys.executable, "-c", read, store["url"]], capture_output=True, text=True, timeout=120)
    assert "rows 2" in out.stdout, out.stderr[-2000:]
    assert sorted(map(str, spark.read.format("jdbc").options(**store, dbtable="nation").load().collect())) == ["Row(N=1, S='a')", "Row(N=None, S=None)"]


def test_limits_without_order_take_what_is_stored_first(spark, tmp_path):
    """As in other engines, whatever the tasks and which ends first."""
    from mosaiq.operators import paging

    for part, n in (("a", 300), ("b", 70_000), ("c", 5_000)):  # the largest file is read first
        rows = spark.range(n).select(F.lit(part).alias("part"), F.col("id").alias("i"), (F.col("id") * 7919 % 1000).alias("v"))
        rows.repartitionByRange(1, "i").sortWithinPartitions("i").write.parquet(f"{tmp_path}/t/{part}")
    e = Engine(spark)
    e.spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    e.catalog.table("t", lambda s: s.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/t"))
    stored = [(p, i) for p, n in (("a", 300), ("b", 70_000), ("c", 5_000)) for i in range(n) if i * 7919 % 1000 >= 100]
    for take, skip in ((10, 0), (200, 200), (60_000, 0), (65_000, 1_000), (100_000, 64_000), (0, 5)):
        got = e.sql(f"SELECT part, i FROM t WHERE v >= ? OFFSET {skip} ROWS FETCH NEXT ? ROWS ONLY", 100, take)
        assert sorted(map(tuple, got.collect())) == stored[skip : skip + take]
    got = e.prepare("SELECT * FROM t AS x WHERE x.v >= :least LIMIT :n")(least=100, n=500)
    assert got.columns == ["part", "i", "v"] and sorted((r["part"], r["i"]) for r in got.collect()) == stored[:500]
    assert e.sql("SELECT COUNT(*) AS n FROM t FETCH FIRST ROW ONLY").collect()[0]["n"] == 75_300
    assert e.sql("SELECT DISTINCT part FROM t FETCH FIRST 2 ROWS ONLY").count() == 2
    assert e.sql("SELECT i FROM t ORDER BY i DESC FETCH FIRST 1 ROW ONLY").collect()[0]["i"] == 69_999
    assert paging.BLOCK < 70_000


def test_includes_are_counted_without_nesting(spark, data):
    from mosaiq.plans.queries import QUERIES
    from mosaiq.plans.suite import engine as suite

    plan = QUERIES["include_deep"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    # arrays of all that a region leads to are as large as the tables
    assert "collect_list" not in plan
    e = suite(spark, data)
    e.catalog.relate("region", [Navigation("nations", "nation", ("r_regionkey",), ("n_regionkey",), many=True)])
    customers, size = F.flatten("nations.customers"), lambda x: F.size(x).cast("bigint")
    nested = e.set("region").include("nations.customers.orders").select("r_name", a=size("nations"), b=size(customers), c=size(F.flatten(F.transform(customers, lambda x: x["orders"]))))
    counted = e.set("region").include_counts("nations.customers.orders", a="nations", b="nations.customers", c="nations.customers.orders").select("r_name", "a", "b", "c")
    assert sorted(nested.df.collect()) == sorted(counted.df.collect())
    nested = e.set("orders").include("parts").select("o_orderkey", n=size("parts"))
    counted = e.set("orders").include_counts("parts", n="parts").select("o_orderkey", "n")
    assert sorted(nested.df.collect()) == sorted(counted.df.collect())
    one = e.set("orders").include_counts("customer.orders", one="customer", n="customer.orders").df.agg(F.sum("one"), F.min("n"), F.count("*")).first()
    assert one[0] == one[2] and one[1] >= 1
    with pytest.raises(KeyError):
        e.set("orders").include_counts("parts", n="customer")


def test_engine_uses_the_shared_folder(spark):
    from mosaiq.session import Engine
    from mosaiq.storage import shared_folder, shared_root

    root = shared_root(spark)
    assert root and shared_root(Engine(spark).spark) == root and shared_folder(spark).startswith(root)


def test_entry_without_the_training_data_package(monkeypatch):
    import sys

    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "mosaiq.llm.queries", None)
    monkeypatch.setitem(sys.modules, "mosaiq.llm", None)
    assert "flagship" in entry.queries() and not any(q.startswith("op") for q in entry.queries())


def test_retries_end_and_pass_on_what_stays():
    import pytest

    from mosaiq.operators.retry import Strategy

    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("Connection reset by peer")
        return "done"

    waits = []
    assert Strategy(sleep=waits.append).run(flaky) == "done" and len(calls) == 3 and waits[1] > waits[0]
    with pytest.raises(ValueError):
        Strategy(sleep=waits.append).run(lambda: (_ for _ in ()).throw(ValueError("no")))
    with pytest.raises(TimeoutError):
        Strategy(retries=2, sleep=waits.append).run(lambda: (_ for _ in ()).throw(TimeoutError()))


def test_unused_left_join_is_not_made(spark, data):
    from mosaiq.plans.suite import engine

    e = engine(spark, data)
    joined = e.set("orders").left_join(e.set("customer"), "o_custkey", "c_custkey")
    assert "Join" not in e.explain(joined.select("o_orderkey").df) and "Join" in e.explain(joined.select("o_orderkey", "c_name").df)
    assert "Join" in e.explain(e.set("customer").left_join(e.set("orders"), "c_custkey", "o_custkey").select("c_name").df)


def test_tags_stand_in_the_plan(spark, data):
    from mosaiq.plans.suite import engine

    e = engine(spark, data)
    tagged = e.set("nation").where("n_regionkey = 1").tag_with("nations of one region").order_by("n_nationkey")
    assert "nations of one region" in e.explain(tagged.df) and [r["n_nationkey"] for r in tagged.rows()] == [1, 6, 11, 16, 21]


def test_changes_by_text_and_their_faults(spark, tmp_path):
    import pytest

    from mosaiq.operators.ddl import Database
    from mosaiq.session import Engine

    e = Engine(spark)
    with pytest.raises(LookupError):
        e.execute("DELETE FROM t")
    db = Database(e.spark, f"file://{tmp_path}/db")
    db.create_table("t", [("k", "INTEGER", False), ("v", "VARCHAR")], key=["k"])
    e.attach(db)
    assert e.execute("INSERT INTO t VALUES (1, 'a,b (c)'), (2, DEFAULT)") == 2
    assert e.execute("INSERT INTO main.t (v, k) VALUES (?, ?)", "x?", 3) == 1
    assert e.execute("UPDATE t SET v = CONCAT(v, ', ', ?), k = k + 10 WHERE v IS NOT NULL AND k < (1 + 1)", "y") == 1
    assert sorted(map(tuple, e.sql("SELECT k, v FROM t").collect())) == [(2, None), (3, "x?"), (11, "a,b (c), y")]
    assert e.execute("UPDATE t SET v = DEFAULT") == 3 and e.execute("DELETE FROM t WHERE k = 2") == 1 and e.execute("DELETE FROM t WHERE k = 2") == 0
    for bad in ("DROP TABLE t", "UPDATE t v = 1", "DELETE FROM none"):
        with pytest.raises((ValueError, LookupError)):
            e.execute(bad)


def _matched_both_ways(engine, monkeypatch, pattern, **more) -> bool:
    """Whether Spark matches a pattern without Python; its rows are those of the matching in Python."""
    import random

    from mosaiq.operators import matching

    dice = random.Random(pattern)
    rows = [(k, i, dice.choice(["A", "B", "AB", "x", None])) for k, n in ((1, 40), (2, 0), (3, 1), (None, 30), (5, 2), (6, 40)) for i in range(n)] + [(7, i, "A") for i in range(90)]
    df = engine.spark.createDataFrame(rows, "k int, i int, x string")
    define = {s: F.col("x").contains(s) for s in "AB"}  # C is always true
    run = lambda: matching.match_recognize(df, partition=["k"], order=["i"], pattern=pattern, define=define, **more)
    got = run()
    plan = got._jdf.queryExecution().executedPlan().toString()
    with monkeypatch.context() as m:
        m.setattr(matching, "WIDE", -1)
        want = run()
    assert "InArrow" in want._jdf.queryExecution().executedPlan().toString() and got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert plan.count("Exchange") == 1
    return "InArrow" not in plan


def _plan(spark, data, name) -> str:
    from mosaiq.plans.queries import QUERIES

    return QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()


def test_short_patterns_need_no_python(engine, spark, data, monkeypatch):
    for pattern in ("PERMUTE(A, B)", "(A | B) C?", "(A | B)?? C", "A{1,3} {- B -} A?", "{- A -} | B", "C A"):
        assert _matched_both_ways(engine, monkeypatch, pattern, after="to next row"), pattern
    for pattern in ("A+ B", "A{9}", "{- A -}"):
        assert not _matched_both_ways(engine, monkeypatch, pattern, after="to next row"), pattern
    assert "InArrow" not in _plan(spark, data, "kind_pattern_permute")


def test_short_patterns_that_skip_one_row_need_no_python(engine, spark, data, monkeypatch):
    for pattern, after in (("A B", "to last B"), ("A {- B -} C", "to first B"), ("A B", "to last A"), ("A | B", "past last row")):
        assert _matched_both_ways(engine, monkeypatch, pattern, after=after), (pattern, after)
    for pattern, after in (("A C B", "to last B"), ("A B?", "past last row"), ("A B B", "to last B")):
        assert not _matched_both_ways(engine, monkeypatch, pattern, after=after), (pattern, after)
    assert "InArrow" not in _plan(spark, data, "kind_pattern_skip")


def test_runs_need_no_python(engine, spark, data, monkeypatch):
    for pattern in ("A+", "A*", "B{2,}", "(A){3,}", "C+"):
        assert _matched_both_ways(engine, monkeypatch, pattern), pattern
    for pattern, after in (("A+?", "past last row"), ("A{2,}", "to next row"), ("A{9,}", "past last row")):
        assert not _matched_both_ways(engine, monkeypatch, pattern, after=after), (pattern, after)
    assert "InArrow" not in _plan(spark, data, "match_pattern")


def test_rows_of_runs_need_no_python(engine, spark, data, monkeypatch):
    for pattern in ("A+", "A*", "B{2,}", "(A){3,}", "C+"):
        assert _matched_both_ways(engine, monkeypatch, pattern, all_rows=True), pattern
    assert not _matched_both_ways(engine, monkeypatch, "A B", all_rows=True)
    plan = _plan(spark, data, "sql_match_recognize")
    # one shuffle and two orders: the partition's, and each match's
    assert "InArrow" not in plan and plan.count("Exchange") == 1 and plan.count("Sort [") == 2
