from __future__ import annotations

import pytest

from mosaiq.plans.dialect import translate


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("SELECT a FROM t OFFSET 5 ROWS FETCH NEXT 3 ROWS ONLY", "SELECT a FROM t LIMIT 3 OFFSET 5"),
        ("SELECT a FROM t FETCH FIRST ROW ONLY", "SELECT a FROM t LIMIT 1"),
        ("SELECT a FROM t OFFSET 2 ROWS", "SELECT a FROM t OFFSET 2"),
        ("CAST(x AS VARCHAR)", "CAST(x AS STRING)"),
        ("CAST(x AS VARCHAR(5))", "CAST(x AS VARCHAR(5))"),
        ("CAST(x AS TINYINT UNSIGNED)", "CAST(x AS SMALLINT)"),
        ("JSON_VALUE(d, 'strict $.a[0].b')", "get_json_object(d, '$.a[0].b')"),
        ("JSON_VALUE(d, '$.a' RETURNING INTEGER)", "CAST(get_json_object(d, '$.a') AS INTEGER)"),
        ("POSITION('a' IN s FROM 3)", "locate('a', s, 3)"),
        ("BITAND(a, BITOR(b, 1))", "((a) & (((b) | (1))))"),
        ("SAFE_CAST(x AS INTEGER)", "try_cast(x AS INTEGER)"),
        ("ARRAY[1, 2]", "array(1, 2)"),
        ("x = ANY (SELECT y FROM t)", "x IN (SELECT y FROM t)"),
        ("x <> ALL (SELECT y FROM t)", "x NOT IN (SELECT y FROM t)"),
        ("FLOOR(ts TO HOUR)", "date_trunc('HOUR', ts)"),
        ("FLOOR(x)", "FLOOR(x)"),
        ("'CAST(x AS VARCHAR) FETCH FIRST ROW ONLY'", "'CAST(x AS VARCHAR) FETCH FIRST ROW ONLY'"),
        ("s SIMILAR TO '(a|b)%'", "s RLIKE '^(?:(a|b).*)$'"),
    ],
)
def test_rules(text, want):
    squeeze = lambda s: s.replace(" ", "")
    assert squeeze(translate(text)) == squeeze(want)


def test_apply_is_lateral():
    out = translate("SELECT * FROM a OUTER APPLY (SELECT 1 AS one) AS x WHERE y")
    assert "LEFT JOIN LATERAL" in out and "AS x ON true WHERE" in out
    assert "CROSS JOIN LATERAL" in translate("SELECT * FROM a CROSS APPLY (SELECT 1) x")


def test_table_names_only_where_tables_stand():
    views = {("s", "T"): "s__T", ("T",): "s__T"}
    names = lambda parts: views.get(tuple(parts))
    out = translate('SELECT "T".a, EXTRACT(YEAR FROM T) FROM "s"."T", T AS u WHERE b IN (1, T)', names)
    assert "EXTRACT(YEAR FROM T)" in out
    assert "FROM `s__T` AS `T`" in out and "`s__T` AS u" in out and "IN (1, T)" in out


def test_dialect_runs(engine):
    df = engine.sql("SELECT TRUNCATE(-2.7, 0) AS t, CONCAT2(NULL, 'b') AS c, TIMESTAMP WITH TIME ZONE '2024-01-01 10:00:00 GMT+02:00' = TIMESTAMP '2024-01-01 08:00:00Z' AS same, ROW(1, 'a') AS r")
    row = df.first()
    assert (float(row["t"]), row["c"], row["same"], tuple(row["r"])) == (-2.0, "b", True, (1, "a"))


def test_parameters(engine):
    assert engine.sql("SELECT ? + 1 AS a", 2).first()["a"] == 3
    assert engine.sql("SELECT :x AS a", x="y").first()["a"] == "y"
    run = engine.prepare("SELECT id FROM RANGE(10) WHERE id > ? FETCH FIRST ? ROWS ONLY")
    assert run(3, 2).count() == 2 and run(8, 5).count() == 1


@pytest.mark.parametrize(
    ("text", "part"),
    [
        ("SELECT EXTRACT(YEAR FROM d), TRIM(LEADING 'x' FROM d) FROM d", "EXTRACT(YEAR FROM d), TRIM(LEADING 'x' FROM d) FROM `m__d` AS `d`"),
        ("SELECT 1 FROM d WHERE d IS NOT DISTINCT FROM d", "d IS NOT DISTINCT FROM d"),
        ("SELECT EXTRACT(YEAR FROM (SELECT MAX(x) FROM d))", "(SELECT MAX(x) FROM `m__d` AS `d`)"),
        ("SELECT SUBSTRING(d FROM 2 FOR 3) FROM d", "SUBSTRING(d FROM 2 FOR 3)"),
    ],
)
def test_from_inside_calls_names_no_table(text, part):
    assert part in translate(text, lambda parts: "m__d" if parts == ["d"] else None)


def test_quantified_comparison_takes_its_whole_operand(spark):
    q = lambda text: [tuple(r) for r in spark.sql(translate(text)).collect()]
    assert q("SELECT 1 + 2 >= ALL (SELECT * FROM VALUES (1), (3)), 1 + 2 > ALL (SELECT * FROM VALUES (1), (3)), NOT 2 * 2 < SOME (SELECT * FROM VALUES (1), (4))") == [(True, False, True)]
    assert q("SELECT 5 > ALL (SELECT * FROM VALUES (1), (NULL)), 0 > ALL (SELECT * FROM VALUES (1), (NULL)), 5 > SOME (SELECT * FROM VALUES (1), (NULL)), 0 > SOME (SELECT * FROM VALUES (1), (NULL))") == [(None, False, True, None)]
    assert q("SELECT 1 > ALL (SELECT 1 WHERE false), 1 > SOME (SELECT 1 WHERE false), 3 <> SOME (SELECT * FROM VALUES (3), (4)), 3 = ALL (SELECT * FROM VALUES (3), (3))") == [(True, False, True, True)]
    assert q("SELECT CASE WHEN true THEN 1 ELSE 2 END = ALL (SELECT 1)") == [(True,)]


@pytest.mark.parametrize("value", ["it's", "back\\slash", "", None, True, 7, -1.5, "?"])
def test_literals_are_what_they_were(spark, value):
    from mosaiq.plans.dialect import literal

    assert spark.sql(f"SELECT {literal(value)}").first()[0] == value


@pytest.mark.parametrize("before", ["SELECT", "SELECT 1,", "SELECT x FROM t WHERE", "SELECT NOT"])
def test_period_predicates_stand_anywhere(before):
    assert translate(f"{before} (a, b) OVERLAPS (c, d)").endswith("(a < d AND c < b)")
    assert "f(a, b)" in translate("SELECT f(a, b) FROM t")


def test_table_of_a_call():
    assert translate("SELECT * FROM TABLE(range(3)) AS r") == "SELECT * FROM range(3) AS r"
