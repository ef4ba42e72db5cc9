"""Every registered query of the engine against its SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from mosaiq.plans.queries import QUERIES, SQL

from .oracle import assert_same, connect


@pytest.fixture(scope="module")
def con():
    from .conftest import DATA

    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, data, con):
    df = QUERIES[name](spark, data)
    if name in SQL:
        assert_same(df, con, SQL[name])
    else:
        # every column is computed, not only rows counted
        assert len(df.collect()) > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_imports(spark):
    import __spark_entry__ as entry

    assert "flagship" in entry.queries() and "flagship" in entry.oracle_sql()
    assert entry.entry(spark).count() > 0


def _customers(con, folder, rows: str) -> None:
    con.execute(f"COPY (SELECT k AS c_custkey, n::INTEGER AS c_nationkey, s AS c_mktsegment FROM ({rows}) t(k, n, s)) TO '{folder}/customer.parquet' (FORMAT parquet)")
    con.execute(f"CREATE VIEW customer AS FROM '{folder}/customer.parquet'")


def test_struct_equality_of_nulls_and_repeats(spark, tmp_path):
    con = duckdb.connect()
    _customers(con, tmp_path, "VALUES (1::BIGINT, 1, 'a'), (2, 1, 'a'), (2, 1, 'a'), (3, NULL, 'a'), (4, NULL, 'a'), (5, NULL, NULL), (6, NULL, NULL), (7, 1, NULL), (8, 1, NULL), (NULL, 1, 'a'), (9, 2, 'a')")
    assert_same(QUERIES["struct_equality"](spark, str(tmp_path)), con, SQL["struct_equality"])


def test_struct_equality_across_blocks(spark, tmp_path):
    # repeated keys on either side of a block's end
    con = duckdb.connect()
    _customers(con, tmp_path, "SELECT (i // 3)::BIGINT, i % 2, 'a' FROM range(5000) r(i)")
    ours = QUERIES["struct_equality"](spark, str(tmp_path)).agg(F.count("*"), F.sum(F.expr("a_key * 7 + b_key")), F.sum(F.expr("a_key * b_key"))).first()
    assert tuple(ours) == con.execute(f"SELECT COUNT(*), SUM(a_key * 7 + b_key)::BIGINT, SUM(a_key * b_key)::BIGINT FROM ({SQL['struct_equality']}) t").fetchone()


def test_struct_equality_deals_the_pairs_of_one_group(spark, tmp_path):
    con = duckdb.connect()
    _customers(con, tmp_path, "SELECT i::BIGINT, 1, 'a' FROM range(5000) r(i)")
    tasks = [r["count"] for r in QUERIES["struct_equality"](spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 5000 * 4999 // 2
    assert max(tasks) < 0.6 * sum(tasks)
