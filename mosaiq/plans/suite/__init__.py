"""The registered queries: each through the engine, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...catalog import Navigation
from ...session import Engine

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Keys of the tables.
KEYS = {
    "region": ("r_regionkey",),
    "nation": ("n_nationkey",),
    "customer": ("c_custkey",),
    "supplier": ("s_suppkey",),
    "part": ("p_partkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
    "documents": ("doc_id",),
    "labels": ("doc_id",),
    "pages": ("page_id",),
    "benchmark": ("item_id",),
    "embeddings": ("vec_id",),
    "conversations": ("conv_id", "turn"),
}


def engine(spark: SparkSession, sf_dir: str) -> Engine:
    e = Engine(spark)
    for name, key in KEYS.items():
        e.catalog.parquet(name, f"{sf_dir}/{name}.parquet", key=key)
    e.catalog.relate(
        "orders",
        [
            Navigation("customer", "customer", ("o_custkey",), ("c_custkey",)),
            Navigation("lines", "lineitem", ("o_orderkey",), ("l_orderkey",), many=True),
            Navigation("parts", "part", ("o_orderkey",), ("p_partkey",), many=True, through=("lineitem", ("l_orderkey",), ("l_partkey",))),
        ],
    )
    e.catalog.relate("customer", [Navigation("nation", "nation", ("c_nationkey",), ("n_nationkey",)), Navigation("orders", "orders", ("c_custkey",), ("o_custkey",), many=True)])
    e.catalog.relate("nation", [Navigation("region", "region", ("n_regionkey",), ("r_regionkey",)), Navigation("customers", "customer", ("n_nationkey",), ("c_nationkey",), many=True)])
    return e


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query under ``name``: a function of the engine (and, if it
    takes two arguments, of the tables' folder) that gives a builder or a DataFrame."""

    def add(fn: Callable) -> Callable:
        wants_folder = fn.__code__.co_argcount > 1

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            e = engine(spark, sf_dir)
            out = fn(e, sf_dir) if wants_folder else fn(e)
            return out if isinstance(out, DataFrame) else out.df

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def same(name: str, sql: str, *args: object) -> None:
    """Register a query whose text runs in both engines, here through the dialect."""
    query(name, sql)(lambda e: e.sql(sql, *args))


def col(name: str):
    return F.col(name)
