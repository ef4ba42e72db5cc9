"""Window functions, row patterns and time windows over batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

UNBOUNDED_BEFORE, UNBOUNDED_AFTER = Window.unboundedPreceding, Window.unboundedFollowing


def over(partition: Sequence[str | Column] = (), order: Sequence[Column | str] = (), *, rows: tuple[int, int] | None = None, range_: tuple[int, int] | None = None) -> WindowSpec:
    w = Window.partitionBy(*partition).orderBy(*order)
    if rows is not None:
        return w.rowsBetween(*rows)
    return w.rangeBetween(*range_) if range_ is not None else w


def tumble(ts: str | Column, size: str) -> Column:
    """Windows of ``size`` without gaps; ``.start`` and ``.end`` are its bounds."""
    return F.window(ts, size)


def hop(ts: str | Column, size: str, slide: str) -> Column:
    return F.window(ts, size, slide)


def session(ts: str | Column, gap: str) -> Column:
    return F.session_window(ts, gap)


def snapshot(df: DataFrame, at: Column, valid_from: str, valid_to: str) -> DataFrame:
    """The rows of a temporal table that were valid at a time."""
    return df.where((F.col(valid_from) <= at) & (F.col(valid_to).isNull() | (F.col(valid_to) > at)))


def match_runs(df: DataFrame, partition: Sequence[str], order: Sequence[str | Column], condition: Column, least: int = 2) -> DataFrame:
    """MATCH_RECOGNIZE for the pattern ``A{least,}`` with A as ``condition``
    (which may use lag and lead over the same order): a row for each maximal
    run, with its number, first and last order values and length."""
    w = Window.partitionBy(*partition).orderBy(*order)
    first = order[0] if isinstance(order[0], Column) else F.col(order[0])
    marked = df.withColumn("__hit", F.coalesce(condition, F.lit(False)).cast("int")).withColumn("__at", first)
    marked = marked.withColumn("__begin", (F.col("__hit") == 1) & (F.coalesce(F.lag("__hit").over(w), F.lit(0)) == 0))
    marked = marked.withColumn("__run", F.sum(F.col("__begin").cast("int")).over(w)).where("__hit = 1")
    runs = marked.groupBy(*partition, F.col("__run").alias("run")).agg(F.min("__at").alias("first_at"), F.max("__at").alias("last_at"), F.count(F.lit(1)).alias("length"))
    kept = runs.where(F.col("length") >= least)
    number = Window.partitionBy(*partition).orderBy("first_at", "run")
    return kept.withColumn("match_number", F.row_number().over(number)).drop("run")
