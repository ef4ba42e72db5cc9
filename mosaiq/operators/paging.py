"""The first rows of a table as it is stored, for limits without an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a file that are counted together.
BLOCK = 1 << 16


def position():
    """Where a row of a file source is stored; files go by their path."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def first_stored(df: DataFrame, at: str, take: int, skip: int = 0) -> DataFrame:
    """``take`` rows behind the first ``skip``, by :func:`position` in column ``at``.

    Rows are counted by blocks of files; blocks wholly inside go through as they
    are, and only the rows of the two blocks at the ends are numbered, so no
    task sorts or holds the rows taken."""
    df = df.withColumns({"__file": F.col(at)["file"], "__block": F.floor(F.col(at)["row"] / BLOCK)})
    counts = df.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")
    ends = F.col("__before") + F.col("__n")
    blocks = counts.withColumn("__before", before).where((F.col("__before") < skip + take) & (ends > skip))
    rows = df.join(F.broadcast(blocks), ["__file", "__block"])
    inside = (F.col("__before") >= skip) & (ends <= skip + take)
    number = F.col("__before") + F.row_number().over(Window.partitionBy("__file", "__block").orderBy(F.col(at)["row"]))
    cut = rows.where(~inside).withColumn("__number", number).where((F.col("__number") > skip) & (F.col("__number") <= skip + take)).drop("__number")
    return rows.where(inside).unionByName(cut).drop("__file", "__block", "__n", "__before")
