"""Connected components of a distributed graph, by alternating star steps.

Each round links every node's larger neighbours to the smallest node it knows
(large star) and its smaller ones likewise (small star), until all links are
stars; the number of rounds grows with the logarithm of the graph's width.
Each round is a few group-bys over links and is written to the shared folder;
the driver sees one number a round. Its memory goes with the plans and tasks it
keeps account of, so a round reads its links in two places only, and none is
spent on showing that the one before it was the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

#: Tasks over which the links of a hub are dealt.
DEALT = 16


def _smallest(links: DataFrame) -> DataFrame:
    """(u, v) links with ``m``: the smallest of u and all its v. A hub's links
    meet as partial minima and are dealt over ``DEALT`` tasks to be joined with it."""
    low = links.groupBy("u").agg(F.min("v").alias("m"))
    low = low.select(F.col("u").alias("w"), F.least("u", "m").alias("m"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("seat"))
    dealt = links.withColumn("place", F.pmod(F.xxhash64("v"), F.lit(DEALT)))
    return dealt.join(low, (dealt["u"] == low["w"]) & (dealt["place"] == low["seat"])).select("u", "v", "m")


def _round(links: DataFrame) -> DataFrame:
    """The links after a large star and a small star."""
    both = links.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    large = _smallest(both).where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    joined = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return _smallest(large).select(F.inline(joined)).where("u <> v").distinct()


def _stars(links: DataFrame) -> bool:
    """Whether every larger end has one link, to a node that is no larger end:
    a round would change nothing. ``links``: distinct (u, v), u the larger."""
    ends = links.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))))
    ends = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ends.where("ups > 1 OR (ups = 1 AND least = 0)").agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every node that has a link to another; the
    component is its smallest node. ``links``: two columns of one orderable
    type without nulls, in either direction, repeats allowed."""
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = materialize(links, "links")
    while True:
        last, links = links, materialize(_round(links), "links")
        discard(last)
        if _stars(links):
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
