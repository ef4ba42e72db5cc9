"""Mixing sources to target weights along a time-varying curriculum.

Training runs over the time 0..1. Each source has a weight schedule, linear
between knots; its integral is the source's weight, and the integral up to a
time, over the whole, is the share of the source's target that is wanted by
then. A source's documents stand in a reproducible random order; the words
before a document's are its place in the source's demand, and inverting the
cumulative demand gives the document its training position. Demand beyond the
source's size starts the order again (a second copy), and the copy that
crosses the target is cut there, so every source gives its target to the word.

Scale: words before a document are found in two steps, so that no task holds
a source: sums over small hash ranges of each source (about ``RANGE``
documents each, however large the source is), running sums over the ranges,
and running sums inside each range.
Sources are ranked with a distributed sort, and the targets are found by a few
aggregations over one row for each source; nothing is collected but totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import count_words, fresh, materialize, numbered, unit_hash

#: Documents that one hash range of a source holds, about.
RANGE = 4_000


def schedule_expr(knots: Sequence[tuple[float, float]]) -> tuple[list[tuple], float]:
    """Segments (t0, t1, w0, w1, c0, c1) of a schedule that is linear between
    its knots (time, weight), with the cumulative weight at both ends, and the
    whole integral."""
    knots = sorted(knots)
    if len(knots) < 2 or knots[0][0] != 0.0 or knots[-1][0] != 1.0 or min(w for _, w in knots) < 0:
        raise ValueError("knots must run from time 0 to 1 with weights of 0 or more")
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        out.append((t0, t1, w0, w1, done, done + area))
        done += area
    if done <= 0:
        raise ValueError("a schedule needs some weight")
    return [(*s[:4], s[4] / done, s[5] / done) for s in out], done


def invert(segments: list[tuple], share: Column) -> Column:
    """The time by which ``share`` (0..1) of a source's demand has arisen."""
    at = F.lit(1.0)
    for t0, t1, w0, w1, c0, c1 in reversed([s for s in segments if s[5] > s[4]]):
        # w0*x + (w1-w0)/(2*(t1-t0))*x^2 = a, in the root that stays stable for w1 = w0
        a = (share - F.lit(c0)) / F.lit(c1 - c0) * F.lit((t1 - t0) * (w0 + w1) / 2)
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + a * F.lit(2 * slope)))
        x = F.when(a <= 0, F.lit(0.0)).otherwise(a * 2 / (root + F.lit(w0)))
        at = F.when(share <= F.lit(c1), F.lit(t0) + F.least(x, F.lit(t1 - t0))).otherwise(at)
    return at


def source_targets(sources: DataFrame, total_share: float, cap: float, weights: Sequence[float]) -> DataFrame:
    """``sources`` (source, source_size, rank) with ``target``: shares of
    ``total_share`` times all sizes by weight, no more than ``cap`` times the
    source's size, the excess reshared by weight until none is above."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(sources.withColumns({"weight": weight, "limit": F.col("source_size") * F.lit(float(cap))}), "sources")
    all_words = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted, level, capped = float(all_words) * total_share, 0.0, -1
    while True:
        over = F.col("limit") <= F.lit(level) * F.col("weight")
        n, fixed, free = sources.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("limit"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (wanted - fixed) / free
    return sources.withColumn("target", F.least(F.col("limit"), F.lit(level) * F.col("weight")) if free else F.col("limit"))


def mix(
    docs: DataFrame,
    *,
    schedules: Sequence[Sequence[tuple[float, float]]],
    total_share: float = 1.5,
    cap: float = 2.0,
    source: str = "source",
    key: str = "doc_id",
    size: Column | None = None,
    digest: Column | None = None,
) -> DataFrame:
    """Every row of ``docs`` with what the mix takes of it.

    Adds ``size`` (words; 0 for null), ``source_size``, ``target``, ``taken``
    (words, all copies), and ``positions``: for each copy its training
    position (0..1), its number and its words. Rows that the mix does not
    take have empty ``positions``. ``schedules`` are dealt to the sources in
    code point order, null last, again and again. ``cap`` bounds the copies.
    Columns of these names are replaced, others stay whatever their names.
    Repeated rows are rows of their own; null keys, texts and sources are
    allowed (null sources are one source); empty texts have no words and are
    never taken; very long ones are counted whole, and the last copy that a
    source's target reaches is cut; an empty table gives an empty one. ``size`` and ``digest`` (a hash of the text, for the
    random order) may be given where they are known; they come from ``text``
    otherwise.
    """
    spark = docs.sparkSession
    segments, weights = zip(*(schedule_expr(s) for s in schedules))
    size = count_words(F.col("text")) if size is None else size
    digest = F.xxhash64("text") if digest is None else digest
    src, u, sized_source, sized_u, bucket, before, start, rank = fresh(docs, "source", "u", "s", "v", "range", "before", "start", "rank")
    docs = docs.withColumns({"size": size, u: unit_hash(F.col(key), digest, F.col(source))})
    docs = docs.drop("source_size", "target", "taken", "positions")

    # one row for each source and its rank, by a distributed sort
    by_source = docs.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    sources = source_targets(numbered(by_source, F.col("source").asc_nulls_last(), "rank"), total_share, cap, weights)
    sources = sources.withColumn("ranges", F.ceil(F.col("n") / F.lit(RANGE)).cast("long"))
    # a few ten thousand sources fit a broadcast; Spark decides by the written table's size
    sources = materialize(sources, "targets")
    known = sources.select(F.col("source").alias(src), "source_size", "target", "ranges", F.col("rank").alias(rank))
    docs = docs.join(known, docs[source].eqNullSafe(known[src]), "left").drop(src)
    docs = docs.withColumn(bucket, F.floor(F.col(u) * F.col("ranges"))).drop("ranges")

    sums = docs.groupBy(F.col(rank).alias(sized_source), F.col(bucket).alias(sized_u)).agg(F.sum("size").alias(before))
    prior = Window.partitionBy(sized_source).orderBy(sized_u).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(sized_source, sized_u, F.coalesce(F.sum(before).over(prior), F.lit(0)).alias(start))
    inside = Window.partitionBy(rank, bucket).orderBy(u, key, "size").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn(before, F.coalesce(F.sum("size").over(inside), F.lit(0)))
    docs = docs.join(sums, (docs[rank] == sums[sized_source]) & (docs[bucket] == sums[sized_u]), "left")
    docs = docs.withColumn(start, F.col(start) + F.col(before))

    rounds = max(1, int(-(-cap // 1)))
    copies = []
    for n in range(rounds):
        at = F.col(start) + F.col("source_size") * F.lit(n)
        words = F.greatest(F.lit(0), F.least(F.col("size"), F.round(F.col("target")).cast("long") - at))
        share = F.try_divide(at.cast("double"), F.col("target"))
        time = F.lit(1.0)
        for i, s in enumerate(segments):
            time = F.when(F.col(rank) % len(segments) == i, invert(s, share)).otherwise(time)
        copies.append(F.when(words > 0, F.struct(time.alias("position"), F.lit(n).alias("copy"), words.alias("words"))))
    docs = docs.withColumn("positions", F.array_compact(F.array(*copies)))
    docs = docs.withColumn("taken", F.aggregate("positions", F.lit(0).cast("long"), lambda a, x: a + x["words"]))
    return docs.drop(u, sized_source, sized_u, bucket, before, start, rank)


def by_position(mixed: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``mixed`` range-sorted by the training position of each row's first copy;
    rows that the mix does not take come last, by a hash of their keys, so that
    they are dealt over ranges too."""
    first = F.coalesce(F.get("positions", F.lit(0))["position"], F.lit(2.0))
    return mixed.repartitionByRange(first, F.xxhash64(key)).sortWithinPartitions(first, F.xxhash64(key))


def training_order(mixed: DataFrame) -> DataFrame:
    """The training sequence: a row for each copy, range-sorted by position
    (each output file holds one stretch of training time, in order)."""
    rows = mixed.select("*", F.inline("positions"))
    return rows.repartitionByRange(F.col("position"), F.col("copy")).sortWithinPartitions("position", "copy")
