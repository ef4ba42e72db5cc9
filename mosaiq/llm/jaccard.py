"""Near-duplicates by SimHash and min-hashes, with the exact Jaccard similarity of word shingles.

1. Every whole text becomes its set of shingle hashes (one narrow pass); texts
   of one set are one point. Only a digest of the set and its min-hash bands
   go on.
2. Texts whose SimHash fingerprints the vantage-point tree links (see
   :mod:`simhash`; over the same shingles) share a bucket. What differs by more
   bits than the tree can part also meets by min-hashes: points that agree in a
   band share a bucket. With ``BANDS`` bands of ``ROWS`` min-hashes a pair of
   similarity 0.8 shares none in about 3 of 10^6 cases. Buckets of one point,
   and all but one of buckets with the same points, go.
3. Only texts whose point shares a bucket are shuffled, as whole sets. Buckets
   of many or large sets are dealt to parts, and each two parts meet in a
   shard of their own.
4. In a shard the similarity is exact. A point taken as vantage point joins all
   its ball; of the others only those within twice the radius can be linked to
   the ball (Jaccard distance is a metric), and one link each is enough. A
   group of n points yields n - 1 links or so, never all pairs.
5. Components of the links, by star steps over the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, materialize
from .components import components
from .simhash import near_components, word_shingles

SHINGLE, SIMILARITY = 5, 0.8
#: Differing bits, of 64, within which the tree links fingerprints.
RADIUS = 4
#: What puts texts into a bucket; every bucket is compared exactly.
SIMHASH, MINHASH = "simhash", "minhash"
BANDS, ROWS = 32, 5
#: Points, and shingles, that a part of a bucket holds, about.
DEAL, DEAL_SHINGLES = 1_000, 2_000_000
#: Texts whose sets are held at once.
SLICE = 250

_rng = np.random.default_rng(42)
_FLIP = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_TIMES = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, shingle: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles (ASCII letters
    in lower case); one for a text of fewer words, none without words."""
    n, parts = word_shingles(text, shingle)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p) for p in parts), np.uint64, n))


def bands(found: np.ndarray) -> np.ndarray:
    """A number for each band of min-hashes; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    low = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for a in range(0, len(found), 2048):
        low = np.minimum(low, ((found[a : a + 2048, None] ^ _FLIP) * _TIMES >> np.uint64(32)).min(0))
    out = np.arange(BANDS, dtype=np.uint64)
    for m in low.reshape(BANDS, ROWS).T:
        out = (out ^ m) * _FOLD
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def links_in_shard(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """Spanning links of the points whose sets are at least that similar."""
    size = np.array([len(s) for s in sets])
    if not size.all():
        raise ValueError("sets must not be empty")
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(size)])
    parts = [flat[a:b] for a, b in zip(begin, begin[1:])]
    mark = np.zeros(len(values), np.int64)

    def alike(x: int, others: np.ndarray) -> np.ndarray:
        mark[parts[x]] = 1
        taken = [parts[o] for o in others]
        starts = np.concatenate([[0], np.cumsum(size[others])[:-1]])
        both = np.add.reduceat(mark[np.concatenate(taken)], starts)
        mark[parts[x]] = 0
        return both / (size[x] + size[others] - both)

    left = np.arange(len(sets))
    while len(left) > 1:
        v, left = int(left[0]), left[1:]
        # a set of less than the similarity's share of the other's size is out of reach
        reach = max(0.0, 2 * similarity - 1) - 1e-9
        can = np.minimum(size[left], size[v]) >= reach * np.maximum(size[left], size[v])
        others = left[can]
        if not len(others):
            continue
        j = alike(v, others)
        near, ring = others[j >= similarity], others[(j < similarity) & (j >= reach)]
        yield from ((v, int(y)) for y in near)
        for x in near.tolist():
            if not len(ring):
                break
            hit = alike(x, ring) >= similarity
            yield from ((x, int(y)) for y in ring[hit])
            ring = ring[~hit]
        left = left[~np.isin(left, near)]


def near_points(
    docs: DataFrame, *, shingle: int = SHINGLE, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text", by: tuple[str, ...] = (SIMHASH, MINHASH)
) -> DataFrame:
    """(``own``, ``best``, ``class``) for each distinct set of shingles: the
    set's digest, its row of the smallest key (nulls last; then the smallest
    text hash), and the smallest digest of its class. Sets are linked by a
    similarity of ``similarity`` or more; a class is what links reach. Sets
    meet ``by`` SimHash components, bands of min-hashes, or both.

    Null and empty texts and texts of white space share the empty set; a text
    of fewer words than a shingle is one shingle. Very long texts are compared
    whole. An empty table gives an empty one; other columns are not read."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                digests, sizes, found = [], [], []
                for t in part.column("text"):
                    s = shingles(t.as_py(), shingle)
                    digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sizes.append(len(s))
                    found.append(bands(s))
                p = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("text_hash"), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    ["key", "text_hash", "p0", "p1", "size", "bands"],
                )

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE):
                part = batch.slice(a, SLICE)
                found = pa.array([shingles(t.as_py(), shingle).tobytes() for t in part.column("text")], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("p0"), part.column("p1"), found], ["p0", "p1", "found"])

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        points = pdf[["p0", "p1"]].to_numpy(np.int64)
        x = np.array(list(links_in_shard([np.frombuffer(s, np.uint64) for s in pdf["found"]], similarity)), np.int64).reshape(-1, 2)
        a, b = points[x[:, 0]], points[x[:, 1]]
        return pd.DataFrame({"a0": a[:, 0], "a1": a[:, 1], "b0": b[:, 0], "b1": b[:, 1]})

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    made = materialize(rows.mapInArrow(prints, f"key {kind}, text_hash long, p0 long, p1 long, size long, bands array<long>"), "prints")
    best = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "text_hash"))
    points = made.groupBy("p0", "p1").agg(best.alias("best"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    points = materialize(points, "points")
    member = points.select("p0", "p1", "size", F.explode("bands" if MINHASH in by else F.array().cast("array<long>")).alias("bucket"))
    if SIMHASH in by:
        linked = near_components(rows.select(F.col("text_hash").alias("node"), "text"), shingle=shingle, radius=RADIUS, key="node")
        # written, as what follows reads it twice
        linked = materialize(linked.groupBy("text_hash").agg(F.min("component_id").alias("bucket")), "linked")
        same = made.where("size > 0").select("text_hash", "p0", "p1", "size").distinct().join(linked, "text_hash")
        member = member.unionByName(same.select("p0", "p1", "size", "bucket").distinct())
    many = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("all")).where("n > 1")
    shared = materialize(member.join(many, "bucket").select("bucket", "n", "all", "p0", "p1"), "shared")
    # of buckets that hold the same points one is enough
    mixed = [F.sum(F.xxhash64("p0", "p1", F.lit(i)).cast("decimal(20,0)")).alias(f"sum{i}") for i in (0, 1)]
    kept = shared.groupBy("bucket", "n", "all").agg(*mixed).groupBy("n", "all", "sum0", "sum1").agg(F.min("bucket").alias("bucket"))
    parts = F.greatest(F.ceil(F.col("n") / DEAL), F.ceil(F.col("all") / DEAL_SHINGLES)).cast("int")
    if SIMHASH in by:
        discard(linked)
    first, shared = shared, materialize(shared.join(kept.select("bucket"), "bucket").select("bucket", parts.alias("parts"), "p0", "p1"), "shared")
    discard(first)
    needed = points.join(shared.select("p0", "p1").distinct(), ["p0", "p1"]).select("p0", "p1", F.col("best.text_hash").alias("text_hash"))
    texts = rows.select("text_hash", "text").join(needed, "text_hash").dropDuplicates(["p0", "p1"]).select("p0", "p1", "text")
    sets = materialize(texts.mapInArrow(with_sets, "p0 long, p1 long, found binary"), "sets")
    part = F.pmod(F.xxhash64("p0", "p1", F.lit(2)), F.col("parts")).cast("int")
    dealt = shared.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.where("parts = 1 OR part <> other").select("bucket", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "p0", "p1")
    links = dealt.join(sets, ["p0", "p1"]).groupBy("bucket", "low", "high").applyInPandas(join, "a0 long, a1 long, b0 long, b1 long")
    found = components(links.select(*[F.struct(F.col(f"{s}0").alias("p0"), F.col(f"{s}1").alias("p1")).alias(s) for s in "ab"]))
    for done in (made, shared, sets):
        discard(done)
    own = F.struct("p0", "p1")
    return points.select(own.alias("own"), "best").join(found, F.col("own") == F.col("node"), "left").select("own", "best", F.coalesce("component", "own").alias("class"))


def drop_near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, similarity: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of near copies (see :func:`near_points`), with the
    columns of ``docs`` whatever their names: that of the smallest key that is
    not null; of different texts under one key the one of the smallest hash; of
    equal rows one."""
    found = near_points(docs, shingle=shingle, similarity=similarity, key=key, text=text)
    kept_key, kept_hash, digest = fresh(docs, "key", "hash", "digest")
    best = found.groupBy("class").agg(F.min("best").alias("best"))
    best = best.select(F.col("best.key").alias(kept_key), F.col("best.text_hash").alias(kept_hash))
    docs = docs.withColumn(digest, F.xxhash64(text))
    stay = docs.join(best, docs[key].eqNullSafe(best[kept_key]) & (docs[digest] == best[kept_hash]), "left_semi")
    return stay.dropDuplicates([key, digest]).drop(digest)
