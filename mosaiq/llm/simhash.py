"""SimHash near-duplicates by a vantage-point tree over fingerprints.

1. Every whole text gets its fingerprint (one narrow pass), and only
   (id, fingerprint) goes on; equal fingerprints become one point.
2. A vantage-point tree is fitted to a bounded sample of points on the driver.
   An inner node has a vantage point and a distance: points up to that
   distance are inside, the others outside. Its leaves are the shards.
3. Every point has one home shard, and asks the shards that its ball of the
   link radius overlaps: by the triangle inequality no other holds a
   neighbour. Of two points at least one asks the other's home (the inner
   one, where their ways part), so outer points need not ask inwards.
   Where the metric does not separate points (a ball that overlaps nearly
   everything, a dense group), a shard's homes and guests are dealt by hash to
   parts, and each two parts meet in a shard of their own, so that a shard
   holds about twice ``DEAL`` points at most.
4. In a shard, two points within the radius agree in one of radius + 1 blocks
   of bits at least, so only points that share a block are compared. Of many
   that do, one taken as vantage point joins all its ball at once and the ball
   is settled: others need one link to it, and only those within twice the
   radius can have one. A shard gives spanning links, never all pairs, so a
   group of n copies yields n - 1 links or so from each shard.
5. Components of the links, by star steps over the cluster. A node is a point
   with its smallest key before it, so the smallest node of a component names
   it, and no join goes by components, of which one may hold most rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialize
from .components import components

#: Fingerprints in the sample to which the tree is fitted.
SAMPLE = 20_000
#: A shard is meant to hold this many points times the points' number to the
#: power 0.6: larger shards compare more pairs, smaller ones are asked by more guests.
SHARD = 6
#: Homes, or guests, above which those of a shard are dealt to parts.
DEAL = 250_000
#: Points that share a block and are compared pair by pair at most.
RUN = 64
#: Share of points asking both sides beyond which a split is not worth it.
BOTH = 0.95

_BLANKS = re.compile(rb"[\x20\x09-\x0d]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Shingles whose places are held as Python numbers at once.
_RUN = 1 << 16


def word_shingles(text: str | None, shingle: int) -> tuple[int, Iterator[bytes]]:
    """How many word shingles a text has (ASCII letters in lower case, words
    joined by one space), and these: one of all words if there are fewer, none
    without words. Takes memory for a few numbers a word, however long the text."""
    line = _BLANKS.sub(b" ", text.encode("utf-8", "replace").translate(_LOWER)).strip(b" ") if text else b""
    if not line:
        return 0, iter(())
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    if len(gaps) < shingle:
        return 1, iter((line,))
    begins = np.concatenate(([0], gaps + 1))[: len(gaps) + 2 - shingle]
    ends = np.concatenate((gaps, [len(line)]))[shingle - 1 :]

    def run() -> Iterator[bytes]:
        for i in range(0, len(begins), _RUN):
            for a, b in zip(begins[i : i + _RUN].tolist(), ends[i : i + _RUN].tolist()):
                yield line[a:b]

    return len(begins), run()


def fingerprint(text: str | None, shingle: int, seeds: tuple[int, ...]) -> list[int]:
    """A 64-bit SimHash of word shingles for each seed; 0 without words."""
    out = []
    for seed in seeds:
        n, parts = word_shingles(text, shingle)
        if not n:
            return [0] * len(seeds)
        h = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), np.uint64, n)
        octets = h.view(np.uint8).reshape(-1, 8)
        bits = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
        out.append(int(np.packbits(bits * 2 > n, bitorder="little").view(np.uint64)[0]))
    return out


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def with_fingerprints(docs: DataFrame, *, shingle: int, seeds: tuple[int, ...], text: str = "text", to: str = "fp") -> DataFrame:
    """``docs`` with ``to``: an array of signed 64-bit fingerprints."""

    @F.pandas_udf("array<long>")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.array(fingerprint(t, shingle, seeds), np.uint64).view(np.int64) for t in batch])

    return docs.withColumn(to, fp(F.col(text)))


@dataclass
class Node:
    """A vantage point with its limit, or parts dealt by hash, or a leaf."""

    vantage: np.ndarray | None = None
    limit: int = 0
    inside: Node | None = None
    outside: Node | None = None
    #: Of a leaf: parts of its homes and of its guests, and its first shard.
    parts: int = 0
    guest_parts: int = 0
    shard: int = -1


@dataclass
class Tree:
    radius: int
    root: Node
    shards: int = 0
    leaves: list[Node] = field(default_factory=list)


def distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Differing bits of each row and ``one``."""
    d = np.bitwise_count(points[:, 0] ^ one[0])
    if points.shape[1] > 1:
        d = d.astype(np.int16)
        for i in range(1, points.shape[1]):
            d += np.bitwise_count(points[:, i] ^ one[i])
    return d


def build(sample: np.ndarray, total: int, radius: int, *, shard: float | None = None, deal: int = DEAL) -> Tree:
    """A tree for ``total`` points of which ``sample`` are known. The first of
    a node's sampled points is its vantage point (the sample is in hash
    order), the median distance its limit."""
    tree = Tree(radius, Node())
    shard = SHARD * total**0.6 if shard is None else shard
    scale = total / max(1, len(sample))

    def leaf(node: Node, points: np.ndarray) -> None:
        node.parts = max(1, int(np.ceil(len(points) * scale / deal)))
        node.shard = len(tree.leaves)
        tree.leaves.append(node)

    stack = [(tree.root, sample, 0)]
    while stack:
        node, points, depth = stack.pop()
        if len(points) * scale <= shard or len(points) < 8 or depth > 40:
            leaf(node, points)
            continue
        d = distances(points, points[0]).astype(np.int16)
        limit = int(np.median(d))
        if limit >= d.max():
            limit = int(d.max()) - 1
        inner = d <= limit
        both = np.mean((d > limit - radius) & (d <= limit + radius))
        if limit < 0 or both > BOTH or not inner.any() or inner.all():
            leaf(node, points)
            continue
        node.vantage, node.limit, node.inside, node.outside = points[0], limit, Node(), Node()
        stack += [(node.outside, points[~inner], depth + 1), (node.inside, points[inner], depth + 1)]
    # the sample's guests tell how many each leaf will have
    asked = np.zeros(len(tree.leaves))
    for node, at, home in leaves_of(tree, sample):
        asked[node.shard] += (~home).sum()
    for node in tree.leaves:
        node.guest_parts = max(1, int(np.ceil(asked[node.shard] * scale / deal)))
        node.shard, tree.shards = tree.shards, tree.shards + node.parts * (node.parts + 1) // 2 + node.parts * (node.guest_parts - 1)
    return tree


def leaves_of(tree: Tree, points: np.ndarray) -> Iterator[tuple[Node, np.ndarray, np.ndarray]]:
    """(leaf, rows, whether at home) for every leaf that some of the points ask."""
    stack = [(tree.root, np.arange(len(points)), np.ones(len(points), bool))]
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if node.vantage is None:
            yield node, at, home
            continue
        d = distances(points[at], node.vantage).astype(np.int16)
        inner = d <= node.limit
        go_in = np.where(home, inner, d <= node.limit + tree.radius)
        go_out = np.where(home, ~inner | (d > node.limit - tree.radius), d > node.limit - tree.radius)
        stack.append((node.inside, at[go_in], home[go_in]))
        stack.append((node.outside, at[go_out], (home & ~inner)[go_out]))


def route(tree: Tree, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, whether at home) for all shards that the points ask.

    A leaf's shards: one for each two parts of its homes (the later part as
    guests of the earlier), and one for each part of its homes with each part
    of its guests; the guests' first part joins the homes alone with themselves."""
    rows, shards, homes = [], [], []

    def put(at: np.ndarray, shard: np.ndarray | int, home: bool) -> None:
        rows.append(at)
        shards.append(np.broadcast_to(np.asarray(shard, np.int64), len(at)))
        homes.append(np.full(len(at), home))

    with np.errstate(over="ignore"):
        mixed = (points[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ (points[:, -1] >> np.uint64(29))) >> np.uint64(7)
    for node, at, home in leaves_of(tree, points):
        p, g = node.parts, node.guest_parts
        own, guests = at[home], at[~home]
        part = (mixed[own] % np.uint64(p)).astype(np.int64)
        for other in range(p):
            low, high = np.minimum(part, other), np.maximum(part, other)
            pair = node.shard + low * p - low * (low - 1) // 2 + high - low
            first = part <= other
            put(own[first], pair[first], True)
            put(own[~first], pair[~first], False)
        after = node.shard + p * (p + 1) // 2
        seat = (mixed[guests] % np.uint64(g)).astype(np.int64)
        for i in range(p):
            put(guests, np.where(seat == 0, node.shard + i * p - i * (i - 1) // 2, after + i * (g - 1) + seat - 1), False)
        for j in range(g - 1):
            put(own, after + part * (g - 1) + j, True)
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(homes)


class Forest:
    """Which points are joined already, so that only spanning links are given."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def links_in_shard(homes: np.ndarray, guests: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that join what is within ``radius``: of homes with homes and with
    guests. Indices; guests count on from the homes."""
    points = np.concatenate([homes, guests]) if len(guests) else homes
    width = 64 * points.shape[1] // (radius + 1) if points.ndim == 2 else 0
    if len(points) <= 4 * RUN or width < 8:
        yield from _by_vantage(homes, guests, radius)
        return
    forest, left = Forest(len(points)), len(homes)
    for block in range(radius + 1):
        key = _block(points, block * 64 * points.shape[1] // (radius + 1), (block + 1) * 64 * points.shape[1] // (radius + 1))
        order = np.argsort(key, kind="stable")
        key = key[order]
        begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(begins, len(key)))
        run = np.repeat(np.arange(len(begins)), sizes)
        few = (sizes <= RUN)[run]
        for step in range(1, RUN):
            i = np.flatnonzero((run[step:] == run[:-step]) & few[step:])
            if not len(i):
                break
            a, b = order[i], order[i + step]
            near = np.bitwise_count(points[a] ^ points[b]).sum(1, dtype=np.int64) <= radius
            near &= (a < left) | (b < left)
            for x, y in zip(a[near].tolist(), b[near].tolist()):
                if forest.join(x, y):
                    yield x, y
        for r in np.flatnonzero(sizes > RUN):
            at = np.sort(order[begins[r] : begins[r] + sizes[r]])  # homes come first
            n = int((at < left).sum())
            for x, y in _by_vantage(points[at[:n]], points[at[n:]], radius):
                if forest.join(int(at[x]), int(at[y])):
                    yield int(at[x]), int(at[y])


def _block(points: np.ndarray, low: int, high: int) -> np.ndarray:
    """The bits from ``low`` up to ``high`` of each point, as a number."""
    word, at, n = low // 64, low % 64, high - low
    out = points[:, word] >> np.uint64(at)
    if at + n > 64:
        out = out | points[:, word + 1] << np.uint64(64 - at)
    return out & np.uint64((1 << n) - 1)


def _by_vantage(homes: np.ndarray, guests: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """The same, by vantage points and their balls alone."""
    points = np.concatenate([homes, guests]) if len(guests) else homes
    ids, left = np.arange(len(points)), len(homes)
    forest = Forest(len(points))

    def joined(x: int, others: np.ndarray) -> Iterator[tuple[int, int]]:
        for y in others.tolist():
            if forest.join(x, y):
                yield x, y

    gone = np.zeros(len(points), bool)  # by place; homes come first, and those before v are done
    v = settled = 0
    while v < left:
        if gone[v]:
            v, settled = v + 1, settled - 1
            continue
        d = distances(points[v + 1 :], points[v])
        hits = np.flatnonzero(d <= 2 * radius) + v + 1
        hits = hits[~gone[hits]]
        at = d[hits - v - 1]
        near, ring = hits[at <= radius], hits[at > radius]
        yield from joined(int(ids[v]), ids[near])
        ball = near[near < left]  # guests stay: other homes may need them
        # one link of each of the ring to the ball is enough, by the ball's points in turn
        for x in ball if len(ring) else ():
            hit = distances(points[ring], points[x]) <= radius
            yield from joined(int(ids[x]), ids[ring[hit]])
            ring = ring[~hit]
            if not len(ring):
                break
        gone[ball] = True
        settled += len(ball)
        v += 1
        if settled > 1000 and settled > (left - v) // 4:
            keep = np.flatnonzero(~gone[v:]) + v
            left = int((keep < left).sum())
            points, ids, gone, v, settled = points[keep], ids[keep], np.zeros(len(keep), bool), 0, 0


def _node(prefix: str, words: int, first: str, kind: str) -> Column:
    """A point as one value that sorts by its smallest key, nulls last: the
    smallest node of a component holds the component's id."""
    least = F.col(first).cast(kind)
    return F.struct(least.isNull().alias("none"), least.alias("first"), *[F.col(f"{prefix}{i}").alias(f"f{i}") for i in range(words)])


def near_components(
    docs: DataFrame, *, shingle: int = 4, bits: int = 64, radius: int = 4, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(``key``, ``fingerprint``, ``component_id``, ``text_hash``, ``class``)
    for every row of ``docs``.

    ``fingerprint``: hex of the SimHash of ``bits`` (64 or more, by 64) over
    word shingles (see :func:`fingerprint`). Rows are linked where ``radius``
    bits or fewer differ. ``component_id``: the smallest key that can be
    reached (null if all are null). ``class`` is the component's smallest node.

    Null texts count as empty, all texts without words share fingerprint 0;
    very long texts are read whole. Repeated rows, and different texts under
    one key, give a row each; an empty table gives an empty one; other columns
    of ``docs`` are not read. Keys are integers or strings.
    """
    spark = docs.sparkSession
    words = bits // 64
    seeds = tuple(42 + i for i in range(words))
    own = [f"f{i}" for i in range(words)]
    kind = docs.schema[key].dataType.simpleString()
    prints = with_fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle=shingle, seeds=seeds, to="fp")
    prints = materialize(prints.select("key", F.xxhash64("text").alias("text_hash"), *[F.col("fp")[i].alias(f) for i, f in enumerate(own)]), "prints")
    # keys travel as text: a null must not turn a batch of integers into floats
    points = materialize(prints.groupBy(*own).agg(F.min("key").cast("string").alias("first")), "points")
    total = points.count()
    sample = points.orderBy(F.xxhash64(*own), *own).select(*own).limit(SAMPLE).collect()
    known = np.array([tuple(r) for r in sample], np.int64).reshape(len(sample), words).view(np.uint64)
    tree = spark.sparkContext.broadcast(build(known, total, radius))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            p = np.ascontiguousarray(batch[own].to_numpy(np.int64)).view(np.uint64)
            first = batch["first"].to_numpy()
            for a in range(0, len(p), 2000):
                part = p[a : a + 2000]
                row, shard, home = route(tree.value, part)
                flat = part.view(np.int64)[row]
                yield pd.DataFrame({"shard": shard, "home": home, **{f: flat[:, i] for i, f in enumerate(own)}, "first": first[a : a + 2000][row]})

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        p = np.ascontiguousarray(pdf[own].to_numpy(np.int64)).view(np.uint64)
        home = pdf["home"].to_numpy(bool)
        both = np.concatenate([p[home], p[~home]]).view(np.int64)
        first = pdf["first"].to_numpy()
        first = np.concatenate([first[home], first[~home]])
        x = np.array(list(links_in_shard(p[home], p[~home], radius)), np.int64).reshape(-1, 2)
        out = {f"{side}{i}": both[x[:, k], i] for k, side in enumerate("ab") for i in range(words)}
        return pd.DataFrame({**out, "a_first": first[x[:, 0]], "b_first": first[x[:, 1]]})

    longs = lambda side: ", ".join(f"{side}{i} long" for i in range(words))
    asked = points.mapInPandas(spread, f"shard long, home boolean, {longs('f')}, first string")
    links = asked.groupBy("shard").applyInPandas(join, f"{longs('a')}, {longs('b')}, a_first string, b_first string")
    found = components(links.select(_node("a", words, "a_first", kind).alias("a"), _node("b", words, "b_first", kind).alias("b")))
    tree.destroy()  # the links are written
    node = _node("f", words, "first", kind)
    classes = points.select(node.alias("own")).join(found, F.col("own") == F.col("node"), "left").select("own", F.coalesce("component", "own").alias("class"))
    by_point = classes.select(*[F.col("own")[f].alias(f"p{i}") for i, f in enumerate(own)], F.col("class")["first"].alias("component_id"), "class")
    hexed = F.concat(*[F.lower(F.lpad(F.hex(f), 16, "0")) for f in own])
    same = [F.col(f) == F.col(f"p{i}") for i, f in enumerate(own)]
    # a group of copies is a run of equal points on the left, which Spark splits where it is skewed
    return prints.select("key", "text_hash", hexed.alias("fingerprint"), *own).join(by_point, same).select(
        F.col("key").alias(key), "fingerprint", "component_id", "text_hash", "class"
    )


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 4, bits: int = 64, radius: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``:
    that of the smallest key that is not null (of different texts under one
    key, the one of the smallest hash)."""
    found = near_components(docs, shingle=shingle, bits=bits, radius=radius, key=key, text=text)
    kept_key, kept_hash, digest = fresh(docs, "key", "hash", "digest")
    best = found.groupBy("class").agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "text_hash")).alias("best"))
    best = best.select(F.col("best.key").alias(kept_key), F.col("best.text_hash").alias(kept_hash))
    docs = docs.withColumn(digest, F.xxhash64(text))
    stay = docs.join(best, docs[key].eqNullSafe(best[kept_key]) & (docs[digest] == best[kept_hash]), "left_semi")
    return stay.dropDuplicates([key, digest]).drop(digest)
