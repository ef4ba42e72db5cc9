"""Document fingerprints from closed syncmers (DataFrame functions only).

A text is a sequence of tokens: each run of characters that are no white space
is cut into pieces of ``PIECE`` characters from its start, so most words are
one token. A k-mer of tokens is a closed syncmer if the smallest hash among its
inner s-mers is the first's or the last's. That depends on nothing outside the
k-mer, so an edit moves no anchor that it does not touch, and equal passages
have equal anchors at equal distances wherever they stand. One rule holds for
texts of every length.

The fingerprint keeps all anchors with their positions. Two fingerprints are
compared by position: anchors of one hash meet where they stand closest, each
meeting tells by how many tokens the texts are shifted against each other, and
those count that agree on the shift up to ``SLACK`` tokens. The likeness is
their number over that of all anchors of both.

Scale: :func:`with_next` finds each row's successor in one shuffle by key
ranges, each range with the first row of the following one added, so there is
no global window; a key that many rows share is cut into ranges of its texts'
hashes. Only texts are shuffled; fingerprints are made after that, in one pass
over each text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh

#: Characters of a token at most, tokens of a k-mer and of an inner s-mer.
PIECE, K, S = 8, 4, 1
#: Tokens that shifts may differ by and still agree.
SLACK = 64
_TOKEN = rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _smallest(h: Column, at: Column, offsets: Sequence[int]) -> Column:
    values = [F.get(h, at + o) for o in offsets]
    return F.least(*values) if len(values) > 1 else values[0]


def anchors(text: Column) -> Column:
    """Array of numbers, one for each closed syncmer of the text: 31 bits of
    the k-mer's hash, then 32 bits of its position in tokens. One for the whole
    text if it has fewer tokens than a k-mer; none for null and white space."""
    code = lambda h, pos: F.shiftleft(F.shiftrightunsigned(h, 33), 32) + pos

    def found(h: Column, inner: Column) -> Column:
        ends = (0, K - S)
        closed = F.filter(F.sequence(F.lit(0), F.size(h) - K), lambda i: _smallest(inner, i, range(1, K - S)) >= _smallest(inner, i, ends))
        return F.transform(closed, lambda i: code(F.xxhash64(*[F.get(h, i + o) for o in range(K)]), i.cast("long")))

    def hashed(h: Column) -> Column:
        mers = h if S == 1 else F.transform(F.sequence(F.lit(0), F.size(h) - S), lambda i: F.xxhash64(*[F.get(h, i + o) for o in range(S)]))
        many = found(h, h) if S == 1 else let(mers, lambda m: found(h, m))
        return F.when(F.size(h) >= K, many).when(F.size(h) > 0, F.array(code(F.xxhash64(h), F.lit(0).cast("long"))))

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.coalesce(let(F.transform(tokens, lambda t: F.xxhash64(t)), hashed), F.array().cast("array<bigint>"))


def as_string(found: Column) -> Column:
    """Sixteen hex digits for each anchor, eight of its hash and eight of its position; empty without any."""
    return F.lower(F.array_join(F.transform(found, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def shifts(a: Column, b: Column) -> Column:
    """By how many tokens ``b`` must move for its anchors to meet those of
    ``a``: one number for each two of one hash that stand closest."""
    place = lambda x: F.shiftright(x, 1).bitwiseAND(F.lit(0xFFFFFFFF))
    side = lambda x: x.bitwiseAND(F.lit(1))

    def meet(x: Column, y: Column) -> Column:
        same = (F.shiftright(x, 33) == F.shiftright(y, 33)) & (side(x) != side(y))
        return F.when(same, (place(x) - place(y)) * (1 - 2 * side(x)))

    def walk(t: Column) -> Column:
        n = F.greatest(F.size(t) - 1, F.lit(0))
        return F.array_compact(F.zip_with(F.slice(t, 1, n), F.slice(t, 2, n), meet))

    both = F.concat(F.transform(a, lambda x: F.shiftleft(x, 1)), F.transform(b, lambda x: F.shiftleft(x, 1) + 1))
    return let(F.sort_array(both), walk)


def _most(values: Column) -> Column:
    """How many of the most frequent value there are."""
    start = F.struct(F.lit(None).cast("long").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(x == a["last"], a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["most"], run).alias("most"))

    return F.aggregate(F.sort_array(values), start, step, lambda a: a["most"])


def agreeing(found: Column) -> Column:
    """How many shifts lie in the fullest stretch of ``SLACK`` tokens, of the
    stretches around whole multiples and those between."""
    stretch = lambda by: F.transform(found, lambda x: F.floor((x + by) / SLACK))
    return F.greatest(_most(stretch(SLACK // 2)), _most(stretch(0)))


def likeness(a: Column, b: Column) -> Column:
    """Of two arrays of anchors, 0 to 1; two empty ones are alike."""
    least, all_ = F.least(F.size(a), F.size(b)), F.size(a) + F.size(b)
    met = let(shifts(a, b), lambda s: F.when(F.size(s) > 0, F.least(agreeing(s), least)).otherwise(0))
    return F.when(all_ == 0, F.lit(1.0)).otherwise(let(met, lambda m: m / (all_ - m)))


def with_next(df: DataFrame, key: str, carried: Sequence[str], tie: str, made: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with ``next_<c>`` for each carried column: its value in the row of
    the next key, after the last the first. Equal keys are ordered by ``tie``, a
    64-bit hash; null keys come last. The key is an integer. ``made``: columns
    that are added after the shuffle; they can be carried."""
    made = made or {}
    last, least = 2**63 - 1, -(2**63)
    at = F.coalesce(F.col(key).cast("long"), F.lit(last))
    shards = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, cuts = df.select(at.alias("k")).agg(F.min("k"), F.percentile_approx("k", [i / shards for i in range(1, shards)], 10_000)).first()
    if low is None:
        return df.withColumns(made).withColumns({f"next_{c}": F.col(c) for c in carried})
    # where a range begins: at a key that exists, and inside a key of many rows at hashes
    parts = Counter(cuts)
    parts[low] = max(1, parts[low])
    begins = [(c, least + j * 2**64 // n) for c, n in sorted(parts.items()) for j in range(n)]
    k, shard, added = fresh(df, "k", "shard", "added")
    limits = F.array(*[F.struct(F.lit(c).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for c, t in begins])
    own = F.struct(at.alias("k"), F.col(tie).alias("t"))
    rows = df.withColumns({k: at, shard: F.size(F.filter(limits, lambda x: x <= own)) - 1, added: F.lit(False)})
    first = rows.where(F.col(key).isin([c for c in parts if c != last]) | (F.col(key).isNull() if last in parts else F.lit(False)))
    if max(parts.values()) > 1:
        there = sorted(r[0] for r in first.select(shard).distinct().collect())
    else:
        there = list(range(len(begins)))
    one = first.groupBy(shard).agg(F.min_by(F.struct(*df.columns, k), F.struct(k, tie)).alias("r")).select("r.*", shard)
    before = F.element_at(F.create_map(*[F.lit(x) for i, s in enumerate(there) for x in (s, there[i - 1])]), F.col(shard))
    ends = one.withColumns({shard: before, added: F.lit(True)})
    order = Window.partitionBy(shard).orderBy(added, k, tie)
    both = rows.unionByName(ends)
    if made:
        both = both.repartition(shard).withColumns(made)
    return both.withColumns({f"next_{c}": F.lead(c).over(order) for c in carried}).where(~F.col(added)).drop(k, shard, added)


def compare_edited(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``) for every row: the
    fingerprint of its text, of the text whose last quarter is replaced by the
    start of the next row's, and their likeness.

    Null texts count as empty; empty texts have empty fingerprints, alike;
    very long ones are taken whole. Rows of one key follow each other by the
    hash of their texts, null keys come last, repeated rows stay; a single row
    is its own next; an empty table gives an empty one; other columns are not read."""
    whole = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    whole = whole.withColumn("tie", F.xxhash64("text"))
    rows = with_next(whole, "key", ["text", "own"], "tie", {"own": anchors(F.col("text"))})
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = rows.select("key", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    rows = rows.select("key", "n_chars", "own", "next_own", F.sha2("edited", 256).alias("edited_sha256"), anchors(F.col("edited")).alias("changed"))
    return rows.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        as_string(F.col("own")).alias("fingerprint"),
        as_string(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
