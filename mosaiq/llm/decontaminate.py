"""Benchmark decontamination by templates (DataFrame functions only).

Each word of a text is made canonical: numbers, names (capitalised inside a
sentence) and units after numbers become typed placeholders, the rest is
lower-cased without punctuation. Windows of ``width`` canonical words are hash
keys; a benchmark question whose numbers and names were exchanged still has
the keys of the original. A window that keeps fewer than half of its words
literal says too little, so it is keyed by its words as they are.

Windows of documents meet the benchmark's in a hash join. On each diagonal
(document position less item position) the slots' values must be consistent:
over all matched windows one item value stands for one document value and the
other way round. An item leaks into a text if at least ``coverage`` of its
distinct windows are met on consistent diagonals, however often each is met.

Scale: one narrow pass makes keys, with no shuffle of texts; only windows that
the benchmark has go on, keyed by a hash of their text, so copies are judged
together. The benchmark's windows are broadcast if they are at most
``BROADCAST``, as counted; beyond, the join shuffles.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import count_words, fresh, materialize

#: Words of the shortest item that is looked for inside texts; of fewer words,
#: which stand in clean texts too, it leaks only where it is the whole text.
SHORTEST = 4
#: Windows of the benchmark that are broadcast at most.
BROADCAST = 500_000

NUM, UNIT, NAME = "\ue000", "\ue001", "\ue002"
#: Inside a character class. Characters below 256 are listed one by one, as the
#: regex engine looks these up in a table and tries ranges in turn.
_WS = r"\x20\x09\x0A\x0B\x0C\x0D"
#: Units of measure and currency that may follow a number.
UNITS = (
    "mm|cm|m|km|in|inch|inches|ft|foot|feet|yd|yard|yards|mi|mile|miles|mg|g|kg|gram|grams|kilogram|kilograms|t|ton|tons|oz|lb|lbs|pound|pounds|"
    "ml|cl|l|liter|liters|litre|litres|gal|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hr|hour|hours|day|days|week|weeks|month|months|year|years|"
    "meter|meters|metre|metres|kilometer|kilometers|hz|khz|mhz|ghz|w|kw|mw|v|kv|a|ma|j|kj|cal|kcal|n|pa|kpa|bar|c|f|k|degrees|percent|"
    "usd|eur|gbp|dollar|dollars|euro|euros|cent|cents"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: ASCII and Latin punctuation and symbols, then ranges of general ones.
_MARKS = [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F), *range(0xA1, 0xAA), *range(0xAB, 0xB2), 0xB4, *range(0xB6, 0xB9), 0xBB, 0xBF]
_PUNCT = "".join(rf"\x{c:02X}" for c in _MARKS) + r"\u2010-\u2027\u2030-\u205e\u3001-\u3003\u3008-\u3011"


def canonical(text: Column) -> Column:
    """The text with placeholders and without punctuation that touches a word;
    white space, and so the number of words, stays. The patterns begin with
    the character that is rare, so most positions fail at once."""
    t = F.regexp_replace(text, rf"\p{{Lu}}(?<=[\p{{Ll}},;:][{_WS}]\p{{Lu}})[\p{{L}}\p{{M}}'’-]*+", NAME)
    t = F.regexp_replace(t, r"[0-9]++(?:[.,:/][0-9]++)*+", NUM)
    units = lambda x: F.regexp_replace(x, rf"(?i)(?<={NUM}|{NUM}[{_WS}])(?:{UNITS})(?!\p{{L}})", UNIT)
    t = let(t, lambda x: F.when(F.contains(x, F.lit(NUM)), units(x)).otherwise(x))
    t = F.regexp_replace(t, rf"[{_PUNCT}]++(?=[^{_WS}{_PUNCT}])|[{_PUNCT}](?<=[^{_WS}{_PUNCT}][{_PUNCT}])[{_PUNCT}]*+", "")
    return F.lower(t)


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(rf"[^{_WS}]+"), F.lit(0))


def _rolled(h: Column, width: int) -> Column:
    """A hash of every ``width`` neighbours of ``h``, made of hashes of halves."""
    if width == 1:
        return h
    half = width // 2

    def joined(a: Column) -> Column:
        n = F.size(h) - width + 1
        pairs = F.zip_with(F.slice(a, 1, n), F.slice(a, half + 1, n), lambda x, y: F.xxhash64(x, y))
        return F.zip_with(pairs, F.slice(h, width, n), lambda x, y: F.xxhash64(x, y)) if width % 2 else pairs

    return let(_rolled(h, half), joined)


_WINDOWS = "array<struct<pos:int,key:bigint,slots:array<string>>>"


def windows(text: Column, width: int, narrow: Sequence[int] = ()) -> Column:
    """Array of (``pos``, ``key``, ``slots``); one window if there are fewer
    words, null without words. ``slots`` is null where there are none. Windows
    of each ``narrow`` width follow, where the text is longer."""
    slot = rf"[{NUM}-{NAME}]"
    none = F.lit(None).cast("array<string>")

    def short(keys: Column, n: Column) -> Column:
        """Keys of windows of fewer than ``width`` words."""
        return F.transform(F.sequence(F.lit(1), F.size(keys) - n + 1), lambda i: F.xxhash64(F.slice(keys, i, n)))

    def placed(keys: Column, slots: Callable[[Column], Column] | None, n: Column | int) -> Column:
        def window(key: Column, i: Column) -> Column:
            if slots is None:
                return F.struct((i + 1).alias("pos"), key.alias("key"), none.alias("slots"))
            return let(slots(i), lambda s: F.struct((i + 1).alias("pos"), key.alias("key"), F.when(F.size(s) > 0, s).alias("slots")))

        return F.transform(keys, window)

    def of_width(k: Column, n: Column | int, whole: bool) -> Column:
        return _rolled(k, width) if whole else short(k, F.lit(n) if isinstance(n, int) else n)

    def slotted(k: Column, words: Column, raw: Column, n: Column | int, whole: bool) -> Column:
        plain = F.transform(raw, lambda w: F.xxhash64(F.lower(w)))
        values = F.zip_with(words, raw, lambda w, r: F.when(w.rlike(slot), r))
        length = F.lit(n) if isinstance(n, int) else n

        def both(a: Column, p: Column, v: Column) -> Column:
            held = lambda i: F.array_compact(F.slice(v, i + 1, length))
            literal_key = lambda x, i: F.when(F.size(held(i)) * 2 <= length, x).otherwise(F.xxhash64(F.get(p, i), F.lit(1)))
            return placed(F.transform(a, literal_key), held, n)

        keys, plains = of_width(k, n, whole), let(plain, lambda p: of_width(p, n, whole))
        return let(keys, lambda a: let(plains, lambda p: let(values, lambda v: both(a, p, v))))

    def made(canon: Column, words: Column) -> Column:
        def keyed(k: Column) -> Column:
            has_slots = canon.rlike(slot)

            def either(n: Column | int, whole: bool) -> Column:
                return F.when(has_slots, slotted(k, words, _words(text), n, whole)).otherwise(placed(of_width(k, n, whole), None, n))

            main = F.when(F.size(k) >= width, either(width, True)).when(F.size(k) > 0, let(F.size(k), lambda n: either(n, False)))
            more = [F.when(F.size(k) > w, either(w, False)).otherwise(F.array().cast(_WINDOWS)) for w in narrow]
            return F.concat(main, *more) if more else main

        return let(F.transform(words, lambda w: F.xxhash64(w)), keyed)

    return let(canonical(text), lambda canon: let(_words(canon), lambda words: made(canon, words)))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, width: int = 8, coverage: float = 0.5, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(``text_hash``, ``item``, ``windows``, ``share``, ``changed``) for each
    distinct text of ``docs`` and each item that leaks into it. ``windows``:
    distinct windows of the item that are met; ``changed``: slots whose values
    differ from the item's on the diagonal that has most of them.

    An item of fewer than ``width`` words is one window, looked for inside
    texts if it has ``SHORTEST`` words at least. Null and empty texts match
    nothing; items without words are left out; very long texts are read whole;
    repeated rows count once; empty tables give none."""
    short = count_words(F.col(item_text))
    narrow = sorted(r[0] for r in benchmark.select(short.alias("n")).where(F.col("n").between(SHORTEST, width - 1)).distinct().collect())
    own = benchmark.select(F.col(item).alias("item"), F.inline(windows(F.col(item_text), width)))
    own = own.groupBy("item", "key").agg(F.min_by(F.struct("pos", "slots"), "pos").alias("w"))
    own = materialize(own.select("item", "key", F.col("w.pos").alias("item_pos"), F.col("w.slots").alias("item_slots")), "benchmark")
    sizes = own.groupBy("item").agg(F.count(F.lit(1)).alias("whole"))
    small = own.count() <= BROADCAST
    side = F.broadcast(own) if small else own
    rows = docs.select(F.xxhash64(text).alias("text_hash"), F.inline(windows(F.col(text), width, narrow)))
    hits = rows.join(side, "key").select("text_hash", "item", "item_pos", "slots", "item_slots", (F.col("pos") - F.col("item_pos")).alias("shift"))
    # windows of one key have as many slots; copies of a text give the same hits
    zipped = F.coalesce(F.arrays_zip(F.col("item_slots").alias("a"), F.col("slots").alias("b")), F.array().cast("array<struct<a:string,b:string>>"))
    hits = hits.groupBy("text_hash", "item", "shift", "item_pos").agg(F.first(zipped).alias("pairs"))
    pairs = F.array_distinct(F.flatten(F.collect_list("pairs")))
    lines = hits.groupBy("text_hash", "item", "shift").agg(F.collect_list("item_pos").alias("met"), pairs.alias("pairs"))
    one = lambda c: F.size(F.array_distinct(F.transform("pairs", lambda p: p[c])))
    lines = lines.where((one("a") == F.size("pairs")) & (one("b") == F.size("pairs")))
    same = -F.size(F.filter("pairs", lambda p: p["a"] != p["b"]))
    # an item's window that several diagonals meet counts once
    met = lines.select("text_hash", "item", F.struct(F.size("met").alias("n"), same.alias("same")).alias("line"), "met")
    met = met.select("text_hash", "item", "line", F.explode("met").alias("item_pos"))
    met = met.groupBy("text_hash", "item", "item_pos").agg(F.max("line").alias("line"))
    leaks = met.groupBy("text_hash", "item").agg(F.count(F.lit(1)).alias("windows"), (-F.max("line")["same"]).cast("long").alias("changed"))
    leaks = leaks.join(F.broadcast(sizes) if small else sizes, "item")
    return leaks.select("text_hash", "item", "windows", (F.col("windows") / F.col("whole")).alias("share"), "changed").where(F.col("share") >= coverage)


def leak_rows(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(``key``, ``item``, ``windows``, ``share``, ``changed``) for every row of ``docs`` and every item that leaks into it."""
    found = find_leaks(docs, benchmark, text=text, **options)
    rows = docs.select(F.col(key), F.xxhash64(text).alias("text_hash"))
    return rows.join(found, "text_hash").drop("text_hash")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with its columns."""
    (digest,) = fresh(docs, "digest")
    found = find_leaks(docs, benchmark, text=text, **options).select(F.col("text_hash").alias(digest)).distinct()
    found = materialize(found, "leaks")
    marked = docs.withColumn(digest, F.xxhash64(text))
    return marked.join(found, digest, "left_anti").drop(digest)
