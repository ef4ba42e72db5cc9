"""URL allow/block rules as a sort-merge range join (DataFrame functions only).

A rule is a host and a path prefix. Writing a host with its labels reversed
and a dot after each (``www.example.com`` -> ``com.example.www.``) and then the
path gives a canonical key under which a rule covers one interval of keys,
those that start with it, for each host label suffix that its host names. A
URL of host ``a.b.c`` is therefore probed with one key for each of its
suffixes ``c``, ``b.c`` and ``a.b.c``.

Intervals of prefixes are nested or disjoint. Rules and probes are dealt to
shards, which are key ranges cut at quantiles of a bounded sample of keys (at
most ``SAMPLE`` keys reach the driver), and a rule goes to every shard that its
interval overlaps, so a shard needs nothing from its neighbours. In a shard the
rules are walked in key order with a stack: what has ended is popped, the rule
is pushed, and what the stack holds then is the nest of rules that is active
from this key on. Probes and nests are merged in key order; a probe takes the
nest met last, less the rules that have ended before it, and its top is the
longest rule that fits.

Scale: each distinct URL is judged once, so a URL that fills a third of the
rows is one row here and only the final join meets its copies (an outer join
from the pages, which AQE splits where skewed); each distinct key is swept once.
There is a shard for each ``RULES`` rules at least, so the rules that one walk
holds stay few. No side is broadcast, and the rules may be as many as the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, fresh

#: Keys in the sample from which the shards' limits are taken.
SAMPLE = 4096
#: Characters of a key that count for the shard it belongs to.
CUT = 1000
#: Rules that a shard holds, about.
RULES = 500
#: Sorts behind every continuation of a key.
LAST = "\U0010ffff"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(rest), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as above."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _key(host: Column, path: Column) -> Column:
    return F.concat(reversed_host(host), F.lit("\u0000"), path)


def _probes(host: Column, path: Column) -> Column:
    """One key for each label suffix of the host."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".\u0000"), path),
    )


_RULE = "struct<len:int,rule:string,action:string,key:string>"


def _keyed(rules: DataFrame) -> DataFrame:
    """(``key``, ``r``): one rule for each key; of contradicting ones, the blocking one."""
    whole = F.concat("host", "path")
    key = _key(F.col("host"), F.col("path"))
    keyed = rules.select(key.alias("key"), F.struct(F.char_length(whole).alias("len"), whole.alias("rule"), F.col("action").alias("action"), key.alias("key")).alias("r"))
    return keyed.groupBy("key").agg(F.max_by("r", F.col("r.action")).alias("r"))


def _nests(placed: DataFrame) -> DataFrame:
    """(``key``, ``shard``, ``stack``) for each rule of each shard, from
    (``key``, ``shard``, ``r``): the rules that are active from its key on,
    outermost first. The walk keeps them on a stack."""
    stack_type = f"array<{_RULE}>"
    start = F.struct(F.array().cast(stack_type).alias("stack"), F.array().cast(f"array<struct<key:string,stack:{stack_type}>>").alias("met"))

    def walk(a: Column, x: Column) -> Column:
        still = F.filter(a["stack"], lambda r: F.startswith(x["key"], r["key"]))
        pushed = F.array(F.concat(still, F.array(x["r"])))
        return F.get(F.transform(pushed, lambda now: F.struct(now.alias("stack"), F.concat(a["met"], F.array(F.struct(x["key"].alias("key"), now.alias("stack")))).alias("met"))), F.lit(0))

    inside = placed.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("key", "r"))).alias("rules"))
    return inside.select("shard", F.inline(F.aggregate("rules", start, walk, lambda a: a["met"])))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with the columns ``host``, ``path``, ``rule`` and ``verdict``
    added (columns of these names are replaced).

    ``rules`` has ``host``, ``path`` and ``action``. A rule fits its host and
    all subdomains if the URL's path starts with the rule's; the longest wins
    (host and path together); no rule: ``default`` and a null rule. Repeated
    rows stay; null and empty URLs have empty host and path; very long ones are
    judged whole; an empty table of pages gives an empty one, one of rules the
    default for all. Other columns stay, whatever their names. Rules that have
    a null are left out. Of two actions for the same rule, ``block`` wins.
    """
    spark = pages.sparkSession
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "action").dropna()
    judged = pages.select(F.col(url).alias("__url")).dropna().distinct()
    judged = judged.select("__url", url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    probes = judged.select("__url", F.explode(_probes(F.col("host"), F.col("path"))).alias("key"))

    # a key that many URLs share, such as a short path below a top-level domain, is swept once
    keys = probes.select("key").distinct()

    # shards: quantiles of the keys, of URLs and rules, that have the smallest hashes
    sample = keys.select(F.substring("key", 1, CUT).alias("k")).unionByName(_keyed(rules).select(F.substring("key", 1, CUT).alias("k"))).orderBy(F.xxhash64("k"), "k").limit(SAMPLE)
    cuts = sorted({r.k for r in sample.collect()})
    keyed = _keyed(rules)
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), keyed.count() // RULES)
    shards = max(1, min(len(cuts), wanted))
    limits = F.array(*[F.lit(cuts[len(cuts) * i // shards]) for i in range(1, shards)]).cast("array<string>")

    def shard(key: Column) -> Column:
        at = F.substring(key, 1, CUT)
        return F.size(F.filter(limits, lambda x: x <= at))

    probed = keys.select("key", shard(F.col("key")).alias("shard"), F.lit(None).cast(f"array<{_RULE}>").alias("stack"))
    placed = keyed.select("key", F.explode(F.sequence(shard(F.col("key")), shard(F.concat("key", F.lit(LAST))))).alias("shard"), "r")
    starts = _nests(placed).select("key", "shard", "stack")
    # a rule sorts before the probe that equals its key
    sweep = Window.partitionBy("shard").orderBy(F.col("key").asc(), F.col("stack").isNull().asc()).rowsBetween(Window.unboundedPreceding, 0)
    swept = starts.unionByName(probed).withColumn("nest", F.last("stack", ignorenulls=True).over(sweep)).where("stack IS NULL")
    active = F.filter("nest", lambda r: F.startswith(F.col("key"), r["key"]))
    top_rule = F.array_max(F.transform(active, lambda r: F.struct(r["len"].alias("len"), r["rule"].alias("rule"), r["action"].alias("action"))))
    ruled = swept.select("key", top_rule.alias("r")).where("r IS NOT NULL")
    best = probes.join(ruled, "key").groupBy("__url").agg(F.max("r").alias("r"))
    kept = pages.drop("host", "path", "rule", "verdict")
    key, top = fresh(pages, "judged", "top")
    best = best.select(F.col("__url").alias(key), F.col("r").alias(top))
    return (
        kept.join(best, kept[url] == best[key], "left")
        .withColumns(
            {
                "host": url_host(F.col(url)),
                "path": url_path(F.col(url)),
                "rule": F.col(top)["rule"],
                "verdict": F.coalesce(F.col(top)["action"], F.lit(default)),
            }
        )
        .drop(key, top)
    )
