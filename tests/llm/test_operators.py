"""The training-data operators against brute force, on small fixtures and odd rows."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from mosaiq.llm import boosting, components, cotraining, decontaminate, html_text, mixing, nbsvm, ngrams, pii, queries, simhash, syncmers, toxicity, url_filter, warc

from ..oracle import assert_same, connect

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, __k string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark, texts):
    """Documents with clashing extra columns; a pair gives the id too."""
    rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en" if t else None, f"s{(i or 0) % 3}" if t else None, len(t or ""), "x", "y") for i, t in rows], DOCS)


ODD = [(1, None), (1, None), (2, ""), (2, " \t\n"), (3, "a"), (None, "a"), (None, None), (4, "word " * 30_000), (5, "x" * 50_000), (6, "é👍 ñandú"), (6, "é👍 ñandú")]


# SimHash


def brute_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    parts = [" ".join(w)] if len(w) < k else [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def brute_components(prints, radius=4):
    at = list(range(len(prints)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                a, b = find(i), find(j)
                at[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n", "A", "a b", " a  B\tc\n", "a b c d", "É b c d e", "x " * 9 + "y", "one\x0btwo\x0cthree\rfour five"])
@pytest.mark.parametrize("k", [1, 4, 5])
def test_word_shingles(text, k, monkeypatch):
    monkeypatch.setattr(simhash, "_RUN", 2)
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    want = [" ".join(words[i : i + k]).encode() for i in range(max(1, len(words) - k + 1))] if words else []
    n, found = simhash.word_shingles(text, k)
    assert list(found) == want and n == len(want)


def test_simhash_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas()
    prints = [brute_print(t) for t in docs["text"]]
    roots = brute_components(prints)
    smallest = {}
    for i, r in zip(docs["doc_id"], roots):
        smallest[r] = min(i, smallest.get(r, i))
    got = queries.op1_simhash(spark, data).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    for i, p, r in zip(docs["doc_id"], prints, roots):
        assert got.loc[i, "fingerprint"] == f"{p:016x}" and got.loc[i, "component_id"] == smallest[r]


def test_simhash_odd_rows(spark):
    got = simhash.near_components(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    none = [r for r in got if r["fingerprint"] == "0" * 16]
    assert len(none) == 5 and {r["component_id"] for r in none} == {1}
    alone = [r["component_id"] for r in got if r["doc_id"] is None and r["fingerprint"] != "0" * 16]
    assert alone == [3]
    kept = simhash.drop_near_duplicates(docs_of(spark, ODD))
    assert kept.columns == docs_of(spark, ODD).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6]
    assert simhash.near_components(docs_of(spark, [])).count() == 0
    assert [r["component_id"] for r in simhash.near_components(docs_of(spark, [(None, "a b")])).collect()] == [None]


@pytest.mark.parametrize(("words", "radius", "shard", "deal"), [(1, 4, 40, 10_000), (1, 4, 40, 50), (1, 4, 10_000, 30), (2, 20, 30, 60), (1, 0, 10, 100)])
def test_tree_loses_no_link(words, radius, shard, deal):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, (300, words), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (300, words), dtype=np.uint64)
    near = np.repeat(base[:60], 6, 0)
    for i in range(len(near)):
        for b in rng.integers(0, 64 * words, rng.integers(0, radius + 3)):
            near[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    points = np.unique(np.concatenate([base, near]), axis=0)
    tree = simhash.build(points[:200], len(points), radius, shard=shard, deal=deal)
    row, where, home = simhash.route(tree, points)
    assert np.bincount(row[home], minlength=len(points)).min() >= 1
    assert deal > 1000 or max(np.bincount(where)) <= 4 * deal
    links = []
    for s in np.unique(where):
        of, at_home = row[where == s], home[where == s]
        own, guests = of[at_home], of[~at_home]
        ids = np.concatenate([own, guests])
        links += [(ids[a], ids[b]) for a, b in simhash.links_in_shard(points[own], points[guests], radius)]
    dist = lambda a, b: sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(points[a], points[b]))
    assert all(dist(a, b) <= radius for a, b in links)

    def classes(pairs):
        at = list(range(len(points)))

        def find(x):
            while at[x] != x:
                x = at[x]
            return x

        for a, b in pairs:
            x, y = find(a), find(b)
            at[max(x, y)] = min(x, y)
        return [find(i) for i in range(len(points))]

    want = [(i, j) for i in range(len(points)) for j in range(i) if dist(i, j) <= radius]
    assert classes(links) == classes(want)


@pytest.mark.parametrize(("words", "radius", "run"), [(1, 4, 64), (1, 4, 3), (2, 9, 5), (1, 0, 4), (2, 25, 64)])
def test_links_by_blocks_are_those_of_all_pairs(words, radius, run, monkeypatch):
    monkeypatch.setattr(simhash, "RUN", run)
    rng = np.random.default_rng(9)
    near = np.repeat(rng.integers(0, 2**63, (90, words), dtype=np.uint64), 8, 0)
    for i in range(len(near)):
        for b in rng.integers(0, 64 * words, rng.integers(0, radius + 3)):
            near[i, b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    points = rng.permutation(np.unique(near, axis=0))
    homes, guests = points[: 2 * len(points) // 3], points[2 * len(points) // 3 :]
    d = np.bitwise_count(points[:, None] ^ points[None]).sum(2, dtype=int)

    def classes(pairs):
        forest = simhash.Forest(len(points))
        for x, y in pairs:
            forest.join(int(x), int(y))
        return [forest.find(i) for i in range(len(points))]

    got = list(simhash.links_in_shard(homes, guests, radius))
    want = [(i, j) for i, j in np.argwhere(d <= radius) if i < j and i < len(homes)]
    assert all(d[x, y] <= radius for x, y in got) and classes(got) == classes(want) and len(got) < len(points)


def test_shard_links_stay_few_in_a_dense_group():
    base = np.uint64(0x0123456789ABCDEF)
    group = np.array([[base ^ np.uint64((1 << a) | (1 << b))] for a in range(64) for b in range(a)], np.uint64)
    links = list(simhash.links_in_shard(group, group[:0], 4))
    assert len(links) == len(group) - 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 100), (7, 7), (60, 100)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_spend_few_plans_on_the_driver(spark, monkeypatch):
    """No round goes to showing that the last one changed nothing, and a round's plan reads its links in four places."""
    written = []
    monkeypatch.setattr(components, "materialize", lambda df, label, to=components.materialize: written.append(df) or to(df, label))
    stars = [(i, i // 10 * 10) for i in range(100) if i % 10] + [(1, 0)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {i: i // 10 * 10 for i in range(100)}
    assert len(written) == 2  # the links, and one round
    assert written[1]._jdf.queryExecution().optimizedPlan().collectLeaves().size() <= 4


def test_components_of_random_links(spark):
    rng = np.random.default_rng(7)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 400, (330, 2))] + [(399 - i, 400 + i) for i in range(60)] + [(7, 7)]
    root = list(range(460))
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: root[n] for a, b in links if a != b for n in (a, b)}


# URL rules

URLS = ["http://EXAMPLE.com/en/x?q#f", "https://www.example.com/en/", "http://sub.www.example.com/en/1", "http://badexample.com/en/", "http://a.net/es/1", "http://a.net/es", "http://net/fr/", "no scheme", None, "", "://", "http://example.com", "http://x.com?y/z", "http://a.net/es/1", "ftp://u@h:80/p", "http://..com/", "http://example.com/EN/", "http://a.com/" + "p" * 5000]


def brute_judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = re.search(r"[/?#]", rest)
        host, tail = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "")
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = re.split(r"[?#]", tail)[0]
    fit = [(len(h + p), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best[1] if best else None, best[2] if best else default


@pytest.mark.parametrize("rules", [queries.URL_RULES, [("com", "", "block"), ("example.com", "/e", "allow"), ("com", "/en/", "block"), ("www.example.com", "/", "allow"), ("net", "/es/1", "allow"), ("net", "/", "block")]])
def test_url_filter(spark, rules):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(URLS)], "page_id int, url string, host string, r string")
    got = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, action string")).collect()
    assert len(got) == len(URLS)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_judge(r["url"], rules), r["url"]
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame([], "host string, path string, action string")).count() == 0


def test_many_nested_rules(spark):
    """Rules by the hundreds, nested at random, in many shards."""
    rng = np.random.default_rng(5)
    hosts = ["com", "net", *[f"{a}.com" for a in "abc"], *[f"{a}.{b}.com" for a in "xyz" for b in "abc"]]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/a/b/c", "/z"]
    rules = sorted({(hosts[rng.integers(len(hosts))], paths[rng.integers(len(paths))], ("allow", "block")[rng.integers(2)]) for _ in range(60)})
    rules = list({(h, p): (h, p, a) for h, p, a in rules}.values())
    urls = [f"http://{'w.' * int(rng.integers(3))}{hosts[rng.integers(len(hosts))]}{paths[rng.integers(len(paths))]}{'x' * int(rng.integers(3))}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, action string")).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute_judge(r["url"], rules), r["url"]


def test_op2_sql(spark, data):
    assert_same(queries.op2_url_filter(spark, data), connect(data), queries.OP2_SQL)


# mixing


def test_mixing(spark, data):
    got = queries.op3_mixing(spark, data).toPandas()
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas()
    assert dict(zip(docs["doc_id"], (len(WORD.findall(t)) for t in docs["text"]))) == dict(zip(got["doc_id"], got["size"]))
    got = got.merge(docs[["doc_id", "source"]], on="doc_id")
    sizes = got.groupby("source")["size"].sum()
    names = sorted(sizes.index, key=lambda s: s.encode())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sizes.sum(), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    for s, part in got.groupby("source"):
        want = 2 * sizes[s] if s in capped else level * weight[s]
        assert part["target"].iloc[0] == pytest.approx(want) and abs(part["taken"].sum() - want) <= 1
    assert (got["taken"] <= 2 * got["size"]).all()
    first = [p[0] if len(p) else 2.0 for p in got["positions"]]
    assert len(got) == len(docs) and first == sorted(first)
    again = queries.op3_mixing(spark, data).toPandas().sort_values("doc_id")
    assert again["taken"].tolist() == got.sort_values("doc_id")["taken"].tolist()


def test_mixing_odd_rows(spark):
    mixed = mixing.mix(docs_of(spark, ODD), schedules=queries.CURRICULUM)
    rows = mixed.collect()
    assert len(rows) == len(ODD) and sum(r["size"] for r in rows if r["text"] is None) == 0
    order = mixing.training_order(mixed).select("position").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)
    assert mixing.mix(docs_of(spark, []), schedules=queries.CURRICULUM).count() == 0
    assert sum(r["taken"] for r in mixing.mix(docs_of(spark, [(1, None)]), schedules=queries.CURRICULUM).collect()) == 0


@pytest.mark.parametrize("knots", [((0.0, 7.5), (1.0, 2.5)), ((0.0, 0.0), (0.3, 4.0), (1.0, 0.0)), ((0.0, 1.0), (0.5, 0.0), (0.6, 0.0), (1.0, 3.0))])
def test_schedules_invert(spark, knots):
    segments, _ = mixing.schedule_expr(knots)
    t = np.linspace(0, 1, 20001)
    w = np.interp(t, *zip(*knots))
    cumulative = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2)])
    cumulative /= cumulative[-1]
    got = [r[0] for r in spark.range(101).select(mixing.invert(segments, F.col("id") / 100)).collect()]
    for i, x in enumerate(got):
        assert np.interp(x, t, cumulative) == pytest.approx(i / 100, abs=1e-4)


# decontamination

ITEM = "Yesterday the farmer said that Tom has 12 apples and gives 5 kg of them to Anna, so how many apples are left for Tom now?"


def leaks(spark, texts, items=((1, ITEM),), **options):
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r["doc_id"], r["item"]): r for r in decontaminate.leak_rows(docs_of(spark, texts), bench, **options).collect()}


def test_leaks(spark):
    inside = "Some words before it. "
    again = ITEM.replace("Tom", "Bob").replace("12", "31").replace("5 kg", "9 g").replace("Anna", "Mary")
    mixed = ITEM.replace("Tom has", "Bob has")
    half = " ".join(ITEM.split()[:10])
    texts = [inside + ITEM + " And after.", inside + again, inside + mixed, half, "nothing of the kind " * 40, None, "", ITEM.upper(), "1 2 3 4 5 6 7 8 9 " * 500]
    got = leaks(spark, texts)
    assert {k[0] for k in got} >= {0, 1} and not {k[0] for k in got} & {2, 3, 4, 5, 6, 8}
    assert got[0, 1]["changed"] == 0 and got[1, 1]["changed"] > 0
    kept = decontaminate.drop_leaks(docs_of(spark, texts[:7]), spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 6] and kept.columns == docs_of(spark, []).columns


def test_leaks_odd_items(spark):
    items = [(1, None), (2, ""), (3, "only four little words"), (None, ITEM), (5, "7 8 9 10 11 12 13 14 15 16")]
    texts = [(9, "only four little words"), (9, "only four little words"), (10, "x 7 8 9 10 11 12 13 14 15 16 y"), (11, "7 8 9 1 1 2 3 4 5 6 6")]
    assert set(leaks(spark, texts, items)) == {(9, 3), (10, 5)}
    assert leaks(spark, [], items) == {} and leaks(spark, texts, []) == {}


def brute_leaks(text, items, known, width=8, coverage=0.5):
    """By definition, over keys themselves instead of hashes; ``known`` keeps the items' windows."""
    import regex

    ws = r"\x20\x09-\x0D"

    def windows(t, narrow=()):
        canon = regex.sub(rf"\p{{Lu}}(?<=[\p{{Ll}},;:][{ws}]\p{{Lu}})[\p{{L}}\p{{M}}'’-]*+", decontaminate.NAME, t)
        canon = regex.sub(r"[0-9]++(?:[.,:/][0-9]++)*+", decontaminate.NUM, canon)
        canon = regex.sub(rf"(?i)(?<={decontaminate.NUM}|{decontaminate.NUM}[{ws}])(?:{decontaminate.UNITS})(?!\p{{L}})", decontaminate.UNIT, canon)
        p = decontaminate._PUNCT
        canon = regex.sub(rf"[{p}]++(?=[^{ws}{p}])|[{p}](?<=[^{ws}{p}][{p}])[{p}]*+", "", canon).lower()
        words, raw = regex.findall(rf"[^{ws}]+", canon), regex.findall(rf"[^{ws}]+", t)
        for n in ([min(width, len(words))] if words else []) + [w for w in narrow if len(words) > w]:
            for i in range(len(words) - n + 1):
                slots = [r for w, r in zip(words[i : i + n], raw[i : i + n]) if regex.search(f"[{decontaminate.NUM}-{decontaminate.NAME}]", w)]
                yield i, (tuple(words[i : i + n]), False) if 2 * len(slots) <= n else (tuple(w.lower() for w in raw[i : i + n]), True), slots

    found = {}
    narrow = sorted({n for _, t in items if t and 4 <= (n := len(WORD.findall(t))) < width})
    own_windows = list(windows(text or "", narrow))
    for item, t in items:
        first = {}
        for i, key, slots in known.setdefault(item, list(windows(t or "")) if item not in known else ()):
            first.setdefault(key, (i, slots))
        lines = {}
        for i, key, slots in own_windows:
            if key in first:
                at, own = first[key]
                lines.setdefault(i - at, {})[at] = list(zip(own, slots))
        met = set()
        for line in lines.values():
            pairs = {p for ps in line.values() for p in ps}
            if len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs):
                met |= set(line)
        if first and len(met) / len(first) >= coverage:
            found[item] = (len(met), len(met) / len(first))
    return found


def test_leaks_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").toPandas()
    bench = spark.read.parquet(f"{data}/benchmark.parquet").toPandas()
    items = [*zip(bench["item_id"].tolist(), bench["text"]), (900, ITEM), (901, "only four little words"), (902, "7 8 9 10 11 12 13 14 15 16 17 18")]
    changed = [t.replace("Tom", "Bob").replace("12", "31") for t in (ITEM, ITEM.replace("5 kg", "9 g"))]
    ours = [ITEM, *changed, "before " + ITEM + " after " + ITEM, " ".join([" ".join(ITEM.split()[:8])] * 6), "And only four little words, in it.", "7 8 9 10 11 12 13 14 15 16 17 18 " * 3, ITEM.replace("Tom has", "Bob has")]
    texts = [*docs["text"], *ours]
    got = {}
    for (i, item), r in leaks(spark, texts, items).items():
        got.setdefault(i, {})[item] = (r["windows"], r["share"])
    known = {}
    for i, t in enumerate(texts):
        assert got.get(i, {}) == brute_leaks(t, items, known), t[:100]


def test_repeated_windows_count_once(spark):
    """A text that repeats one window of a nine-window item is no leak of it."""
    item = " ".join(f"w{i}" for i in range(16))
    one = " ".join(f"w{i}" for i in range(8))
    assert leaks(spark, [" x ".join([one] * 6)], [(1, item)]) == {}
    assert leaks(spark, [one], [(1, item)], coverage=0.1)[0, 1]["windows"] == 1


def test_every_planted_passage_is_found(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{data}/benchmark.parquet").toPandas()
    want = {(d, i) for d, t in zip(docs["doc_id"], docs["text"]) for i, x in zip(bench["item_id"], bench["text"]) if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op4_decontaminate(spark, data).collect()}
    assert want and want <= got and len(got - want) <= 2


# syncmers


def test_edited_texts(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas().sort_values("doc_id")
    got = queries.op5_syncmers(spark, data).toPandas().set_index("doc_id")
    texts = docs["text"].tolist()
    for n, (i, t) in enumerate(zip(docs["doc_id"], texts)):
        nxt, q = texts[(n + 1) % len(texts)], len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        assert got.loc[i, "n_chars"] == len(t) and got.loc[i, "edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert 0.5 < got["near_edited"].mean() < 0.7 and got["near_next"].mean() < 0.02
    by_text = docs.set_index("doc_id")["text"].to_frame().join(got["fingerprint"])
    assert (by_text.groupby("text")["fingerprint"].nunique() == 1).all()


def test_syncmers_odd_rows(spark):
    got = syncmers.compare_edited(docs_of(spark, ODD)).collect()
    assert len(got) == len(ODD)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {""}
    assert syncmers.compare_edited(docs_of(spark, [])).count() == 0
    one = syncmers.compare_edited(docs_of(spark, [(None, "abcdefgh")])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest()


def parts_of(anchors):
    return [(a >> 32, a & 0xFFFFFFFF) for a in anchors]


def pieces(text):
    return re.findall(rf"[^\x20\x09-\x0D]{{1,{syncmers.PIECE}}}", text or "")


def test_anchors_are_closed_syncmers(spark):
    """By definition: the smallest inner hash is the first or the last."""
    texts = [" ".join(f"w{i * 7919 % 911}" for i in range(300)), "x" * 100 + " short and longer-words-than-pieces", "中文没有空格，" * 9, "a b c d", "a b c", "", " \n"]
    k, s = syncmers.K, syncmers.S
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(syncmers.anchors(F.col("t"))).collect()]
    for text, found in zip(texts, got):
        tokens = pieces(text)
        hashed = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)] or [(-1, "")], "i int, t string")
        inner = {r["i"]: r["h"] for r in hashed.select("i", F.xxhash64("t").alias("h")).collect()}
        want = [i for i in range(len(tokens) - k + 1) if min(inner[i + j] for j in range(k - s + 1)) in (inner[i], inner[i + k - s])]
        assert [p for _, p in parts_of(found)] == (want if len(tokens) >= k else [0] * bool(tokens))


def brute_likeness(a, b):
    """Closest meetings of one hash, walked in order; those that agree on the shift."""
    line = sorted([(h, p, 0) for h, p in a] + [(h, p, 1) for h, p in b])
    moved = [(x[1] - y[1]) * (1 - 2 * x[2]) for x, y in zip(line, line[1:]) if x[0] == y[0] and x[2] != y[2]]
    best = 0
    for by in (0, syncmers.SLACK // 2):
        counts = pd.Series([(m + by) // syncmers.SLACK for m in moved], dtype=float).value_counts()
        best = max(best, counts.max() if len(counts) else 0)
    met = min(best, len(a), len(b))
    return 1.0 if not a and not b else met / (len(a) + len(b) - met)


def test_likeness_against_brute_force(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas().sort_values("doc_id")
    got = queries.op5_syncmers(spark, data).toPandas().set_index("doc_id").loc[docs["doc_id"]]
    split = lambda f: [(int(f[i : i + 8], 16), int(f[i + 8 : i + 16], 16)) for i in range(0, len(f), 16)]
    own = [split(f) for f in got["fingerprint"]]
    direct = {r["doc_id"]: parts_of(r["a"]) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", syncmers.anchors(F.col("text")).alias("a")).collect()}
    assert [direct[i] for i in docs["doc_id"]] == own
    for i, (a, e) in enumerate(zip(own, got["edited_fingerprint"])):
        assert got["near_edited"].iloc[i] == pytest.approx(brute_likeness(a, split(e)))
        assert got["near_next"].iloc[i] == pytest.approx(brute_likeness(a, own[(i + 1) % len(own)]))


def test_positions_align(spark):
    body = " ".join(f"t{i * 31 % 997}" for i in range(200))
    df = spark.createDataFrame([("one two three " + body, body)], "a string, b string")
    moved = df.select(syncmers.shifts(syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b")))).first()[0]
    assert len(moved) > 50 and set(moved) == {3}


def test_likeness_counts_only_what_aligns(spark):
    """The same passages in another order are less alike than in order."""
    part = [" ".join(f"{c}{i}" for i in range(200)) for c in "abcd"]
    rows = [(1, " ".join(part)), (2, " ".join(reversed(part)))]
    got = {r["doc_id"]: r["near_next"] for r in syncmers.compare_edited(docs_of(spark, [*rows, (3, "x " * 50 + rows[1][1]), (4, "end")])).collect()}
    assert got[1] < 0.3 and got[2] > 0.85


def test_likeness_across_lengths(spark):
    """One rule for all lengths: texts on either side of any limit are compared alike."""
    words = [f"{i * 7919 % 9973:04d}x" for i in range(400)]
    for n in (10, 30, 69, 70, 120, 400):
        text = " ".join(words[:n])
        near = {r["doc_id"]: r["near_edited"] for r in syncmers.compare_edited(docs_of(spark, [(1, text), (2, "tiny")])).collect()}
        assert (0.3 if n == 10 else 0.5) < near[1] < 0.8, (n, near)
    solid = syncmers.compare_edited(docs_of(spark, [(1, "".join(words)), (2, "tiny")])).collect()
    assert max(r["near_edited"] for r in solid if r["n_chars"] > 100) > 0.6


def test_next_of_a_key_that_most_rows_share(spark):
    docs = docs_of(spark, [(7, f"text number {i}") for i in range(300)] + [(None, f"none {i}") for i in range(100)] + [(i, f"own {i}") for i in range(40) if i != 7] + [(7, "same")] * 50)
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    got = syncmers.with_next(rows, "doc_id", ["text"], "tie").collect()
    order = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["tie"], r["text"]) for r in rows.collect())
    want = sorted((a[3], b[3]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((r["text"], r["next_text"]) for r in got) == want


def test_likeness_across_the_short_limit(spark):
    """A text of 420 characters whose edited form is shorter than the limit."""
    long = " ".join(f"{i * 7919 % 9973:04d}x" for i in range(70))[:419]
    got = {r["doc_id"]: r for r in syncmers.compare_edited(docs_of(spark, [(1, long), (2, "a b c"), (3, long[:405]), (4, long[:395]), (5, "z")])).collect()}
    assert len(long) == 419 and got[1]["near_edited"] > 0.6 and got[3]["near_next"] > 0.9


def test_long_texts_that_share_a_passage(spark):
    """All anchors count, however long the text, and keep their positions."""
    passage = " ".join(f"p{i}" for i in range(50))
    long = [" ".join(f"{c}{i}" for i in range(20_000)) for c in "ab"]
    got = {r["doc_id"]: r for r in syncmers.compare_edited(docs_of(spark, [(1, f"{long[0]} {passage}"), (2, f"{passage} {long[1]}")])).collect()}
    assert got[1]["near_next"] > 0
    anchors = [{(f[i : i + 8], int(f[i + 8 : i + 16], 16)) for i in range(0, len(f), 16)} for f in (got[1]["fingerprint"], got[2]["fingerprint"])]
    shared = {h for h, _ in anchors[0]} & {h for h, _ in anchors[1]}
    places = [{h: p for h, p in a} for a in anchors]
    assert len(shared) > 15 and {places[0][h] - places[1][h] for h in shared} == {20_000}


# personal data

ADVERSE = [
    "a@b.co_x@y.com z@q a@b@c.de ..@x.y a@.b.c", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.004 0000000001.2.3.4", "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111110000 4111 1111 1111 1112",
    "+1 (509) 555-6973 +12 3 +49.30.123456789012345 +1-2-3-4-5-6-7-8 +1 800 555 0100.", "9" * 30_000, "a" * 60_000, "x@" + "a-" * 5_000, "é 👍 me@x.org +   +1 800 555 0100", "+ +" * 2_000, "1 2 3 4 5 6 7 8 9 0 " * 1_000, None, "",
]
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    def luhn(d):
        t = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (2 if i % 2 else 1)
            t += v - 9 if v > 9 else v
        return t % 10 == 0

    out = []
    for kind, pattern in PATTERNS.items():
        if not text or (kind == "email" and "@" not in text):
            continue
        for m in re.finditer(pattern, text):
            digits = re.sub(r"\D", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark, data):
    docs = docs_of(spark, ADVERSE).select("doc_id", "text").unionByName(spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text"))
    for r in docs.select("text", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect():
        assert [tuple(x) for x in r["s"]] == brute_spans(r["text"])


def test_spans_are_base_and_more(spark, data):
    got = queries.op7_pii(spark, data).toPandas().set_index("doc_id")
    for i, t in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        base = [f"{k}:{a}:{b}" for k, a, b in brute_spans(t)]
        assert got.loc[i, "base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(filter(None, got.loc[i, "spans"].split(",")))
        assert got.loc[i, "n_email"] == sum(b.startswith("email") for b in base)


DISGUISED = [
    ("write to jan.doe [at] mail7.example.com today", "email", "jan.doe [at] mail7.example.com"),
    ("or zoe.9(at)mail3.example.org please", "email", "zoe.9(at)mail3.example.org"),
    ("host 10[.]20[.]30[.]40 is up", "ip", "10[.]20[.]30[.]40"),
    ("from 2001:db8:85a3:0:0:8a2e:370:7334 again", "ip", "2001:db8:85a3:0:0:8a2e:370:7334"),
    ("card 4111.1111.1111.1111 expired", "card", "4111.1111.1111.1111"),
    ("call me at (509) 555-1234 soon", "phone", "(509) 555-1234"),
    ('here password = "a81bc81bdead4e5dabff90865d1e13b1" ends', "secret", "a81bc81bdead4e5dabff90865d1e13b1"),
]


def pii_corpus():
    """Base spans, disguised ones, and clean texts with numbers and hashes in them."""
    card = lambda i: next(f"4{i:014d}{c}" for c in range(10) if luhn_ok(f"4{i:014d}{c}"))
    base = [f"call me at +1 (509) 555-{1000 + i} or mail me{i}@mail{i % 9}.example.com from 10.0.{i}.{i + 1} with card {card(i * 7919)} soon" for i in range(150)]
    secrets = [f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}" is set' for i in range(60)]
    clean = [f"order {i * 7919 % 9999999:07d} of {1900 + i % 120} has id {i * 104729 % 10**9:09d} and part {hashlib.md5(str(i).encode()).hexdigest()} in stock" for i in range(200)]
    return base, secrets, clean


def luhn_ok(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_proposals_are_the_generators_matches(spark, data):
    import regex

    texts = [t for t, _, _ in DISGUISED] + [t for t in ADVERSE if t and len(t) < 20_000] + sum(pii_corpus(), [])[::7]
    docs = docs_of(spark, texts).select("text").unionByName(spark.read.parquet(f"{data}/documents.parquet").select("text"))
    for r in docs.select("text", pii.proposals(F.col("text")).alias("p")).collect():
        want = [(k, m.start(), m.end()) for k, pattern in pii.GENERATORS for m in regex.finditer(pattern, r["text"])]
        assert [(x["kind"], x["start"], x["end"]) for x in r["p"]] == want


def test_disguised_data_is_found_and_clean_texts_stay(spark):
    base, secrets, clean = pii_corpus()
    docs = docs_of(spark, [*base, *secrets, *clean, *[t for t, _, _ in DISGUISED]])
    found = pii.with_candidates(docs)
    model = pii.fit(found)
    rows = {r["doc_id"]: [tuple(x) for x in r["spans"]] for r in pii.select_spans(found, model).collect()}
    n = len(base) + len(secrets)
    for i, (text, kind, value) in enumerate(DISGUISED, n + len(clean)):
        assert (kind, text.index(value), text.index(value) + len(value)) in rows[i], (value, rows[i])
    assert all(rows[len(base) + i][0][0] == "secret" for i in range(len(secrets)))
    assert sum(bool(rows[i]) for i in range(n, n + len(clean))) == 0


def test_selection_against_brute_force(spark):
    """Base spans stay; of proposals that meet no base span those of higher score go first."""
    base, secrets, clean = pii_corpus()
    mixed = [f"{a} {b} {c}" for a, b, (c, _, _) in zip(base[:21], clean, DISGUISED * 3)]
    found = pii.with_candidates(docs_of(spark, [*base, *secrets, *clean, *mixed]))
    model = pii.fit(found)
    names = list(pii.LEVELS)
    for r in pii.select_spans(found, model).collect():
        meets = lambda x, y: x["start"] < y["end"] and x["end"] > y["start"]
        free = [p for p in r["proposed"] if not any(meets(b, p) for b in r["base"])]
        score = model.trees.probability(np.array([[p[n] for n in names] for p in free])) if free else []
        ranked = sorted((-s, p["start"], -p["end"], p["kind"]) for s, p in zip(score, free) if s >= model.limits.get(p["kind"], 1.1))
        alone = [x for i, x in enumerate(ranked) if not any(y[1] < -x[2] and -y[2] > x[1] for y in ranked[:i])]
        want = [tuple(b) for b in r["base"]] + [(k, a, -b) for _, a, b, k in alone]
        assert sorted(want, key=lambda x: (pii.ALL_KINDS.index(x[0]), x[1])) == [tuple(x) for x in r["spans"]]


def test_op7_finds_the_planted_tokens(spark, data):
    folder = data.replace("0.001", "0.01")
    got = queries.op7_pii(spark, folder).toPandas().set_index("doc_id")["spans"]
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas().set_index("doc_id")["text"]
    planted = docs[docs.str.contains('token = "', regex=False)]
    assert len(planted) > 5 and got[planted.index].str.contains("secret:").all()
    assert not got.drop(planted.index).str.contains("secret:").any()


def test_redaction(spark):
    texts = [*[f"call me at +1 (509) 555-{1000 + i} or mail me{i}@x.org or 10.0.0.{i} soon {i} {i}{i}" for i in range(60)], *ADVERSE]
    docs = docs_of(spark, texts)
    out = {r["doc_id"]: r["text"] for r in pii.redact_documents(docs).collect()}
    assert out[0] == "call me at [PHONE] or mail [EMAIL] or [IP] soon 0 00"
    assert out[60 + 10] is None and out[60 + 11] == "" and pii.redact_documents(docs).columns == docs.columns
    assert pii.redact_documents(docs_of(spark, [])).count() == 0


def test_boosting_learns_an_interaction(spark):
    x = np.array([(a, b, c) for a in range(3) for b in range(3) for c in range(2)])
    right = (x[:, 0] == 1) & (x[:, 1] == 2) | (x[:, 2] == 1) & (x[:, 0] == 2)
    pos, neg = np.where(right, 95.0, 5.0), np.where(right, 5.0, 95.0)
    model = boosting.calibrate(boosting.fit(x, pos, neg), x, pos, neg)
    p = model.probability(x)
    assert ((p > 0.5) == right).all() and abs(p[right].mean() - 0.95) < 0.05
    df = spark.createDataFrame([tuple(map(int, r)) for r in x], "a int, b int, c int")
    assert np.allclose([r[0] for r in df.select(model.column([F.col("a"), F.col("b"), F.col("c")])).collect()], p)
    t = boosting.threshold(p, pos, neg, 0.9)
    assert pos[p >= t].sum() / (pos + neg)[p >= t].sum() >= 0.9


# quality and toxicity


@pytest.mark.parametrize("text", ["abc", "", None, "Ab 中文字 é", "xy" * 700])
def test_ngrams_are_of_characters(text, monkeypatch):
    """By definition, in one piece and in many; equal grams have equal buckets wherever they stand."""
    grams = ngrams.Grams((2, 3), 20, True)
    whole = f" {text or ''} ".lower()
    want = {whole[i : i + n] for n in (2, 3) for i in range(len(whole) - n + 1)}
    got = grams.of(text)
    assert len(got) == len(set(got.tolist())) == len(want)
    monkeypatch.setattr(ngrams, "PIECE", 5)
    assert set(grams.of(text).tolist()) == set(got.tolist())


def test_long_texts_are_hashed_in_bounded_memory():
    import tracemalloc

    text = "some words that go on " * 500_000
    grams = ngrams.Grams((3, 4, 5), 20, True)
    tracemalloc.start()
    grams.of(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(text)


def test_toxicity_on_held_out_rows(spark, data):
    folder = data.replace("0.001", "0.01")
    got = queries.op9_toxicity(spark, folder).toPandas()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count() and got["score"].between(0, 1).all()
    seen = got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id").query("held_out")
    assert (seen["predicted"] == seen["toxic"]).mean() > 0.95


def test_toxicity_never_reads_held_out_labels(spark):
    ids = [(i, f"text {i} " + ("idiot" if i % 2 else "friend")) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in ids], "doc_id long, toxic int")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = docs_of(spark, ids)
    a, b = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, flipped)
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_toxicity_odd_rows(spark):
    docs = docs_of(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    some = spark.createDataFrame([(1, 0), (1, None), (None, 1), (3, 1), (4, 0), (5, 1), (6, 0)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, some)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(docs, model).collect())
    assert toxicity.score_toxicity(docs_of(spark, []), model).count() == 0
    assert toxicity.drop_toxic(docs, none).columns == docs.columns


def test_drop_toxic_keeps_clashing_columns(spark):
    docs = docs_of(spark, [(i, f"text {i} " + ("idiot" if i % 2 else "friend")) for i in range(100)]).withColumns({"score": F.lit(7.5), "predicted": F.lit("p"), "held_out": F.lit(3)})
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {(r["score"], r["predicted"], r["held_out"]) for r in kept.collect()} == {(7.5, "p", 3)}
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(0, 100, 2))


def brute_buckets(text, orders, bits, lower):
    """Distinct buckets of all n-grams, in plain integers."""
    mask, prime, mix = 2**32 - 1, 16777619, 2654435761
    whole = f" {text or ''} "
    whole = whole.lower() if lower else whole
    out = set()
    for n in orders:
        for i in range(len(whole) - n + 1):
            h = 0
            for k, c in enumerate(whole[i : i + n], 1):
                h = (h * prime + ((ord(c) + k) & mask) * mix) & mask
            out.add((((h ^ (h >> 15)) * mix) & mask) >> (32 - bits))
    return out


def test_toxicity_against_brute_force(spark):
    """Ratios, the fit and the scores by their formulas, row by row."""
    words = "you are a stupid idiot today my kind friend and neighbour é 中文".split()
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(1, 9)))) + (" moron" if i % 3 == 0 else "")) for i in range(90)]
    docs = docs_of(spark, [*rows, (1000, None), (1001, "")])
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    train = [r["doc_id"] for r in labels.where(~toxicity.held_out(F.col("doc_id"))).collect()]
    text = dict(rows)
    sets = {i: brute_buckets(text.get(i), model.orders, model.bits, model.lower) for i in [*text, 1000, 1001]}
    order = [r["doc_id"] for r in docs.where(F.col("doc_id").isin(train)).orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).collect()]
    y = [int(i % 3 == 0) for i in order]
    n_pos, n_neg = sum(y), len(y) - sum(y)
    seen = {}
    for i, v in zip(order, y):
        for b in sets[i]:
            seen.setdefault(b, [0, 0])[v] += 1
    ratio = {}
    for b, (neg, pos) in seen.items():
        r = math.log(((pos + 1) / (n_pos + 2)) / ((neg + 1) / (n_neg + 2)))
        z4 = (r / math.sqrt(1 / (pos + 1) + 1 / (neg + 1))) ** 4
        ratio[b] = r * z4 / (z4 + 81)
    w, total, later, epochs, batch, rate = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 0.0), 0, 5, 32, 0.5
    bias, bias_total = math.log(n_pos / n_neg), 0.0
    norm = [sum(ratio[b] ** 2 for b in sets[i]) + 1 for i in order]
    at = np.random.default_rng(42).permutation(len(order))
    for epoch in range(epochs):
        for a in range(0, len(order), batch):
            part = at[a : a + batch]
            err = [1 / (1 + math.exp(-(bias + sum(w[b] * ratio[b] for b in sets[order[k]])))) - y[k] for k in part]
            for k, e in zip(part, err):
                for b in sets[order[k]]:
                    w[b] -= 4 * rate / norm[k] * e * ratio[b]
            bias -= 0.1 * rate * sum(err) / len(err)
        if epoch >= epochs // 2:
            later, bias_total = later + 1, bias_total + bias
            for b in w:
                total[b] += w[b]
    want = {i: 1 / (1 + math.exp(-(bias_total / later + sum(total[b] / later * ratio[b] for b in found if b in ratio)))) for i, found in sets.items()}
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert set(got) == set(want) and all(got[i] == pytest.approx(want[i], abs=2e-3) for i in want)


def test_quality_scores_against_brute_force(spark):
    """Both views' margins, their calibration and their sum by definition."""
    docs = docs_of(spark, [*[(i, f"{'good calm words' if i % 2 else 'BAD!! LOUD!!'} {i * 7919 % 101}\nline") for i in range(80)], *[(i + 100, t) for i, (_, t) in enumerate(ODD[:5])]])
    model = cotraining.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"), F.lit(True), rounds=2, share=0.2)
    got = {r["doc_id"]: r for r in cotraining.score_quality(docs, model).collect()}
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for r in docs.collect():
        content = model.content[1] + sum(float(model.content[0][b]) for b in brute_buckets(r["text"], cotraining.ORDERS, cotraining.BITS, False))
        meta = model.meta[1] + sum(float(model.meta[0][k]) for k in cotraining.metadata(r["text"], r["lang"], r["source"]))
        z = [m * model.scale[0][k] + model.scale[1][k] for k, m in enumerate((content, meta))]
        want = [sigmoid(z[0]), sigmoid(z[1]), sigmoid(z[0] * model.both[0] + z[1] * model.both[1] + model.both[2])]
        assert [got[r["doc_id"]][k] for k in ("content_score", "metadata_score", "score")] == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("text", ["", " ", "a", " a b\tc\n", "é\xa0ü x", "ab cd " * 50])
def test_words_are_counted_by_pieces(text, monkeypatch):
    for piece in (1, 2, 3, 1 << 18):
        monkeypatch.setattr(cotraining, "PIECE", piece)
        assert cotraining._count_words(text) == len(WORD.findall(text))


def test_metadata_knows_no_characters():
    a, b = cotraining.metadata("abc de\nfgh", "en", "s"), cotraining.metadata("XY! 4?\n中文字", "en", "s")
    assert a.tolist() == b.tolist() and len(set(a.tolist())) == 7 and cotraining.metadata(None, None, None).max() < cotraining.META


def test_logistic_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    y = (x @ np.array([2.0, -1.0, 0.0]) > 0.3).astype(np.float32)
    w, b = nbsvm.logistic(x, y)
    assert (((x @ w + b) > 0) == y).mean() > 0.95


def test_quality_on_held_out_rows(spark, data):
    folder = data.replace("0.001", "0.01")
    got = queries.op6_quality(spark, folder).toPandas()
    seen = got.merge(spark.read.parquet(f"{folder}/labels.parquet").toPandas(), on="doc_id").query("held_out")
    assert (seen["predicted"] == seen["quality"]).mean() > 0.93


def test_quality_odd_rows(spark):
    docs = docs_of(spark, ODD)
    for labels in ([], [(1, 0), (3, 1), (4, 0), (5, 1), (6, 1), (None, 1), (2, None)]):
        model = cotraining.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
        rows = cotraining.score_quality(docs, model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert cotraining.score_quality(docs_of(spark, []), model).count() == 0


def test_quality_scores_keep_other_columns(spark):
    docs = docs_of(spark, ODD).withColumns({"score": F.lit(1.5), "quality": F.lit("q"), "__quality": F.lit("z")})
    model = cotraining.fit(docs, spark.createDataFrame([(1, 0), (3, 1), (4, 0), (6, 1)], "doc_id long, quality int"), F.lit(True))
    rows = cotraining.score_quality(docs, model).collect()
    assert {(r["quality"], r["__quality"]) for r in rows} == {("q", "z")} and all(0 <= r["score"] <= 1 for r in rows)


def test_fit_of_repeated_ids_is_the_same_on_every_run(spark):
    docs = docs_of(spark, [(i // 3, f"text {i * 7919 % 101} {'good' if i % 2 else 'bad'}") for i in range(90)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    a, b = (cotraining.fit(docs.repartition(n), labels, F.lit(True), rounds=1) for n in (1, 3))
    assert np.array_equal(a.content[0], b.content[0]) and np.array_equal(a.meta[0], b.meta[0]) and np.allclose(a.scale, b.scale)


def test_views_teach_each_other(spark):
    """Few labels, and a content that names its class by words of which the
    labelled rows show a few; the metadata view sees the class by word length."""
    rng = np.random.default_rng(3)
    rows, truth = [], {}
    for i in range(1500):
        y = int(rng.integers(0, 2))
        names = rng.choice(30, 4)
        marks = " ".join(f"{'q' if y else 'z'}{chr(97 + n % 26)}{chr(97 + n // 26)}w" for n in names)
        filler = " ".join("m" * int(rng.integers(3, 6) + (3 if y else 0)) for _ in range(12))
        rows.append((i, f"{marks} {filler}"))
        truth[i] = y
    docs = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, truth[i]) for i in range(24)], "doc_id long, quality int")

    def accuracy(rounds):
        model = cotraining.fit(docs, labels, F.lit(True), rounds=rounds, share=0.2)
        got = cotraining.score_quality(docs, model).select("doc_id", "content_score", "score").collect()
        return [np.mean([(r[c] >= 0.5) == truth[r["doc_id"]] for r in got if r["doc_id"] >= 24]) for c in ("content_score", "score")]

    without, taught = accuracy(0), accuracy(3)
    assert taught[1] > 0.95 and taught[0] >= without[0] and sum(taught) >= sum(without), (without, taught)


# pages

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li><a href='/b?x=1&amp;y=2'>B</a></ul></nav><div class="cookie-notice">We use cookies a lot, dear reader, and so do you.</div>
<div id="main"><article><header><h1>The title</h1></header><p>First  paragraph &eacute; with <b>bold
text</b>, a <a href="/c">link</a> and more.<p>Second one<br>goes on.</p><div class="ad">Buy this!</div><ul><li>one<li>two</ul>
<form><input name=q>Search</form><table><tr><td>c1<td>c2</table></article></div>
<section class="comments"><p>Nice post, really a very long comment that says nothing at all but goes on and on and on.</p></section>
<aside><p>Side</p></aside><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html_text.main_text(PAGE).split("\n") == ["The title", "First paragraph é with bold text, a link and more.", "Second one goes on.", "one", "two", "c1", "c2"]


def test_main_text_without_article_element():
    long = lambda w: "<p>" + (w + " ") * 60 + "</p>"
    page = f"<body><div class='menu'><a href=1>x</a></div><div><section><h2>A</h2>{long('one')}{long('two')}</section><section><h2>B</h2>{long('three')}</section></div><div id=comments>{long('no')}</div></body>"
    text = html_text.main_text(page)
    assert all(w in text for w in ("A", "one", "two", "B", "three")) and "no" not in text.split()


@pytest.mark.parametrize("source", [None, "", "<", "<!--", "<p", "</p></div>", "<div " * 2000, "<b>" * 3000 + "x", "<script>never closed", "a<!-- x --", "&#0;&#xD800;&bogus;", "<table><td>" * 500])
def test_broken_pages(source):
    assert isinstance(html_text.main_text(source), str)


@pytest.mark.parametrize("name", ["layout has-sidebar", "page-with-sidebar", "sidebar-wrapper", "no-comments", "js-widget"])
def test_frames_around_the_article_stay(name):
    article = "<article><h1>T</h1><p>" + "word " * 50 + "</p></article>"
    page = f"<body><div class='{name}'>{article}<div class='sidebar'>beside</div><div class='comments'><p>{'said ' * 300}</p></div></div></body>"
    text = html_text.main_text(page)
    assert text.startswith("T\nword") and "beside" not in text and "said" not in text


@pytest.mark.parametrize("make", [lambda n: "<b>" * n + "</i>" * n, lambda n: "<b>" * n + "<hr>" * n, lambda n: "<center>" * n + "<li></li>" * n, lambda n: "<b><div>" + "<i>" * n + "</b>" * n, lambda n: "<div>" * n + "<header></header>" * n, lambda n: "<table>" + "<td>" * n])
def test_open_tags_cost_linear_time(make):
    import time

    page = make(120_000) + "x"
    began = time.process_time()
    html_text.main_text(page)
    assert len(page) > 480_000 and time.process_time() - began < 3


def test_pages_match_their_articles(spark, data):
    import html

    for r in queries.op8_html(spark, data).join(spark.read.parquet(f"{data}/pages.parquet").select("page_id", "html"), "page_id").collect():
        article = r["html"].split("<article>")[1].split("</article>")[0]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_extract_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "x"), (1, "", None), (2, "plain", "y")], "page_id int, html string, text string")
    assert [(r["text"], r["n_chars"]) for r in html_text.extract_main_text(pages).orderBy("page_id", "html").collect()] == [("", 0), ("", 0), ("plain", 5)]
    assert html_text.extract_main_text(pages.limit(0)).count() == 0


# WARC


def test_warc_round_trip(spark, data, tmp_path):
    pages = spark.read.parquet(f"{data}/pages.parquet").limit(20)
    source = warc.responses(pages)
    made = warc.serialize(warc.derive(source, keep=("page_id",))).collect()
    assert len(made) == 40
    by_id = {r["record_id"]: r for r in source.collect()}
    file = b"".join(bytes(r["record"]) for r in made)
    records = list(warc.parse(file))
    assert len(records) == 40
    for (h, block), r in zip(records, made):
        assert h["WARC-Record-ID"] == r["record_id"] and block == bytes(r["block"]) and h["WARC-Block-Digest"] == warc.digest(block)
        of = by_id[h["WARC-Refers-To"]]
        assert h["WARC-Target-URI"] == of["target_uri"]
        payload = bytes(of["block"]).split(b"\r\n\r\n", 1)[1]
        assert h["WARC-Refers-To-Payload-Digest"] == warc.digest(payload)
        if h["WARC-Type"] == "metadata":
            assert f"source-payload-digest: {warc.digest(payload)}" in block.decode()
    assert {h["WARC-Type"] for h, _ in records} == {"metadata", "conversion"}
    assert len({h["WARC-Record-ID"] for h, _ in records}) == 40


def test_warc_files_are_read(spark, tmp_path):
    import gzip

    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<title>caf\xe9</title><body><p>caf\xe9"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Target-URI: http://x/\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-IP-Address: 1.2.3.4\r\nContent-Length: {len(block)}\r\n\r\n"
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    one = head.encode() + block + b"\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(info) + gzip.compress(one))
    (tmp_path / "b.warc").write_bytes(info + one)
    found = warc.read_responses(spark.read.format("binaryFile").load(str(tmp_path)))
    rows = warc.derive(found).collect()
    assert len(rows) == 4
    assert {bytes(r["block"]).decode() for r in rows if r["record_type"] == "conversion"} == {"café"}
    assert all(r["ip"] == "1.2.3.4" and r["date"].startswith("2024") for r in rows)


def test_warc_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (2, "http://x/\r\nEvil: 1", "<p>hi"), (None, "u", "")], "page_id long, url string, html string")
    rows = warc.derive(warc.responses(pages), keep=("page_id",)).collect()
    assert len(rows) == 8
    records = warc.serialize(warc.derive(warc.responses(pages))).collect()
    assert all("Evil" not in h for r in records for h, _ in warc.parse(bytes(r["record"])))
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
    broken = spark.createDataFrame([("i", "u", "d", None, {}, bytearray(b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot gzip")), ("j", None, None, None, None, None)], warc.RESPONSE)
    assert warc.derive(broken).count() == 4


def response(body, *http, **warc_headers):
    block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{h}\r\n" for h in http) + "\r\n").encode() + body
    named = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://x/", "WARC-Date": "2024-01-01T00:00:00Z", **warc_headers, "Content-Length": len(block)}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_source_headers_and_digests_go_on(spark, tmp_path):
    headers = {"WARC-Payload-Digest": "sha1:STATED", "WARC-Concurrent-To": "<urn:uuid:2>", "WARC-Warcinfo-ID": "<urn:uuid:3>", "X-Own": "kept"}
    (tmp_path / "a.warc").write_bytes(response(b"<p>hi", "Content-Type: text/html", **headers))
    made = warc.serialize(warc.derive(warc.read_responses(spark.read.format("binaryFile").load(str(tmp_path))))).collect()
    for r in made:
        assert r["refers_to_payload_digest"] == "sha1:STATED" and r["source_headers"]["X-Own"] == "kept"
        ((h, block),) = warc.parse(bytes(r["record"]))
        assert h["WARC-Concurrent-To"] == "<urn:uuid:2>" and h["WARC-Warcinfo-ID"] == "<urn:uuid:3>" and h["WARC-Refers-To-Date"] == "2024-01-01T00:00:00Z"
        if h["WARC-Type"] == "metadata":
            assert all(x in block.decode() for x in ("source-warc-x-own: kept", "source-payload-digest: sha1:STATED", "source-header-content-type: text/html", "source-record-id: <urn:uuid:1>"))


def test_transfer_and_content_codings():
    import gzip
    import zlib

    body = b"<title>t</title><p>" + b"hello " * 500
    chunked = lambda x, n: b"".join(b"%x;e=1\r\n%s\r\n" % (len(x[i : i + n]), x[i : i + n]) for i in range(0, len(x), n)) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    deflated = raw.compress(body) + raw.flush()
    for sent, http in [
        (chunked(body, 100), ["Transfer-Encoding: chunked"]),
        (chunked(gzip.compress(body), 64), ["Transfer-Encoding: chunked", "Content-Encoding: gzip"]),
        (zlib.compress(body), ["Content-Encoding: deflate"]),
        (deflated, ["Content-Encoding: deflate"]),
        (zlib.compress(gzip.compress(body)), ["Content-Encoding: gzip, deflate"]),
        (body, ["Transfer-Encoding: chunked"]),
        (body, []),
    ]:
        block = ("HTTP/1.1 200 OK\r\n" + "".join(f"{h}\r\n" for h in http) + "\r\n").encode() + sent
        _, (_, _, text, _) = warc.derived_records("i", block, {})
        assert text.decode() == ("hello " * 500).strip(), http
    bomb = gzip.compress(bytes(10_000_000))
    assert warc.decoded(bomb, "gzip", limit=1_000_000) == bomb and warc.decoded(b"no gzip", "gzip") == b"no gzip" and warc.decoded(b"x", "br") == b"x"


@pytest.mark.parametrize("how", ["plain", "by record", "whole"])
def test_long_files_are_read_in_linear_time(how):
    import gzip
    import time

    one = response(b"y" * 20_000)
    data = {"plain": lambda: one * 2_000, "by record": lambda: gzip.compress(one, 1) * 2_000, "whole": lambda: gzip.compress(one * 2_000, 1)}[how]()
    began = time.process_time()
    assert sum(len(b) for _, b in warc.parse(data)) > 40_000_000
    assert time.process_time() - began < 4


def test_damaged_files(spark, tmp_path):
    import gzip

    one = gzip.compress(response(b"<p>one"))
    broken = one[:40] + b"\xff" * 20 + one[60:]
    assert [h["WARC-Type"] for h, _ in warc.parse(one + broken + one)][0] == "response"
    assert list(warc.parse(b"")) == [] and len(list(warc.parse(response(b"x" * 100)[:150]))) <= 1
    assert len(list(warc.parse(one[:-10]))) == 1


def test_kept_columns_with_names_of_the_output(spark):
    pages = spark.createDataFrame([(1, "u", "<p>" + "long " * 200_000)], "page_id long, url string, html string")
    source = warc.responses(pages).withColumns({"Content_Type": F.lit("mine"), "date2": F.lit("2020-01-01T00:00:00Z")})
    made = warc.derive(source, keep=("page_id", "Content_Type"))
    assert made.columns[:2] == ["page_id", "Content_Type_"] and len(set(map(str.lower, made.columns))) == len(made.columns)
    rows = made.collect()
    assert {r["Content_Type_"] for r in rows} == {"mine"} and max(len(r["block"]) for r in rows) == 5 * 200_000 - 1
    assert {r["date"] for r in warc.responses(pages, date=F.lit("2020-01-01T00:00:00Z")).collect()} == {"2020-01-01T00:00:00Z"}


def test_derivatives_against_other_code(spark, data):
    """Records read by gzip and string splitting alone; text and links by patterns."""
    import base64
    import gzip
    import html

    blocks = "html|body|nav|ul|li|div|article|h1|p|footer|header|title|head|section"
    pages = spark.read.parquet(f"{data}/pages.parquet")
    made = warc.serialize(warc.derive(warc.responses(pages), keep=("page_id",))).collect()
    source = {r["page_id"]: r for r in pages.collect()}
    assert len(made) == 2 * len(source)
    for r in made:
        page = source[r["page_id"]]["html"]
        head, _, rest = gzip.decompress(bytes(r["record"])).partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        block = rest[: int(fields["Content-Length"])]
        sha1 = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
        assert lines[0] == "WARC/1.1" and rest[len(block) :] == b"\r\n\r\n" and fields["WARC-Block-Digest"] == sha1(block)
        assert fields["WARC-Refers-To-Payload-Digest"] == sha1(page.encode()) and fields["WARC-Target-URI"] == source[r["page_id"]]["url"]
        if fields["WARC-Type"] == "conversion":
            body = re.sub(r"(?s)<!--.*?-->|<(script|style|head)\b.*?</\1>", "", page)
            parts = re.split(rf"</?(?:{blocks})\b[^>]*>", re.sub(r"<br>", " ", body))
            text = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in parts]
            assert block.decode() == "\n".join(x for x in text if x)
        else:
            links = [html.unescape(x) for x in re.findall(r'<a [^>]*href="([^"]*)"', page)]
            assert re.findall(r"(?m)^outlink: (.*)\r$", block.decode()) == links


def test_digest_is_base32_sha1():
    assert warc.digest(b"") == "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"
    assert not math.isnan(len(pd.DataFrame()))
