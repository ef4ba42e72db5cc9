"""The stages of the pipeline against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from mosaiq.llm.common import materialize

from .test_operators import ODD, brute_spans, docs_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def smallest_of_class(texts):
    """The smallest id of each one's class, by all pairs: five-word shingles, similarity 0.8 or more."""
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))}
    at = {i: i for i in sets}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 5 >= max(len(a), len(b)) * 4 and len(a & b) * 5 >= len(a | b) * 4:
                x, y = sorted((find(i), find(j)))
                at[y] = x
    return {i: find(i) for i in ids}


def test_stages(spark, data):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "mixing"]
    docs = spark.read.parquet(f"{data}/documents.parquet")
    bench = [r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{data}/labels.parquet").where("toxic = 1").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = materialize(stage(spark, docs, data), name)
        after = {r["doc_id"]: r for r in docs.collect()}
        gone = set(before) - set(after)
        if name != "mixing":
            assert docs.columns == COLUMNS
        if name == "toxicity":
            insult = re.compile("idiot|moron|stupid|loser|trash|scum|clown|pathetic|worthless|disgusting", re.I)
            rude = {i for i, r in before.items() if insult.search(r["text"])}
            assert rude and len(rude - gone) <= 0.2 * len(rude)
            assert len(gone - rude - toxic) <= 0.05 * len(before)
        elif name == "near_duplicates":
            assert set(after) == set(smallest_of_class({i: r["text"] for i, r in before.items()}).values())
        elif name == "decontamination":
            leaked = {i for i, r in before.items() if any(b in r["text"] for b in bench)}
            assert leaked and leaked <= gone and len(gone - leaked) <= 2
        elif name == "personal_data":
            assert set(after) == set(before)
            assert all(not brute_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after.values())
        else:
            rows = docs.collect()
            assert len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows) and all(0 < r["words"] <= r["size"] and r["copy"] in (0, 1) and 0 <= r["position"] <= 1 for r in rows)
            size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in before.items()}
            assert all(r["size"] == size[r["doc_id"]] for r in rows)
            by_source = {}
            for r in rows:
                by_source.setdefault(r["source"], []).append(r)
            for source, mixed in by_source.items():
                whole = sum(size[i] for i, r in before.items() if r["source"] == source)
                assert abs(sum(r["words"] for r in mixed) - mixed[0]["target"]) <= 1 and mixed[0]["target"] <= 2 * whole + 1e-6
                # a source's words come in the order of its positions, the first copies of all before the second
                line = sorted(mixed, key=lambda r: (r["copy"], r["position"]))
                assert [r["position"] for r in line] == sorted(r["position"] for r in line)


def test_run_gives_the_last_stage(spark, data):
    out = corpus_pipeline.run(spark, data)
    assert out.count() > 0 and {"doc_id", "position", "words"} <= set(out.columns)


def test_stages_take_odd_rows(spark, data):
    docs = docs_of(spark, ODD).select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, data), name)
    assert docs.count() > 0


def test_near_copies_by_shingle_similarity(spark, data):
    """Against all pairs: five-word shingles, similarity 0.8 or more."""
    docs = spark.read.parquet(data.replace("0.001", "0.01") + "/documents.parquet")
    words = [f"w{i}" for i in range(104)]
    # 80 of 100 shingles shared of 120 in all is below 0.8; of 100 and 80 is 0.8
    made = [(-1, words), (-2, words[:84]), (-3, words[:83]), (-4, words[20:] + [f"x{i}" for i in range(20)])]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(i, " ".join(w)) for i, w in made], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = smallest_of_class(texts)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, data).collect()}
    assert kept == set(first.values()) and {-4, -3, -2, -1} & kept == {first[i] for i in (-4, -3, -2, -1)}


def test_near_copies_meet_by_simhash_and_by_bands(spark, data):
    """Each alone gives links, and what either gives holds by the exact similarity."""
    from mosaiq.llm import jaccard, simhash

    docs = spark.read.parquet(data.replace("0.001", "0.01") + "/documents.parquet").select("doc_id", "text")
    words = [f"w{i}" for i in range(2000)]
    # 1,996 shingles, 4 of them less or other: the fingerprints differ by a few bits at most
    made = [(-1, words), (-2, words[:1996]), (-3, ["y", *words[1:]])]
    docs = docs.unionByName(spark.createDataFrame([(i, " ".join(w)) for i, w in made] + [(-4, None), (-5, " "), (-6, "one two")], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}

    def classes(by):
        out = {}
        for r in jaccard.near_points(docs, by=by).collect():
            out.setdefault(tuple(r["class"]), set()).add(r["best"]["key"])
        return {frozenset(c) for c in out.values()}

    def linked(found):
        return {(a, b) for c in found for a in c for b in c if a < b}

    def bits(i):
        return simhash.fingerprint(texts[i], jaccard.SHINGLE, (42,))[0]

    tree, bands, both = (linked(classes(by)) for by in (("simhash",), ("minhash",), ("simhash", "minhash")))
    assert {(-3, -1), (-2, -1), (-3, -2)} <= tree and tree <= both and bands <= both
    first = smallest_of_class(texts)
    assert all(first[a] == first[b] for a, b in both)
    points = sorted({i for pair in both for i in pair})
    near = {(a, b) for n, a in enumerate(points) for b in points[n + 1 :] if (bits(a) ^ bits(b)).bit_count() <= jaccard.RADIUS and (a, b) in bands}
    assert near and near <= tree
