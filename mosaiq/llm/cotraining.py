"""Quality of documents by co-training two views.

The content view is a linear model over the presence of hashed character
n-grams of the whole text. The metadata view knows no characters: language,
source, and how many characters, words and lines there are and how long they
run, each cut into classes. Both are fitted to labelled rows; then, in rounds,
each view scores all unlabelled documents, and the share of them that it is
surest of, by quantiles over all of them, is labelled for the other view,
which is fitted again with these. Margins of both are calibrated on labelled
rows that no fit has used, and combined by a small logistic model.

Bounds: a fit takes ``max_labelled`` labelled rows and of the pseudo-labelled
ones ``max_taught`` a round for each view, those of the smallest hashes; a view
is fitted in one task, and the driver gets its weights. The ids of these rows
are the only broadcast. Scores, quantiles and the choice of confident rows
cover every document, in one pass for each round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, materialize
from .nbsvm import bucket_counts, labelled_sample, log_ratio, logistic
from .ngrams import PIECE, Grams, logistic_on_presence, packed

ORDERS, BITS = (1, 2, 3), 18
#: Classes of each metadata feature, and where each begins in the view.
_CLASSES = {"chars": 40, "words": 40, "word_length": 64, "line_length": 64, "words_by_line": 64, "lang": 64, "source": 256}
_BEGIN = dict(zip(_CLASSES, np.concatenate([[0], np.cumsum(list(_CLASSES.values()))[:-1]]).tolist()))
META = sum(_CLASSES.values())
#: Buckets of the content view, classes of the metadata view.
SIZES = (1 << BITS, META)


def _count_words(text: str) -> int:
    """Runs of characters that are not ASCII white space, counted piece by piece."""
    n, inside = 0, False
    for a in range(0, len(text), PIECE):
        data = np.frombuffer(text[a : a + PIECE].encode("utf-32-le", "replace"), "<u4")
        word = (data != 32) & ((data < 9) | (data > 13))
        n += int(np.count_nonzero(word[1:] & ~word[:-1])) + int(word[0] and not inside)
        inside = bool(word[-1])
    return n


def metadata(text: str | None, lang: object, source: object) -> np.ndarray:
    """The metadata view of a row: one class of each feature. Null languages
    and sources are values of their own."""
    t = text or ""
    chars, words, lines = len(t), _count_words(t), t.count("\n") + 1
    found = {
        "chars": 2 * np.log2(chars + 1),
        "words": 2 * np.log2(words + 1),
        "word_length": 4 * (chars - words + 1) / (words + 1),
        "line_length": 4 * np.log2(chars / lines + 1),
        "words_by_line": 4 * np.log2(words / lines + 1),
        "lang": zlib.crc32(repr(lang).encode()) % _CLASSES["lang"],
        "source": zlib.crc32(repr(source).encode()) % _CLASSES["source"],
    }
    return np.array([_BEGIN[k] + min(int(v), _CLASSES[k] - 1) for k, v in found.items()], np.int32)


@dataclass(frozen=True)
class Views:
    """Weights by bucket and a bias of either view; Platt's scaling of either
    margin; the weights of both and a constant."""

    content: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    scale: np.ndarray
    both: np.ndarray

    def margins(self, texts: list, lang: list, source: list, grams: Grams) -> np.ndarray:
        rows = ((grams.of(t), metadata(t, x, s)) for t, x, s in zip(texts, lang, source))
        return np.array([(self.content[1] + float(self.content[0][a].sum()), self.meta[1] + float(self.meta[0][b].sum())) for a, b in rows], float).reshape(-1, 2)

    def combine(self, margins: np.ndarray) -> np.ndarray:
        """Content, metadata and combined probability of each row."""
        z = margins * self.scale[0] + self.scale[1]
        return _sigmoid(np.column_stack([z, z @ self.both[:2] + self.both[2]]))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _platt(m: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    scale = max(1e-6, float(np.abs(m).mean()))
    w, b = logistic((m[:, None] / scale).astype(np.float32), y, l2=1e-2)
    return max(0.0, float(w[0])) / scale, b


def _features(rows: DataFrame, *kept: str) -> DataFrame:
    """The kept columns, with the content buckets and metadata classes of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams(ORDERS, BITS, False)
        for b in batches:
            a = [packed(grams.of(t)) for t in b["text"]]
            m = [packed(metadata(*r)) for r in zip(b["text"], b["lang"], b["source"])]
            yield pd.DataFrame({**{c: b[c] for c in kept}, "content": a, "meta": m})

    schema = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in kept)
    return rows.mapInPandas(run, f"{schema}, content binary, meta binary")


def _unpack(found: bytes) -> np.ndarray:
    return np.frombuffer(found, "<i4")


def _learn(lesson: pd.DataFrame) -> pd.DataFrame:
    """The weights of a view from its rows (``view``, ``id``, ``label``, ``found``)."""
    lesson = lesson.sort_values(["id", "label"], kind="stable")
    view = int(lesson["view"].iat[0])
    rows, y = [_unpack(x) for x in lesson["found"]], lesson["label"].to_numpy(np.float32)
    n = bucket_counts(rows, y, SIZES[view])
    ratio = log_ratio(n[1], n[0], float((y == 1).sum()), float((y == 0).sum()))
    w, b = logistic_on_presence(rows, ratio, y)
    return pd.DataFrame({"view": [view], "weight": [w.astype("<f4").tobytes()], "bias": [b]})


def _fitted(lessons: DataFrame) -> list[tuple[np.ndarray, float]]:
    got = lessons.groupBy("view").applyInPandas(_learn, "view int, weight binary, bias double").collect()
    return [(np.frombuffer(bytes(r["weight"]), "<f4"), r["bias"]) for r in sorted(got, key=lambda r: r["view"])]


def _views(rows: DataFrame) -> DataFrame:
    """A row for each view of rows that have both."""
    both = F.array(*[F.struct(F.lit(v).alias("view"), F.col(n).alias("found")) for v, n in enumerate(("content", "meta"))])
    return rows.select("id", "label", F.inline(both)).select("view", "id", F.col("label").cast("int").alias("label"), "found")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    *,
    label: str = "quality",
    key: str = "doc_id",
    rounds: int = 3,
    share: float = 0.03,
    max_labelled: int = 6_000,
    max_taught: int = 4_000,
) -> Views:
    """Co-train on labels that ``train`` admits; ``share`` of all unlabelled
    rows is labelled by either view in each round. Without both labels among
    the known ones every row gets the share of label 1 (0.5 without any).
    Of several texts under one key all count; reruns agree."""
    known = materialize(labelled_sample(labels, label, train, max_labelled, key), "known")
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(key, "text").alias("id"), "text", "lang", "source")
    side = F.broadcast(known.select(F.col(key).alias("key"), "label"))
    held = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(4)) == 0
    got = materialize(_features(rows.join(side, "key"), "id", "label").withColumn("held", held), "labelled")
    count = {(r["held"], r["label"]): r["count"] for r in got.groupBy("held", "label").count().collect()}
    seen = {v: count.get((True, v), 0) + count.get((False, v), 0) for v in (0, 1)}
    if not seen[0] or not seen[1]:
        p = (seen[1] + 1) / (seen[0] + seen[1] + 2)
        nothing = (np.zeros(SIZES[0], np.float32), 0.0), (np.zeros(SIZES[1], np.float32), 0.0)
        return Views(*nothing, np.array([[1.0, 1.0], [0.0, 0.0]]), np.array([0.0, 0.0, np.log(p / (1 - p))]))
    # too few labels to hold any back: all are learnt from and calibrated on
    apart = all(count.get((h, v)) for h in (True, False) for v in (0, 1))
    first, test = (got.where(~F.col("held")), got.where("held")) if apart else (got, got)
    positive = count[False, 1] / (count[False, 0] + count[False, 1]) if apart else seen[1] / (seen[0] + seen[1])
    prior = float(np.clip(positive, 0.05, 0.95))
    lessons = _views(first)
    pool = rows.join(side, "key", "left_anti")
    models = _fitted(lessons)
    taught = None
    for _ in range(rounds):
        scored = materialize(_margins(pool, models), "margins")
        cuts = scored.agg(*[F.percentile_approx(c, [share * (1 - prior), 1 - share * prior], 10_000) for c in ("a", "b")]).first()
        if cuts[0] is None:
            break
        picks = []
        for me, other in ((0, 1), (1, 0)):
            m = F.col("ab"[me])
            low, high = (F.lit(float(x)) for x in cuts[me])
            # only what the view is sure of: its own side of the margin
            sure = F.when((m <= low) & (m < 0), 0).when((m >= high) & (m > 0), 1)
            chosen = scored.select("id", sure.alias("label"), F.lit(other).alias("view")).where("label IS NOT NULL").distinct()
            if taught is not None:
                chosen = chosen.join(F.broadcast(taught.select("view", "id")), ["view", "id"], "left_anti")
            picks.append(chosen.select("id", "label", "view").orderBy(F.xxhash64("id"), "id").limit(max_taught))
        chosen = materialize(picks[0].unionByName(picks[1]), "chosen")
        new = _features(pool.join(F.broadcast(chosen), "id").dropDuplicates(["id", "view"]), "id", "label", "view")
        own = new.select("view", "id", "label", F.when(F.col("view") == 0, F.col("content")).otherwise(F.col("meta")).alias("found"))
        before, taught = taught, materialize(own if taught is None else taught.unionByName(own), "taught")
        models = _fitted(lessons.unionByName(taught))
        for done in (scored, chosen, before):
            discard(done)
    margins, y = _tested(test, models)
    scale = np.array([_platt(margins[:, k], y) for k in (0, 1)]).T
    w, c = logistic((margins * scale[0] + scale[1]).astype(np.float32), y, l2=1e-2)
    return Views(*models, scale, np.array([*np.maximum(w, 0), c], float))


def _tested(rows: DataFrame, models: list[tuple[np.ndarray, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Margins and labels of bounded rows of features."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            m = [[bias + float(w[_unpack(x)].sum()) for x in b[n]] for (w, bias), n in zip(shared.value, ("content", "meta"))]
            yield pd.DataFrame({"id": b["id"], "label": b["label"], "a": m[0], "b": m[1]})

    got = rows.select("id", F.col("label").cast("int").alias("label"), "content", "meta").mapInPandas(run, "id long, label int, a double, b double").collect()
    got.sort(key=lambda r: (r["id"], r["label"], r["a"]))
    return np.array([(r["a"], r["b"]) for r in got]), np.array([r["label"] for r in got], np.float32)


def _margins(rows: DataFrame, models: list[tuple[np.ndarray, float]]) -> DataFrame:
    """(``id``, ``a``, ``b``): the margins of both views of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(Views(*models, np.zeros((2, 2)), np.zeros(3)))

    @F.pandas_udf("struct<a: double, b: double>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        grams = Grams(ORDERS, BITS, False)
        for text, lang, source in batches:
            yield pd.DataFrame(shared.value.margins(text.tolist(), lang.tolist(), source.tolist(), grams), columns=["a", "b"])

    return rows.select("id", run("text", "lang", "source").alias("m")).select("id", "m.a", "m.b")


def score_quality(docs: DataFrame, model: Views) -> DataFrame:
    """``docs`` with ``content_score``, ``metadata_score``, ``score`` (0 to 1)
    and ``predicted`` (1 from 0.5 on); columns of these names are replaced, all
    others stay.

    Null texts count as empty; very long ones are read whole, piece by piece;
    null languages and sources are values of their own. Repeated rows stay,
    ties get equal scores, an empty table gives an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<content_score: double, metadata_score: double, score: double>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        grams = Grams(ORDERS, BITS, False)
        for text, lang, source in batches:
            m = shared.value.margins(text.tolist(), lang.tolist(), source.tolist(), grams)
            yield pd.DataFrame(shared.value.combine(m), columns=["content_score", "metadata_score", "score"])

    rest = docs.drop("content_score", "metadata_score", "score", "predicted")
    (quality,) = fresh(rest, "quality")
    out = rest.select("*", run("text", "lang", "source").alias(quality))
    return out.select(*rest.columns, f"{quality}.*").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
