"""Linear classifier over character n-grams scaled by naive Bayes log-count
ratios (binary features), with its fit on a bounded sample of labelled rows.

Fit: the labelled rows with the smallest hashes, at most ``max_rows``, are
found in ``docs`` by a join with that bounded side (the only broadcast here;
its size is ``max_rows`` ids). Each gives the distinct hash buckets of its
n-grams, which meet in one task: ``max_rows`` texts' worth, whatever the
corpus. Every bucket that occurs is a feature; its ratio comes from these rows,
and a logistic regression is fitted to the presence of all of them. The driver
gets the weights alone. Scores are made for every row by one narrow pass over the whole
texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .ngrams import Grams, logistic_on_presence, packed

#: Added to counts.
SMOOTH = 1.0


@dataclass(frozen=True)
class Linear:
    """``weight`` by bucket (scaled by the ratios already)."""

    weight: np.ndarray
    bias: float
    orders: tuple[int, ...]
    bits: int
    lower: bool

    def margins(self, texts: list[str | None], grams: Grams | None = None) -> np.ndarray:
        grams = grams or Grams(self.orders, self.bits, self.lower)
        return np.array([margin(self.weight, self.bias, grams.of(t)) for t in texts], float)


def margin(weight: np.ndarray, bias: float, found: np.ndarray) -> float:
    """Of a text's distinct buckets."""
    return bias + float(weight[found].sum())


def log_ratio(pos: np.ndarray, neg: np.ndarray, n_pos: float, n_neg: float) -> np.ndarray:
    """Naive Bayes log-count ratios of binary features; 0 where nothing was
    seen. A ratio of fewer than about three standard errors shrinks smoothly:
    features of one or two rows say little, and there are most of them."""
    p, q = (pos + SMOOTH) / (n_pos + 2 * SMOOTH), (neg + SMOOTH) / (n_neg + 2 * SMOOTH)
    r = np.log(p / q)
    z4 = (r / np.sqrt(1 / (pos + SMOOTH) + 1 / (neg + SMOOTH))) ** 4
    return np.where(pos + neg > 0, r * z4 / (z4 + 81), 0.0).astype(np.float32)


def bucket_counts(rows: list[np.ndarray], label: np.ndarray, size: int) -> np.ndarray:
    """Rows of label 0 and of label 1 that have each bucket."""
    n = np.zeros((2, size), np.int32)
    for r, v in zip(rows, label):
        n[int(v), r] += 1
    return n


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, weight: np.ndarray | None = None, steps: int = 400) -> tuple[np.ndarray, float]:
    """Regularised logistic regression on few columns by accelerated gradient steps."""
    n, k = x.shape
    weight = np.ones(n, np.float32) if weight is None else weight.astype(np.float32)
    weight = weight / weight.sum()
    bound = 0.25 * float((weight * (x * x).sum(1)).sum() + 1) + l2
    w, b, vw, vb, t = np.zeros(k, np.float32), 0.0, np.zeros(k, np.float32), 0.0, 1.0
    for _ in range(steps):
        g = weight * (1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30))) - y).astype(np.float32)
        nw, nb = vw - (g @ x + l2 * vw) / bound, vb - float(g.sum()) / bound
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = nw, nb, t2
    return w, b


def labelled_sample(labels: DataFrame, label: str, train: Column, max_rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``max_rows`` (key, label) rows: those that ``train`` admits and
    whose hashes are smallest; of contradicting labels the larger counts."""
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & train).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64(key), key).limit(max_rows)


def fit(
    docs: DataFrame,
    sample: DataFrame,
    *,
    orders: tuple[int, ...] = (3, 4, 5),
    bits: int = 20,
    lower: bool = True,
    text: str = "text",
    key: str = "doc_id",
) -> Linear:
    """Fit to ``sample`` (key, label), whose rows are bounded. Without rows of
    both labels the score is the share of label 1 (or 0.0) for every text.
    Of several texts under one key all count. The rows are taken in the order
    of key and text, so reruns agree."""
    rows = materialize(docs.select(key, text).join(F.broadcast(sample), key).select(key, text, "label"), "labelled")

    def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = Grams(orders, bits, lower)
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "hash": batch["hash"], "label": batch["label"], "found": [packed(grams.of(t)) for t in batch["text"]]})

    def learn(got: pd.DataFrame) -> pd.DataFrame:
        got = got.sort_values(["key", "hash", "label"], kind="stable")
        label = got["label"].to_numpy(np.float32)
        n_pos, n_neg = float((label == 1).sum()), float((label == 0).sum())
        if not n_neg or not n_pos:
            p = min(max((n_pos + 1e-6) / (n_neg + n_pos + 2e-6), 1e-6), 1 - 1e-6)
            return pd.DataFrame({"weight": [b""], "bias": [float(np.log(p / (1 - p)))]})
        found = [np.frombuffer(x, "<i4") for x in got["found"]]
        n = bucket_counts(found, label, 1 << bits)
        weight, bias = logistic_on_presence(found, log_ratio(n[1], n[0], n_pos, n_neg), label)
        return pd.DataFrame({"weight": [weight.astype("<f4").tobytes()], "bias": [bias]})

    source = rows.select(F.xxhash64(key).alias("key"), F.xxhash64(text).alias("hash"), "label", F.col(text).alias("text"))
    features = source.mapInPandas(seen, "key long, hash long, label int, found binary")
    model = features.groupBy(F.lit("all")).applyInPandas(learn, "weight binary, bias double").first()
    if model is None:
        return Linear(np.zeros(1 << bits, np.float32), float(np.log(1e-6)), orders, bits, lower)
    weight = np.frombuffer(bytes(model["weight"]), "<f4") if model["weight"] else np.zeros(1 << bits, np.float32)
    return Linear(weight, model["bias"], orders, bits, lower)


def score_text(docs: DataFrame, model: Linear, *, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with ``to``: the probability of label 1 of the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        grams = Grams(m.orders, m.bits, m.lower)
        for batch in batches:
            yield pd.Series(1 / (1 + np.exp(-np.clip(m.margins(batch.tolist(), grams), -700, 700))), dtype=float)

    return docs.withColumn(to, score(F.col(text)))
