"""Toxicity of whole texts: character n-grams, naive Bayes ratios, linear fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import nbsvm
from .common import fresh

#: Labelled rows that a fit uses at most, by default.
MAX_ROWS = 5_000


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> nbsvm.Linear:
    """Learn from at most ``max_rows`` labelled rows that are not held out."""
    sample = nbsvm.labelled_sample(labels, "toxic", ~held_out(F.col("doc_id")), max_rows)
    return nbsvm.fit(docs, sample)


def score_toxicity(docs: DataFrame, model: nbsvm.Linear) -> DataFrame:
    """Every row of ``docs`` with ``held_out``, ``score`` (0 to 1) and
    ``predicted`` (1 from a score of 0.5 on).

    Null and empty texts are scored as texts of no words; very long ones are
    read whole, piece by piece. Columns of the three names are replaced, all
    others stay. Repeated rows and null ids stay as they are, ties get equal
    scores, an empty table gives an empty one."""
    docs = docs.drop("held_out", "score", "predicted").withColumn("held_out", held_out(F.col("doc_id")))
    return nbsvm.score_text(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with the columns of ``docs`` as
    they are, whatever their names."""
    (score,) = fresh(docs, "score")
    model = fit_toxicity(docs.select("doc_id", "text"), labels, max_rows=max_rows)
    return nbsvm.score_text(docs, model, to=score).where(F.col(score) < 0.5).select(*docs.columns)
