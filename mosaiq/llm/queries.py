"""The queries of the training-data operators, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cotraining, decontaminate, html_text, mixing, pii, simhash, syncmers, toxicity, url_filter, warc
from .common import count_words, materialize, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_components(docs).select("doc_id", "fingerprint", "component_id")


#: (host, path, action)
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
whole AS (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, row_number() OVER () AS n FROM parts),
hits AS (
  SELECT n, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM whole, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM whole LEFT JOIN hits USING (n)
"""


#: Heavy sources fade, light ones grow, as training goes on.
CURRICULUM = (
    ((0.0, 7.5), (1.0, 2.5)),
    ((0.0, 2.0), (0.5, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", count_words(F.col("text")).alias("size"), F.xxhash64("text").alias("digest")), "sized")
    mixed = mixing.by_position(mixing.mix(sized, schedules=CURRICULUM, size=F.col("size"), digest=F.col("digest")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.col("positions.position").alias("positions"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and each benchmark item that leaks into it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.leak_rows(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.col("item").alias("item_id"), "windows", "share", "changed")


def op5_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learnt from rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    model = cotraining.fit(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    scored = cotraining.score_quality(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id")))
    return scored.select("doc_id", "held_out", "content_score", "metadata_score", "score", "predicted")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(pii.with_candidates(docs).select("doc_id", "base", "proposed", "taught"), "candidates")
    spans = pii.select_spans(found, pii.fit(found))
    count = {f"n_{k}": F.size(F.filter("base", _is_kind(k))).cast("long") for k in pii.KINDS}
    return spans.select(
        "doc_id",
        *[c.alias(n) for n, c in count.items()],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).select("page_id", "url", "text", "n_chars")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata and conversion records of every page's response record."""
    source = warc.responses(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    made = warc.derive(source, keep=("page_id",))
    return made.select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "refers_to_payload_digest", "content_length",
        F.decode("block", "UTF-8").alias("content"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_mixing": op3_mixing,
    "op4_decontaminate": op4_decontaminate,
    "op5_syncmers": op5_syncmers,
    "op6_quality": op6_quality,
    "op7_pii": op7_pii,
    "op8_html": op8_html,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
}

SQL: dict[str, str] = {"op2_url_filter": OP2_SQL}
