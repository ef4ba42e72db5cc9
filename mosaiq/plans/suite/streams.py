"""The time windows over streams; a finished stream gives what the batch gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.windows import hop, session, tumble
from ...storage import shared_folder
from ...streaming.windows import deduplicated, follow, run_once, run_to, sessions_with_state, windowed
from . import SQL, query, windows  # noqa: F401  the batch queries' SQL is the streams' too


def _events(e, folder):
    return follow(e.spark, folder, e.set("events").df.schema, glob="events.parquet")


def _instants(stream):
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


_NTZ = ("window_start", "window_end")


def _plain(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in _NTZ})


@query("stream_tumble", SQL["tumble_events"])
def stream_tumble(e, folder):
    out = windowed(_instants(_events(e, folder)), "ts", tumble("ts", "1 hour"), ["event_type"], n=F.count(F.lit(1)))
    return _plain(run_once(out, shared_folder(e.spark)))


@query("stream_hop", SQL["hop_events"])
def stream_hop(e, folder):
    out = windowed(_instants(_events(e, folder)), "ts", hop("ts", "1 hour", "30 minutes"), [], n=F.count(F.lit(1)))
    return _plain(run_once(out, shared_folder(e.spark)))


@query("stream_session", SQL["session_events"])
def stream_session(e, folder):
    out = windowed(_instants(_events(e, folder)), "ts", session("ts", "30 minutes"), ["user_id"], n=F.count(F.lit(1)))
    return _plain(run_once(out, shared_folder(e.spark)))


@query("stream_dedupe", "SELECT COUNT(DISTINCT event_id) AS n FROM events")
def stream_dedupe(e, folder):
    rows = _instants(_events(e, folder))
    target = shared_folder(e.spark)
    run_to(deduplicated(rows, "ts", ["event_id"], "3650 days").select("event_id"), f"{target}/out", f"{target}/checkpoint")
    return e.spark.read.schema("event_id long").parquet(f"{target}/out").agg(F.count(F.lit(1)).alias("n"))


@query("stream_state", """
WITH m AS (SELECT user_id, ts, CASE WHEN ts < LAG(ts) OVER w + INTERVAL '30 minutes' THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, SUM(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM m)
SELECT user_id, epoch_us(MIN(ts)) AS first_us, epoch_us(MAX(ts)) AS last_us, COUNT(*) AS n FROM s GROUP BY user_id, g
HAVING MAX(ts) + INTERVAL '30 minutes' <= (SELECT MAX(ts) - INTERVAL '1 hour' FROM events)""")
def stream_state(e, folder):
    """Sessions by managed state: those that the watermark has closed."""
    rows = _instants(_events(e, folder)).select("user_id", "ts")
    target = shared_folder(e.spark)
    run_to(sessions_with_state(rows, "user_id", "ts", 1800, "1 hour"), f"{target}/out", f"{target}/checkpoint")
    return e.spark.read.schema("user_id long, first_us long, last_us long, n long").parquet(f"{target}/out")
