"""Windowed aggregation over unbounded tables, with watermarks for late rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def follow(spark: SparkSession, folder: str, schema: Any, *, glob: str = "*.parquet", files_per_batch: int = 16) -> DataFrame:
    """The Parquet files of a folder, those there and those to come, as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed(events: DataFrame, ts: str, window: Column, keys: Sequence[str | Column], *, late: str | None = None, **aggregates: Column) -> DataFrame:
    """``aggregates`` by time window and keys, the window's bounds as
    ``window_start`` and ``window_end``; works on batches and streams.
    ``late``: how long a stream waits for rows, then its state goes."""
    if late is not None:
        events = events.withWatermark(ts, late)
    grouped = events.groupBy(window.alias("w"), *keys).agg(*[c.alias(n) for n, c in aggregates.items()])
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def deduplicated(events: DataFrame, ts: str, keys: Sequence[str], late: str) -> DataFrame:
    """The first row of each key within the watermark's span."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def run_once(stream: DataFrame, path: str, *, mode: str = "complete") -> DataFrame:
    """Take in all that is there, stop, and give the result table as it is then.
    Each batch's table goes from the executors to a folder of its own below
    ``path``, written over if the batch is repeated; the last one counts."""
    last: list[int] = []

    def keep(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/tables/{batch}")
        last.append(batch)

    stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(stream.schema).parquet(f"{path}/tables/{last[-1]}") if last else spark.createDataFrame([], stream.schema)


def run_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what is final to Parquet files, exactly once, all that is there now."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def merged_sessions(sessions: Sequence[tuple[int, int, int]], gap: int) -> list[tuple[int, int, int]]:
    """(first, last, n) of sessions, joined where less than ``gap`` lies between them."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(sessions):
        if out and first - out[-1][1] < gap:
            a, b, m = out[-1]
            out[-1] = (a, max(b, last), m + n)
        else:
            out.append((first, last, n))
    return out


def sessions_with_state(events: DataFrame, key: str, ts: str, gap_seconds: int, late: str) -> DataFrame:
    """Sessions by user-managed state: a row (key, first, last, n) for each
    session, once the watermark has passed its end. Timestamps are instants.
    The state of a key is its open sessions; a row joins those that it lies
    within the gap of, whatever order rows come in."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    gap = gap_seconds * 1_000_000

    def step(k: tuple, batches: Any, state: Any) -> Any:
        held = list(zip(*state.get)) if state.exists else []
        if not state.hasTimedOut:
            held += [(int(t), int(t), 1) for b in batches for t in b["us"]]
        now = state.getCurrentWatermarkMs() * 1000
        held = merged_sessions(held, gap)
        closed = [s for s in held if s[1] + gap <= now]
        still = [s for s in held if s[1] + gap > now]
        if still:
            state.update(tuple(list(map(int, c)) for c in zip(*still)))
            state.setTimeoutTimestamp(max(min(s[1] for s in still) + gap, now + 1000) // 1000)
        elif state.exists:
            state.remove()
        yield pd.DataFrame([(k[0], *s) for s in closed], columns=[key, "first_us", "last_us", "n"])

    kind = dict(events.dtypes)[key]
    rows = events.withWatermark(ts, late).select(key, ts, F.unix_micros(ts).alias("us"))
    return rows.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, first_us long, last_us long, n long", "first_us array<long>, last_us array<long>, n array<long>", "append", GroupStateTimeout.EventTimeTimeout
    )
