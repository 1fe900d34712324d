"""Streaming jobs: bars arriving as files, and bars built from a tick stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.functions.scalar import BAR_SECONDS, bar_seconds, bar_seconds_col
from barloom.operators.blocks import TIME
from barloom.sources.bars import BARS_SCHEMA, bars_from_ticks, bucket_start, rolled_up, tick_totals
from barloom.sources.payloads import bars_from_payloads
from barloom.sources.store import append_bars


def ingest_bars(arriving: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append unseen bars of a stream to the stored bars and stop when the input is used up.

    A bar may come at any time after its own. So there is no watermark, which would drop late ones: each
    batch is reduced to first arrivals and compared with the stored keys, which also makes replays harmless.
    """
    return _append_batches(arriving, lambda batch: append_bars(batch, path), checkpoint)


def ingest_payloads(arriving: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the bars of landed payloads (see ``payloads.BARS_PAYLOAD``)."""
    return ingest_bars(bars_from_payloads(arriving), path, checkpoint)


def _append_batches(rows: DataFrame, work: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(lambda batch, _: work(batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def tick_bars(ticks: DataFrame, size: str, lateness: str = "1 hour") -> DataFrame:
    """Bars of one size over a tick stream ``(symbol, ts, seq, price, amount)``.

    In append mode a bar is emitted once, when the watermark has passed its end.
    """
    at = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    bars = at.groupBy("symbol", F.window("ts", f"{bar_seconds(size)} seconds").alias("_bar")).agg(*tick_totals())
    return bars.select(
        "symbol", F.lit(size).alias("interval"), F.col("_bar.start").alias(TIME), "open", "high", "low", "close", "volume"
    )


def ingest_ticks(ticks: DataFrame, path: str, checkpoint: str, sizes: Sequence[str] = tuple(BAR_SECONDS), lateness: str = "1 hour") -> StreamingQuery:
    """Store closed bars of every size from one scan of a tick stream.

    State is kept for the shortest bars alone. When some of them close, the longer bars that they end are
    rolled up from the stored short ones and appended; the append skips those that are there already.
    """
    shortest, *longer = sorted(sizes, key=bar_seconds)

    def work(closed: DataFrame) -> None:
        spark = closed.sparkSession
        append_bars(closed, path)
        span = closed.agg(F.min(TIME).alias("first"), F.max(TIME).alias("last")).first()
        if span["first"] is None or not longer:
            return
        stored = spark.read.schema(BARS_SCHEMA).parquet(path).where(F.col("interval") == shortest)
        until = F.lit(span["last"]) + F.make_dt_interval(secs=F.lit(bar_seconds(shortest)))
        append_bars(_rolled_up(stored, longer, F.lit(span["first"]), until), path)

    return _append_batches(tick_bars(ticks, shortest, lateness), work, checkpoint)


def _rolled_up(stored: DataFrame, sizes: Sequence[str], since: Column, until: Column) -> DataFrame:
    """Bars of ``sizes`` from short ones: those that end after ``since`` and not after ``until``."""
    longest = max(map(bar_seconds, sizes))
    near = stored.where(F.col(TIME) >= bucket_start(since, F.lit(longest)))
    bars = rolled_up(near, sizes)
    end = F.col(TIME) + F.make_dt_interval(secs=bar_seconds_col(F.col("interval")))
    return bars.where((end > since) & (end <= until))


def close_open_bars(ticks: DataFrame, path: str, sizes: Sequence[str] = tuple(BAR_SECONDS)) -> None:
    """Add the bars that a finished stream has left open, from a batch read of its ticks.

    The stream emits a bar when its watermark has passed it, so the last ones stay in its state. What is
    stored is kept, what is missing is appended.
    """
    append_bars(bars_from_ticks(ticks, sizes), path)
