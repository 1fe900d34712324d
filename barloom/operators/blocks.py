"""Splitting a time series into bounded blocks.

A series (symbol, interval) may hold a large share of all bars, so no operator here partitions a
window by the series alone. Rows get a position in their series (``bar_index``), positions are cut
into blocks of ``block_bars`` rows, and a block receives as many earlier (``reach``) and later
(``ahead``) rows as the widest frame needs. Every window is then partitioned by
(symbol, interval, block). What has no bounded reach (running totals, back-fill) is carried between
blocks through a table with one row per block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.scalar import bar_seconds_col

KEYS = ("symbol", "interval")
TIME = "start_timestamp"
INDEX = "bar_index"
BLOCK = "bar_block"
BLOCK_BARS = 32768


def block_of(index: Column, block_bars: int) -> Column:
    return F.floor(index / F.lit(block_bars)).cast("long")


def totals_before(
    df: DataFrame, keys: Sequence[str], block: str, totals: Mapping[str, Column]
) -> DataFrame:
    """One row per (keys, block): the totals of all earlier blocks of the same keys.

    The sums are combined map-side, so what is shuffled and what the window sorts is one row per
    block, not one per input row.
    """
    per_block = df.groupBy(*keys, block).agg(*[expr.alias(name) for name, expr in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    zeros = {name: F.lit(0).cast(per_block.schema[name].dataType) for name in totals}
    return per_block.select(
        *keys,
        block,
        *[F.coalesce(F.sum(name).over(earlier), zeros[name]).alias(name) for name in totals],
    )


def with_position(
    df: DataFrame, keys: Sequence[str], block: str, order: Sequence[Column | str], name: str
) -> DataFrame:
    """0-based position of each row within ``keys``, given a block column that follows the order.

    Rows are numbered inside (keys, block) and shifted by the row count of the earlier blocks. The
    join is a left one so that only the small side can ever be the broadcast side; broadcasting the
    rows would leave them partitioned by the keys alone.
    """
    before = totals_before(df, keys, block, {"_rows_before": F.count(F.lit(1))})
    inside = Window.partitionBy(*keys, block).orderBy(*order)
    return (
        df.join(before, [*keys, block], "left")
        .withColumn(name, F.col("_rows_before") + F.row_number().over(inside) - 1)
        .drop("_rows_before")
    )


def with_bar_index(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Add ``bar_index``, the 0-based position of a bar in its series.

    Bars of a series have distinct times on a grid, so a time block of ``block_bars`` bar lengths
    holds at most ``block_bars`` rows. Bars without a time have no place in a series and get no index.
    """
    if INDEX in bars.columns:
        return bars
    unknown = F.raise_error(F.concat(F.lit("unknown bar size: "), F.coalesce("interval", F.lit("null")))).cast("long")
    seconds = F.coalesce(bar_seconds_col(F.col("interval")), unknown) * block_bars
    span = F.floor(F.unix_seconds(F.col(TIME).cast("timestamp")) / seconds).cast("long")
    return with_position(bars.withColumn("_span", span), KEYS, "_span", [TIME], INDEX).drop("_span")


def spread(indexed: DataFrame, reach: int, ahead: int = 0, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Copy each row to its own block and to the blocks whose frames can see it."""
    position = F.col(INDEX)
    first = F.greatest(block_of(position - ahead, block_bars), F.lit(0).cast("long"))
    last = block_of(position + reach, block_bars)
    if not reach and not ahead:
        return indexed.withColumn(BLOCK, last)
    return indexed.withColumn(BLOCK, F.explode(F.sequence(first, last)))


def is_own(block_bars: int = BLOCK_BARS) -> Column:
    """True for the rows a block owns, false for the copies it only looks at."""
    return block_of(F.col(INDEX), block_bars) == F.col(BLOCK)


def join_per_group(df: DataFrame, per_group: DataFrame, keys: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Attach one row per group to every row of the group.

    The small side is repeated per salt, as many as there are shuffle partitions, so a hot group meets its
    values in all tasks. Spark still broadcasts the small side when its measured size is under the broadcast
    threshold.
    """
    salts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salted = per_group.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    return rows.join(salted, [*keys, "_salt"], "left").drop("_salt")


def join_per_series(df: DataFrame, per_series: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Attach per-series values to every bar."""
    return join_per_group(df, per_series, keys, [TIME])
