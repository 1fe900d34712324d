"""Exponential averages as window sums, and the parabolic SAR as a streamed pass.

An exponential average is y[i] = q*y[i-1] + in[i]. Unrolled over a chunk of rows it is
``q**j * sum(in * q**-j)``: a running sum, which Spark evaluates in one pass. A chunk is short enough
that ``q**-j`` stays far from overflow and long enough that what two chunks back contribute is below
1e-43 of the value, so one carried value (the last one of the preceding chunk) completes the sum.
Chunk numbers are part of the sort order of every window of the block, hence all spans share one sort.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import kernels
from barloom.operators.blocks import INDEX, KEYS, TIME

_SMALLEST_CHUNK = 256
_CHUNK_DECAY = 100.0  # exp(-100) is what a chunk leaves of the value two chunks back
_ENOUGH_FADE = 35.0  # exp(-35) < 1e-15: what is left of the chunks before can't be seen any more
_LONGEST_FADE = 150.0  # more than that is nothing either, and its inverse must stay a double
_REACH_DECAY = 46.1  # exp(-46.1) < 1e-20: beyond this many bars a value cannot change a double


def decay(span: int) -> float:
    return (span - 1) / (span + 1)


def chunk_bars(span: int) -> int | None:
    """Chunk length for a span; chunk lengths are 256 * 4**n so that they nest."""
    if span <= 1:
        return None
    size = _SMALLEST_CHUNK
    while -math.log(decay(span)) * size < _CHUNK_DECAY:
        size *= 4
    return size


def reach_bars(span: int) -> int:
    """Bars after which an exponential average has forgotten its start."""
    return 0 if span <= 1 else math.ceil(_REACH_DECAY / -math.log(decay(span)))


def log_fade(span: int, gap: Column) -> Column:
    """Logarithm of what a new value leaves of the average; ``gap`` is its distance to the value before, null if there is none."""
    q = decay(span)
    left = gap * math.log(q) - F.log(F.pow(F.lit(q), gap) + F.lit(1.0 - q))
    return F.when(gap == 1, F.lit(math.log(q))).when(gap.isNull(), F.lit(0.0)).otherwise(F.greatest(left, F.lit(-_LONGEST_FADE)))


def new_share(span: int, gap: Column) -> Column:
    """Weight of a new value in the average."""
    q = decay(span)
    return F.when(gap == 1, F.lit(1.0 - q)).when(gap.isNull(), F.lit(1.0)).otherwise((1.0 - q) / (F.pow(F.lit(q), gap) + F.lit(1.0 - q)))


def closing(size: int, total: str, faded: str, rows: str) -> Column:
    """What a chunk hands on: its own part of the average on its last row.

    It leaves out the chunks before, which is right as long as they have faded. Where so many values of a
    chunk (all its ``rows`` are here) are missing that they have not, the query fails rather than giving a
    wrong average.
    """
    sparse = F.raise_error(F.lit("too many missing values for an exponential average")).cast("double")
    unfaded = (F.col(faded) > -_ENOUGH_FADE) & (F.col(rows) == size) & (F.col(INDEX) >= size)
    return F.when(offset_in_chunk(size) == size - 1, F.when(unfaded, sparse).otherwise(F.col(total)))


def offset_in_chunk(size: int) -> Column:
    return (F.col(INDEX) % size).cast("double")


def weight(span: int, exponent: Column) -> Column:
    return F.pow(F.lit(decay(span)), exponent)


def with_sar(bars: DataFrame) -> DataFrame:
    """Add ``sar`` and ``bar_index``.

    The flips make this recurrence non-associative, so a series must be walked in order. It is walked
    as a stream of Arrow batches with four numbers of state: memory does not grow with the series,
    and distinct bar times on a grid bound its length.
    """
    schema = T.StructType([f for f in bars.schema.fields if f.name not in ("sar", INDEX)])
    schema = schema.add("sar", T.DoubleType()).add(INDEX, T.LongType(), False)
    plain = bars.select(*[f.name for f in schema.fields if f.name in bars.columns and f.name not in ("sar", INDEX)])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return kernels.walk_sar(batches)

    ordered = plain.repartition(*KEYS).sortWithinPartitions(*KEYS, TIME)
    return ordered.mapInPandas(walk, schema)
