"""Landed JSON payloads: bars per (symbol, bar size) and the instrument list."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalar import to_number
from barloom.operators.blocks import TIME
from barloom.sources.bars import PRICES

MIN_LISTED_DAYS = 90  # fixed value: how long an instrument must have been listed

# Numbers are read as text so that a missing key, a null and a badly typed value can be told apart.
_ROW = T.MapType(T.StringType(), T.StringType())

BARS_PAYLOAD = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("data", T.StructType([T.StructField("rows", T.ArrayType(_ROW))])),
    ]
)

INSTRUMENTS_PAYLOAD = T.StructType(
    [
        T.StructField("success", T.BooleanType()),
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "rows",
                        T.ArrayType(
                            T.StructType(
                                [T.StructField("symbol", T.StringType()), T.StructField("created_time", T.LongType())]
                            )
                        ),
                    )
                ]
            ),
        ),
    ]
)


def read_bars_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One payload per line, with the ``symbol`` and ``interval`` that were asked for."""
    return spark.read.schema(BARS_PAYLOAD).json(path)


def bars_from_payloads(payloads: DataFrame) -> DataFrame:
    """Typed bars; a payload is rejected whole when its rows lack a required column.

    A column counts as there when any row of the payload has the key, as in a table built from rows.
    ``arrival`` orders the rows: by ``landed`` (any column that orders the payloads), then by place.
    """
    rows = F.col("data.rows")

    def present(name: str) -> Column:
        return F.exists(rows, lambda row: F.map_contains_key(row, name))

    whole = payloads.where(F.size(rows) > 0)
    for name in (TIME, *PRICES):
        whole = whole.where(present(name))
    landed = [name for name in ("landed",) if name in payloads.columns]
    bars = whole.select("symbol", "interval", *landed, F.posexplode(rows).alias("place", "row"))
    millis = to_number(F.try_element_at("row", F.lit(TIME))).cast("long")
    return bars.select(
        "symbol",
        "interval",
        F.timestamp_millis(millis).alias(TIME),
        *[to_number(F.try_element_at("row", F.lit(name))).alias(name) for name in PRICES],
        F.struct(*landed, "place").alias("arrival"),
    )


def first_arrivals(bars: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One bar per (symbol, interval, time): the one that arrived first.

    An aggregate rather than a ranked window: repeated copies of a bar collapse before the shuffle.
    """
    keys = ("symbol", "interval", TIME)
    kept = [c for c in bars.columns if c not in (*keys, arrival)]
    return bars.groupBy(*keys).agg(*[F.min_by(name, F.col(arrival)).alias(name) for name in kept])


def read_instruments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INSTRUMENTS_PAYLOAD).json(path)


def listed_symbols(payloads: DataFrame, as_of: dt.datetime | Column, min_days: int = MIN_LISTED_DAYS) -> DataFrame:
    """Symbols listed at least ``min_days`` before ``as_of``; rows without a listing time are left out."""
    rows = payloads.where("success").select(F.explode("data.rows").alias("row"))
    created = F.col("row.created_time")
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    latest = as_of.cast("timestamp") - F.make_dt_interval(F.lit(min_days))
    return rows.where(
        F.col("row.symbol").isNotNull() & (created != 0) & (F.timestamp_millis(created) <= latest)
    ).select(F.col("row.symbol").alias("symbol"))
