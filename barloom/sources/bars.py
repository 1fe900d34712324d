"""Reading bars and building them from ticks."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalar import BAR_SECONDS, bar_seconds, to_number
from barloom.operators.blocks import KEYS, TIME, join_per_series

PRICES = ("open", "high", "low", "close", "volume")

BARS_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField(TIME, T.TimestampType()),
        *[T.StructField(name, T.DoubleType()) for name in PRICES],
    ]
)

# Rows read per series for each bar size, and for any other size.
ROW_LIMITS = {"1h": 500, "4h": 200, "1d": 100}
DEFAULT_ROW_LIMIT = 500

READ_COLUMNS = ("symbol", "interval", TIME, "low", "high", "volume", "close")


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars written by :func:`barloom.sources.store.append_bars`."""
    return spark.read.schema(BARS_SCHEMA).parquet(path)


def one_series(bars: DataFrame, symbol: str, interval: str) -> DataFrame:
    """Bars of one series; on the stored layout this prunes to a single folder."""
    return bars.where((F.col("symbol") == symbol) & (F.col("interval") == interval))


def numeric(bars: DataFrame) -> DataFrame:
    """Prices and volume as numbers; text that is no number becomes null."""
    return bars.withColumns(
        {name: to_number(F.col(name)) for name in PRICES if name in bars.columns}
    )


def bars_in_range(bars: DataFrame, values: str) -> DataFrame:
    """Bars in a closed time range given as ``"from|to"``, without ``open``.

    The filter sits on the scan, before any window: indicators of a range start at its first bar.
    """
    bounds = [part.strip() for part in values.split("|")]
    if len(bounds) != 2 or not all(bounds):
        raise ValueError(f"expected 'from|to', got {values!r}")
    begin, end = (F.lit(bound).cast("timestamp") for bound in bounds)
    return numeric(bars.where(F.col(TIME).between(begin, end)).select(*READ_COLUMNS))


def row_limit(interval: Column) -> Column:
    limits = F.create_map(*[F.lit(part) for item in ROW_LIMITS.items() for part in item])
    return F.coalesce(F.try_element_at(limits, interval), F.lit(DEFAULT_ROW_LIMIT))


def first_bars(bars: DataFrame, limit: int | None = None, latest: bool = False) -> DataFrame:
    """The first bars of every series in time order, without ``open``.

    ``limit=None`` takes the limit of the bar size. ``latest=True`` takes the newest bars instead of
    the oldest. The constant bound is what lets Spark cut each series to that many rows in every map
    task before the shuffle; the smaller limits then apply to what is left.
    """
    bound = limit if limit is not None else max(DEFAULT_ROW_LIMIT, *ROW_LIMITS.values())
    order = F.col(TIME).desc() if latest else F.col(TIME).asc()
    ranked = bars.select(*READ_COLUMNS).withColumn("_rank", F.row_number().over(Window.partitionBy(*KEYS).orderBy(order)))
    kept = ranked.where(F.col("_rank") <= bound)
    if limit is None:
        kept = kept.where(F.col("_rank") <= row_limit(F.col("interval")))
    return numeric(kept.drop("_rank"))


def bars_from_ticks(ticks: DataFrame, sizes: Sequence[str] = tuple(BAR_SECONDS)) -> DataFrame:
    """Bars of every size from ticks ``(symbol, ts, seq, price, amount)``.

    Ticks are aggregated once, to the longest length that divides every size; the sizes are rolled
    up from those bars, so the tick volume is scanned and shuffled (as map-side partials) only once.
    """
    seconds = {size: bar_seconds(size) for size in sizes}
    base = _common_length(seconds.values())
    fine = (
        ticks.groupBy("symbol", bucket_start(F.col("ts"), F.lit(base)).alias("_at"))
        .agg(*tick_totals())
    )
    return rolled_up(fine.withColumnRenamed("_at", TIME), sizes)


def rolled_up(bars: DataFrame, sizes: Sequence[str]) -> DataFrame:
    """Longer bars from shorter ones (symbol, time, prices) whose length divides theirs."""
    seconds = [F.struct(F.lit(s).alias("interval"), F.lit(bar_seconds(s)).alias("n")) for s in sizes]
    return (
        bars.select("symbol", F.col(TIME).alias("_at"), *PRICES, F.explode(F.array(*seconds)).alias("size"))
        .groupBy("symbol", F.col("size.interval").alias("interval"), bucket_start(F.col("_at"), F.col("size.n")).alias(TIME))
        .agg(
            F.min_by("open", "_at").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "_at").alias("close"),
            F.sum("volume").alias("volume"),
        )
    )


def tick_totals() -> list[Column]:
    # (time, sequence) as one fixed-width number: a struct would force a sort-based aggregate.
    micros = F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(17,0)")
    arrival = micros * F.lit(Decimal(10**19)) + F.col("seq").cast("decimal(19,0)")
    return [
        F.min_by("price", arrival).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", arrival).alias("close"),
        F.sum("amount").alias("volume"),
    ]


def _common_length(lengths) -> int:
    return gcd(*lengths)


def bucket_start(ts: Column, seconds: Column) -> Column:
    """Start of the epoch-aligned bucket that holds ``ts``."""
    at = F.unix_seconds(ts.cast("timestamp"))
    return F.timestamp_seconds(at - F.pmod(at, seconds))


# --- catalogue ---------------------------------------------------------------------------------


def series(bars: DataFrame) -> DataFrame:
    return bars.select(*KEYS).distinct()


def series_name(symbol: Column, interval: Column) -> Column:
    return F.concat_ws("_", symbol, interval)


def series_like(bars: DataFrame, pattern: str = "PERP_%_%") -> DataFrame:
    """Series whose name matches a LIKE pattern (``_`` stands for any one character)."""
    return series(bars).where(series_name(F.col("symbol"), F.col("interval")).like(pattern))


def series_exist(wanted: DataFrame, bars: DataFrame) -> DataFrame:
    """``wanted`` series with a flag that tells whether any bar of them is stored."""
    known = series(bars).withColumn("found", F.lit(True))
    return wanted.join(known, list(KEYS), "left").withColumn("found", F.coalesce("found", F.lit(False)))


def coverage(bars: DataFrame) -> DataFrame:
    """First and last bar date and row count of every series."""
    return bars.groupBy(*KEYS).agg(
        F.to_date(F.min(TIME)).alias("first_date"),
        F.to_date(F.max(TIME)).alias("last_date"),
        F.count(F.lit(1)).alias("bars"),
    )


def scaled_prices(bars: DataFrame, factor: float = 1e8) -> DataFrame:
    """Close prices, multiplied where the mean close of the series is below one."""
    mean = bars.groupBy(*KEYS).agg(F.avg("close").alias("_mean"))
    scaled = F.when(F.col("_mean") < 1, F.col("close") * factor).otherwise(F.col("close"))
    return join_per_series(bars, mean).withColumn("scaled_close", scaled).drop("_mean")


def time_ordered(bars: DataFrame) -> DataFrame:
    """All series, each in time order; a range-partitioned sort."""
    return bars.orderBy(*KEYS, TIME)
