"""Labels from the next bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalar import ratio
from barloom.operators import indicators as ind
from barloom.operators.blocks import BLOCK, BLOCK_BARS, INDEX, KEYS, join_per_series
from barloom.operators.ranking import exact_quantiles
from barloom.operators.scaling import min_max_scaled

# Quantiles of the next return that bound the sell and buy labels; look-back length.
SELL_QUANTILE = 0.15
BUY_QUANTILE = 0.85
LOOK_BACK = 60


def next_return() -> list[ind.Step]:
    """``return``: relative change of close to the next bar, null on the last bar."""
    return [
        *ind.next_value("close", "_next_close"),
        ind.Step("return", lambda rows: ratio(F.col("_next_close"), F.col("close")) - 1.0, ("_next_close", "close")),
    ]


def rises_next() -> list[ind.Step]:
    """``target``: 1 where the next close is higher, else 0; 0 on the last bar."""

    def target():
        return F.when(F.col("_next_close") > F.col("close"), 1).otherwise(0)

    return [*ind.next_value("close", "_next_close"), ind.Step("target", lambda rows: target(), ("_next_close", "close"))]


def binary_labels(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    return ind.apply_steps(bars, rises_next(), ["target"], block_bars).drop(BLOCK)


def with_return(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    return ind.apply_steps(bars, next_return(), ["return"], block_bars).drop(BLOCK)


def return_thresholds(df: DataFrame) -> DataFrame:
    """Sell and buy thresholds of every series: exact quantiles of ``return``."""
    return exact_quantiles(df, KEYS, "return", {"lower_threshold": SELL_QUANTILE, "upper_threshold": BUY_QUANTILE})


def with_three_way_target(df: DataFrame, thresholds: DataFrame | None = None) -> DataFrame:
    """``target`` 1 above the buy threshold, -1 below the sell threshold, else 0 (also without a return)."""
    thresholds = return_thresholds(df) if thresholds is None else thresholds
    target = F.when(F.col("return") > F.col("upper_threshold"), 1).when(F.col("return") < F.col("lower_threshold"), -1)
    return join_per_series(df, thresholds).withColumn("target", target.otherwise(0)).drop("lower_threshold", "upper_threshold")


def complete_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows without a null in any column, or in the given ones."""
    return df.na.drop("any", subset=subset)


def label_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(*KEYS, "target").agg(F.count(F.lit(1)).alias("rows"))


def look_back_windows(
    bars: DataFrame, look_back: int = LOOK_BACK, block_bars: int = BLOCK_BARS
) -> DataFrame:
    """``x``: the preceding scaled closes, oldest first; ``y``: the scaled close that follows them."""
    scaled = min_max_scaled(bars, ["close"], suffix="_scaled")
    steps = ind.lookback("close_scaled", look_back, "x")
    windows = ind.apply_steps(scaled, steps, ["x"], block_bars)
    full = windows.where(F.col(INDEX) >= look_back)
    return full.select(*KEYS, "start_timestamp", INDEX, "x", F.col("close_scaled").alias("y"))
