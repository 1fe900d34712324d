"""Strategy catalogue: which features a strategy trains on, per bar size."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Features of every strategy beyond the base columns, EMA spans per bar size.
BASE_FEATURES = ("close", "high", "low", "volume")

EMA_SPANS = {"5m": (12, 26), "1h": (20, 50), "4h": (50, 200), "1d": (50, 200)}

# "{fast}" and "{slow}" stand for the EMA features of the bar size.
STRATEGY_FEATURES = {
    "Trend-Following": ("{fast}", "{slow}", "macd", "macd_signal", "adx", "vwap"),
    "Volatility Breakout": ("atr_14", "bollinger_hband", "bollinger_lband", "std_20", "vwap"),
    "Momentum Reversal": ("rsi_14", "stoch_k_14", "stoch_d_14", "roc_10", "momentum_10", "vwap"),
    "Momentum + Volatility": ("rsi_14", "atr_14", "bollinger_hband", "bollinger_lband", "roc_10", "momentum_10", "vwap"),
    "Hybrid": ("{fast}", "{slow}", "atr_14", "bollinger_hband", "rsi_14", "macd", "vwap"),
    "Advanced": ("tenkan_sen_9", "kijun_sen_26", "senkou_span_a", "senkou_span_b", "sar", "vwap"),
    "Router": (
        "ema_12", "ema_26", "macd", "macd_signal", "adx", "atr_14", "bollinger_hband", "bollinger_lband", "std_20",
        "rsi_14", "stoch_k_14", "stoch_d_14", "roc_10", "momentum_10", "tenkan_sen_9", "kijun_sen_26",
        "senkou_span_a", "senkou_span_b", "sar", "vwap",
    ),
}

# The only strategy whose features are selected from the data instead of all used.
SELECTED = "Router"

STRATEGIES_SCHEMA = T.StructType(
    [
        T.StructField("interval", T.StringType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("force_features", T.BooleanType()),
    ]
)


def strategy_features(interval: str, strategy: str) -> dict:
    """Features of a strategy; an unknown pair has none."""
    if interval not in EMA_SPANS or strategy not in STRATEGY_FEATURES:
        return {"interval": interval, "strategy": strategy, "features": [], "force_features": False}
    fast, slow = (f"ema_{span}" for span in EMA_SPANS[interval])
    named = [name.format(fast=fast, slow=slow) for name in STRATEGY_FEATURES[strategy]]
    return {
        "interval": interval,
        "strategy": strategy,
        "features": [*BASE_FEATURES, *named],
        "force_features": strategy != SELECTED,
    }


def require_features(interval: str, strategy: str) -> dict:
    found = strategy_features(interval, strategy)
    if not found["features"]:
        raise ValueError(f"no features for interval {interval!r} and strategy {strategy!r}")
    return found


def strategy_table(spark: SparkSession) -> DataFrame:
    """The catalogue as a table of 28 rows."""
    rows = [strategy_features(i, s) for i in EMA_SPANS for s in STRATEGY_FEATURES]
    return spark.createDataFrame([tuple(r.values()) for r in rows], STRATEGIES_SCHEMA)


def merged_features(features: Column) -> Column:
    """Base columns first, then the strategy's, each once."""
    base = F.array(*[F.lit(name) for name in BASE_FEATURES])
    return F.array_distinct(F.concat(base, features))


def lookup(jobs: DataFrame, strategies: DataFrame) -> DataFrame:
    """Features of every (interval, strategy) asked for; an empty list where there are none."""
    found = jobs.join(F.broadcast(strategies), ["interval", "strategy"], "left")
    return found.withColumns(
        {
            "features": F.coalesce("features", F.array().cast("array<string>")),
            "force_features": F.coalesce("force_features", F.lit(False)),
        }
    )


def job_list(series: DataFrame, strategies: DataFrame) -> DataFrame:
    """Every series with every strategy of its bar size: one row per model to train."""
    return series.join(F.broadcast(strategies), "interval").select(
        "symbol", "interval", "strategy", "features", "force_features"
    )


def model_key(symbol: Column, interval: Column, features: Column) -> Column:
    return F.concat_ws("_", symbol, interval, F.replace(F.array_join(features, "_"), F.lit(" "), F.lit("")))


_WINDOWED = re.compile(r"^(.*)_(\d+)$")


def parse_feature(name: str) -> tuple[str, int | None]:
    """``"rsi_14"`` is ``("rsi", 14)``; a name without a window is returned whole."""
    match = _WINDOWED.match(name)
    return (match.group(1), int(match.group(2))) if match else (name, None)


def parsed_features(strategies: DataFrame) -> DataFrame:
    """One row per feature of the catalogue, split into indicator and window."""
    pattern = r"^(.*)_(\d+)$"
    exploded = strategies.select("interval", "strategy", F.posexplode("features").alias("position", "feature"))
    window = F.regexp_extract("feature", pattern, 2)
    return exploded.select(
        "interval",
        "strategy",
        "position",
        "feature",
        F.when(window != "", F.regexp_extract("feature", pattern, 1)).otherwise(F.col("feature")).alias("indicator"),
        F.when(window != "", window).cast("int").alias("window"),
    )


def existing_features(df: DataFrame, features: list[str]) -> list[str]:
    """The requested features that the table has, in the requested order."""
    present = set(df.columns)
    return [name for name in features if name in present]
