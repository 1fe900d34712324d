"""Feature sets over bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalar import day_of_week
from barloom.operators import indicators as ind
from barloom.operators.blocks import BLOCK, BLOCK_BARS, INDEX, TIME
from barloom.operators.recurrence import with_sar
from barloom.operators.scaling import min_max_scaled
from barloom.plans.strategies import parse_feature

RAW = ("open", "high", "low", "close", "volume")


def steps_for(feature: str) -> tuple[list[ind.Step], list[str]]:
    """Steps of a feature name and the columns it adds (the feature and its side columns)."""
    indicator, window = parse_feature(feature)
    if feature in RAW:
        return [], []
    if feature in ("macd", "macd_signal"):
        return ind.macd("ema_12", "ema_26"), ["ema_12", "ema_26", "macd", "macd_signal"]
    if feature == "vwap":
        return ind.vwap(), ["vwap"]
    if feature == "sar":
        return [], ["sar"]
    if feature == "senkou_span_a":
        parts = [*ind.mid_range(9, "tenkan_sen_9"), *ind.mid_range(26, "kijun_sen_26")]
        return [*parts, *ind.senkou_a(feature, "tenkan_sen_9", "kijun_sen_26")], ["tenkan_sen_9", "kijun_sen_26", feature]
    if feature == "senkou_span_b":
        return ind.senkou_b(feature), [feature]
    if feature == "adx" or (indicator == "adx" and window):
        side = ["plus_dm", "minus_dm", "tr", "plus_di", "minus_di", "dx"]
        return ind.adx(window or 14, feature), [*side, feature]
    if feature.startswith("bollinger_"):
        return _bollinger(feature, window or 20)
    if not window:
        raise ValueError(f"unknown feature: {feature!r}")
    if indicator == "ema":
        return ind.ema("close", window, feature), [feature]
    if indicator == "sma":
        return ind.sma("close", window, feature), [feature]
    if indicator == "std":
        return ind.deviation("close", window, feature), [feature]
    if indicator == "atr":
        return ind.atr(window, feature), ["tr", feature]
    if indicator == "rsi":
        return ind.rsi("close", window, feature), [feature]
    if indicator in ("stoch_k", "stoch_d"):
        names = [f"stoch_k_{window}", f"stoch_d_{window}"]
        return ind.stochastic(window, *names), names
    if indicator == "momentum":
        return ind.momentum(window, feature), [feature]
    if indicator == "roc":
        return ind.rate_of_change(window, feature, 100.0), [feature]
    if indicator in ("tenkan_sen", "kijun_sen"):
        return ind.mid_range(window, feature), [feature]
    raise ValueError(f"unknown feature: {feature!r}")


def _bollinger(feature: str, window: int) -> tuple[list[ind.Step], list[str]]:
    """Bare names use the plain columns; a name with a window gets columns of its own."""
    suffix = f"_{window}" if feature.endswith(f"_{window}") else ""
    names = [f"bollinger_{part}{suffix}" for part in ("mavg", "std", "hband", "lband")]
    if feature not in names:
        raise ValueError(f"unknown feature: {feature!r}")
    return ind.bollinger("close", window, *names), names


def add_indicators(
    bars: DataFrame,
    features: Sequence[str],
    fill: bool = True,
    side_columns: bool = True,
    extra: Sequence[ind.Step] = (),
    block_bars: int = BLOCK_BARS,
) -> DataFrame:
    """Compute exactly the requested features (and their side columns) for every series.

    ``fill`` back-fills the warm-up rows from the first value that follows. ``extra`` steps (labels)
    are computed in the same pass and are not filled.
    """
    steps, added = [], []
    for feature in dict.fromkeys(features):
        more, names = steps_for(feature)
        steps += more
        added += names if side_columns else [n for n in names if n == feature]
    added = list(dict.fromkeys(added))
    source = with_sar(bars) if "sar" in features else bars
    keep = [*added, *[step.name for step in extra if not step.name.startswith("_")]]
    computed = ind.apply_steps(source, [*steps, *extra], keep, block_bars)
    if not fill or not added:
        return computed.drop(BLOCK)
    return _filled(computed, steps, added, block_bars)


def _filled(computed: DataFrame, steps: Sequence[ind.Step], added: Sequence[str], block_bars: int) -> DataFrame:
    open_ended = ind.open_columns(steps, added, computed, block_bars)
    return ind.backfill(computed, added, open_ended, block_bars).drop(BLOCK)


# Feature lists of the signal, linear and boosted models.
SIGNAL_FEATURES = (
    "rsi", "macd", "macd_signal", "bollinger_hband", "bollinger_mavg", "bollinger_lband", "ema", "volatility",
    "price_rate_of_change",
)
LINEAR_FEATURES = ("sma_10", "ema_10", "rsi", "bollinger_high", "bollinger_low")
BOOSTED_FEATURES = ("time_index", "sma_10", "ema_10", "volatility")


def signal_features(bars: DataFrame, extra: Sequence[ind.Step] = (), block_bars: int = BLOCK_BARS) -> DataFrame:
    steps = [
        *ind.rsi("close", 14, "rsi"),
        *ind.windowed_macd(),
        *ind.bollinger("close", 20, "bollinger_mavg", "_band", "bollinger_hband", "bollinger_lband"),
        *ind.ema("close", 14, "ema"),
        *ind.deviation("close", 10, "volatility"),
        *ind.rate_of_change(1, "price_rate_of_change"),
    ]
    keep = [*SIGNAL_FEATURES, *[step.name for step in extra]]
    computed = ind.apply_steps(bars, [*steps, *extra], keep, block_bars)
    return _filled(computed, steps, SIGNAL_FEATURES, block_bars)


def linear_features(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    steps = [
        *ind.ema("close", 10, "ema_10"),
        *ind.rsi("close", 14, "rsi"),
        *ind.bollinger("close", 10, "sma_10", "_band", "bollinger_high", "bollinger_low"),
    ]
    computed = ind.apply_steps(bars, steps, LINEAR_FEATURES, block_bars)
    filled = _filled(computed, steps, LINEAR_FEATURES, block_bars)
    return filled.withColumns({"hour": F.hour(TIME), "day_of_week": day_of_week(F.col(TIME))})


def boosted_features(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Time index and three indicators of the close price scaled to [0, 1] per series."""
    scaled = min_max_scaled(bars, ["close"], suffix="_scaled")
    steps = [
        *ind.sma("close_scaled", 10, "sma_10"),
        *ind.ema("close_scaled", 10, "ema_10"),
        *ind.deviation("close_scaled", 10, "volatility"),
    ]
    computed = ind.apply_steps(scaled, steps, BOOSTED_FEATURES[1:], block_bars)
    filled = _filled(computed, steps, BOOSTED_FEATURES[1:], block_bars)
    return filled.withColumn("time_index", F.col(INDEX).cast("double"))
