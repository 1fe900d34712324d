"""Indicators against pandas expressions, edge series, and block-size independence."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import indicators as ind
from barloom.operators.blocks import BLOCK, KEYS, TIME, with_bar_index
from barloom.operators.recurrence import chunk_bars, decay, reach_bars, with_sar
from barloom.plans import features as sets
from barloom.plans.strategies import STRATEGY_FEATURES, strategy_features

KEY = [*KEYS, TIME]


def per_series(frame: pd.DataFrame, columns) -> pd.DataFrame:
    parts = []
    for _, g in frame.sort_values(KEY).groupby(list(KEYS)):
        g = g.reset_index(drop=True)
        parts.append(pd.concat([g[KEY], pd.DataFrame(columns(g))], axis=1))
    return pd.concat(parts, ignore_index=True)


def assert_same(ours: pd.DataFrame, expected: pd.DataFrame, tolerance: float = 1e-8):
    both = ours.merge(expected, on=KEY, suffixes=("", "_expected"))
    assert len(both) == len(ours) == len(expected)
    for name in [c for c in expected.columns if c not in KEY]:
        a, b = both[name].to_numpy("float64"), both[f"{name}_expected"].to_numpy("float64")
        assert (np.isnan(a) == np.isnan(b)).all(), name
        assert np.nanmax(np.abs(a - b), initial=0.0) <= tolerance, name


def reference(g: pd.DataFrame) -> dict:
    c, h, lo, v = g.close, g.high, g.low, g.volume
    change = c.diff()
    up, down = change.clip(lower=0).fillna(0), (-change).clip(lower=0).fillna(0)
    mean_up, mean_down = up.rolling(14).mean(), down.rolling(14).mean()
    widest = np.fmax(h - lo, np.fmax((h - c.shift()).abs(), (lo - c.shift()).abs()))
    tr14 = widest.rolling(14).mean()
    plus = 100 * h.diff().clip(lower=0).fillna(0).rolling(14).mean() / tr14
    minus = 100 * (-lo.diff()).clip(lower=0).fillna(0).rolling(14).mean() / tr14
    k = 100 * (c - lo.rolling(14).min()) / (h.rolling(14).max() - lo.rolling(14).min())
    mid = {n: (h.rolling(n).max() + lo.rolling(n).min()) / 2 for n in (9, 26, 52)}
    fast, slow = c.ewm(span=12, adjust=False).mean(), c.ewm(span=26, adjust=False).mean()
    return {
        "ema_3": c.ewm(span=3, adjust=False).mean(),
        "ema_200": c.ewm(span=200, adjust=False).mean(),
        "macd": fast - slow,
        "macd_signal": (fast - slow).ewm(span=9, adjust=False).mean(),
        "atr_14": tr14,
        "std_20": c.rolling(20).std(),
        "bollinger_hband": c.rolling(20).mean() + 2 * c.rolling(20).std(),
        "rsi_14": 100 - 100 / (1 + mean_up / mean_down),
        "stoch_k_14": k,
        "stoch_d_14": k.rolling(3).mean(),
        "momentum_10": c.diff(10),
        "roc_10": 100 * (c / c.shift(10) - 1),
        "adx": (100 * (plus - minus).abs() / (plus + minus)).rolling(14).mean(),
        "tenkan_sen_9": mid[9],
        "senkou_span_a": ((mid[9] + mid[26]) / 2).shift(26),
        "senkou_span_b": mid[52].shift(26),
        "vwap": (v * (h + lo + c) / 3).cumsum() / v.cumsum(),
    }


FEATURES = list(reference(pd.DataFrame({n: [1.0] for n in ("close", "high", "low", "volume")})))


@pytest.mark.parametrize("block_bars", [32768, 50])
def test_features_equal_pandas(bars, block_bars):
    ours = sets.add_indicators(bars, FEATURES, fill=False, side_columns=False, block_bars=block_bars).toPandas()
    assert_same(ours, per_series(bars.toPandas(), reference))


def test_fill_equals_pandas_across_blocks(bars):
    names = ["senkou_span_b", "std_20", "vwap"]
    ours = sets.add_indicators(bars, names, side_columns=False, block_bars=16).toPandas()
    expected = per_series(bars.toPandas(), lambda g: {n: reference(g)[n].bfill() for n in names})
    assert_same(ours, expected)


def test_windowed_macd_equals_pandas(bars):
    def expected(g):
        fast = g.close.ewm(span=12, min_periods=12).mean()
        slow = g.close.ewm(span=26, min_periods=26).mean()
        return {"macd": fast - slow, "macd_signal": (fast - slow).ewm(span=9, min_periods=9).mean()}

    for block_bars in (32768, 64):
        ours = ind.apply_steps(bars, ind.windowed_macd(), ["macd", "macd_signal"], block_bars).toPandas()
        assert_same(ours, per_series(bars.toPandas(), expected))


def test_bar_index_counts_bars_in_any_block_size(bars):
    for block_bars in (32768, 7):
        found = with_bar_index(bars, block_bars).toPandas().sort_values(KEY)
        assert (found["bar_index"].to_numpy() == found.groupby(list(KEYS)).cumcount().to_numpy()).all()


def walk(highs, lows):
    """Plain statement of the recurrence, one bar at a time."""
    out, extreme, stop, rising, speed = [None], highs[0], lows[0], True, 0.02
    for high, low in zip(highs[1:], lows[1:]):
        stop = stop + speed * (extreme - stop)
        if rising and low < stop:
            stop, extreme, rising, speed = extreme, low, False, 0.02
        elif not rising and high > stop:
            stop, extreme, rising, speed = extreme, high, True, 0.02
        speed = speed + 0.02 if speed < 0.2 else speed
        out.append(stop)
    return out


def test_sar_walks_every_series(bars):
    ours = with_sar(bars).select(*KEY, "sar").toPandas()
    assert_same(ours, per_series(bars.toPandas(), lambda g: {"sar": np.array(walk(g.high.tolist(), g.low.tolist()), dtype=float)}), 0.0)


def test_sar_state_survives_small_batches(spark, bars):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    whole = with_sar(bars).select(*KEY, "sar", "bar_index").toPandas()
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        cut = with_sar(bars).select(*KEY, "sar", "bar_index").toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    pd.testing.assert_frame_equal(whole.sort_values(KEY, ignore_index=True), cut.sort_values(KEY, ignore_index=True))


def series(spark, closes, volumes=None, name="A"):
    times = pd.date_range("2024-01-01", periods=len(closes), freq="h")
    frame = pd.DataFrame({"symbol": name, "interval": "1h", TIME: times})
    for column in ("open", "high", "low", "close"):
        frame[column] = np.asarray(closes, dtype=float)
    frame["volume"] = np.asarray(volumes if volumes is not None else np.ones(len(closes)), dtype=float)
    return spark.createDataFrame(frame)


def column(df, name):
    return df.orderBy(TIME).toPandas()[name].to_numpy("float64")


def test_constant_price_has_no_strength_and_no_position(spark):
    found = sets.add_indicators(series(spark, [5.0] * 40), ["rsi_14", "stoch_k_14"])
    assert np.isnan(column(found, "rsi_14")).all() and np.isnan(column(found, "stoch_k_14")).all()


def test_rising_price_has_full_strength(spark):
    assert (column(sets.add_indicators(series(spark, range(1, 41)), ["rsi_14"]), "rsi_14") == 100.0).all()


def test_vwap_starts_with_the_first_volume(spark):
    found = sets.add_indicators(series(spark, [1, 2, 4, 8], [0, 0, 1, 1]), ["vwap"])
    assert column(found, "vwap").tolist() == [4, 4, 4, 6]


def test_zero_price_gives_no_rate(spark):
    found = sets.add_indicators(series(spark, [0, 1, 2, 3]), ["roc_1"], fill=False)
    assert np.isnan(column(found, "roc_1")[:2]).all() and column(found, "roc_1")[2] == 100.0


def test_series_shorter_than_the_window_stays_empty(spark):
    assert np.isnan(column(sets.add_indicators(series(spark, [1, 2, 3]), ["std_20"]), "std_20")).all()


def test_sar_speed_may_pass_its_ceiling_by_one_step(spark):
    closes = np.linspace(100, 200, 60)
    found = with_sar(series(spark, closes))
    assert np.allclose(column(found, "sar")[1:], np.array(walk(closes.tolist(), closes.tolist())[1:], dtype=float), atol=0)


@pytest.mark.parametrize("span", [2, 3, 9, 12, 26, 50, 200, 2000])
def test_chunk_weights_stay_inside_doubles(span):
    size = chunk_bars(span)
    assert decay(span) ** -size < 1e250 and decay(span) ** size < 1e-40
    assert decay(span) ** reach_bars(span) < 1e-19


def test_every_strategy_feature_is_computed(bars):
    for interval in ("5m", "1h", "4h", "1d"):
        for strategy in STRATEGY_FEATURES:
            wanted = strategy_features(interval, strategy)["features"]
            assert set(wanted) <= set(sets.add_indicators(bars, wanted).columns)


def test_one_exchange_and_one_sort_serve_all_windows(spark, bars):
    """Rolling, exponential and nested windows of a block share partitioning and order."""
    found = ind.apply_steps(
        with_bar_index(bars), [*ind.macd("ema_12", "ema_26"), *ind.rsi("close", 14, "rsi_14"), *ind.adx(14, "adx")],
        ["macd_signal", "rsi_14", "adx"],
    )
    plan = found._jdf.queryExecution().sparkPlan().toString()
    executed = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") > 5
    by_block = [line for line in executed.splitlines() if "Exchange hashpartitioning" in line and "bar_block" in line]
    sorts = [line for line in executed.splitlines() if "Sort [" in line and "bar_block" in line]
    assert len(by_block) == 1 and len(sorts) == 1


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ")[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line]


STRATEGY_LISTS = [strategy_features(i, s)["features"] for i in ("1h", "1d") for s in STRATEGY_FEATURES]


@pytest.mark.parametrize("features", [["ema_200"], ["ema_12", "ema_200"], *STRATEGY_LISTS], ids=lambda f: "-".join(f[-3:]))
def test_rows_move_twice_at_most(bars, features):
    """Once for positions, once into blocks; the other exchanges carry a row per block."""
    if "sar" in features:
        features = [f for f in features if f != "sar"]
    found = sets.add_indicators(bars, features, fill=False)
    moved = [e for e in exchanges(found) if "REPARTITION" in e or "_span" in e]
    by_block = [e for e in moved if "REPARTITION" in e]
    assert len(by_block) == 1
    # Positions: partial counts by span, and the rows once.
    assert len([e for e in moved if "_span" in e]) <= 3


def gappy(g: pd.DataFrame) -> pd.DataFrame:
    out = g.copy()
    out.loc[out.index % 11 == 3, "close"] = np.nan
    out.loc[out.index % 13 == 6, "low"] = np.nan
    out.loc[out.index < 2, "close"] = np.nan
    return out


@pytest.mark.parametrize("block_bars", [32768, 512])
def test_missing_prices_are_what_they_are_in_pandas(spark, bars, block_bars):
    names = ["ema_3", "ema_12", "macd", "macd_signal", "sma_20", "std_20", "stoch_k_14", "stoch_d_14", "tenkan_sen_9", "vwap"]
    frame = pd.concat([gappy(g.sort_values(KEY).reset_index(drop=True)) for _, g in bars.toPandas().groupby(list(KEYS))])

    def expected(g):
        c, h, lo, v = g.close, g.high, g.low, g.volume
        k = 100 * (c - lo.rolling(14).min()) / (h.rolling(14).max() - lo.rolling(14).min())
        fast, slow = c.ewm(span=12, adjust=False).mean(), c.ewm(span=26, adjust=False).mean()
        return {
            "ema_3": c.ewm(span=3, adjust=False).mean(), "ema_12": fast, "macd": fast - slow,
            "macd_signal": (fast - slow).ewm(span=9, adjust=False).mean(), "sma_20": c.rolling(20).mean(), "std_20": c.rolling(20).std(),
            "stoch_k_14": k, "stoch_d_14": k.rolling(3).mean(), "tenkan_sen_9": (h.rolling(9).max() + lo.rolling(9).min()) / 2,
            "vwap": (v * (h + lo + c) / 3).cumsum() / v.cumsum(),
        }

    holes = spark.createDataFrame(frame.astype({"close": object, "low": object}).where(frame.notna(), None), bars.schema)
    ours = sets.add_indicators(holes, names, fill=False, side_columns=False, block_bars=block_bars).toPandas()
    assert_same(ours, per_series(frame, expected))


def test_an_average_of_next_to_nothing_fails(spark):
    rows = series(spark, np.zeros(34_000))
    holes = rows.withColumn("close", F.when(F.hour(TIME) % 12 == 0, 1.0))
    assert ind.apply_steps(holes, ind.ema("close", 12, "x"), ["x"]).where("abs(x - 1) < 1e-9").count() == 34_000
    with pytest.raises(Exception, match="too many missing values"):
        ind.apply_steps(holes, ind.ema("close", 200, "x"), ["x"]).collect()


def test_unknown_feature_is_refused(bars):
    with pytest.raises(ValueError):
        sets.add_indicators(bars, ["no_such_thing"])
    with pytest.raises(ValueError):
        ind.apply_steps(bars, ind.sma("nothing", 3, "x"), ["x"])
    assert BLOCK not in sets.add_indicators(bars, ["sma_3"]).columns


def test_time_filter_reaches_the_scan(spark, bars):
    from barloom.sources.bars import bars_in_range

    plan = bars_in_range(bars, "2024-01-02|2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_timestamp" in plan.replace("PushedFilters: [", "") and "open" not in plan.split("ReadSchema")[1]
