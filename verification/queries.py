"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalar import day_of_week, hash32, to_number
from barloom.models import arima, boosted, forest, linear, registry
from barloom.operators import balance, evaluate, indicators as ind, labels, scaling, selection
from barloom.operators.blocks import BLOCK, INDEX, KEYS, TIME, with_bar_index
from barloom.operators.recurrence import with_sar
from barloom.plans import features as sets, forests, strategies, training
from barloom.session import Workspace, for_local_runs, stage
from barloom.sources import bars as src, payloads, store
from barloom.streaming import ingest
from verification import fixtures as fx
from verification.oracle import SPANS, STRATEGY_QUERIES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BAR = (*KEYS, TIME)
_LANDED = T.StructType(payloads.BARS_PAYLOAD.fields + [T.StructField("landed", T.StructType().add("at", T.LongType()).add("seq", T.LongType()))])
ALL = (*BAR, "open", "high", "low", "close", "volume")
READ = (*BAR, "low", "high", "volume", "close")


def query(function: Query) -> Query:
    """Register a query. What it stages stays until ``release``: its result is read from it."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        Workspace(for_local_runs(spark), function.__name__)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def _path(spark: SparkSession, name: str) -> str:
    return Workspace.current(spark).path(name)


def r6(df: DataFrame, *keep: str) -> DataFrame:
    """The named columns, doubles to six places."""
    kinds = dict(df.dtypes)
    return df.select(*[(F.round(c, 6) + F.lit(0.0)).alias(c) if kinds[c] == "double" else F.col(c) for c in keep])


def steps(spark: SparkSession, sf_dir: str, parts: list[ind.Step], *keep: str) -> DataFrame:
    return r6(ind.apply_steps(fx.bars(spark, sf_dir), parts, keep), *BAR, *keep)


# --- sources, sinks, catalogue -------------------------------------------------------------------


@query
def bars_from_ticks(spark, sf_dir):
    return src.bars_from_ticks(fx.ticks(spark, sf_dir)).select(*ALL)


@query
def bars_in_range(spark, sf_dir):
    return src.bars_in_range(fx.bars(spark, sf_dir), "2024-01-08|2024-01-20").select(*READ)


@query
def first_bars(spark, sf_dir):
    return src.first_bars(fx.bars(spark, sf_dir)).select(*READ)


@query
def latest_bars(spark, sf_dir):
    return src.first_bars(fx.bars(spark, sf_dir), limit=200, latest=True).select(*READ)


@query
def bars_ordered(spark, sf_dir):
    return src.time_ordered(fx.bars(spark, sf_dir)).select(*BAR, "close")


@query
def bars_from_payloads(spark, sf_dir):
    """Every tick lands as a payload with one hourly row, so each hour arrives in many copies."""
    landed = _tick_payloads(spark, sf_dir).select(F.from_json("value", _LANDED).alias("p"))
    return payloads.first_arrivals(payloads.bars_from_payloads(landed.select("p.*"))).select(*ALL)


def _tick_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct(
        F.unix_millis(F.date_trunc("hour", "ts")).alias(TIME),
        *[F.col("price").alias(n) for n in ("open", "high", "low", "close")],
        F.col("amount").alias("volume"),
    )
    data = F.struct(F.array(row).alias("rows")).alias("data")
    text = F.to_json(F.struct("symbol", F.lit("1h").alias("interval"), data, F.struct(F.unix_micros("ts").alias("at"), "seq").alias("landed")))
    return fx.ticks(spark, sf_dir).select(text.alias("value"))


@query
def listed_symbols(spark, sf_dir):
    """Customers as instruments, listed when they first ordered; never ordered means no listing time."""
    customer, orders = (fx.table(spark, sf_dir, n) for n in ("customer", "orders"))
    first = orders.groupBy("o_custkey").agg(F.unix_millis(F.min("o_orderdate").cast("timestamp")).alias("created_time"))
    joined = customer.join(first, customer.c_custkey == first.o_custkey, "left")
    name = F.concat_ws("_", F.lit("PERP"), "c_mktsegment", "c_custkey")
    row = F.struct(name.alias("symbol"), F.coalesce("created_time", F.lit(0)).cast("long").alias("created_time"))
    landed = joined.select(F.lit(True).alias("success"), F.struct(F.array(row).alias("rows")).alias("data"))
    return payloads.listed_symbols(landed, F.lit("1995-06-01").cast("timestamp"))


def _stored_and_batch(spark, sf_dir):
    bars = fx.bars(spark, sf_dir).select(*ALL)
    return bars.where(F.col(TIME) < F.lit("2024-01-15").cast("timestamp")), bars


@query
def unseen_bars(spark, sf_dir):
    stored, batch = _stored_and_batch(spark, sf_dir)
    return store.unseen(batch, stored).select(*ALL)


@query
def appended_bars(spark, sf_dir):
    """The stored table after two appends of overlapping batches with conflicting copies, read back from files."""
    stored, batch = _stored_and_batch(spark, sf_dir)
    path = _path(spark, "bars")
    store.append_bars(_with_late_copies(stored), path)
    store.append_bars(_with_late_copies(batch), path)
    return src.read_bars(spark, path).select(*ALL)


def _with_late_copies(bars: DataFrame) -> DataFrame:
    """Every bar and a copy with other prices that arrived after it."""
    copies = bars.withColumns({"open": F.col("open") - 1.0, "close": F.col("close") / 2, "arrival": F.lit(1)})
    return copies.unionByName(bars.withColumn("arrival", F.lit(0)))


@query
def bars_without_null_time(spark, sf_dir):
    bars = fx.bars(spark, sf_dir).withColumn(TIME, F.when(F.col("volume") > 0, F.col(TIME)))
    return store.with_time(bars).select(*BAR, "close")


@query
def series_exist(spark, sf_dir):
    bars = fx.bars(spark, sf_dir)
    sizes = F.explode(F.array(*[F.lit(s) for s in ("5m", "1h", "4h", "1d")]))
    other = fx.table(spark, sf_dir, "customer").select(F.upper("c_mktsegment").alias("symbol")).distinct()
    asked = other.select("symbol", sizes.alias("interval")).unionByName(src.series(bars)).distinct()
    return src.series_exist(asked, bars).select(*KEYS, "found")


@query
def series_like(spark, sf_dir):
    return src.series_like(fx.bars(spark, sf_dir))


@query
def series_coverage(spark, sf_dir):
    found = src.coverage(fx.bars(spark, sf_dir))
    return found.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


def _jobs(spark, sf_dir):
    return strategies.job_list(src.series(fx.bars(spark, sf_dir)), strategies.strategy_table(spark))


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


@query
def model_keys(spark, sf_dir):
    key = strategies.model_key(F.col("symbol"), F.col("interval"), F.col("features"))
    return _jobs(spark, sf_dir).select(*KEYS, "strategy", key.alias("model_key"))


@query
def job_list(spark, sf_dir):
    return _jobs(spark, sf_dir).select(*KEYS, "strategy", _joined("features"), "force_features")


@query
def strategy_lookup(spark, sf_dir):
    names = F.explode(F.array(*[F.lit(n) for n in (*strategies.STRATEGY_FEATURES, "Unknown")]))
    asked = src.series(fx.bars(spark, sf_dir)).withColumn("strategy", names)
    found = strategies.lookup(asked, strategies.strategy_table(spark))
    return found.select(*KEYS, "strategy", _joined("features"), "force_features")


@query
def merged_features(spark, sf_dir):
    merged = _jobs(spark, sf_dir).withColumn("features", strategies.merged_features(F.col("features")))
    return merged.select(*KEYS, "strategy", _joined("features"), F.size("features").cast("long").alias("feature_count"))


@query
def parsed_features(spark, sf_dir):
    parsed = strategies.parsed_features(strategies.strategy_table(spark))
    series = src.series(fx.bars(spark, sf_dir))
    return series.join(F.broadcast(parsed), "interval").select(
        *KEYS, "strategy", "position", "feature", "indicator", F.coalesce("window", F.lit(0)).alias("window")
    )


# --- scalar functions ----------------------------------------------------------------------------


@query
def numbers_from_text(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        to_number(F.get_json_object("props", "$.k")).alias("k"),
        to_number(F.col("event_type")).alias("word"),
        to_number(F.col("value").cast("string")).alias("value"),
    )


@query
def times_from_epoch(spark, sf_dir):
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return fx.table(spark, sf_dir, "orders").select("o_orderkey", F.timestamp_millis(millis).alias("at"), millis.alias("millis"))


@query
def hour_and_weekday(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("hour"), day_of_week(F.col("ts")).alias("day_of_week"))


@query
def scaled_prices(spark, sf_dir):
    """Bars of ticks and daily bars of tax rates; only the latter are below one."""
    lines = fx.table(spark, sf_dir, "lineitem")
    taxes = lines.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.col("l_tax").alias("price"),
        F.col("l_quantity").alias("amount"),
    )
    both = fx.bars(spark, sf_dir).unionByName(src.bars_from_ticks(taxes, ["1d"]))
    return r6(src.scaled_prices(both), *BAR, "scaled_close")


@query
def bar_index(spark, sf_dir):
    return with_bar_index(fx.bars(spark, sf_dir)).select(*BAR, INDEX)


# --- windows -------------------------------------------------------------------------------------


@query
def lag_lead_difference(spark, sf_dir):
    parts = [
        ind.Step("prev_close", lambda rows: rows.lag("close"), ("close",), 1),
        ind.Step("next_close", lambda rows: rows.lead("close"), ("close",), ahead=1),
        ind.Step("change", lambda rows: F.col("close") - rows.lag("close"), ("close",), 1),
    ]
    return steps(spark, sf_dir, parts, "prev_close", "next_close", "change")


@query
def sma(spark, sf_dir):
    return steps(spark, sf_dir, [*ind.sma("close", 10, "sma_10"), *ind.sma("close", 20, "sma_20")], "sma_10", "sma_20")


@query
def rolling_deviation(spark, sf_dir):
    parts = [*ind.deviation("close", 20, "std_20"), *ind.deviation("close", 10, "volatility")]
    return steps(spark, sf_dir, parts, "std_20", "volatility")


@query
def rsi(spark, sf_dir):
    return steps(spark, sf_dir, ind.rsi("close", 14, "rsi_14"), "rsi_14")


@query
def bollinger(spark, sf_dir):
    names = ("bollinger_mavg", "bollinger_hband", "bollinger_lband")
    return steps(spark, sf_dir, ind.bollinger("close", 20, names[0], "_band", *names[1:]), *names)


@query
def true_range(spark, sf_dir):
    return steps(spark, sf_dir, ind.true_range(), "tr")


@query
def atr(spark, sf_dir):
    return steps(spark, sf_dir, ind.atr(14, "atr_14"), "atr_14")


@query
def stochastic(spark, sf_dir):
    return steps(spark, sf_dir, ind.stochastic(14, "stoch_k_14", "stoch_d_14"), "stoch_k_14", "stoch_d_14")


@query
def momentum(spark, sf_dir):
    return steps(spark, sf_dir, ind.momentum(10, "momentum_10"), "momentum_10")


@query
def rate_of_change(spark, sf_dir):
    parts = [*ind.rate_of_change(10, "roc_10", 100.0), *ind.rate_of_change(1, "price_rate_of_change")]
    return steps(spark, sf_dir, parts, "roc_10", "price_rate_of_change")


@query
def adx(spark, sf_dir):
    return steps(spark, sf_dir, ind.adx(14, "adx"), "plus_di", "minus_di", "dx", "adx")


@query
def tenkan_kijun(spark, sf_dir):
    parts = [*ind.mid_range(9, "tenkan_sen_9"), *ind.mid_range(26, "kijun_sen_26")]
    return steps(spark, sf_dir, parts, "tenkan_sen_9", "kijun_sen_26")


@query
def senkou_spans(spark, sf_dir):
    found = sets.add_indicators(fx.bars(spark, sf_dir), ["senkou_span_a", "senkou_span_b"], fill=False)
    return r6(found, *BAR, "senkou_span_a", "senkou_span_b")


@query
def vwap(spark, sf_dir):
    return steps(spark, sf_dir, ind.vwap(), "vwap")


@query
def backfill(spark, sf_dir):
    busy = ind.Step("busy", lambda rows: F.when(F.col("volume") > 60, F.col("volume")), ("volume",))
    computed = ind.apply_steps(fx.bars(spark, sf_dir), [*ind.senkou_b("senkou_span_b"), busy], ["senkou_span_b", "busy"])
    return r6(ind.backfill(computed, ["senkou_span_b", "busy"]), *BAR, "senkou_span_b", "busy")


@query
def ema(spark, sf_dir):
    names = [f"ema_{s}" for s in SPANS]
    return steps(spark, sf_dir, [p for s, n in zip(SPANS, names) for p in ind.ema("close", s, n)], *names)


@query
def macd(spark, sf_dir):
    return steps(spark, sf_dir, ind.macd("ema_12", "ema_26"), "macd", "macd_signal")


@query
def windowed_macd(spark, sf_dir):
    return steps(spark, sf_dir, ind.windowed_macd(), "macd", "macd_signal")


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of which some lack a close, a low or a volume."""

    def missing(name: str, modulus: int, rest: int) -> Column:
        return F.when(F.col(INDEX) % modulus != rest, F.col(name))

    bars = with_bar_index(fx.bars(spark, sf_dir))
    close = F.when((F.col(INDEX) % 19 != 4) & (F.col(INDEX) % 57 != 5), F.col("close"))
    return bars.withColumns({"close": close, "low": missing("low", 23, 5), "volume": missing("volume", 29, 7)})


@query
def gappy_windows(spark, sf_dir):
    names = ("sma_10", "std_20", "bollinger_hband", "stoch_k_14", "stoch_d_14", "tenkan_sen_9", "kijun_sen_26", "vwap", "atr_14", "rsi_14")
    found = sets.add_indicators(_gappy(spark, sf_dir), names, fill=False)
    return r6(found, *BAR, *names)


@query
def gappy_filled(spark, sf_dir):
    found = sets.add_indicators(_gappy(spark, sf_dir), ["sma_10", "vwap"], side_columns=False, block_bars=256)
    return r6(found, *BAR, "sma_10", "vwap")


@query
def gappy_averages(spark, sf_dir):
    parts = [*ind.macd("ema_12", "ema_26"), *ind.ema("close", 50, "ema_50")]
    names = ["ema_12", "ema_26", "ema_50", "macd", "macd_signal"]
    return r6(ind.apply_steps(_gappy(spark, sf_dir), parts, names, block_bars=2048), *BAR, *names)


@query
def gappy_windowed_macd(spark, sf_dir):
    return r6(ind.apply_steps(_gappy(spark, sf_dir), ind.windowed_macd(), ["macd", "macd_signal"]), *BAR, "macd", "macd_signal")


@query
def parabolic_sar(spark, sf_dir):
    return r6(with_sar(fx.bars(spark, sf_dir)), *BAR, "sar")


# --- feature sets --------------------------------------------------------------------------------


def _register_feature_query(name: str, features: list[str], intervals: list[str]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = fx.bars(spark, sf_dir).where(F.col("interval").isin(intervals))
        found = sets.add_indicators(bars, features)
        return r6(found, *BAR, INDEX, *[c for c in found.columns if c not in (*ALL, INDEX)])

    run.__name__ = name
    query(run)


for _name, (_features, _intervals) in STRATEGY_QUERIES.items():
    _register_feature_query(_name, _features, _intervals)


@query
def signal_features(spark, sf_dir):
    found = sets.signal_features(fx.bars(spark, sf_dir), labels.rises_next())
    return r6(found, *BAR, *sets.SIGNAL_FEATURES, "target")


@query
def linear_features(spark, sf_dir):
    return r6(sets.linear_features(fx.bars(spark, sf_dir)), *BAR, "hour", "day_of_week", *sets.LINEAR_FEATURES)


@query
def boosted_features(spark, sf_dir):
    return r6(sets.boosted_features(fx.bars(spark, sf_dir)), *BAR, *sets.BOOSTED_FEATURES, "close_scaled")


@query
def boosted_update_rows(spark, sf_dir):
    found = boosted.price_update_features(fx.bars(spark, sf_dir))
    return r6(found, *KEYS, *sets.BOOSTED_FEATURES, "close_scaled")


# --- labels --------------------------------------------------------------------------------------


def _returns(spark, sf_dir):
    return labels.with_return(fx.bars(spark, sf_dir))


def _labelled(spark, sf_dir):
    """Thresholds and rows both read the returns, so these are written once."""
    return labels.with_three_way_target(stage(_returns(spark, sf_dir), "returns"))


def _rows(spark, sf_dir):
    """Labelled rows that have a next bar, written once: most uses read them several times."""
    return stage(labels.complete_rows(_labelled(spark, sf_dir), ["return"]), "rows")


@query
def binary_labels(spark, sf_dir):
    return labels.binary_labels(fx.bars(spark, sf_dir)).select(*BAR, "target")


@query
def return_thresholds(spark, sf_dir):
    return r6(labels.return_thresholds(_returns(spark, sf_dir)), *KEYS, "lower_threshold", "upper_threshold")


@query
def three_way_labels(spark, sf_dir):
    return r6(_labelled(spark, sf_dir), *BAR, "return", "target")


@query
def label_distribution(spark, sf_dir):
    return labels.label_distribution(_labelled(spark, sf_dir))


def _with_average(spark, sf_dir):
    found = sets.add_indicators(fx.bars(spark, sf_dir), ["sma_20"], fill=False, extra=labels.next_return())
    return labels.with_three_way_target(found)


@query
def complete_rows(spark, sf_dir):
    return r6(labels.complete_rows(_with_average(spark, sf_dir)), *BAR, "sma_20", "target")


@query
def complete_in_subset(spark, sf_dir):
    wanted = strategies.existing_features(found := _with_average(spark, sf_dir), ["sma_20", "doji", "target"])
    return r6(labels.complete_rows(found, wanted), *BAR, *wanted)


@query
def look_back_windows(spark, sf_dir):
    found = labels.look_back_windows(fx.bars(spark, sf_dir))
    weighted = F.aggregate(
        F.transform("x", lambda v, i: v * (i + 1)), F.lit(0.0), lambda total, part: total + part
    )
    shown = found.withColumns(
        {"length": F.size("x"), "x_first": F.get("x", F.lit(0)), "x_last": F.get("x", F.lit(59)), "x_weighted": weighted}
    )
    return r6(shown, *BAR, INDEX, "y", "length", "x_first", "x_last", "x_weighted")


# --- feature engineering -------------------------------------------------------------------------


@query
def min_max_scaled(spark, sf_dir):
    found = scaling.min_max_scaled(fx.bars(spark, sf_dir), ["close", "volume"], suffix="_scaled")
    return r6(found, *BAR, "close_scaled", "volume_scaled")


@query
def standard_scaled(spark, sf_dir):
    found = scaling.standard_scaled(fx.bars(spark, sf_dir), ["close", "volume"], suffix="_scaled")
    return r6(found, *BAR, "close_scaled", "volume_scaled")


_CORRELATED = ["close", "high", "low", "volume", "sma_10", "sma_20"]


def _correlations(spark, sf_dir):
    averages = sets.add_indicators(fx.bars(spark, sf_dir), _CORRELATED, fill=False)
    return selection.correlations(averages, _CORRELATED)


@query
def correlations(spark, sf_dir):
    return r6(_correlations(spark, sf_dir), *KEYS, "earlier", "later", "correlation")


@query
def uncorrelated_features(spark, sf_dir):
    found = _correlations(spark, sf_dir)
    selected = found.select(*KEYS).distinct().withColumn("features", F.array(*[F.lit(n) for n in _CORRELATED]))
    return selection.uncorrelated_features(found, selected).select(*KEYS, _joined("final_features"))


_INFORMATIVE = ["close", "high", "low", "volume", "change"]


def _information(spark, sf_dir):
    change = ind.Step("change", lambda rows: F.coalesce(F.col("close") - rows.lag("close"), F.lit(0.0)), ("close",), 1)
    rows = ind.apply_steps(fx.bars(spark, sf_dir), [change, *labels.next_return()], ["change", "return"]).drop(BLOCK)
    labelled = stage(labels.complete_rows(labels.with_three_way_target(rows), ["return"]), "rows")
    return selection.mutual_information(labelled, _INFORMATIVE)


@query
def mutual_information(spark, sf_dir):
    return r6(_information(spark, sf_dir), *KEYS, "feature", "information")


@query
def informative_features(spark, sf_dir):
    found = selection.features_above(_information(spark, sf_dir), _INFORMATIVE)
    return found.select(*KEYS, "threshold", _joined("features"))


@query
def class_weights(spark, sf_dir):
    return r6(balance.balanced_weights(_rows(spark, sf_dir)), *KEYS, "target", "class_rows", "weight")


_SCALED = ["close_scaled", "volume_scaled"]


def _scaled_rows(spark, sf_dir):
    return scaling.standard_scaled(_rows(spark, sf_dir), ["close", "volume"], suffix="_scaled")


@query
def class_neighbours(spark, sf_dir):
    found = balance.class_neighbours(balance.class_members(_scaled_rows(spark, sf_dir), _SCALED), cell_rows=256)
    return r6(found, *KEYS, "target", "member", "rank", "neighbour", "distance")


@query
def synthetic_rows(spark, sf_dir):
    return r6(balance.synthetic_rows(_scaled_rows(spark, sf_dir), _SCALED), *KEYS, "target", "replica", *_SCALED)


# --- evaluation ----------------------------------------------------------------------------------

_SCORES = {-1: "p_neg", 0: "p_zero", 1: "p_pos"}


def scored_rows(spark, sf_dir):
    """Labelled rows with three scores drawn from the md5 of their key."""
    rows = _rows(spark, sf_dir)
    parts = [F.col(c).cast("string") for c in (*KEYS, INDEX)]
    drawn = rows.withColumns({f"_{t}": hash32(*parts, F.lit(t)) % 1000 + 1 for t in "abc"})
    total = F.col("_a") + F.col("_b") + F.col("_c")
    shares = drawn.withColumns({n: F.col(f"_{t}").cast("double") / total for t, n in zip("abc", _SCORES.values())})
    return shares.withColumn("prediction", evaluate.most_likely(F.array(*_SCORES.values()))).drop("_a", "_b", "_c")


def _folded(spark, sf_dir):
    return evaluate.stratified_folds(_rows(spark, sf_dir), [*KEYS, INDEX])


@query
def stratified_folds(spark, sf_dir):
    return _folded(spark, sf_dir).select(*BAR, "target", "fold")


@query
def accuracy(spark, sf_dir):
    return r6(evaluate.accuracy(scored_rows(spark, sf_dir)), *KEYS, "accuracy")


@query
def macro_scores(spark, sf_dir):
    return r6(evaluate.macro_scores(scored_rows(spark, sf_dir)), *KEYS, "accuracy", "precision", "recall", "f1_score")


@query
def roc_auc(spark, sf_dir):
    return r6(evaluate.roc_auc(scored_rows(spark, sf_dir), _SCORES), *KEYS, "roc_auc")


@query
def roc_auc_two_classes(spark, sf_dir):
    return r6(evaluate.roc_auc(scored_rows(spark, sf_dir).where("target <> 0"), _SCORES), *KEYS, "roc_auc")


@query
def roc_auc_one_class(spark, sf_dir):
    return r6(evaluate.roc_auc(scored_rows(spark, sf_dir).where("target = 0"), _SCORES), *KEYS, "roc_auc")


@query
def one_hot_labels(spark, sf_dir):
    hot = _rows(spark, sf_dir).withColumn("hot", evaluate.one_hot(F.col("target")))
    return hot.select(*BAR, *[F.get("hot", F.lit(i)).alias(n) for i, n in enumerate(("is_sell", "is_hold", "is_buy"))])


@query
def soft_vote(spark, sf_dir):
    one = F.array("p_neg", "p_zero", "p_pos")
    other = F.array("p_pos", "p_neg", "p_zero")
    voted = scored_rows(spark, sf_dir).withColumn("vote", evaluate.soft_vote([one, other]))
    shown = voted.withColumn("prediction", evaluate.most_likely(F.col("vote"))).withColumns(
        {n: F.get("vote", F.lit(i)) for i, n in enumerate(_SCORES.values())}
    )
    return r6(shown, *BAR, *_SCORES.values(), "prediction")


@query
def mean_squared_error(spark, sf_dir):
    bars = ind.apply_steps(fx.bars(spark, sf_dir), ind.next_value("close", "next_close"), ["next_close"])
    return r6(evaluate.mean_squared_error(bars, "next_close", "close"), *KEYS, "mse")


def _fold_scores(spark, sf_dir):
    folded = evaluate.stratified_folds(scored_rows(spark, sf_dir), [*KEYS, INDEX])
    return evaluate.fold_scores(folded.withColumn("candidate", F.col("prediction")), "candidate")


@query
def fold_scores(spark, sf_dir):
    return r6(_fold_scores(spark, sf_dir), *KEYS, "fold", "candidate", "labels", "score")


@query
def best_candidate(spark, sf_dir):
    means = evaluate.mean_score(_fold_scores(spark, sf_dir), [*KEYS, "candidate"])
    best = evaluate.best_of(means, F.col("mean_score"), "candidate", ["candidate", "mean_score"])
    return r6(best, *KEYS, "candidate", "mean_score")


# --- models --------------------------------------------------------------------------------------


@query
def unit_root(spark, sf_dir):
    return r6(arima.unit_root(fx.bars(spark, sf_dir)), *KEYS, "tau", "d")


@query
def candidate_orders(spark, sf_dir):
    return arima.candidate_orders(src.series(fx.bars(spark, sf_dir)))


@query
def arima_orders(spark, sf_dir):
    """Best order per series, over whole series."""
    orders = arima.best_orders(arima.order_criteria(stage(arima.lagged_sums(fx.bars(spark, sf_dir)), "sums")))
    return orders.select(*KEYS, "p", "d", "q", (F.round("aic", 3) + F.lit(0.0)).alias("aic"))


@query
def augmented_unit_root(spark, sf_dir):
    return r6(arima.augmented_unit_root(arima.lagged_sums(fx.bars(spark, sf_dir))), *KEYS, "tau", "d")


def _split(spark, sf_dir):
    jobs = _jobs(spark, sf_dir)
    registered = jobs.where(F.col("symbol").like("PERP%")).select(*registry.JOB_KEYS)
    return registry.split_jobs(jobs, registered)


@query
def jobs_to_update(spark, sf_dir):
    return _split(spark, sf_dir)[0].select(*registry.JOB_KEYS)


@query
def jobs_to_train(spark, sf_dir):
    return _split(spark, sf_dir)[1].select(*registry.JOB_KEYS)


@query
def linear_update_rows(spark, sf_dir):
    rows = sets.linear_features(fx.bars(spark, sf_dir))
    early = rows.where(F.col(TIME) <= F.lit("2024-01-15").cast("timestamp"))
    found = linear.training_rows(rows, scaling.min_max_statistics(early, sets.LINEAR_FEATURES))
    return r6(found, *BAR, "scaler", "close", *[f"{n}_scaled" for n in sets.LINEAR_FEATURES])


@query
def linear_predictions(spark, sf_dir):
    rows = sets.linear_features(fx.bars(spark, sf_dir))
    return r6(linear.predict(rows, linear.fit(rows)), *BAR, "close", "prediction")


@query
def forest_weights(spark, sf_dir):
    """Probabilities of a forest of 100 trees and one of 50 added by an update."""
    parts = [F.array("p_neg", "p_zero", "p_pos"), F.array("p_pos", "p_neg", "p_zero")]
    both = scored_rows(spark, sf_dir).withColumn("p", forest.weighted_probabilities(parts, [100, 50]))
    return both.select(*BAR, *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(_SCORES.values())])


# Small spaces: the queries show what training stores, not how good it gets.
_TREES = {"numTrees": (3, 5), "maxDepth": (2, 4)}
_BOOSTS = {"maxIter": (2, 4), "maxDepth": (2, 4)}
_RANGE = "2024-01-01|2030-01-01"


def _models(spark: SparkSession) -> registry.ModelStore:
    return registry.ModelStore(spark, _path(spark, "models"))


def _four_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.bars(spark, sf_dir).where("interval = '4h'")


def _strategy_runs(spark: SparkSession, sf_dir: str, runs: int, replace: bool = False) -> tuple[registry.ModelStore, str]:
    bars, models, metrics = _four_hours(spark, sf_dir), _models(spark), _path(spark, "metrics")
    jobs = strategies.job_list(src.series(bars), strategies.strategy_table(spark)).where("strategy = 'Volatility Breakout'")
    for _ in range(runs):
        training.train_strategies(
            bars, jobs, models, metrics, _RANGE, n_iter=1, folds=2, space=_TREES, new_trees=2, replace_metrics=replace
        )
    return models, metrics


@query
def strategy_models(spark, sf_dir):
    """Registered forests after a training and an update, as they are stored."""
    models, _ = _strategy_runs(spark, sf_dir, 2)
    found = []
    for r in models.registered("strategy").select(*registry.JOB_KEYS, "model_key", "features").collect():
        model = forest.GrowingForest.load(models, r["model_key"])
        grown = model.trees[1] == 2 and 3 <= model.trees[0] < 5
        found.append((*r, len(model.forests), grown, all(set(s) == set(r["features"]) for s in model.scalings)))
    schema = "symbol string, interval string, strategy string, model_key string, features array<string>, forests int, grown boolean, scaled boolean"
    rows = spark.createDataFrame(found, schema)
    return rows.withColumn("features", F.concat_ws(",", "features"))


@query
def metrics_written(spark, sf_dir):
    """Metrics rows of two runs, each in range and later than the run before."""
    _, metrics = _strategy_runs(spark, sf_dir, 2)
    names = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
    inside = F.lit(True)
    for name in names:
        inside = inside & F.col(name).between(0.0, 1.0)
    return store.read_metrics(spark, metrics).groupBy("asset", "interval", "strategy").agg(
        F.count(F.lit(1)).alias("runs"), F.count_distinct("timestamp").alias("times"), F.every(inside).alias("in_range")
    )


@query
def scored_strategies(spark, sf_dir):
    """What the stored forests say of every complete row: a probability of each class, and the likeliest class."""
    models, _ = _strategy_runs(spark, sf_dir, 1, replace=True)
    features = strategies.require_features("4h", "Volatility Breakout")["features"]
    rows = stage(training.strategy_rows(src.bars_in_range(_four_hours(spark, sf_dir), _RANGE), features), "rows")
    out = None
    for r in models.registered("strategy").select("symbol", "interval", "model_key").collect():
        scored = forest.GrowingForest.load(models, r["model_key"]).transform(training.of_series(rows, r))
        out = scored if out is None else out.unionByName(scored)
    whole = F.abs(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p) - 1.0) < 1e-9
    chosen = evaluate.most_likely(F.col("probability")) == F.col("prediction")
    return out.select(*BAR, "target", whole.alias("sums_to_one"), chosen.alias("likeliest"))


_FORESTS = {"trees": (2, 5), "depth": (2, 5), "min_split": (5, 20), "min_leaf": (2, 10), "subset": ["sqrt", "log2"]}


def _forest_run(spark: SparkSession, sf_dir: str, runs: int) -> tuple[DataFrame, DataFrame, registry.ModelStore, DataFrame]:
    """Forests of all series, bar sizes and strategies: five draws on two folds, then two trees more for each further run."""
    bars, models = fx.bars(spark, sf_dir), _models(spark)
    jobs = stage(strategies.job_list(src.series(bars), strategies.strategy_table(spark)), "jobs")
    for _ in range(runs):
        report = forests.train_forests(bars, jobs, models, _path(spark, "metrics"), _RANGE, n_iter=5, folds=2, space=_FORESTS, new_trees=2)
    return bars, jobs, models, report


@query
def forest_models(spark, sf_dir):
    """The report of every job after a training and an update of all forests, with what is stored of each."""
    _, _, models, report = _forest_run(spark, sf_dir, 2)
    trees_of = models.table("forests/nodes").groupBy("model").agg(F.count_distinct("fit").alias("runs"), F.count_distinct("fit", "tree").alias("trees"))
    fits = models.table("forests/fits").select("model", "has")
    stored = trees_of.join(fits, "model").withColumn("grown", (F.col("trees") == F.col("has")) & F.col("has").between(4, 6))
    found = report.withColumn("model", F.concat_ws("|", *registry.JOB_KEYS)).join(stored, "model", "left")
    inside = F.lit(True)
    for name in ("accuracy", "precision", "recall", "f1_score"):
        inside = inside & F.col(name).between(0.0, 1.0)
    return found.select(*registry.JOB_KEYS, "status", "model_key", "runs", "grown", inside.alias("in_range"))


@query
def scored_forests(spark, sf_dir):
    """What the stored forests of all jobs say of every complete row, in one job for all."""
    bars, jobs, models, _ = _forest_run(spark, sf_dir, 1)
    out = forests.score_forests(bars, jobs, models, _RANGE)
    whole = F.abs(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p) - 1.0) < 1e-9
    chosen = evaluate.most_likely(F.col("probability")) == F.col("prediction")
    return out.select(*registry.JOB_KEYS, TIME, "target", whole.alias("sums_to_one"), chosen.alias("likeliest"))


@query
def signal_models(spark, sf_dir):
    """Stored votes after a training and a refit, over the rows they were fitted on."""
    bars, models = _four_hours(spark, sf_dir), _models(spark)
    for _ in range(2):
        training.train_signals(bars, models, n_iter=1, folds=2, forest_space=_TREES, boosted_space=_BOOSTS)
    rows, out = stage(training.signal_rows(bars), "rows"), None
    for r in models.registered("signal").select(*KEYS, "model_key").collect():
        voted = training.predict_signals(training.of_series(rows, r), models, r).withColumn("version", F.lit(models.note(r["model_key"])["version"]))
        out = voted if out is None else out.unionByName(voted)
    vote = F.col("probability")
    good = (F.abs(vote[0] + vote[1] - 1.0) < 1e-9) & (F.col("prediction") == F.when(vote[1] > vote[0], 1).otherwise(0))
    return out.select(*BAR, "target", "version", good.alias("voted"))


def _boosted_facts(spark: SparkSession, models: registry.ModelStore, kind: str, rows: DataFrame) -> DataFrame:
    found = []
    for r in models.registered(kind).select(*KEYS, "model_key").collect():
        model = boosted.BoostedRegressor.load(models, r["model_key"])
        own = training.of_series(rows, r)
        mean = own.agg(F.avg("label")).first()[0]
        errors = model.transform(own).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)).alias("model"), F.avg(F.pow(F.col("label") - mean, 2)).alias("mean")).first()
        found.append((r["symbol"], r["interval"], models.note(r["model_key"])["version"], len(model.stages), own.count(), errors["model"] <= errors["mean"]))
    return spark.createDataFrame(found, "symbol string, interval string, version int, stages int, rows long, better_than_mean boolean")


@query
def look_back_models(spark, sf_dir):
    """Look-back models of all series after a training and one more boost."""
    bars, models = _four_hours(spark, sf_dir), _models(spark)
    for _ in range(2):
        training.train_look_back(bars, models, look_back=10, n_iter=1, folds=2, space=_BOOSTS)
    return _boosted_facts(spark, models, "look_back", boosted.look_back_rows(stage(labels.look_back_windows(bars, 10), "windows")))


@query
def price_models(spark, sf_dir):
    """Price models of all series after a training and a refit on one row more."""
    bars, models = _four_hours(spark, sf_dir), _models(spark)
    for _ in range(2):
        training.train_prices(bars, models, n_iter=1, folds=2, space=_BOOSTS)
    return _boosted_facts(spark, models, "price", boosted.price_rows(stage(boosted.price_update_features(bars), "rows")))


@query
def arima_history(spark, sf_dir):
    """Models trained on the first days and updated with the rest have seen every row of the whole series."""
    bars, models = fx.bars(spark, sf_dir).where("interval in ('5m', '1h')"), _models(spark)
    cut = F.lit("2024-01-12").cast("timestamp")
    training.train_arima(bars.where(F.col(TIME) < cut), models)
    kept = models.table("arima").select(*KEYS, F.col("p").alias("p0"), F.col("d").alias("d0"), F.col("q").alias("q0"))
    found = training.train_arima(bars.where(F.col(TIME) >= cut), models).join(kept, list(KEYS))
    same = (F.col("p") == F.col("p0")) & (F.col("d") == F.col("d0")) & (F.col("q") == F.col("q0"))
    return found.select(*KEYS, "rows", same.alias("order_kept"), F.col("aic").isNotNull().alias("fitted"))


# --- streaming -----------------------------------------------------------------------------------


@query
def streamed_bars(spark, sf_dir):
    """Hourly bars landed as files: the latest first, then all of them with late copies."""
    bars = src.bars_from_ticks(fx.ticks(spark, sf_dir), ["1h"]).select(*ALL)
    landing, path, progress = _path(spark, "landing"), _path(spark, "bars"), _path(spark, "progress")
    landed = _with_late_copies(bars)
    for part in (landed.where(F.col(TIME) >= F.lit("2024-01-15").cast("timestamp")), landed):
        part.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(landed.schema).parquet(landing)
        ingest.ingest_bars(arriving, path, progress).awaitTermination()
    return src.read_bars(spark, path).select(*ALL)


@query
def streamed_payload_bars(spark, sf_dir):
    """Payloads landed as JSON files, one per tick with one hourly row, streamed into the stored bars."""
    landing, path = _path(spark, "payloads"), _path(spark, "bars")
    _tick_payloads(spark, sf_dir).write.text(landing)
    arriving = spark.readStream.schema(_LANDED).json(landing)
    ingest.ingest_payloads(arriving, path, _path(spark, "progress")).awaitTermination()
    return src.read_bars(spark, path).select(*ALL)


@query
def streamed_tick_bars(spark, sf_dir):
    """Bars of all sizes from one scan of a tick stream, each once closed, then the last ones."""
    path = _path(spark, "tick-bars")
    ingest.ingest_ticks(_tick_stream(spark, sf_dir), path, _path(spark, "progress")).awaitTermination()
    ingest.close_open_bars(fx.ticks(spark, sf_dir), path)
    return src.read_bars(spark, path).select(*ALL)


@query
def streamed_closed_bars(spark, sf_dir):
    """What the tick stream has stored before its last bars are closed."""
    path = _path(spark, "tick-bars")
    ingest.ingest_ticks(_tick_stream(spark, sf_dir), path, _path(spark, "progress")).awaitTermination()
    return src.read_bars(spark, path).select(*ALL)


def _tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "events").schema
    return fx.ticks_of(spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))
