"""Sources, ranks, labels, selection, balance and evaluation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.functions.scalar import bar_seconds, bar_seconds_col
from barloom.models import arima, linear
from barloom.operators import balance, evaluate, labels, ranking, scaling, selection
from barloom.operators.blocks import INDEX, KEYS, TIME
from barloom.plans import features as sets, strategies
from barloom.session import Workspace
from barloom.sources import bars as src, payloads, store

RELAXED = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


# --- sources -----------------------------------------------------------------------------------------


def test_payload_without_a_required_column_is_rejected(spark):
    import json
    import tempfile

    row = {TIME: 1704067200000, "open": 1, "high": 2, "low": 0.5, "close": 1.5, "volume": 3, "extra": "x"}
    lines = [
        {"symbol": "A", "interval": "1h", "data": {"rows": [row, {**row, "open": 9}]}},
        {"symbol": "B", "interval": "1h", "data": {"rows": [{k: v for k, v in row.items() if k != "low"}]}},
        {"symbol": "C", "interval": "1h", "data": {}},
        {"symbol": "D", "interval": "1h"},
    ]
    with tempfile.NamedTemporaryFile("w", suffix=".json", delete=False) as out:
        out.write("\n".join(json.dumps(line) for line in lines))
    found = payloads.first_arrivals(payloads.bars_from_payloads(payloads.read_bars_payloads(spark, out.name))).collect()
    assert [(r["symbol"], r["open"], r[TIME]) for r in found] == [("A", 1.0, dt.datetime(2024, 1, 1))]


def test_instruments_need_success_time_and_symbol(spark):
    listed = int(dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    recent = int(dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = [("OLD", listed), ("NEW", recent), ("ZERO", 0), ("NONE", None), (None, listed)]
    data = [(True, (rows,)), (False, ([("FAILED", listed)],))]
    frame = spark.createDataFrame(data, payloads.INSTRUMENTS_PAYLOAD)
    found = payloads.listed_symbols(frame, dt.datetime(2024, 4, 15))
    assert [r["symbol"] for r in found.collect()] == ["OLD"]


def test_append_twice_is_append_once(spark, bars):
    path = Workspace.current(spark).path("bars")
    part = bars.where("interval = '1h'")
    with_null = part.unionByName(part.limit(1).withColumn(TIME, F.lit(None).cast("timestamp")))
    for _ in range(2):
        store.append_bars(with_null, path)
    assert src.read_bars(spark, path).count() == part.count()
    pruned = src.one_series(src.read_bars(spark, path), "PERP_VIEW_USDC", "1h")
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()


def test_equal_tick_times_are_settled_by_sequence(spark):
    at = dt.datetime(2024, 1, 1, 0, 0, 1)
    ticks = spark.createDataFrame(
        [("A", at, 2, 20.0, 1.0), ("A", at, 1, 10.0, 1.0), ("A", at, 3, 15.0, 1.0)], "symbol string, ts timestamp, seq long, price double, amount double"
    )
    for bar in src.bars_from_ticks(ticks).collect():
        assert (bar["open"], bar["high"], bar["low"], bar["close"], bar["volume"]) == (10.0, 20.0, 10.0, 15.0, 3.0)


def test_ticks_are_aggregated_by_hash(spark, sf_dir):
    from verification import fixtures

    plan = src.bars_from_ticks(fixtures.ticks(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan


def test_row_limits_and_latest(bars):
    first = src.first_bars(bars).groupBy("interval", "symbol").count().toPandas()
    assert (first[first["interval"] == "4h"]["count"] <= 200).all()
    newest = src.first_bars(bars, 3, latest=True).groupBy(*KEYS).agg(F.max(TIME).alias("m"))
    assert newest.exceptAll(bars.groupBy(*KEYS).agg(F.max(TIME).alias("m"))).isEmpty()
    assert "WindowGroupLimit" in src.first_bars(bars)._jdf.queryExecution().executedPlan().toString()


def test_bar_sizes(spark):
    assert [bar_seconds(s) for s in ("5m", "1h", "4h", "1d")] == [300, 3600, 14400, 86400]
    frame = spark.createDataFrame([("5m",), ("1h",), ("4h",), ("1d",), ("x",), ("m5",)], "interval string")
    assert [r[0] for r in frame.select(bar_seconds_col(F.col("interval"))).collect()] == [300, 3600, 14400, 86400, None, None]
    with pytest.raises(ValueError):
        bar_seconds("h1")
    with pytest.raises(ValueError):
        src.bars_in_range(frame, "2024-01-01")


def test_strategies_need_features():
    with pytest.raises(ValueError):
        strategies.require_features("1h", "Nothing")
    assert strategies.strategy_features("3m", "Router")["features"] == []
    assert strategies.parse_feature("tenkan_sen_9") == ("tenkan_sen", 9)


# --- ranks and quantiles -----------------------------------------------------------------------------


@RELAXED
@given(st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=200))
def test_quantiles_and_ranks_are_exact(spark, values):
    frame = spark.createDataFrame([("g", float(v)) for v in values] + [("g", None)], "g string, v double")
    points = {"low": 0.15, "mid": 0.5, "high": 0.85, "first": 0.0, "last": 1.0}
    found = ranking.exact_quantiles(frame, ["g"], "v", points).first()
    for name, point in points.items():
        assert found[name] == pytest.approx(np.quantile(values, point), rel=1e-12, abs=1e-9)
    ranks = {r["v"]: r["n_below"] for r in ranking.value_ranks(frame, ["g"], "v", {"n": F.count(F.lit(1))}).collect()}
    ordered = sorted(values)
    assert ranks == {v: ordered.index(v) for v in set(values)}


@pytest.mark.parametrize("kind", ["distinct", "copies", "skewed"])
def test_bracketed_quantiles_are_exact(spark, kind):
    """Only values near the quantile are ranked, by any margin."""
    value = {"distinct": F.rand(3), "copies": F.floor(F.rand(3) * 7) * 1.0, "skewed": F.when(F.rand(4) < 0.4, 0.0).otherwise(F.exp(F.rand(3) * 20))}[kind]
    from barloom.session import stage

    frame = stage(spark.range(60000).select(F.lit("g").alias("g"), value.cast("double").alias("v")), "quantiles")
    points = {"low": 0.15, "mid": 0.5, "high": 0.85}
    values = frame.toPandas()["v"].to_numpy()
    for margin in (0, 2):
        found = ranking.exact_quantiles(frame, ["g"], "v", points, margin).first()
        assert [found[n] for n in points] == pytest.approx([np.quantile(values, p) for p in points.values()], rel=1e-13)


def test_a_bracket_that_misses_is_widened(spark, monkeypatch):
    frame = spark.createDataFrame([(g, float(i * i)) for g in "ab" for i in range(400)], "g string, v double")
    monkeypatch.setattr(ranking, "_ACCURACY", 3)  # a sketch that is far off
    monkeypatch.setattr(ranking, "_MARGINS", (1e-2, 2e-2, 3e-2, 1.0))
    found = ranking.exact_quantiles(frame, ["g"], "v", {"x": 0.37, "y": 0.9}).collect()
    values = [float(i * i) for i in range(400)]
    assert len(found) == 2
    for r in found:
        assert (r["x"], r["y"]) == pytest.approx((np.quantile(values, 0.37), np.quantile(values, 0.9)))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_ranks_are_read_from_what_is_written_once(bars):
    """Counts are made and placed once; what follows are partial sums and one exchange of distinct values."""
    rows = bars.select(*KEYS, "close", "volume", (F.col("volume") > 50).cast("int").alias("target"))
    assert exchanges(ranking.value_ranks(rows, KEYS, "close", {"n": F.count(F.lit(1))})) <= 2
    assert exchanges(selection.mutual_information(rows, ["close", "volume"], classes=(0, 1))) <= 4
    assert exchanges(evaluate.roc_auc(rows.withColumn("p", F.col("close")), {1: "p"})) <= 5
    assert exchanges(ranking.exact_quantiles(rows, KEYS, "close", {"a": 0.15, "b": 0.85})) == 0


# --- labels ------------------------------------------------------------------------------------------


def test_labels_do_not_depend_on_blocks(bars):
    whole = labels.with_three_way_target(labels.with_return(bars)).select(*KEYS, TIME, "return", "target")
    cut = labels.with_three_way_target(labels.with_return(bars, block_bars=5)).select(*KEYS, TIME, "return", "target")
    assert whole.exceptAll(cut).isEmpty() and cut.exceptAll(whole).isEmpty()
    last = whole.where(F.col("return").isNull())
    assert last.count() == bars.select(*KEYS).distinct().count() and last.where("target <> 0").isEmpty()


def test_look_back_windows_hold_the_preceding_values(bars):
    found = labels.look_back_windows(bars, 4, block_bars=8).toPandas()
    scaled = scaling.min_max_scaled(bars, ["close"]).toPandas().sort_values([*KEYS, TIME])
    per = {k: g["close"].tolist() for k, g in scaled.groupby(list(KEYS))}
    assert len(found) == sum(max(len(v) - 4, 0) for v in per.values())
    for row in found.sample(50, random_state=1).itertuples():
        values = per[row.symbol, row.interval]
        assert list(row.x) == values[row.bar_index - 4 : row.bar_index] and row.y == values[row.bar_index]


# --- scaling, selection ------------------------------------------------------------------------------


def test_constant_columns_scale_to_zero(spark):
    frame = spark.createDataFrame([("A", "1h", dt.datetime(2024, 1, d), 0.1, float(d)) for d in range(1, 9)], f"symbol string, interval string, {TIME} timestamp, c double, v double")
    for scaled in (scaling.min_max_scaled(frame, ["c", "v"]), scaling.standard_scaled(frame, ["c", "v"])):
        rows = scaled.orderBy(TIME).toPandas()
        assert (rows["c"] == 0.0).all() and rows["v"].is_monotonic_increasing
    assert rows["v"].std(ddof=0) == pytest.approx(1.0)


def test_correlations_of_columns_that_do_not_vary_are_null(spark):
    """Over the rows that have both: ``c`` never varies, ``g`` only where ``b`` is missing; B has one row, C no pair at all."""
    rows = [("A", float(i), 2.0 * i * i, 0.1, None if i == 7 else 3.0 * i, 5.0 if i < 7 else 9.0) for i in range(8)]
    rows += [("B", 1.0, 2.0, 3.0, 4.0, 5.0), ("C", None, 2.0, None, 4.0, None), ("C", 1.0, None, 3.0, None, 5.0), ("D", float("nan"), 1.0, 1.0, 2.0, 3.0), ("D", 1.0, 2.0, 3.0, 4.0, 5.0)]
    frame = spark.createDataFrame([(r[0], "1h", *r[1:]) for r in rows], "symbol string, interval string, a double, q double, c double, b double, g double")
    found = {(r["symbol"], r["earlier"], r["later"]): r["correlation"] for r in selection.correlations(frame, ["a", "q", "c", "b", "g"]).collect()}
    assert len(found) == 40
    x = np.arange(8.0)
    assert found["A", "a", "q"] == pytest.approx(np.corrcoef(x, 2 * x * x)[0, 1], abs=1e-12) and found["A", "a", "b"] == pytest.approx(1.0, abs=1e-12)
    assert found["A", "a", "g"] == pytest.approx(np.corrcoef(x, np.where(x < 7, 5.0, 9.0))[0, 1], abs=1e-12)
    assert found["A", "b", "g"] is None and all(v is None for k, v in found.items() if "c" in k[1:] and k[0] == "A")
    assert all(v is None for k, v in found.items() if k[0] in "BC") and found["D", "a", "q"] is None and found["D", "q", "g"] == pytest.approx(1.0)


def pairs(spark, rows):
    return spark.createDataFrame([("A", "1h", a, b, float(c)) for a, b, c in rows], "symbol string, interval string, earlier string, later string, correlation double")


def selected(spark, names):
    return spark.createDataFrame([("A", "1h", names)], "symbol string, interval string, features array<string>")


@pytest.mark.parametrize(
    "names, high, expected",
    [
        (["a", "close", "b"], [("a", "close", 0.99)], ["a", "b", "close"]),  # close is added back at the end
        (["close", "b", "c", "d"], [("close", "b", 0.99), ("close", "c", 0.99)], ["close", "b", "c"]),  # too few left
        (["b", "c", "d", "e"], [("a", "b", 0.999)], ["b", "c", "d", "e", "close"]),  # the earlier one is not selected
        (["close", "b"], [("close", "b", 0.98)], ["close", "b"]),  # the limit itself is allowed
    ],
)
def test_correlated_features_are_dropped(spark, names, high, expected):
    found = selection.uncorrelated_features(pairs(spark, high), selected(spark, names)).first()
    assert found["final_features"] == expected


def test_features_that_do_not_vary_are_no_reason_to_drop_others(spark):
    rows = [("A", "1h", float(i), i + 0.25, 0.0, float(i * i % 7)) for i in range(30)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, close double, high double, low double, volume double")
    names = ["close", "high", "low", "volume"]
    found = selection.uncorrelated_features(selection.correlations(frame, names), selected(spark, names)).first()
    assert found["final_features"] == ["close", "low", "volume"]


# --- balance -----------------------------------------------------------------------------------------


def points(spark, rows):
    data = [("A", "1h", int(label), i, [float(x) for x in p]) for i, (label, p) in enumerate(rows)]
    frame = spark.createDataFrame(data, "symbol string, interval string, target int, bar_index long, p array<double>")
    return frame.select("symbol", "interval", "target", "bar_index", *[F.col("p")[j].alias(f"f{j}") for j in range(len(rows[0][1]))])


def brute(points, k):
    out = {}
    for i, p in enumerate(points):
        d = [(round(float(np.sqrt(np.sum((p - q) ** 2))), 9), j) for j, q in enumerate(points) if j != i]
        out[i] = [j for _, j in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("kind", ["spread", "copies", "line", "corner"])
@pytest.mark.parametrize("cell_rows", [4, 16, 2048])
def test_neighbours_equal_brute_force(spark, kind, cell_rows):
    random = np.random.default_rng(5)
    made = {
        "spread": random.normal(size=(90, 3)),
        "copies": np.vstack([np.zeros((40, 3)), random.normal(size=(30, 3))]),
        "line": np.column_stack([np.arange(60.0), -np.arange(60.0), np.zeros(60)]),
        "corner": np.vstack([random.normal(size=(50, 3)), np.full((1, 3), 1e3)]),
    }[kind]
    members = balance.class_members(points(spark, [(1, p) for p in made]), ["f0", "f1", "f2"])
    found = balance.class_neighbours(members, cell_rows=cell_rows).toPandas().sort_values(["member", "rank"])
    ours = found.groupby("member")["neighbour"].apply(list).to_dict()
    assert ours == brute(made, 5)


def test_small_classes_use_all_their_rows(spark):
    rows = [(0, (float(i), 0.0)) for i in range(20)] + [(1, (float(i), 1.0)) for i in range(3)]
    even = balance.balanced(points(spark, rows), ["f0", "f1"]).toPandas()
    assert even.groupby("target").size().to_dict() == {0: 20, 1: 20}
    made = even[even["row_id"].str.startswith("s")]
    assert (made["f1"] == 1.0).all() and made["f0"].between(0, 2).all()
    assert even["row_id"].is_unique or even.groupby("target")["row_id"].apply(lambda s: s.is_unique).all()


def test_a_single_row_class_is_refused(spark):
    rows = [(0, (float(i),)) for i in range(5)] + [(1, (1.0,))]
    with pytest.raises(Exception, match="single row"):
        balance.synthetic_rows(points(spark, rows), ["f0"]).collect()


def test_weights_of_a_balanced_table_are_one(spark):
    rows = [(c, (float(i),)) for i in range(6) for c in (-1, 0, 1)]
    assert {r["weight"] for r in balance.balanced_weights(points(spark, rows)).collect()} == {1.0}


# --- evaluation --------------------------------------------------------------------------------------


def scored(spark, rows):
    return spark.createDataFrame(
        [("A", "1h", int(t), *[float(p) for p in ps], int(c)) for t, ps, c in rows], "symbol string, interval string, target int, a double, b double, c double, prediction int"
    )


SCORES = {-1: "a", 0: "b", 1: "c"}


def pair_area(rows, label):
    """Share of (positive, negative) pairs in the right order, ties half."""
    index = list(SCORES).index(label)
    wins = [
        1.0 if p[index] > n[index] else 0.5 if p[index] == n[index] else 0.0
        for t, p, _ in rows if t == label for u, n, _ in rows if u != label
    ]
    return sum(wins) / len(wins)


@RELAXED
@given(st.lists(st.tuples(st.sampled_from([-1, 0, 1]), st.tuples(*[st.integers(0, 4)] * 3), st.sampled_from([-1, 0, 1])), min_size=1, max_size=40))
def test_area_and_macro_scores(spark, rows):
    found = evaluate.classification_metrics(scored(spark, rows), SCORES).first()
    present = sorted({t for t, _, _ in rows})
    if len(present) < 2:
        assert found["roc_auc"] is None
    elif len(present) == 2:
        assert found["roc_auc"] == pytest.approx(pair_area(rows, present[1]))
    else:
        assert found["roc_auc"] == pytest.approx(np.mean([pair_area(rows, c) for c in present]))
    classes = sorted({t for t, _, _ in rows} | {c for _, _, c in rows})
    hits = {k: sum(t == c == k for t, _, c in rows) for k in classes}
    actual = {k: sum(t == k for t, _, _ in rows) for k in classes}
    said = {k: sum(c == k for _, _, c in rows) for k in classes}
    assert found["accuracy"] == pytest.approx(sum(hits.values()) / len(rows))
    assert found["precision"] == pytest.approx(np.mean([hits[k] / said[k] if said[k] else 0 for k in classes]))
    assert found["recall"] == pytest.approx(np.mean([hits[k] / actual[k] if actual[k] else 0 for k in classes]))
    assert found["f1_score"] == pytest.approx(np.mean([2 * hits[k] / (said[k] + actual[k]) for k in classes]))


def test_folds_are_even_per_class(spark, bars):
    rows = labels.complete_rows(labels.with_three_way_target(labels.with_return(bars)), ["return"])
    sizes = evaluate.stratified_folds(rows, [*KEYS, INDEX]).groupBy(*KEYS, "target", "fold").count().toPandas()
    spread = sizes.groupby([*KEYS, "target"])["count"].agg(["min", "max", "size"])
    assert (spread["max"] - spread["min"]).max() <= 1 or (spread["size"] < 5).any()
    assert ((spread["max"] - spread["min"]) <= 1).all()


def test_best_of_ignores_missing_scores_and_takes_the_first(spark):
    rows = [("A", "1h", 1, None), ("A", "1h", 2, 0.5), ("A", "1h", 3, 0.5), ("A", "1h", 4, float("nan")), ("B", "1h", 1, None)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, n int, score double")
    found = {r["symbol"]: r["n"] for r in evaluate.best_of(frame, F.col("score"), "n", ["n", "score"]).collect()}
    assert found == {"A": 2, "B": None}


def test_vote_prefers_the_earlier_class(spark):
    vote = evaluate.soft_vote([F.array(F.lit(0.2), F.lit(0.8)), F.array(F.lit(0.8), F.lit(0.2))])
    row = spark.range(1).select(vote.alias("v"), evaluate.most_likely(vote, (0, 1)).alias("c")).first()
    assert list(row["v"]) == [0.5, 0.5] and row["c"] == 0


# --- closed-form models ------------------------------------------------------------------------------


def test_linear_predictions_equal_least_squares(bars):
    rows = labels.complete_rows(sets.linear_features(bars), list(sets.LINEAR_FEATURES))
    found = linear.predict(rows, linear.fit(rows)).toPandas()
    for _, g in found.groupby(list(KEYS)):
        design = np.column_stack([g[f] for f in sets.LINEAR_FEATURES] + [np.ones(len(g))])
        low, high = design.min(0), design.max(0)
        design[:, :-1] = (design[:, :-1] - low[:-1]) / (high - low)[:-1]
        best = design @ np.linalg.lstsq(design, g["close"], rcond=None)[0]
        assert np.abs(best - g["prediction"]).max() < 1e-6 * g["close"].abs().max()


def test_unit_root_is_blind_to_blocks_and_tells_walks_from_noise(spark):
    random = np.random.default_rng(3)
    noise, walked = random.normal(10, 1, 400), 100 + np.cumsum(random.normal(0, 1, 400))
    rows = [(n, "1h", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(v)) for n, s in (("N", noise), ("W", walked)) for i, v in enumerate(s)]
    frame = spark.createDataFrame(rows, f"symbol string, interval string, {TIME} timestamp, close double")
    whole = {r["symbol"]: r for r in arima.unit_root(frame).collect()}
    cut = {r["symbol"]: r for r in arima.unit_root(frame, block_bars=32).collect()}
    assert whole["N"]["d"] == 0 and whole["W"]["d"] == 1
    assert cut["N"]["tau"] == pytest.approx(whole["N"]["tau"]) and cut["W"]["tau"] == pytest.approx(whole["W"]["tau"])


def test_order_search_finds_an_autoregression(spark):
    random = np.random.default_rng(9)
    values = [0.0, 0.0]
    for shock in random.normal(0, 1, 498):
        values.append(1.2 * values[-1] - 0.6 * values[-2] + shock)
    def sums(symbol, closes):
        times = pd.date_range("2024-01-01", periods=len(closes), freq="h")
        frame = pd.DataFrame({"symbol": symbol, "interval": "1h", TIME: times, "close": [float(c) for c in closes]})
        return arima.lagged_sums(spark.createDataFrame(frame))

    prices = sums("A", [50.0 + v for v in values])
    criteria = arima.order_criteria(prices).toPandas()
    assert len(criteria) == 36
    by_order = criteria.set_index(["p", "q"])["aic"]
    assert by_order[2, 0] < by_order[1, 0] < by_order[0, 0]
    best = arima.best_orders(arima.order_criteria(prices)).first()
    assert best["aic"] == pytest.approx(by_order.min())
    short = sums("B", [1.0, 2.0, 3.0])
    with pytest.raises(Exception, match="no order fits"):
        arima.require_orders(arima.best_orders(arima.order_criteria(short))).collect()


def test_information_of_a_copy_of_the_label(spark):
    rows = [("A", "1h", c, float(c), float(i % 7)) for i in range(300) for c in (-1, 0, 1)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, target int, same double, other double")
    found = {r["feature"]: r["information"] for r in selection.mutual_information(frame, ["same", "other"]).collect()}
    assert found["same"] == pytest.approx(np.log(3)) and found["other"] == pytest.approx(0.0, abs=1e-9)
