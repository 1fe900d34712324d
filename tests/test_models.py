"""Training runs on small spaces: train, update, registry, metrics, failures."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barloom.functions import kernels
from barloom.models import arima, boosted, forest, search
from barloom.models.forest import GrowingForest, new_tree_count
from barloom.models.registry import ModelStore, run_jobs
from barloom.operators.blocks import KEYS
from barloom.plans import strategies, training
from barloom.session import Workspace, stage
from barloom.sources import bars as src, store as tables

TREES = {"numTrees": (3, 5), "maxDepth": (2, 4)}
BOOSTS = {"maxIter": (2, 4), "maxDepth": (2, 4)}
RANGE = training.training_range(dt.date(2024, 2, 10))


@pytest.fixture(scope="module")
def hourly(spark, bars):
    few = bars.where("interval = '1h' and symbol like '%E%_USDC' and symbol like 'PERP_V%'")
    return Workspace(spark, "test-bars-hourly", innermost=False).stage(few, "hourly")


@pytest.fixture()
def models(spark, scratch):
    return ModelStore(spark, scratch.path("models"))


def statuses(report):
    return {r["status"] for r in report.collect()}


def test_sampled_parameters_repeat_and_respect_the_depth_limit():
    once, again = (search.sample_params(search.FOREST_SPACE, 50) for _ in range(2))
    assert once == again and once != search.sample_params(search.FOREST_SPACE, 50, seed=7)
    assert all(500 <= p["numTrees"] < 1500 and 20 <= p["maxDepth"] <= 30 for p in once)


def test_new_tree_count():
    assert [new_tree_count(n) for n in (10, 250, 251, 1000)] == [50, 50, 50, 200]


def test_strategy_model_is_trained_then_grown(spark, hourly, models):
    jobs = strategies.job_list(src.series(hourly), strategies.strategy_table(spark)).where("strategy = 'Momentum Reversal'")
    metrics = Workspace.current(spark).path("metrics")
    options = {"n_iter": 2, "folds": 2, "space": TREES, "new_trees": 2, "threshold_trees": 2}
    job = jobs.first()
    key = "trained_models/" + "_".join([job["symbol"], job["interval"], *job["features"]])
    assert not models.exists(key)
    for forests in (1, 2):
        assert statuses(training.train_strategies(hourly, jobs, models, metrics, RANGE, **options)) == {"ok"}
        found = GrowingForest.load(models, key)
        assert len(found.forests) == forests and found.features == job["features"]
    rows = tables.read_metrics(spark, metrics)
    assert rows.count() == 2 and rows.where("roc_auc between 0.5 and 1 and accuracy between 0 and 1").count() == 2
    scored = found.transform(training.strategy_rows(hourly, found.features)).select("prediction", "probability").collect()
    assert {r["prediction"] for r in scored} <= {-1, 0, 1}
    assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in scored)


def test_holdout_scores_the_latest_rows(spark, hourly, models):
    jobs = strategies.job_list(src.series(hourly), strategies.strategy_table(spark)).where("strategy = 'Volatility Breakout'")
    metrics = Workspace.current(spark).path("metrics")
    report = training.train_strategies(
        hourly, jobs, models, metrics, RANGE, n_iter=1, folds=2, space=TREES, holdout=0.25, replace_metrics=True
    )
    assert statuses(report) == {"ok"} and tables.read_metrics(spark, metrics).count() == 1


def test_signal_vote_is_trained_then_refitted(spark, hourly, models):
    for version in (0, 1):
        report = training.train_signals(hourly, models, n_iter=2, folds=2, forest_space=TREES, boosted_space=BOOSTS)
        assert statuses(report) == {"ok"}
        job = report.first()
        note = models.note(training.signal_key(job))
        assert note["version"] == version
    rows = training.predict_signals(training.signal_rows(hourly), models, job)
    assert rows.where("prediction not in (0, 1) or size(probability) <> 2").isEmpty()


def test_look_back_model_is_boosted_on(hourly, models, spark):
    sizes = []
    for _ in range(2):
        assert statuses(training.train_look_back(hourly, models, look_back=10, n_iter=2, folds=2, space=BOOSTS)) == {"ok"}
        job = hourly.select(*KEYS).first()
        sizes.append(len(boosted.BoostedRegressor.load(models, f"elliott_wave_models/{job['symbol']}_{job['interval']}").stages))
    assert sizes == [1, 2]


def test_boosting_on_lowers_the_error(spark):
    rows = spark.createDataFrame([([float(i % 13), float(i % 7)], float((i % 13) ** 2 + i % 7)) for i in range(300)], "x array<double>, y double")
    rows = stage(boosted.look_back_rows(rows), "boost")
    first = boosted.BoostedRegressor([boosted.regressor().setMaxIter(2).setMaxDepth(2).fit(rows)], {"maxIter": 2, "maxDepth": 2})

    def error(model):
        return model.transform(rows).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]

    assert error(first.continued(rows)) < error(first)


def test_technical_models_of_all_series(spark, hourly, models):
    for _ in range(2):
        assert statuses(training.train_technical(hourly, models, n_iter=2, folds=2, space=BOOSTS)) == {"ok"}
    series = hourly.select(*KEYS).distinct().count()
    assert models.table("linear").count() == series
    found = models.table("arima").collect()
    # Every row of both stretches, but for the first ones, whose lags reach before the series.
    assert len(found) == series and {r["rows"] for r in found} == {2 * hourly.count() - arima.LAGS - 1}


def test_updated_linear_models_keep_series_that_were_not_retrained(spark, bars, models):
    both = stage(bars.where("interval = '4h'"), "four-hours")
    training.train_linear(both, models)
    one = both.where("symbol = 'PERP_VIEW_USDC'")
    assert training.train_linear(one, models).count() == both.select(*KEYS).distinct().count()


def test_series_that_cannot_be_trained_do_not_stop_the_rest(spark, bars, models):
    """One series with a class of one row, one without complete rows: both are reported, the ordinary one is trained."""
    one = bars.where("interval = '4h' and symbol = 'PERP_VIEW_USDC'")
    constant = {c: F.lit(5.0) for c in ("open", "high", "low", "close")}
    later = F.col("start_timestamp") >= F.lit("2024-01-20").cast("timestamp")
    moves = one.withColumns({"symbol": F.lit("PERP_ONCE_USDC"), **constant}).withColumn("close", F.when(later, 6.0).otherwise(5.0))
    short = one.orderBy("start_timestamp").limit(9).withColumn("symbol", F.lit("PERP_SHORT_USDC"))
    mixed = stage(one.unionByName(moves).unionByName(short), "mixed")
    jobs = strategies.job_list(src.series(mixed), strategies.strategy_table(spark)).where("strategy = 'Volatility Breakout'")
    metrics = Workspace.current(spark).path("metrics")
    report = training.train_strategies(mixed, jobs, models, metrics, RANGE, n_iter=1, folds=2, space=TREES)
    assert {r["symbol"].split("_")[1]: r["status"] for r in report.collect()} == {
        "VIEW": "ok", "ONCE": "ValueError: a class with a single row cannot be balanced", "SHORT": "ValueError: no complete rows",
    }
    assert models.registered("strategy").count() == 1 == tables.read_metrics(spark, metrics).count()
    training.train_arima(mixed.where("symbol <> 'PERP_VIEW_USDC'").unionByName(one), models)
    assert "PERP_VIEW_USDC" in {r["symbol"] for r in models.table("arima").collect()}


JOBS = "symbol string, interval string, strategy string"


def test_one_failing_job_does_not_stop_the_rest(spark, scratch):
    jobs = spark.createDataFrame([("A", "1h", "x"), ("B", "1h", "x"), ("C", "1h", "x")], JOBS)

    def work(job):
        if job["symbol"] == "B":
            raise ValueError("no data")

    found = {r["symbol"]: r["status"] for r in run_jobs(spark, jobs, work, scratch.path("report")).collect()}
    assert found == {"A": "ok", "B": "ValueError: no data", "C": "ok"}


def test_forty_parallel_jobs_lose_nothing(spark, scratch, models):
    """Models are saved by the jobs, all in one store; metrics and registry have one writer."""
    jobs = spark.createDataFrame([(f"S{i}", "1h", "x") for i in range(40)], JOBS)
    data = spark.createDataFrame([([float(i)], float(i % 3)) for i in range(9)], "x array<double>, y double")
    rows = stage(boosted.look_back_rows(data), "rows")
    model = boosted.BoostedRegressor([boosted.regressor().setMaxIter(1).setMaxDepth(1).fit(rows)], {"maxIter": 1})

    def work(job):
        model.save(models, f"m_{job['symbol']}")
        return {"model_key": f"m_{job['symbol']}", "features": ["x"], "accuracy": 0.5, "roc_auc": 0.6}

    report = run_jobs(spark, jobs, work, scratch.path("report"), results=training.STRATEGY_RESULTS, parallelism=4, wave=16)
    metrics = scratch.path("metrics")
    tables.append_metrics(training.metrics_rows(report.where("status = 'ok'"), dt.datetime(2024, 1, 1)), metrics)
    models.register(report.withColumn("kind", F.lit("strategy")))
    assert report.where("status = 'ok'").count() == 40 == tables.read_metrics(spark, metrics).count()
    assert models.registered("strategy").where("size(features) = 1").count() == 40
    assert all(models.exists(f"m_S{i}") for i in range(40))


def test_no_jobs_give_an_empty_report(spark, scratch):
    report = run_jobs(spark, spark.createDataFrame([], JOBS), lambda job: None, scratch.path("report"), results="n int")
    assert report.columns == ["symbol", "interval", "strategy", "status", "n"] and report.count() == 0


def ols(target, columns):
    design = np.column_stack(columns)
    solution = np.linalg.lstsq(design, target, rcond=None)[0]
    rest = target - design @ solution
    return solution, rest, np.linalg.pinv(design.T @ design)


def lagged(values, lag, first):
    return values[first - lag : len(values) - lag]


def plain_dickey_fuller(x):
    d, first, best = np.diff(x), arima.LAGS, None
    for k in range(arima.LAGS + 1):
        y = d[first:]
        columns = [x[first:-1], *[lagged(d, i, first) for i in range(1, k + 1)], np.ones(len(y))]
        b, rest, inverse = ols(y, columns)
        aic = len(y) * np.log(rest @ rest / len(y)) + 2 * len(columns)
        if best is None or aic < best[0]:
            best = aic, b[0] / np.sqrt(inverse[0, 0] * (rest @ rest) / (len(y) - len(columns)))
    return best[1]


def plain_criterion(x, p, d, q):
    y = np.diff(x, d)
    first, m = arima.LAGS + 1 - d, arima.LONG_ORDER
    one = [] if d else [np.ones(len(y) - first)]
    b = ols(y[first:], [*one, *[lagged(y, i, first) for i in range(1, m + 1)]])[0]
    c, phi = (0.0, b) if d else (b[0], b[1:])
    shocks = np.array([y[t] - c - phi @ y[t - 1 : t - m - 1 : -1] if t > m else np.nan for t in range(len(y))])
    columns = [*one, *[lagged(y, i, first) for i in range(1, p + 1)], *[lagged(shocks, i, first) for i in range(1, q + 1)]]
    rest = ols(y[first:], columns)[1] if columns else y[first:]
    return len(rest) * (np.log(2 * np.pi * (rest @ rest) / len(rest)) + 1) + 2 * (len(columns) + 1)


def test_order_search_equals_regressions_over_whole_series(spark, bars):
    read = bars.where("interval = '1h' and symbol in ('PERP_VIEW_USDC', 'SPOT_SIGNUP_USDC')")
    sums = stage(arima.lagged_sums(read), "sums")
    tests = {r["symbol"]: r for r in arima.augmented_unit_root(sums).collect()}
    found = arima.order_criteria(sums).collect()
    prices = {s: g.sort_values("start_timestamp")["close"].to_numpy() for s, g in read.toPandas().groupby("symbol")}
    assert len(found) == 36 * len(prices)
    for symbol, x in prices.items():
        assert tests[symbol]["tau"] == pytest.approx(plain_dickey_fuller(x), rel=1e-6)
    for r in found[::5]:
        assert r["aic"] == pytest.approx(plain_criterion(prices[r["symbol"]], r["p"], r["d"], r["q"]), rel=1e-7)


def test_a_stretch_added_later_equals_the_whole_series(spark, bars):
    read = stage(bars.where("interval = '1h' and symbol = 'PERP_VIEW_USDC'"), "bars")
    cut = F.lit("2024-01-10").cast("timestamp")
    first = stage(arima.lagged_sums(read.where(F.col("start_timestamp") < cut)), "first")
    model = stage(arima.fitted(arima.best_orders(arima.order_criteria(first)), first), "model")
    later = arima.extended(model, arima.lagged_sums(read.where(F.col("start_timestamp") >= cut), model)).first()
    center = first.first()["center"]
    x = read.orderBy("start_timestamp").toPandas()["close"].to_numpy() - center
    table = kernels._lag_vectors(x, 0, arima.SIZE)
    assert later["rows"] == len(table) and np.allclose(later["sums"], (table.T @ table).ravel(), rtol=1e-9)


def test_forests_keep_the_scaling_they_were_fitted_under(spark):
    raw = spark.createDataFrame([(float(i), float(i % 5), (i % 3) - 1, 1.0) for i in range(60)], "a double, b double, target int, weight double")
    old, new = {"a": (30.0, 10.0), "b": (2.0, 1.5)}, {"a": (20.0, 4.0), "b": (1.0, 0.5)}

    def scaled(by):
        return raw.withColumns({f: (F.col(f) - m) / s for f, (m, s) in by.items()})

    first = forest.classifier().setNumTrees(3).fit(forest.assembled(scaled(old), ["a", "b"]))
    model = forest.GrowingForest(["a", "b"], [old], [first]).grown(scaled(new), new, trees=2)
    parts = [m.transform(forest.assembled(scaled(s), ["a", "b"])).select(vector_to_array("probability").alias("p")).collect() for m, s in zip(model.forests, [old, new])]
    for rows, by in ((raw, None), (scaled(new), new)):
        found = model.transform(rows, by).select("probability").collect()
        for f, a, b in zip(found, *parts, strict=True):
            assert f["probability"] == pytest.approx([(3 * x + 2 * y) / 5 for x, y in zip(a["p"], b["p"])])


def test_router_features_are_selected(spark, bars):
    rows = stage(training.strategy_rows(bars.where("interval = '4h' and symbol = 'PERP_VIEW_USDC'"), ["rsi_14", "std_20"]), "rows")
    features = ["close", "high", "low", "volume", "rsi_14", "std_20"]
    found = training.chosen_features(rows, features, False, folds=2, trees=2).first()["final_features"]
    assert "close" in found and set(found) <= set(features) and len(found) >= int(0.85 * 2)
