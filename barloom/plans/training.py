"""Training runs. Everything up to the fit is one plan over all series; only fits go one by one."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from barloom.models import arima, boosted, linear, search
from barloom.models.forest import SCORE_COLUMNS, GrowingForest, assembled, classifier, score_columns
from barloom.models.registry import JOB_KEYS, ModelStore, run_jobs
from barloom.operators import balance, evaluate, labels, scaling, selection
from barloom.operators.blocks import INDEX, KEYS
from barloom.operators.evaluate import CLASSES
from barloom.plans import features as sets
from barloom.plans.strategies import BASE_FEATURES, existing_features, model_key
from barloom.session import Workspace, stage
from barloom.sources.bars import bars_in_range, first_bars
from barloom.sources.store import append_metrics

FIRST_DAY = "2024-01-01"  # fixed value: start of the training range


def training_range(today: dt.date) -> str:
    """From the first day to today at midnight."""
    return f"{FIRST_DAY}|{today.isoformat()}"


def of_series(df: DataFrame, job: Row) -> DataFrame:
    return df.where((F.col("symbol") == job["symbol"]) & (F.col("interval") == job["interval"]))


# --- strategies ------------------------------------------------------------------------------------


def strategy_rows(bars: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """Indicators, next return and three-way target of every series, complete rows only."""
    rows = stage(sets.add_indicators(bars, features, extra=labels.next_return(), **options), "features")
    return labels.complete_rows(labels.with_three_way_target(rows))


def balanced_rows(rows: DataFrame, features: Sequence[str], folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Scaled, balanced, weighted rows with folds, and the scaling statistics they used."""
    features = list(features)
    statistics = scaling.standard_statistics(rows, features)
    scaled = stage(scaling.standard_scaled(rows, features, statistics=statistics), "scaled")
    even = stage(balance.balanced(scaled, features), "balanced")
    weights = balance.balanced_weights(even).drop("class_rows")
    # One row per series and class on the small side.
    weighted = even.join(weights, [*KEYS, "target"], "left")
    return evaluate.stratified_folds(weighted, [*KEYS, "row_id"], folds=folds), statistics


def tuned_thresholds(
    rows: DataFrame, features: Sequence[str], folds: int = 5, trees: int = 500, seed: int = search.SEED
) -> DataFrame:
    """Features of the best information threshold of every series; all features where none keeps two.

    Per threshold: scale, balance, and cross-validate a forest; the mean area over folds decides, the
    lower threshold wins a tie.
    """
    information = stage(selection.mutual_information(rows, features), "information")
    tried = selection.features_above(information, features)
    # Thresholds that keep the same features score the same; the lowest of them stands for all.
    candidates = stage(tried.groupBy(*KEYS, "features").agg(F.min("threshold").alias("threshold")), "thresholds")
    path = Workspace.current(rows.sparkSession).path("threshold-scores")
    for case in candidates.select("features").distinct().toLocalIterator():  # one row per feature list
        names = list(case["features"])
        jobs = candidates.where(F.col("features") == F.array(*[F.lit(n) for n in names])).select(*KEYS, "threshold")
        even, _ = balanced_rows(rows.join(jobs.select(*KEYS), list(KEYS), "left_semi"), names, folds)
        ready = stage(assembled(even, names), "folds")

        def one(job: Row, ready=ready) -> dict:
            return {"threshold": job["threshold"], "score": search.cross_validated(classifier(None, seed), {"numTrees": trees}, of_series(ready, job), search.area_score(CLASSES), folds)}

        run_jobs(rows.sparkSession, jobs, one, path, KEYS, "threshold double, score double")
    scored = rows.sparkSession.read.schema("symbol string, interval string, threshold double, score double").parquet(path)
    best = evaluate.best_of(scored, F.col("score"), "threshold", ["threshold"])
    chosen = candidates.join(best, [*KEYS, "threshold"], "left_semi").select(*KEYS, "features")
    everything = F.array(*[F.lit(f) for f in features])
    return rows.select(*KEYS).distinct().join(chosen, list(KEYS), "left").withColumn(
        "features", F.coalesce("features", everything)
    )


def chosen_features(rows: DataFrame, features: Sequence[str], force: bool, **tuning) -> DataFrame:
    """``final_features`` per series: all of them when forced, else selected from the data."""
    if force:
        named = F.array(*[F.lit(f) for f in features])
        return rows.select(*KEYS).distinct().withColumn("final_features", named)
    selected = tuned_thresholds(rows, features, **tuning)
    correlation = selection.correlations(rows, features)
    return selection.uncorrelated_features(correlation, selected).select(*KEYS, "final_features")


def scaling_of(statistics: DataFrame, job: Row, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = of_series(statistics, job).first()
    return {f: (row[f"_mean_{f}"], row[f"_deviation_{f}"]) for f in features}


def train_strategies(
    bars: DataFrame,
    jobs: DataFrame,
    store: ModelStore,
    metrics_path: str,
    values: str,
    n_iter: int = 200,
    folds: int = 5,
    space: dict = search.FOREST_SPACE,
    threshold_trees: int = 500,
    new_trees: int | None = None,
    holdout: float | None = None,
    replace_metrics: bool = False,
    parallelism: int = 4,
) -> DataFrame:
    """Train or update one forest per (symbol, interval, strategy) and report how each job went.

    Indicators, labels, scaling and balance of a strategy are computed for all its series together. A model
    is saved before anything is said about it; metrics and registry rows are written after each bar size and
    strategy, by one writer. Every job has a row in the report; one that fails leaves the others as they are. Metrics are in-sample on the balanced rows; with ``holdout`` that share of the latest rows
    is kept out of training and scored instead. With ``replace_metrics`` those of this run replace all older.
    """
    spark, path = bars.sparkSession, store.report_path("strategies")
    read = bars_in_range(bars, values)
    run_at = dt.datetime.now(dt.timezone.utc)
    keyed = jobs.withColumn("model_key", F.concat(F.lit("trained_models/"), model_key(F.col("symbol"), F.col("interval"), F.col("features"))))
    groups = jobs.select("interval", "strategy", "features", "force_features").distinct()
    replace = replace_metrics

    def finish(group: Row) -> None:
        """Metrics and registry rows of what a group has trained; a later group that fails takes nothing from it."""
        nonlocal replace
        of_group = (F.col("interval") == group["interval"]) & (F.col("strategy") == group["strategy"])
        report = run_jobs(spark, keyed.limit(0), lambda job: None, path, results=STRATEGY_RESULTS)
        done = report.where(of_group & (F.col("status") == "ok"))
        append_metrics(metrics_rows(done, run_at), metrics_path, replace)
        store.register(done.withColumn("kind", F.lit("strategy")))
        replace = False

    def refuse(job: Row) -> None:
        raise ValueError(job["problem"])

    for group in groups.toLocalIterator():  # at most one per bar size and strategy
        with Workspace(spark, "strategies"):
            mine = keyed.where((F.col("interval") == group["interval"]) & (F.col("strategy") == group["strategy"]))
            features = list(dict.fromkeys([*BASE_FEATURES, *group["features"]]))
            rows = stage(strategy_rows(read.join(mine.select(*KEYS), list(KEYS), "left_semi"), features), "strategy-rows")
            # Series that can't be balanced are reported, and the others go on without them.
            known = stage(job_problems(mine, rows.select(*KEYS, "target")), "problems")
            run_jobs(spark, known.where("problem is not null"), refuse, path, results=STRATEGY_RESULTS)
            mine = known.where("problem is null").drop("problem")
            if mine.isEmpty():
                continue
            rows = rows.join(mine.select(*KEYS), list(KEYS), "left_semi")
            kept, unseen = rows, None
            if holdout:
                length = rows.groupBy(*KEYS).agg((F.max(INDEX) * (1.0 - holdout)).alias("_end"))
                marked = rows.join(length, list(KEYS), "left")
                kept, unseen = marked.where(F.col(INDEX) <= F.col("_end")), marked.where(F.col(INDEX) > F.col("_end"))
            known = store.registered("strategy").select("model_key", F.col("features").alias("final_features"))
            updates = mine.join(known, "model_key").select(*JOB_KEYS, "model_key", "final_features", F.lit(True).alias("stored"))
            new = mine.join(known, "model_key", "left_anti")
            lists = updates
            if not new.isEmpty():
                some = kept.join(new.select(*KEYS), list(KEYS), "left_semi")
                chosen = chosen_features(some, features, group["force_features"], folds=folds, trees=threshold_trees)
                lists = lists.unionByName(new.join(chosen, list(KEYS)).select(*JOB_KEYS, "model_key", "final_features", F.lit(False).alias("stored")))
            lists = stage(lists, "jobs")
            # Series with the same feature list are scaled and balanced together.
            for case in lists.select("final_features").distinct().toLocalIterator():
                names = list(case["final_features"])
                work = lists.where(F.col("final_features") == F.array(*[F.lit(n) for n in names]))
                part = kept.join(work.select(*KEYS), list(KEYS), "left_semi")
                even, statistics = balanced_rows(part, names, folds)
                ready, statistics = stage(assembled(even, names), "training"), stage(statistics, "scaling")

                def one(job: Row, names=names, ready=ready, statistics=statistics, unseen=unseen) -> dict:
                    data, key = of_series(ready, job), job["model_key"]
                    scale = scaling_of(statistics, job, names)
                    plain = data.drop("features", "label")
                    if job["stored"]:
                        model = GrowingForest.load(store, key).grown(plain, scale, trees=new_trees)
                    else:
                        fitted, params = search.tuned(
                            classifier(), space, data, search.area_score(CLASSES), folds, n_iter, parallelism=parallelism
                        )
                        model = GrowingForest(names, [scale], [fitted], params)
                    model.save(store, key)
                    scored = model.transform(plain, scale) if unseen is None else model.transform(of_series(unseen, job))
                    found = evaluate.classification_metrics(score_columns(scored), SCORE_COLUMNS).first()
                    return {**(found.asDict() if found else {}), "model_key": key, "features": names}

                run_jobs(spark, work, one, path, results=STRATEGY_RESULTS, parallelism=parallelism)
        finish(group)
    return run_jobs(spark, keyed.limit(0), lambda job: None, path, results=STRATEGY_RESULTS)


def job_problems(jobs: DataFrame, rows: DataFrame) -> DataFrame:
    """``jobs`` with ``problem``: why the series of a job can't be trained on its complete ``rows``, or null."""
    counts = rows.groupBy(*KEYS, "target").agg(F.count(F.lit(1)).alias("n"))
    per_series = counts.groupBy(*KEYS).agg(F.min("n").alias("_least"), F.max("n").alias("_most"))
    single = F.when((F.col("_least") == 1) & (F.col("_most") > 1), "a class with a single row cannot be balanced")
    problem = F.when(F.col("_least").isNull(), "no complete rows").otherwise(single)
    return jobs.join(per_series, list(KEYS), "left").withColumn("problem", problem).drop("_least", "_most")


# What a training job reports beside its status.
STRATEGY_RESULTS = "model_key string, features array<string>, accuracy double, precision double, recall double, f1_score double, roc_auc double"


def metrics_rows(report: DataFrame, at: dt.datetime) -> DataFrame:
    """Rows of the metrics table from the report of a training run."""
    return report.select(
        F.col("symbol").alias("asset"), "interval", "strategy", "accuracy", "precision", "recall", "f1_score", "roc_auc", F.lit(at).alias("timestamp")
    )


# --- signals ---------------------------------------------------------------------------------------


def signal_rows(bars: DataFrame) -> DataFrame:
    """Signal features and the binary target of all bars given."""
    rows = sets.signal_features(bars, labels.rises_next())
    return labels.complete_rows(rows, [*existing_features(rows, list(sets.SIGNAL_FEATURES)), "target"])


def train_signals(
    bars: DataFrame,
    store: ModelStore,
    n_iter: int = 200,
    folds: int = 5,
    forest_space: dict = search.SIGNAL_FOREST_SPACE,
    boosted_space: dict = search.SIGNAL_BOOSTED_SPACE,
    parallelism: int = 4,
    rows: int | None = None,
    latest: bool = False,
) -> DataFrame:
    """Forest and boosted trees per series, combined by a soft vote; refitted when already stored.

    ``rows`` bounds the bars that a classifier learns from, per series: its oldest ones, or its newest with
    ``latest``. By default it learns from all of them.
    """
    spark = bars.sparkSession
    with Workspace(spark, "signals"):
        read = bars if rows is None else first_bars(bars, rows, latest)
        folded = evaluate.stratified_folds(stage(signal_rows(read), "signals"), [*KEYS, INDEX], folds=folds)
        ready = VectorAssembler(inputCols=list(sets.SIGNAL_FEATURES), outputCol="features").transform(
            folded.withColumn("label", F.col("target").cast("double"))
        )
        ready = stage(ready, "signal-rows")
        evaluator = search.accuracy_score()
        models = {
            "forest": (classifier(None), forest_space),
            "boosted": (GBTClassifier(featuresCol="features", labelCol="label", seed=search.SEED), boosted_space),
        }

        def one(job: Row) -> dict:
            data, key = of_series(ready, job), signal_key(job)
            parts, params = {}, {}
            for name, (estimator, space) in models.items():
                if job["stored"]:
                    params[name] = store.note(key)["params"][name]
                    parts[name] = estimator.fit(data, search.param_map(estimator, params[name]))
                else:
                    parts[name], params[name] = search.tuned(estimator, space, data, evaluator, folds, n_iter, parallelism=parallelism)
            store.save(key, parts, {"params": params, "features": list(sets.SIGNAL_FEATURES)})
            return {"model_key": key}

        return _run_series(spark, store, "signal", ready, one, parallelism)


def _run_series(spark: SparkSession, store: ModelStore, kind: str, rows: DataFrame, one: Callable[[Row], dict], parallelism: int) -> DataFrame:
    """Run one job per series of ``rows``, each told whether its model is ``stored``, and register what went well."""
    known = store.registered(kind).select(*KEYS, F.lit(True).alias("stored"))
    series = rows.select(*KEYS).distinct().join(known, list(KEYS), "left")
    work = series.withColumn("stored", F.coalesce("stored", F.lit(False)))
    report = run_jobs(spark, work, one, store.report_path(kind), KEYS, "model_key string", parallelism)
    done = report.where("status = 'ok'").withColumns({"kind": F.lit(kind), "strategy": F.lit(None), "features": F.lit(None)})
    store.register(done)
    return report


def signal_key(job: Row) -> str:
    return f"signal_models/{job['symbol']}_{job['interval']}_signal_model"


def predict_signals(rows: DataFrame, store: ModelStore, job: Row) -> DataFrame:
    """Probabilities and class of the stored vote."""
    readers = {"forest": RandomForestClassificationModel, "boosted": GBTClassificationModel}
    work = VectorAssembler(inputCols=list(sets.SIGNAL_FEATURES), outputCol="features").transform(rows)
    for name, reader in readers.items():
        model = store.load(signal_key(job), name, reader)
        model = model.setProbabilityCol(f"_p_{name}").setPredictionCol(f"_c_{name}").setRawPredictionCol(f"_r_{name}")
        work = model.transform(work)
    vote = evaluate.soft_vote([vector_to_array(f"_p_{name}") for name in readers])
    spare = [f"_{c}_{name}" for name in readers for c in "pcr"]
    voted = work.withColumn("probability", vote)
    return voted.withColumn("prediction", evaluate.most_likely(F.col("probability"), (0, 1))).drop("features", *spare)


# --- look-back ---------------------------------------------------------------------------------------


def train_look_back(
    bars: DataFrame,
    store: ModelStore,
    look_back: int = labels.LOOK_BACK,
    n_iter: int = 200,
    folds: int = 3,
    space: dict = search.LOOK_BACK_SPACE,
    parallelism: int = 4,
) -> DataFrame:
    """Boosted regression of the next scaled close on the closes before it, over whole series; boosted on when stored."""
    spark = bars.sparkSession
    with Workspace(spark, "look-back"):
        windows = stage(labels.look_back_windows(bars, look_back), "windows")

        def one(job: Row) -> dict:
            data, key = of_series(windows, job), f"elliott_wave_models/{job['symbol']}_{job['interval']}"
            if job["stored"]:
                model = boosted.BoostedRegressor.load(store, key).continued(boosted.look_back_rows(data))
            else:
                model = boosted.train_look_back(data, n_iter, folds, space, parallelism=parallelism)
            model.save(store, key)
            return {"model_key": key}

        return _run_series(spark, store, "look_back", windows, one, parallelism)


# --- technical ---------------------------------------------------------------------------------------


def train_linear(bars: DataFrame, store: ModelStore) -> DataFrame:
    """Linear models of all series in one job, over whole series; stored series are refitted on old and new scaling."""
    with Workspace(bars.sparkSession, "linear"):
        rows = stage(labels.complete_rows(sets.linear_features(bars), list(sets.LINEAR_FEATURES)), "linear-rows")
        stored = store.table("linear")
        if stored is None:
            model = linear.fit(rows)
        else:
            names = [f"_{side}_{f}" for f in sets.LINEAR_FEATURES for side in ("low", "high")]
            known = rows.join(stored.select(*KEYS), list(KEYS), "left_semi")
            fresh = rows.join(stored.select(*KEYS), list(KEYS), "left_anti")
            model = linear.fit(known, stored.select(*KEYS, *names)).unionByName(linear.fit(fresh))
        store.save_table("linear", model, KEYS)
    return store.table("linear")


def train_arima(bars: DataFrame, store: ModelStore) -> DataFrame:
    """Order search of all series in one job, over whole series; stored series keep their order and go on. A series
    that no order fits gets no model."""
    with Workspace(bars.sparkSession, "arima"):
        stored = store.table("arima")
        sums = stage(arima.lagged_sums(bars, None if stored is None else stored), "sums")
        fresh = sums if stored is None else sums.join(stored.select(*KEYS), list(KEYS), "left_anti")
        model = arima.fitted(arima.best_orders(arima.order_criteria(fresh)).where("aic is not null"), fresh)
        if stored is not None:
            known = stage(arima.extended(stored, sums), "extended")
            model = model.unionByName(arima.refit(known))
        store.save_table("arima", model, KEYS)
    return store.table("arima")


def train_prices(
    bars: DataFrame, store: ModelStore, n_iter: int = 50, folds: int = 3, space: dict = search.PRICE_SPACE, parallelism: int = 4
) -> DataFrame:
    """Boosted regression on time index and averages, over whole series; refitted with one repeated row when stored."""
    spark = bars.sparkSession
    with Workspace(spark, "prices"):
        rows = stage(sets.boosted_features(bars), "price-rows")
        longer = stage(boosted.price_update_features(bars), "price-update-rows")

        def one(job: Row) -> dict:
            key = f"technical_models/{job['symbol']}_{job['interval']}_price"
            if job["stored"]:
                model = boosted.BoostedRegressor.load(store, key).refitted(boosted.price_rows(of_series(longer, job)))
            else:
                model = boosted.train_price(of_series(rows, job), n_iter, folds, space, parallelism=parallelism)
            model.save(store, key)
            return {"model_key": key}

        return _run_series(spark, store, "price", rows, one, parallelism)


def train_technical(bars: DataFrame, store: ModelStore, n_iter: int = 50, **options) -> DataFrame:
    """Linear, ARIMA and price models over the same bars."""
    train_linear(bars, store)
    train_arima(bars, store)
    return train_prices(bars, store, n_iter, **options)
