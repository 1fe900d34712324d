"""Strategy forests of all series and strategies, searched, fitted, updated and scored together.

Indicators of all strategies come from one plan over all bars. A model is one (symbol, interval, strategy); its rows
are scaled, balanced, weighted and folded with those of all others, every draw of the parameter search is grown on
every fold of every model at once (``barloom.models.trees``), one job scores what was left out, and the best draw of
each model is grown on all of its rows. The number of jobs follows from the depth of the trees, not from the number of
models, draws or folds.

A model that can't be trained (no complete rows, a class of one row) is left out before the others are balanced, and
reported with its reason; every job has one row in the report. Models, parameters, scaling and bin edges are tables of
the store, each written by one writer, and registered after they are written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.models import search, trees
from barloom.models.forest import SCORE_COLUMNS as SCORES
from barloom.models.registry import JOB_KEYS, ModelStore
from barloom.operators import balance, evaluate, labels, scaling
from barloom.operators.blocks import INDEX, KEYS, TIME
from barloom.operators.evaluate import CLASSES
from barloom.plans import features as sets
from barloom.plans.strategies import model_key
from barloom.session import Workspace, stage
from barloom.sources.bars import bars_in_range
from barloom.sources.store import append_metrics

#: Search space of the forests (fixed values); a pair is a range without its end, a list a choice.
SPACE = {"trees": (500, 1500), "depth": (20, 100), "min_split": (5, 20), "min_leaf": (2, 10), "subset": ["sqrt", "log2"]}
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


def _model(prefix: str = "") -> Column:
    return F.concat_ws("|", *[F.col(prefix + k) for k in JOB_KEYS]).alias("model")


def point_names(width: int) -> list[str]:
    return [f"f{i}" for i in range(width)]


def strategy_points(bars: DataFrame, jobs: DataFrame) -> DataFrame:
    """Complete rows of every job: its keys, time, ``target`` and the values of its features in their order, ``f0`` on.

    Strategies have lists of different lengths; places that a strategy does not use hold 0.
    """
    lists = jobs.select("interval", "strategy", "features").distinct().collect()  # one for each bar size and strategy
    width = max((len(r["features"]) for r in lists), default=0)
    wanted = list(dict.fromkeys(f for r in lists for f in r["features"]))
    rows = stage(sets.add_indicators(bars.join(jobs.select(*KEYS).distinct(), list(KEYS), "left_semi"), wanted, extra=labels.next_return()), "features")
    rows = labels.with_three_way_target(rows).where(F.col("return").isNotNull())

    def listed(r) -> Column:
        values = F.array(*[F.col(f).cast("double") for f in r["features"]])
        return F.struct(F.lit(r["interval"]).alias("of"), F.lit(r["strategy"]).alias("strategy"), values.alias("point"))

    own = F.filter(F.array(*map(listed, lists)), lambda s: (s["of"] == F.col("interval")) & F.forall(s["point"], lambda v: v.isNotNull()))
    long = rows.select(*KEYS, TIME, INDEX, "target", F.inline(own)).drop("of")
    mine = long.join(jobs.select(*JOB_KEYS), list(JOB_KEYS), "left_semi")
    places = [F.coalesce(F.get("point", F.lit(i)), F.lit(0.0)).alias(name) for i, name in enumerate(point_names(width))]
    return mine.select(*JOB_KEYS, TIME, INDEX, "target", *places)


def job_problems(jobs: DataFrame, points: DataFrame) -> DataFrame:
    """``jobs`` with ``problem``: why a job can't be trained, or null."""
    counts = points.groupBy(*JOB_KEYS, "target").agg(F.count(F.lit(1)).alias("n"))
    per_job = counts.groupBy(*JOB_KEYS).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    single = F.when((F.col("least") == 1) & (F.col("most") > 1), "a class with a single row cannot be balanced")
    problem = F.when(F.col("least").isNull(), "no complete rows").otherwise(single)
    return jobs.join(per_job, list(JOB_KEYS), "left").withColumn("problem", problem).drop("least", "most")


def training_rows(points: DataFrame, statistics: DataFrame, width: int, folds: int) -> DataFrame:
    """Scaled, balanced, weighted rows of all models, dealt into folds, as ``trees`` wants them."""
    names, keys = point_names(width), list(JOB_KEYS)
    scaled = stage(scaling.standard_scaled(points, names, statistics=statistics, keys=keys), "scaled")
    even = stage(balance.balanced(scaled, names, keys=keys), "balanced")
    weights = balance.balanced_weights(even, keys=keys).drop("class_rows")
    weighted = even.join(weights, [*keys, "target"], "left")
    folded = evaluate.stratified_folds(weighted, [*keys, "row_id"], folds=folds, keys=keys)
    label = (F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("target")) - 1).cast("int")
    return stage(folded.select(_model(), "row_id", F.array(*names).alias("features"), label.alias("label"), "weight", "fold"), "training")


def _scores(scored: DataFrame) -> DataFrame:
    """Scored rows with labels and predictions as classes and a score column for each class."""
    classes = F.array(*[F.lit(c) for c in CLASSES])
    return scored.withColumns(
        {"target": F.get(classes, F.col("label")), "prediction": evaluate.most_likely(F.col("probability")), **{n: F.get("probability", F.lit(i)) for i, n in enumerate(SCORES.values())}}
    )


FIT_COLUMNS = [c.split()[0] for c in trees.FIT.split(", ")]
DRAWN = ("trees", "depth", "min_leaf", "min_split", "subset")


def _draw_table(blocks: DataFrame, draws: Sequence[Mapping]) -> DataFrame:
    rows = [(i, *[d[c] for c in DRAWN]) for i, d in enumerate(draws)]
    return F.broadcast(blocks.sparkSession.createDataFrame(rows, "draw int, trees int, depth int, min_leaf int, min_split int, subset string"))


def draw_scores(blocks: DataFrame, models: DataFrame, draws: Sequence[Mapping], folds: int, seed: int) -> DataFrame:
    """Of each model, draw and fold: the area under the curves on the rows that the fold left out, null for one class."""
    every = models.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(len(draws) - 1))))
    every = every.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).join(_draw_table(blocks, draws), "draw")
    fits = stage(every.withColumn("fit", F.concat_ws("-", "draw", "fold")).select(*FIT_COLUMNS), "fits")
    nodes = stage(trees.grown(blocks, fits, len(CLASSES), seed), "nodes")
    scored = stage(_scores(trees.scored(blocks, nodes, len(CLASSES), fits)), "held-out")
    parts = F.split("fit", "-")
    scored = scored.withColumn("draw", parts[0].cast("int"))
    keys = ["model", "draw"]
    labels_of = evaluate.fold_scores(scored, "draw", keys=["model"]).select(*keys, "fold", "labels")
    areas = evaluate.roc_auc(scored, SCORES, keys=[*keys, "fold"])
    return labels_of.join(areas, [*keys, "fold"], "left").select(*keys, "fold", F.when(F.col("labels") >= 2, F.col("roc_auc")).alias("score"))


def train_forests(
    bars: DataFrame, jobs: DataFrame, store: ModelStore, metrics_path: str, values: str, n_iter: int = 200, folds: int = 5,
    space: Mapping = SPACE, seed: int = search.SEED, new_trees: int | None = None, replace_metrics: bool = False,
) -> DataFrame:
    """Train, or add trees to, the forest of every job and report each: its keys, status, model_key and metrics.

    ``jobs``: symbol, interval, strategy, features. A model that is stored keeps its parameters, scaling and bin edges
    and gets ``new_trees`` more (by default a fifth of what it has, 50 at least) that learn from these bars alone.
    Metrics are in-sample on the balanced rows, with all trees.
    """
    spark, run_at = bars.sparkSession, dt.datetime.now(dt.timezone.utc)
    with Workspace(spark, "forests"):
        jobs = stage(jobs.select(*JOB_KEYS, "features"), "jobs")
        points = stage(strategy_points(bars_in_range(bars, values), jobs), "points")
        known = stage(job_problems(jobs, points).withColumn("model", _model()), "known")
        good = known.where("problem is null")
        width = len([c for c in points.columns if c in point_names(len(points.columns))])
        points = stage(points.join(good.select(*JOB_KEYS), list(JOB_KEYS), "left_semi"), "good-points")

        stored = {name: store.table(f"forests/{name}") for name in ("scaling", "edges", "fits", "nodes")}
        fresh_scaling = scaling.standard_statistics(points, point_names(width), list(JOB_KEYS)).withColumn("model", _model())
        statistics = stage(_stored_first(stored["scaling"], fresh_scaling, good), "scaling")
        rows = training_rows(points, statistics.drop("model"), width, folds)
        edges = stage(_stored_first(stored["edges"], trees.bin_edges(rows), good), "edges")
        blocks = trees.packed(rows, edges)

        allowed = F.transform(F.sequence(F.lit(0), F.size("features") - 1), lambda i: i.cast("int"))
        models = good.select("model", allowed.alias("allowed"))
        new = models if stored["fits"] is None else models.join(stored["fits"].select("model"), "model", "left_anti")
        new = stage(new, "new")
        fits = None if stored["fits"] is None else _more_trees(stored["fits"].join(models.select("model"), "model", "left_semi"), new_trees)
        if not new.isEmpty():
            chosen = _chosen(blocks, new, search.sample_params(space, n_iter, seed), folds, seed)
            fits = chosen if fits is None else fits.unionByName(chosen)
        fits = stage(fits, "all-fits")
        nodes = stage(trees.grown(blocks, fits.drop("has"), len(CLASSES), seed), "grown")
        if stored["nodes"] is not None:
            nodes = nodes.unionByName(stored["nodes"].join(models.select("model"), "model", "left_semi"))
        # One fit of a model holds all its trees from now on; units stay apart by the fit that grew them.
        whole = stage(nodes, "whole")
        found = evaluate.classification_metrics(_scores(trees.scored(blocks, one_forest(whole), len(CLASSES))), SCORES, keys=["model"])
        found = stage(found, "metrics")
        _save(store, {"scaling": statistics, "edges": edges, "nodes": whole, "fits": fits.withColumn("has", F.col("has") + F.col("trees"))})
        report = known.join(found, "model", "left").select(
            *JOB_KEYS, F.coalesce("problem", F.when(F.col("accuracy").isNull(), "no trees"), F.lit("ok")).alias("status"),
            F.concat(F.lit("trained_models/"), model_key(F.col("symbol"), F.col("interval"), F.col("features"))).alias("model_key"), "features", *METRICS,
        )
        path = store.report_path("forests")
        report.write.parquet(path)
    report = spark.read.parquet(path)
    done = report.where("status = 'ok'")
    append_metrics(done.select(F.col("symbol").alias("asset"), "interval", "strategy", *METRICS, F.lit(run_at).alias("timestamp")), metrics_path, replace_metrics)
    store.register(done.withColumn("kind", F.lit("forest")))
    return report


def one_forest(nodes: DataFrame) -> DataFrame:
    """All trees of a model as those of one fit: a tree counts the same, whichever run has grown it."""
    unit = F.xxhash64("fit", "unit").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    return nodes.withColumns({"unit": unit, "fit": F.lit("all")})


def _stored_first(stored: DataFrame | None, fresh: DataFrame, good: DataFrame) -> DataFrame:
    if stored is None:
        return fresh
    kept = stored.join(good.select("model"), "model", "left_semi")
    both = kept.unionByName(fresh.join(kept.select("model"), "model", "left_anti"), allowMissingColumns=True)
    return both.na.fill(0.0)  # places that no strategy of one of the runs uses


def _chosen(blocks: DataFrame, models: DataFrame, draws: Sequence[Mapping], folds: int, seed: int) -> DataFrame:
    """The fit of each model on all its rows by its best draw: the first of the highest mean area over the folds that
    can be scored, or the first draw where none can."""
    means = evaluate.mean_score(draw_scores(blocks, models, draws, folds, seed), ["model", "draw"])
    best = evaluate.best_of(means, F.col("mean_score"), "draw", ["draw"], keys=["model"])
    picked = models.join(best, "model", "left").withColumn("draw", F.coalesce("draw", F.lit(0)))
    fits = picked.join(_draw_table(blocks, draws), "draw")
    return fits.withColumns({"fit": F.lit("run0"), "fold": F.lit(None).cast("int"), "has": F.lit(0)}).select(*FIT_COLUMNS, "has")


def _more_trees(fits: DataFrame, new_trees: int | None) -> DataFrame:
    """Stored fits as the next run's: as many new trees as an update adds."""
    more = F.greatest(F.lit(50), F.floor(F.col("has") * 0.2)) if new_trees is None else F.lit(new_trees)
    run = F.concat(F.lit("run"), F.substring("fit", 4, 9).cast("int") + 1)
    return fits.withColumns({"trees": more.cast("int"), "fit": run})


def _save(store: ModelStore, tables: Mapping[str, DataFrame]) -> None:
    for name, table in tables.items():
        store.save_table(f"forests/{name}", table, ["model"])


def score_forests(bars: DataFrame, jobs: DataFrame, store: ModelStore, values: str) -> DataFrame:
    """What the stored forests say of every complete row: keys, time, target, prediction, probability. One job for all
    models, whose plan does not grow with their number."""
    points = stage(strategy_points(bars_in_range(bars, values), jobs), "points")
    names = [c for c in points.columns if c in point_names(len(points.columns))]
    scaled = scaling.standard_scaled(points, names, statistics=store.table("forests/scaling").drop("model"), keys=list(JOB_KEYS))
    known = scaled.join(store.table("forests/edges").select(F.split("model", r"\|").alias("k")).select(*[F.col("k")[i].alias(c) for i, c in enumerate(JOB_KEYS)]), list(JOB_KEYS), "left_semi")
    label = (F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("target")) - 1).cast("int")
    row_id = F.date_format(TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    rows = known.select(_model(), row_id.alias("row_id"), F.array(*names).alias("features"), label.alias("label"), F.lit(1.0).alias("weight"), F.lit(0).alias("fold"))
    found = _scores(trees.scored(trees.packed(stage(rows, "rows"), store.table("forests/edges")), one_forest(store.table("forests/nodes")), len(CLASSES)))
    keys = [F.split("model", r"\|")[i].alias(c) for i, c in enumerate(JOB_KEYS)]
    return found.select(*keys, F.to_timestamp("row_id").alias(TIME), "target", "prediction", "probability")
