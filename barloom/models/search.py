"""Random parameter search over Spark ML estimators."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.evaluate import accuracy, mean_score, mean_squared_error, roc_auc

# Search spaces. A pair (low, high) is a range of whole numbers without its end, a list
# is a choice. Names are those of Spark ML.
FOREST_SPACE = {
    "numTrees": (500, 1500),
    "maxDepth": (20, 100),
    "minInstancesPerNode": (2, 10),
    "featureSubsetStrategy": ["sqrt", "log2"],
}
SIGNAL_FOREST_SPACE = {
    "numTrees": (50, 300),
    "maxDepth": (10, 60),
    "minInstancesPerNode": (1, 20),
    "featureSubsetStrategy": ["sqrt", "log2"],
}
SIGNAL_BOOSTED_SPACE = {
    "maxIter": (50, 300),
    "maxDepth": (3, 8),
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.5", "0.7", "1.0"],
}
LOOK_BACK_SPACE = {
    "maxIter": (100, 800),
    "maxDepth": [3, 5, 7, 10],
    "stepSize": [0.01, 0.05, 0.1],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["0.3", "0.5", "0.7", "1.0"],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3],
}
PRICE_SPACE = {**LOOK_BACK_SPACE, "maxIter": (100, 500)}

DEEPEST = 30  # Spark ML grows no deeper trees
SEED = 42

# Ranges that have no counterpart in Spark ML; stored with a model for the record.
WITHOUT_COUNTERPART = ("min_samples_split", "class_weight", "reg_alpha", "reg_lambda", "min_child_weight")


def sample_params(space: Mapping[str, tuple[int, int] | list], n_iter: int, seed: int = SEED) -> list[dict]:
    """``n_iter`` repeatable draws from a search space."""
    draw = random.Random(seed)
    sampled = []
    for _ in range(n_iter):
        one = {
            name: draw.randrange(*values) if isinstance(values, tuple) else draw.choice(values)
            for name, values in space.items()
        }
        if "maxDepth" in one:
            one["maxDepth"] = min(one["maxDepth"], DEEPEST)
        sampled.append(one)
    return sampled


def param_map(estimator: Estimator, params: Mapping[str, object]) -> dict:
    return {estimator.getParam(name): value for name, value in params.items()}


@dataclass(frozen=True)
class Score:
    """``by_fold`` gives (fold, score) of scored rows, null where a fold cannot be scored."""

    by_fold: Callable[[DataFrame, str], DataFrame]
    larger_better: bool = True


def area_score(classes: Sequence[int], label: str = "label") -> Score:
    """Macro one-vs-rest area; labels are positions in ``classes``. A fold of one class has none."""

    def by_fold(scored: DataFrame, fold: str) -> DataFrame:
        p = vector_to_array("probability")
        rows = scored.select(
            fold,
            F.get(F.array(*[F.lit(c) for c in classes]), F.col(label).cast("int")).alias("target"),
            *[F.get(p, F.lit(i)).alias(f"p{i}") for i in range(len(classes))],
        )
        found = roc_auc(rows, {c: f"p{i}" for i, c in enumerate(classes)}, "target", [fold])
        return found.select(fold, F.col("roc_auc").alias("score"))

    return Score(by_fold)


def accuracy_score(label: str = "label") -> Score:
    return Score(lambda scored, fold: accuracy(scored, label, "prediction", [fold]).select(fold, F.col("accuracy").alias("score")))


def error_score(label: str = "label") -> Score:
    return Score(lambda scored, fold: mean_squared_error(scored, label, "prediction", [fold]).select(fold, F.col("mse").alias("score")), False)


def cross_validated(estimator: Estimator, params: Mapping[str, object], rows: DataFrame, score: Score, folds: int, fold_col: str = "fold") -> float | None:
    """Mean score over the folds that can be scored; None if there is none. All folds are scored in one job."""
    scored = None
    for fold in range(folds):
        model = estimator.fit(rows.where(F.col(fold_col) != fold), param_map(estimator, params))
        part = model.transform(rows.where(F.col(fold_col) == fold))
        scored = part if scored is None else scored.unionByName(part)
    return mean_score(score.by_fold(scored, fold_col), [], "score").first()["mean_score"]


def tuned(
    estimator: Estimator,
    space: Mapping[str, tuple[int, int] | list],
    rows: DataFrame,
    score: Score,
    folds: int,
    n_iter: int,
    fold_col: str = "fold",
    parallelism: int = 4,
    seed: int = SEED,
) -> tuple[Transformer, dict]:
    """Best of ``n_iter`` draws by cross-validation on the given folds, refitted on all rows.

    Folds that cannot be scored (one class only) are left out of a draw's mean; a draw without any score
    never wins. The first draw wins a tie.
    """
    draws = sample_params(space, n_iter, seed)
    with ThreadPoolExecutor(parallelism) as pool:
        run = inheritable_thread_target(rows.sparkSession)(lambda d: cross_validated(estimator, d, rows, score, folds, fold_col))
        means = list(pool.map(run, draws))
    sign = 1.0 if score.larger_better else -1.0
    ranked = [float("-inf") if m is None else sign * m for m in means]
    chosen = draws[ranked.index(max(ranked))]
    return estimator.fit(rows, param_map(estimator, chosen)), chosen
