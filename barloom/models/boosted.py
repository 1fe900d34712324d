"""Boosted regressors: the look-back model and the price model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.models.registry import ModelStore
from barloom.models.search import LOOK_BACK_SPACE, PRICE_SPACE, error_score, param_map, tuned
from barloom.operators.blocks import BLOCK_BARS, INDEX, KEYS, TIME
from barloom.plans.features import BOOSTED_FEATURES, boosted_features


@dataclass
class BoostedRegressor:
    """Sum of boosted regressors; each further one was fitted to what the earlier ones left over."""

    stages: list[GBTRegressionModel]
    params: dict = field(default_factory=dict)

    def transform(self, rows: DataFrame) -> DataFrame:
        work, total = rows, F.lit(0.0)
        for i, stage in enumerate(self.stages):
            work = stage.copy().setPredictionCol(f"_stage{i}").transform(work)
            total = total + F.col(f"_stage{i}")
        return work.withColumn("prediction", total).drop(*[f"_stage{i}" for i in range(len(self.stages))])

    def continued(self, rows: DataFrame, label: str = "label", seed: int = 42) -> "BoostedRegressor":
        """Boost on from the stored model: one more regressor on its residuals."""
        rest = self.transform(rows).withColumn(label, F.col(label) - F.col("prediction")).drop("prediction")
        estimator = regressor(seed + len(self.stages), label)
        return BoostedRegressor([*self.stages, estimator.fit(rest, param_map(estimator, self.params))], self.params)

    def refitted(self, rows: DataFrame, label: str = "label", seed: int = 42) -> "BoostedRegressor":
        """A new model with the stored parameters."""
        estimator = regressor(seed, label)
        return BoostedRegressor([estimator.fit(rows, param_map(estimator, self.params))], self.params)

    def save(self, store: ModelStore, key: str) -> None:
        store.save(key, {f"stage-{i}": s for i, s in enumerate(self.stages)}, {"params": self.params, "stages": len(self.stages)})

    @classmethod
    def load(cls, store: ModelStore, key: str) -> "BoostedRegressor":
        note = store.note(key)
        return cls([store.load(key, f"stage-{i}", GBTRegressionModel) for i in range(note["stages"])], note["params"])


def regressor(seed: int = 42, label: str = "label") -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, seed=seed)


def train(rows: DataFrame, space: dict, folds: int = 3, n_iter: int = 50, parallelism: int = 4, seed: int = 42) -> BoostedRegressor:
    """Random search by mean squared error on contiguous folds, then a fit on all rows."""
    model, params = tuned(regressor(seed), space, with_contiguous_folds(rows, folds), error_score(), folds, n_iter, parallelism=parallelism, seed=seed)
    return BoostedRegressor([model], params)


def with_contiguous_folds(rows: DataFrame, folds: int, order: str = INDEX) -> DataFrame:
    """Folds of neighbouring rows, without shuffling; rows of one series with a known position."""
    first, last = rows.agg(F.min(order), F.max(order)).first()
    if first is None:
        raise ValueError("no rows to train on")
    share = (F.col(order) - first) * folds / (last - first + 1)
    return rows.withColumn("fold", F.floor(share).cast("int"))


def look_back_rows(windows: DataFrame) -> DataFrame:
    return windows.withColumns({"features": array_to_vector("x"), "label": F.col("y")})


def price_rows(features: DataFrame) -> DataFrame:
    rows = features.withColumn("label", F.col("close_scaled"))
    return VectorAssembler(inputCols=list(BOOSTED_FEATURES), outputCol="features").transform(rows)


def train_look_back(windows: DataFrame, n_iter: int = 200, folds: int = 3, space: dict = LOOK_BACK_SPACE, **options) -> BoostedRegressor:
    return train(look_back_rows(windows), space, folds, n_iter, **options)


def train_price(features: DataFrame, n_iter: int = 50, folds: int = 3, space: dict = PRICE_SPACE, **options) -> BoostedRegressor:
    return train(price_rows(features), space, folds, n_iter, **options)


def with_next_row(bars: DataFrame) -> DataFrame:
    """Every series plus one bar that repeats its last price, just after it."""
    last = bars.groupBy(*KEYS).agg(
        F.max_by(F.struct(*[c for c in bars.columns if c not in KEYS]), TIME).alias("_last")
    )
    repeated = last.select(*KEYS, "_last.*").withColumn(TIME, F.col(TIME) + F.expr("INTERVAL 1 MICROSECOND"))
    return bars.unionByName(repeated.select(*bars.columns))


def price_update_features(bars: DataFrame, block_bars: int = BLOCK_BARS) -> DataFrame:
    """Training rows of an update: the features of the series with its last price repeated once."""
    return boosted_features(with_next_row(bars), block_bars)
