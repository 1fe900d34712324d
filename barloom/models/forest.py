"""Three-way strategy classifier: a random forest that can grow by further forests."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.models.registry import ModelStore
from barloom.operators.evaluate import CLASSES, most_likely
from barloom.operators.scaling import standard_expression

Scaling = dict[str, tuple[float, float]]

MIN_NEW_TREES = 50  # fixed values: trees added by an update
NEW_TREE_SHARE = 0.2


def label_position(target: Column) -> Column:
    """-1, 0, 1 as 0, 1, 2: Spark ML counts classes from zero."""
    return (target + 1).cast("double")


def new_tree_count(trees: int) -> int:
    return max(MIN_NEW_TREES, int(NEW_TREE_SHARE * trees))


def weighted_probabilities(parts: Sequence[Column], trees: Sequence[int]) -> Column:
    """Mean of the probabilities of several forests, weighted by their trees.

    Probabilities of a forest are the mean over its trees, so this equals one forest of all trees.
    """
    total = float(sum(trees))

    def share(part: Column, count: int) -> Column:
        return F.transform(part, lambda p: p * (count / total))

    shares = [share(part, count) for part, count in zip(parts, trees)]
    return reduce(lambda left, right: F.zip_with(left, right, lambda a, b: a + b), shares)


@dataclass
class GrowingForest:
    """Forests over the same features, each with the scaling (mean, deviation per feature) it was fitted under."""

    features: list[str]
    scalings: list[Scaling]
    forests: list[RandomForestClassificationModel]
    params: dict = field(default_factory=dict)

    @property
    def trees(self) -> list[int]:
        return [forest.getNumTrees for forest in self.forests]

    def transform(self, rows: DataFrame, scaled_by: Scaling | None = None) -> DataFrame:
        """Add ``probability`` (array in class order) and ``prediction`` (-1, 0, 1).

        Features are raw, or already ``scaled_by`` some scaling; each forest sees them in its own.
        """
        work, parts = rows, []
        for i, (forest, scaling) in enumerate(zip(self.forests, self.scalings, strict=True)):
            names = self.features
            if scaling != scaled_by:
                names = [f"_{f}_{i}" for f in self.features]
                work = work.withColumns({n: _rescaled(f, scaled_by, scaling) for n, f in zip(names, self.features, strict=True)})
            work = VectorAssembler(inputCols=names, outputCol="features").transform(work)
            view = forest.copy().setProbabilityCol(f"_p{i}").setPredictionCol(f"_c{i}").setRawPredictionCol(f"_r{i}")
            work = view.transform(work).drop("features", *(names if names is not self.features else []))
            parts.append(vector_to_array(f"_p{i}"))
        work = work.withColumn("probability", weighted_probabilities(parts, self.trees))
        work = work.withColumn("prediction", most_likely(F.col("probability")))
        return work.drop(*[f"_{c}{i}" for i in range(len(self.forests)) for c in "pcr"])

    def grown(self, rows: DataFrame, scaling: Scaling, weight_col: str = "weight", trees: int | None = None, seed: int = 42) -> GrowingForest:
        """The same forest with further trees, grown on ``rows`` (scaled by ``scaling``) only."""
        count = new_tree_count(sum(self.trees)) if trees is None else trees
        params = {k: v for k, v in self.params.items() if k != "numTrees"}
        estimator = classifier(weight_col, seed + len(self.forests)).setNumTrees(count)
        added = estimator.fit(assembled(rows, self.features), {estimator.getParam(k): v for k, v in params.items()})
        return GrowingForest(self.features, [*self.scalings, scaling], [*self.forests, added], self.params)

    def save(self, store: ModelStore, key: str) -> None:
        note = {"features": self.features, "scalings": self.scalings, "params": self.params, "forests": len(self.forests)}
        store.save(key, {f"forest-{i}": forest for i, forest in enumerate(self.forests)}, note)

    @classmethod
    def load(cls, store: ModelStore, key: str) -> GrowingForest:
        note = store.note(key)
        if "features" not in note or "forests" not in note:
            raise ValueError(f"no growing forest at {key!r}")
        forests = [
            store.load(key, f"forest-{i}", RandomForestClassificationModel) for i in range(note["forests"])
        ]
        scalings = [{name: tuple(pair) for name, pair in s.items()} for s in note["scalings"]]
        return cls(note["features"], scalings, forests, note["params"])


def _rescaled(feature: str, given: Scaling | None, wanted: Scaling) -> Column:
    """A feature under another scaling."""
    value = F.col(feature)
    if given is not None:
        mean, deviation = given[feature]
        value = value * F.lit(deviation) + F.lit(mean)
    mean, deviation = wanted[feature]
    return standard_expression(value, F.lit(mean), F.lit(deviation))


def classifier(weight_col: str | None = "weight", seed: int = 42) -> RandomForestClassifier:
    estimator = RandomForestClassifier(featuresCol="features", labelCol="label", seed=seed)
    return estimator.setWeightCol(weight_col) if weight_col else estimator


def assembled(rows: DataFrame, features: Sequence[str], target: str = "target") -> DataFrame:
    """``features`` vector and ``label`` position, other columns kept."""
    labelled = rows.withColumn("label", label_position(F.col(target)))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(labelled)


SCORE_COLUMNS = {c: f"p{i}" for i, c in enumerate(CLASSES)}


def score_columns(scored: DataFrame) -> DataFrame:
    return scored.withColumns({name: F.get("probability", F.lit(i)) for i, name in enumerate(SCORE_COLUMNS.values())})
