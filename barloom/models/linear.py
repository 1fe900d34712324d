"""Linear regression of every series at once, from one aggregation."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import kernels
from barloom.operators.blocks import KEYS, join_per_series
from barloom.operators.scaling import min_max_scaled, min_max_statistics
from barloom.plans.features import LINEAR_FEATURES


def coefficients(rows: DataFrame, features: Sequence[str], label: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """``intercept`` and ``weights`` per series by least squares.

    The rows are reduced to means and covariances in one pass; what is solved per series is a matrix as
    wide as the feature list. Redundant features get the solution of least length.
    """
    names = [*features, label]
    moments = rows.groupBy(*keys).agg(
        F.array(*[F.avg(n) for n in names]).alias("means"),
        F.array(*[F.covar_pop(a, b) for a in features for b in names]).alias("covariances"),
    )
    schema = T.StructType([moments.schema[k] for k in keys])
    schema = schema.add("intercept", T.DoubleType()).add("weights", T.ArrayType(T.DoubleType()))

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield kernels.solve_least_squares(batch)[schema.names]

    return moments.mapInPandas(solve, schema)


def predicted(features: Sequence[str]) -> Column:
    values = F.array(*[F.col(f) for f in features])
    return F.col("intercept") + F.aggregate(
        F.zip_with("weights", values, lambda w, x: w * x), F.lit(0.0), lambda total, part: total + part
    )


def training_rows(rows: DataFrame, stored_scaling: DataFrame | None = None, features: Sequence[str] = LINEAR_FEATURES) -> DataFrame:
    """Scaled training rows. With a stored scaling, every row comes twice: old and new scaling."""
    new = min_max_scaled(rows, features, suffix="_scaled").withColumn("scaler", F.lit("new"))
    if stored_scaling is None:
        return new
    old = min_max_scaled(rows, features, suffix="_scaled", statistics=stored_scaling).withColumn("scaler", F.lit("old"))
    return old.unionByName(new)


def fit(rows: DataFrame, stored_scaling: DataFrame | None = None, features: Sequence[str] = LINEAR_FEATURES, label: str = "close") -> DataFrame:
    """Model of every series: scaling statistics of the new rows, intercept and weights."""
    scaled = [f"{f}_scaled" for f in features]
    solved = coefficients(training_rows(rows, stored_scaling, features), scaled, label)
    return solved.join(min_max_statistics(rows, features), list(KEYS))


def predict(rows: DataFrame, model: DataFrame, features: Sequence[str] = LINEAR_FEATURES) -> DataFrame:
    statistics = model.select(*KEYS, *[f"_{s}_{f}" for f in features for s in ("low", "high")])
    scaled = min_max_scaled(rows, features, suffix="_scaled", statistics=statistics)
    weighted = join_per_series(scaled, model.select(*KEYS, "intercept", "weights"))
    return weighted.withColumn("prediction", predicted([f"{f}_scaled" for f in features])).drop(
        "intercept", "weights", *[f"{f}_scaled" for f in features]
    )
