"""Scaling per series: one aggregate per series, attached to its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import KEYS, join_per_series


def min_max_expression(value: Column, low: Column, high: Column) -> Column:
    """Scale to [0, 1]; a constant column becomes 0."""
    return F.when(high > low, (value - low) / F.nullif(high - low, F.lit(0.0))).when(value.isNotNull(), F.lit(0.0))


def standard_expression(value: Column, mean: Column, deviation: Column) -> Column:
    """Centre and divide by the population deviation; a constant column becomes 0."""
    return F.when(deviation > 0, (value - mean) / F.nullif(deviation, F.lit(0.0))).when(value.isNotNull(), F.lit(0.0))


def min_max_statistics(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[f for name in columns for f in (F.min(name).alias(f"_low_{name}"), F.max(name).alias(f"_high_{name}"))]
    )


def standard_statistics(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean and population deviation; exactly 0 for a constant column, whatever the rounding."""
    return df.groupBy(*keys).agg(
        *[
            f
            for name in columns
            for f in (
                F.avg(name).alias(f"_mean_{name}"),
                F.when(F.max(name) > F.min(name), F.stddev_pop(name)).otherwise(0.0).alias(f"_deviation_{name}"),
            )
        ]
    )


def min_max_scaled(
    df: DataFrame, columns: Sequence[str], suffix: str = "", statistics: DataFrame | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    statistics = min_max_statistics(df, columns, keys) if statistics is None else statistics
    joined = join_per_series(df, statistics, keys)
    scaled = {f"{n}{suffix}": min_max_expression(F.col(n), F.col(f"_low_{n}"), F.col(f"_high_{n}")) for n in columns}
    return joined.withColumns(scaled).drop(*[f"_{side}_{n}" for n in columns for side in ("low", "high")])


def standard_scaled(
    df: DataFrame, columns: Sequence[str], suffix: str = "", statistics: DataFrame | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    statistics = standard_statistics(df, columns, keys) if statistics is None else statistics
    joined = join_per_series(df, statistics, keys)
    scaled = {
        f"{n}{suffix}": standard_expression(F.col(n), F.col(f"_mean_{n}"), F.col(f"_deviation_{n}")) for n in columns
    }
    return joined.withColumns(scaled).drop(*[f"_{side}_{n}" for n in columns for side in ("mean", "deviation")])
