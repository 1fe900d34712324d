"""Choosing features: mutual information with the label, and correlation between features."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import KEYS
from barloom.operators.ranking import value_ranks

# Thresholds tried for mutual information, correlation limit, share of features kept.
INFORMATION_THRESHOLDS = (0.005, 0.01, 0.02, 0.05, 0.08)
CORRELATION_LIMIT = 0.98
KEPT_SHARE = 0.85
CLASSES = (-1, 0, 1)
BINS = 16


def mutual_information(
    df: DataFrame, features: Sequence[str], label: str = "target", keys: Sequence[str] = KEYS, classes: Sequence[int] = CLASSES
) -> DataFrame:
    """``information`` of every feature about the label, from 16 bins of equal frequency.

    A value's bin follows from how many rows of the series lie below it, so equal values share a bin.
    All features go through one unpivoted aggregation; what is shuffled are counts per value.
    """
    long = df.select(*keys, label, *features).unpivot([*keys, label], list(features), "feature", "value")
    groups = [*keys, "feature"]
    per_class = {f"n{i}": F.count_if(F.col(label) == c) for i, c in enumerate(classes)}
    ranked = value_ranks(long, groups, "value", {"n": F.count(F.lit(1)), **per_class})
    binned = ranked.withColumn("_bin", F.floor(F.col("n_below") * BINS / F.col("n_total")))
    joint = binned.groupBy(*groups, "_bin").agg(
        F.sum("n").alias("_in_bin"),
        F.first("n_total").alias("_total"),
        *[F.sum(name).alias(name) for name in per_class],
        *[F.first(f"{name}_total").alias(f"_{name}") for name in per_class],
    )

    def term(name: str) -> Column:
        share = F.col(name) / F.col("_total")
        lift = F.col(name) * F.col("_total") / F.nullif(F.col("_in_bin") * F.col(f"_{name}"), F.lit(0))
        return F.when(F.col(name) > 0, share * F.ln(lift)).otherwise(0.0)

    terms = [term(name) for name in per_class]
    return joint.groupBy(*groups).agg(F.sum(sum(terms[1:], terms[0])).alias("information"))


def features_above(
    information: DataFrame, features: Sequence[str], thresholds: Sequence[float] = INFORMATION_THRESHOLDS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Features above each threshold, in feature order; thresholds that keep fewer than two are left out."""
    position = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    tried = information.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds])))
    kept = F.sort_array(F.collect_list(F.struct(position.alias("position"), "feature")))
    return (
        tried.where(F.col("information") > F.col("threshold"))
        .groupBy(*keys, "threshold")
        .agg(F.transform(kept, lambda item: item["feature"]).alias("features"))
        .where(F.size("features") >= 2)
    )


def _correlation(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both. It is null where one of them does not vary, which is an error in ``F.corr``."""
    return F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))


def correlations(df: DataFrame, features: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Absolute Pearson correlation of every pair of features, all pairs in one aggregation."""
    pairs = list(combinations(features, 2))
    measured = df.groupBy(*keys).agg(*[_correlation(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("earlier"), F.lit(b).alias("later"), F.abs(F.nanvl(F.col(f"_c{i}"), F.lit(None))).alias("correlation"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return measured.select(*keys, F.inline(rows))


def uncorrelated_features(correlation: DataFrame, selected: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Drop features that follow an earlier selected one too closely.

    ``selected`` holds ``features`` per series. ``close`` always stays. If too few are left, the first
    features of the selection are used instead.
    """
    pairs = correlation.groupBy(*keys).agg(F.collect_list(F.struct("earlier", "later", "correlation")).alias("_pairs"))
    chosen = selected.join(pairs, list(keys), "left")

    def close_pair(pair: Column) -> Column:
        both = F.array_contains("features", pair["earlier"]) & F.array_contains("features", pair["later"])
        return both & (pair["correlation"] > CORRELATION_LIMIT)

    dropped = F.transform(F.filter(F.coalesce("_pairs", F.array()), close_pair), lambda pair: pair["later"])

    def with_close(names: Column) -> Column:
        return F.when(F.array_contains(names, "close"), names).otherwise(F.array_append(names, F.lit("close")))

    least = F.floor(F.size("features").cast("double") * KEPT_SHARE).cast("int")
    return (
        chosen.withColumn("_kept", with_close(F.filter("features", lambda name: ~F.array_contains(dropped, name))))
        .withColumn("_kept", F.when(F.size("_kept") < least, F.slice("features", F.lit(1), least)).otherwise(F.col("_kept")))
        .withColumn("final_features", with_close(F.col("_kept")))
        .drop("_pairs", "_kept")
    )
