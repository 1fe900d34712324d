"""Folds, votes and classification metrics, as aggregates over scored rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.blocks import KEYS, with_position
from barloom.operators.ranking import value_ranks

_PART_ROWS = 65536
CLASSES = (-1, 0, 1)  # fixed value: class order of the score columns


def stratified_folds(
    df: DataFrame, row_id: Sequence[str], label: str = "target", folds: int = 5, seed: int = 42, keys: Sequence[str] = KEYS
) -> DataFrame:
    """``fold`` 0..folds-1, shuffled, with class sizes that differ by at most one between folds.

    Rows are dealt in md5 order. The leading hex digits of the md5 are even, so they cut a class into
    equal parts that are numbered in parallel; the largest class decides how many digits that takes.
    """
    token = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in row_id], F.lit(str(seed))))
    largest = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    digits = max(1, math.ceil(math.log(max(largest, 1) / _PART_ROWS, 16)))
    shuffled = df.withColumn("_token", token).withColumn("_part", F.substring("_token", 1, digits))
    dealt = with_position(shuffled, [*keys, label], "_part", ["_token"], "_position")
    return dealt.withColumn("fold", (F.col("_position") % folds).cast("int")).drop("_token", "_part", "_position")


def one_hot(label: Column, classes: Sequence[int] = CLASSES) -> Column:
    """0/1 array in class order."""
    return F.transform(F.array(*[F.lit(c) for c in classes]), lambda c: (c == label).cast("int"))


def soft_vote(scores: Sequence[Column]) -> Column:
    """Mean of several probability arrays."""
    first, *others = scores
    total = first
    for other in others:
        total = F.zip_with(total, other, lambda a, b: a + b)
    return F.transform(total, lambda p: p / float(len(scores)))


def most_likely(probabilities: Column, classes: Sequence[int] = CLASSES) -> Column:
    """Class of the highest probability; the earlier class wins a tie."""
    order = F.array(*[F.lit(c) for c in classes])
    return F.get(order, (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int"))


def confusion(scored: DataFrame, label: str = "target", prediction: str = "prediction", keys: Sequence[str] = KEYS) -> DataFrame:
    return scored.groupBy(*keys, label, prediction).agg(F.count(F.lit(1)).alias("rows"))


def accuracy(scored: DataFrame, label: str = "target", prediction: str = "prediction", keys: Sequence[str] = KEYS) -> DataFrame:
    return scored.groupBy(*keys).agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def macro_scores(scored: DataFrame, label: str = "target", prediction: str = "prediction", keys: Sequence[str] = KEYS) -> DataFrame:
    """Accuracy and plain class means of precision, recall and F1; undefined parts count as zero.

    Classes are those that occur as a label or as a prediction of the series. Everything after the
    first count works on one row per (label, prediction).
    """
    cells = confusion(scored, label, prediction, keys)
    sides = cells.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.col(label).alias("class"), F.lit(True).alias("actual"), F.col("rows"), (F.col(label) == F.col(prediction)).alias("hit")),
                F.struct(F.col(prediction).alias("class"), F.lit(False).alias("actual"), F.col("rows"), (F.col(label) == F.col(prediction)).alias("hit")),
            )
        ),
    )
    per_class = sides.groupBy(*keys, "class").agg(
        F.sum(F.when(F.col("actual") & F.col("hit"), F.col("rows")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("actual"), F.col("rows")).otherwise(0)).alias("actual"),
        F.sum(F.when(~F.col("actual"), F.col("rows")).otherwise(0)).alias("predicted"),
    )

    def share(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    hits = F.col("hits")
    return per_class.groupBy(*keys).agg(
        F.try_divide(F.sum("hits").cast("double"), F.sum("actual").cast("double")).alias("accuracy"),
        F.avg(share(hits, F.col("predicted"))).alias("precision"),
        F.avg(share(hits, F.col("actual"))).alias("recall"),
        F.avg(share(hits * 2, F.col("predicted") + F.col("actual"))).alias("f1_score"),
    )


def roc_auc(
    scored: DataFrame, scores: Mapping[int, str], label: str = "target", keys: Sequence[str] = KEYS
) -> DataFrame:
    """One-vs-rest area under the ROC curve; ``scores`` maps a class to its probability column.

    Three classes: the mean over classes. Two classes: the area of the larger label, with the score of
    that label. Fewer: null. Areas come from counts of positive and negative rows below each distinct
    score, so ties count half and nothing is sorted group-wise.
    """
    candidates = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("class"), F.col(name).alias("score"), (F.col(label) == c).alias("positive"))
                for c, name in scores.items()
            ]
        )
    )
    long = scored.select(*keys, candidates)
    counts = {"pos": F.count_if("positive"), "neg": F.count_if(~F.col("positive"))}
    ranked = value_ranks(long, [*keys, "class"], "score", counts)
    area = ranked.groupBy(*keys, "class").agg(
        F.try_divide(
            F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0)),
            (F.sum("pos") * F.sum("neg")).cast("double"),
        ).alias("auc"),
        F.sum("pos").alias("pos"),
    )
    present = area.groupBy(*keys).agg(
        F.count_if(F.col("pos") > 0).alias("_labels"),
        F.avg("auc").alias("_mean"),
        F.max_by("auc", F.when(F.col("pos") > 0, F.col("class"))).alias("_larger"),
    )
    value = F.when(F.col("_labels") == 2, F.col("_larger")).when(F.col("_labels") > 2, F.col("_mean"))
    return present.select(*keys, value.alias("roc_auc"))


def classification_metrics(
    scored: DataFrame, scores: Mapping[int, str], label: str = "target", prediction: str = "prediction", keys: Sequence[str] = KEYS
) -> DataFrame:
    return macro_scores(scored, label, prediction, keys).join(roc_auc(scored, scores, label, keys), list(keys), "left")


def mean_squared_error(scored: DataFrame, label: str, prediction: str = "prediction", keys: Sequence[str] = KEYS) -> DataFrame:
    return scored.groupBy(*keys).agg(F.avg(F.pow(F.col(label) - F.col(prediction), 2)).alias("mse"))


def fold_scores(
    scored: DataFrame, candidate: str, label: str = "target", prediction: str = "prediction", keys: Sequence[str] = KEYS
) -> DataFrame:
    """Accuracy of every candidate on every fold, with the labels that occur; null where there is only one."""
    scores = scored.groupBy(*keys, "fold", candidate).agg(
        F.count_distinct(label).alias("labels"), F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("score")
    )
    return scores.withColumn("score", F.when(F.col("labels") >= 2, F.col("score")))


def mean_score(folds: DataFrame, by: Sequence[str], score: str = "score") -> DataFrame:
    """Mean over folds; missing folds are left out."""
    return folds.groupBy(*by).agg(F.avg(score).alias("mean_score"))


def best_of(candidates: DataFrame, score: Column, order: str, keep: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Row with the highest score per series; the first in ``order`` wins a tie, missing scores never win."""
    rank = F.when(score.isNotNull() & ~F.isnan(score), F.struct(score, -F.col(order)))
    return candidates.groupBy(*keys).agg(F.max_by(F.struct(*keep), rank).alias("_best")).select(*keys, "_best.*")
