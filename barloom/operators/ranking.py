"""Exact ranks and quantiles per group, without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.blocks import join_per_group
from barloom.session import stage

_ACCURACY = 10000
# Half widths of the brackets around a quantile, narrow to wide; the last one holds every value.
_MARGINS = (3.0 / _ACCURACY, 3e-3, 3e-2, 1.0)


def value_ranks(df: DataFrame, keys: Sequence[str], value: str, counts: Mapping[str, Column]) -> DataFrame:
    """One row per distinct value of a group.

    ``counts`` are aggregates over the rows of that value; each comes with ``<name>_below``, its total
    over all smaller values of the group, and ``<name>_total``, that over the group. Null values are left out.

    Rows are reduced to distinct values with counts (map-side) and written once, range-partitioned by
    (group, value): parts are even whatever the sizes of the groups, and their number follows the data.
    What is below a value is what earlier parts of its group hold, one row a part, and what its part holds.
    """
    distinct = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*[c.alias(n) for n, c in counts.items()])
    order = [*keys, value]
    placed = distinct.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    placed = stage(placed, "values")
    parts = placed.groupBy(*keys, "_part").agg(*[F.sum(n).alias(n) for n in counts])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.select(
        *keys, "_part",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_{n}_before") for n in counts],
        *[F.sum(n).over(group).alias(f"{n}_total") for n in counts],
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.join(stage(sums, "parts"), [*keys, "_part"], "left").withColumns(
        {f"{n}_below": F.col(f"_{n}_before") + F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in counts}
    )
    return ranked.drop("_part", *[f"_{n}_before" for n in counts])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], first_margin: int = 0) -> DataFrame:
    """Quantiles with linear interpolation between neighbours, nulls left out.

    A sketch brackets each quantile, by a margin of at least two ranks; a second scan counts the rows below
    the bracket and keeps only the values inside it. Both scans reduce map-side, so no group is shuffled or
    sorted whole. The counts also tell if a bracket missed its rank; that group is counted again with the
    next wider bracket (from ``first_margin`` on), of which the last holds all values.
    """
    rows = stage(df.select(*keys, value).where(F.col(value).isNotNull()), "quantile-rows")
    edges = [e for p in points.values() for m in _MARGINS for e in (max(p - m, 0.0), min(p + m, 1.0))]
    sketch = stage(
        rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_total"),
            F.min(value).alias("_least"),
            F.max(value).alias("_most"),
            F.percentile_approx(value, F.array(*[F.lit(e) for e in edges]), F.lit(_ACCURACY)).alias("_edges"),
        ),
        "sketch",
    )
    wide = reduce(lambda c, i: F.when(F.col("_total") * _MARGINS[i] >= 2, F.lit(i)).otherwise(c), reversed(range(len(_MARGINS) - 1)), F.lit(len(_MARGINS) - 1))
    open_groups = sketch.withColumn("_margin", F.greatest(wide, F.lit(first_margin)))
    done = None
    while True:
        found = stage(_within_brackets(rows, open_groups, keys, value, points), "quantiles")
        whole = F.lit(True)
        for name in points:
            whole = whole & F.col(name).isNotNull()
        good = found.where(whole).drop("_margin")
        done = good if done is None else done.unionByName(good)
        missed = found.where(~whole).select(*keys, (F.col("_margin") + 1).alias("_margin"))
        if missed.isEmpty():
            return done
        open_groups = stage(sketch.join(missed, list(keys)), "again")


def _within_brackets(rows: DataFrame, groups: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """The quantiles of ``groups``, null where the bracket of their margin misses a rank."""
    margins, widest = len(_MARGINS), len(_MARGINS) - 1

    def bracket(i: int, name: str) -> Column:
        at = 2 * (i * margins + F.col("_margin"))
        low = F.when(F.col("_margin") == widest, F.col("_least")).otherwise(F.get("_edges", at))
        high = F.when(F.col("_margin") == widest, F.col("_most")).otherwise(F.get("_edges", at + 1))
        return F.struct(F.lit(name).alias("name"), low.alias("low"), high.alias("high"))

    brackets = groups.select(*keys, F.array(*[bracket(i, n) for i, n in enumerate(points)]).alias("_brackets"))
    x = F.col(value)
    within = F.filter("_brackets", lambda b: x <= b["high"])
    # Null stands for every value below the bracket: one partial count per task.
    kept = F.transform(within, lambda b: F.struct(b["name"].alias("name"), F.when(x >= b["low"], x).alias("at")))
    counted = (
        join_per_group(rows, brackets, keys, [value])
        .where(F.col("_brackets").isNotNull())
        .select(*keys, F.inline(kept))
        .groupBy(*keys, "name", "at")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = Window.partitionBy(*keys, "name").orderBy(F.col("at").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_n").over(upto)).join(groups.select(*keys, "_total", "_margin"), list(keys))
    share = F.element_at(F.create_map(*[F.lit(part) for item in points.items() for part in (item[0], float(item[1]))]), F.col("name"))
    position = (F.col("_total") - 1) * share
    first = F.col("_upto") - F.col("_n")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < F.col("_upto")), F.col("at")))

    found = ranked.groupBy(*keys, "_margin", "name").agg(
        at_rank(F.floor(position)).alias("_low"), at_rank(F.ceil(position)).alias("_high"), F.max(position - F.floor(position)).alias("_part")
    )
    exact = F.col("_low") * (1 - F.col("_part")) + F.col("_high") * F.col("_part")
    return found.groupBy(*keys, "_margin").agg(*[F.max(F.when(F.col("name") == name, exact)).alias(name) for name in points])
