"""Class balance: nearest neighbours inside a class, synthetic rows, sample weights."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import kernels
from barloom.functions.scalar import hash32
from barloom.operators.blocks import BLOCK_BARS, INDEX, KEYS, block_of, join_per_group, with_position
from barloom.session import stage

NEIGHBOURS = 5  # fixed value: neighbours per row
CELL_ROWS = 2048
FAN = 8  # parts that a cell is cut into
VISITORS = 4096
_SLACK = 1e-8
_REPLICA_CHUNK = 4096


def class_counts(df: DataFrame, label: str = "target", keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("class_rows"))


def balanced_weights(df: DataFrame, label: str = "target", keys: Sequence[str] = KEYS) -> DataFrame:
    """Weight of every class: rows / (classes * rows of the class)."""
    series = Window.partitionBy(*keys)
    counts = class_counts(df, label, keys)
    return counts.withColumn(
        "weight", F.sum("class_rows").over(series) / (F.count(F.lit(1)).over(series) * F.col("class_rows"))
    )


def class_members(df: DataFrame, features: Sequence[str], label: str = "target", keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows numbered by time within their class (``member``), features as one array (``point``)."""
    rows = df.select(*keys, label, INDEX, F.array(*[F.col(f).cast("double") for f in features]).alias("point"))
    blocks = rows.withColumn("_block", block_of(F.col(INDEX), BLOCK_BARS))
    return with_position(blocks, [*keys, label], "_block", [INDEX], "member").drop("_block", INDEX)


def class_neighbours(
    members: DataFrame, label: str = "target", k: int = NEIGHBOURS, keys: Sequence[str] = KEYS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """The ``k`` nearest rows of the same class for every row, exactly.

    A class is cut into cells of at most ``cell_rows`` rows, along the widest feature of each part, as often as
    its size asks for. The neighbours inside its own cell bound how far a row has to look. Cells whose box is
    farther away than that hold no nearer row; which are not is found by descending the tree of boxes, cell
    by cell, and then checked row by row. A task compares a bounded number of rows with one cell. Distances
    count to nine places, ties go to the lower member number.
    """
    groups = [*keys, label]
    located = stage(_with_cells(stage(members, "members"), groups, cell_rows), "cells")
    near = stage(_inside_cells(located, groups, k), "near")
    visits = stage(_visits(located, near, groups), "visits")
    found = near.select(*groups, "member", "neighbours", "distances")
    if not visits.isEmpty():
        found = found.unionByName(_across_cells(located, visits, groups, k))
    hits = F.transform(F.arrays_zip("distances", "neighbours"), lambda h: F.struct(h["distances"].alias("distance"), h["neighbours"].alias("neighbour")))
    best = found.select(*groups, "member", hits.alias("hits")).groupBy(*groups, "member").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")
    )
    return best.select(*groups, "member", F.posexplode("hits").alias("rank", "hit")).select(
        *groups, "member", (F.col("rank") + 1).alias("rank"), "hit.neighbour", "hit.distance"
    )


def _box(features: int) -> list[Column]:
    """Least and greatest value of every feature."""
    return [F.array(*[f(F.get("point", F.lit(i))) for i in range(features)]).alias(n) for n, f in (("low", F.min), ("high", F.max))]


def _with_cells(members: DataFrame, groups: Sequence[str], cell_rows: int) -> DataFrame:
    """Add ``cell``. Cells are numbered like nodes of a tree: the parts of cell c are c * FAN and the next ones."""
    width = members.select(F.size("point")).first()
    features = width[0] if width else 0
    rows = members.withColumn("cell", F.lit(1).cast("long"))
    cuts = F.array(*[F.lit((i + 1) / FAN) for i in range(FAN - 1)])
    while True:
        parts = rows.groupBy(*groups, "cell").agg(F.count(F.lit(1)).alias("n"), *_box(features)).where(F.col("n") > cell_rows)
        spans = F.zip_with("high", "low", lambda h, l: h - l)
        widest = F.array_position(spans, F.array_max(spans)).cast("int") - 1
        large = stage(parts.where(F.array_max(spans) > 0).select(*groups, "cell", widest.alias("_along")), "large")
        if large.isEmpty():
            break
        along = F.get("point", F.col("_along"))
        marked = stage(join_per_group(rows, large, [*groups, "cell"], ["member"]), "marked")
        splits = marked.where(F.col("_along").isNotNull()).groupBy(*groups, "cell").agg(F.percentile_approx(along, cuts, F.lit(1000)).alias("_cuts"), F.max(along).alias("_top"))
        split = join_per_group(marked, splits, [*groups, "cell"], ["member"])
        # A value as large as the greatest is on its own side of some cut, so every split makes progress.
        part = F.size(F.filter("_cuts", lambda c: (c < along) | ((c == along) & (along == F.col("_top")))))
        rows = stage(
            split.withColumn("cell", F.when(F.col("_along").isNotNull(), F.col("cell") * FAN + part).otherwise(F.col("cell")))
            .drop("_along", "_cuts", "_top"),
            "split",
        )
    # What is left over the bound is one point many times; it is dealt out.
    crowd = rows.groupBy(*groups, "cell").agg(F.ceil(F.count(F.lit(1)) / cell_rows).alias("_parts"))
    dealt = join_per_group(rows, stage(crowd, "crowd"), [*groups, "cell"], ["member"])
    return dealt.withColumn("part", F.pmod("member", "_parts")).drop("_parts")


def _hits_schema(located: DataFrame, groups: Sequence[str]) -> T.StructType:
    schema = T.StructType([located.schema[name] for name in groups]).add("member", T.LongType())
    return schema.add("neighbours", T.ArrayType(T.LongType())).add("distances", T.ArrayType(T.DoubleType()))


def _inside_cells(located: DataFrame, groups: Sequence[str], k: int) -> DataFrame:
    """Nearest rows within the own cell, with ``bound``: how far a nearer row could still be."""
    schema = _hits_schema(located, groups).add("cell", T.LongType()).add("part", T.LongType()).add("bound", T.DoubleType())
    schema = schema.add("point", T.ArrayType(T.DoubleType()))

    def search(cell: pd.DataFrame) -> pd.DataFrame:
        return kernels.nearest_inside(cell, k)[schema.names]

    return located.groupBy(*groups, "cell", "part").applyInPandas(search, schema)


def _visits(located: DataFrame, near: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows with the (cell, part) that may hold a nearer one: ``other``, ``other_part``."""
    width = located.select(F.size("point")).first()
    leaves = stage(located.groupBy(*groups, "cell", "part").agg(*_box(width[0] if width else 0)), "leaves")
    reach = near.groupBy(*groups, "cell", "part").agg(F.max("bound").alias("reach"))
    asking = leaves.join(reach, [*groups, "cell", "part"])
    # A node's number in base FAN is a 1 and the parts on the way to it, so its digits without the last are its parent.
    digits = F.conv(F.col("cell").cast("string"), 10, FAN)
    above = leaves.withColumn("node", F.explode(F.transform(F.sequence(F.lit(1), F.length(digits)), lambda j: F.conv(F.substr(digits, F.lit(1), j), FAN, 10).cast("long"))))
    boxes = above.groupBy(*groups, "node").agg(
        *[F.array(*[f(F.get(n, F.lit(i))) for i in range(width[0] if width else 0)]).alias(n) for n, f in (("low", F.min), ("high", F.max))]
    )
    tree = stage(boxes.withColumn("parent", F.when(F.col("node") > 1, F.expr(f"node div {FAN}"))), "tree")

    def gap(low: Column, high: Column, other_low: Column, other_high: Column) -> Column:
        sides = F.zip_with(F.zip_with(low, other_high, lambda a, b: a - b), F.zip_with(other_low, high, lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0)))
        return F.sqrt(F.aggregate(sides, F.lit(0.0), lambda t, x: t + x * x))

    near_enough = gap(F.col("low"), F.col("high"), F.col("_low"), F.col("_high")) <= F.col("reach") + _SLACK
    frontier = asking.select(*groups, "cell", "part", "low", "high", "reach", F.lit(1).cast("long").alias("node"))
    below = tree.select(*groups, F.col("parent").alias("node"), F.col("node").alias("_child"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    pairs, ends = None, leaves.select(*groups, F.col("cell").alias("node"), F.col("part").alias("other_part")).distinct()
    while True:
        frontier = stage(frontier, "frontier")
        reached = frontier.join(ends, [*groups, "node"]).select(*groups, "cell", "part", F.col("node").alias("other"), "other_part")
        pairs = reached if pairs is None else pairs.unionByName(reached)
        frontier = frontier.join(below, [*groups, "node"]).where(near_enough).select(*groups, "cell", "part", "low", "high", "reach", F.col("_child").alias("node"))
        if frontier.isEmpty():
            break
    own = (F.col("cell") == F.col("other")) & (F.col("part") == F.col("other_part"))
    boxed = leaves.select(*groups, F.col("cell").alias("other"), F.col("part").alias("other_part"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    pairs = stage(pairs.where(~own).join(boxed, [*groups, "other", "other_part"]), "pairs")
    met = near.select(*groups, "cell", "part", "member", "bound", "point").join(pairs, [*groups, "cell", "part"])
    inside = gap(F.col("point"), F.col("point"), F.col("_low"), F.col("_high")) <= F.col("bound") + _SLACK
    return met.where(inside).select(*groups, "other", "other_part", "member", "point")


def _across_cells(located: DataFrame, visits: DataFrame, groups: Sequence[str], k: int) -> DataFrame:
    """Nearest rows in the visited cells. The rows that visit a cell are cut into chunks, each with its copy of the cell."""
    where_ = [*groups, "other", "other_part"]
    chunks = stage(visits.groupBy(*where_).agg(F.ceil(F.count(F.lit(1)) / VISITORS).cast("int").alias("_chunks")), "chunks")
    asking = join_per_group(visits, chunks, where_, ["member"]).withColumn("chunk", F.pmod(F.xxhash64("member"), F.col("_chunks")).cast("int"))
    hosts = located.select(*groups, F.col("cell").alias("other"), F.col("part").alias("other_part"), "member", "point").join(chunks, where_)
    hosts = hosts.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    schema = _hits_schema(located, groups)

    def search(asking: pd.DataFrame, hosting: pd.DataFrame) -> pd.DataFrame:
        return kernels.nearest_across(asking, hosting, k)[schema.names]

    by = [*where_, "chunk"]
    sides = [df.select(*[F.col(c).alias(c) for c in (*by, "member", "point")]) for df in (asking, hosts)]
    return sides[0].groupBy(*by).cogroup(sides[1].groupBy(*by)).applyInPandas(search, schema)


def synthetic_rows(
    df: DataFrame, features: Sequence[str], label: str = "target", k: int = NEIGHBOURS, keys: Sequence[str] = KEYS, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """New rows that raise every class to the size of the largest class of its series.

    A new row lies between a row of the class and one of that row's nearest rows of the class. Which
    row, which neighbour and how far between follow from an md5 of the series, class and running
    number, so a repeated run gives the same rows.
    """
    groups = [*keys, label]
    counts = class_counts(df, label, keys).withColumn(
        "_missing", F.max("class_rows").over(Window.partitionBy(*keys)) - F.col("class_rows")
    )
    short = stage(counts.where(F.col("_missing") > 0), "short")
    if not short.where(F.col("class_rows") < 2).isEmpty():
        raise ValueError("a class with a single row cannot be balanced")
    members = stage(class_members(_of_classes(df, short, groups), features, label, keys), "members")
    nearest = class_neighbours(members, label, k, keys, cell_rows)
    wanted = _running_numbers(short, groups)
    parts = [F.col(name) for name in groups] + [F.col("replica")]

    def draw(tag: str) -> Column:
        return hash32(*parts, F.lit(tag))

    drawn = wanted.select(
        *groups,
        "replica",
        (draw("s") % F.col("class_rows")).alias("member"),
        (draw("n") % F.least(F.lit(k), F.col("class_rows") - 1) + 1).cast("int").alias("rank"),
        (draw("g") / F.lit(float(1 << 32))).alias("gap"),
    )
    ends = members.select(*groups, F.col("member").alias("neighbour"), F.col("point").alias("_end"))
    placed = (
        drawn.join(nearest.select(*groups, "member", "rank", "neighbour"), [*groups, "member", "rank"])
        .join(members.select(*groups, "member", "point"), [*groups, "member"])
        .join(ends, [*groups, "neighbour"])
    )
    between = F.zip_with("point", "_end", lambda a, b: a + F.col("gap") * (b - a))
    placed = placed.withColumn("_new", between)
    return placed.select(*groups, "replica", *[F.get("_new", F.lit(i)).alias(f) for i, f in enumerate(features)])


def _of_classes(df: DataFrame, short: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows of the classes that need new rows. One row per class on the small side."""
    return df.join(short.select(*groups), list(groups), "left_semi")


def _running_numbers(short: DataFrame, groups: Sequence[str]) -> DataFrame:
    """0..missing-1 per class, generated in chunks so that a large class is spread over tasks."""
    last = F.floor((F.col("_missing") - 1) / _REPLICA_CHUNK).cast("long")
    chunks = short.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(*groups, "_chunk")
    start = F.col("_chunk") * _REPLICA_CHUNK
    end = F.least(start + _REPLICA_CHUNK, F.col("_missing")) - 1
    return chunks.withColumn("replica", F.explode(F.sequence(start, end))).drop("_chunk", "_missing")


def balanced(
    df: DataFrame, features: Sequence[str], label: str = "target", k: int = NEIGHBOURS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Original and synthetic rows; ``row_id`` tells them apart (``b<bar_index>``, ``s<replica>``)."""
    original = df.select(*keys, label, F.concat(F.lit("b"), F.col(INDEX)).alias("row_id"), *features)
    made = synthetic_rows(df, features, label, k, keys).withColumn("row_id", F.concat(F.lit("s"), F.col("replica")))
    return original.unionByName(made.drop("replica"))
