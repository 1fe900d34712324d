"""Sharding by histogram sort, in DataFrame operations only.

The rows are ordered by (key, tie). Boundaries that cut this order into parts of equal weight are found
by counting: every round places probes in the interval that still holds each boundary, one partial
aggregate counts the exact weight and rows between probes, and the interval shrinks to the gap that the
boundary falls in. A boundary is done when a probe lies within the tolerance, or when its interval is one
(key, tie). Only then do whole rows move, once, straight to their part. What a round sends to the driver
is bounded by ``PROBES``, or 16 for each part where there are more parts than that.

Defined cases: a null key or tie counts as -1 and sorts first. Rows that agree in key and tie stay
together. A very long text is one row like others and is never cut; its weight is its size. An empty table
gives no rows. Input columns named like the result's are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import prepared, size_of, text_bytes
from barloom.session import Workspace

PROBES = 1 << 15
KEY, TIE, WEIGHT, PART = "_hs_key", "_hs_tie", "_hs_weight", "_hs_part"
SPACE = 1 << 62
Point = tuple[int, int]


@dataclass
class Splitters:
    """Boundaries between parts, and the exact weight and rows below each."""

    points: list[Point]
    weight_below: list[int]
    rows_below: list[int]
    rounds: int


@dataclass(frozen=True)
class _Gap:
    """Points from ``start`` up to ``start + span`` on one axis (0: key, 1: tie within one key)."""

    axis: int
    start: Point
    span: int
    weight: int
    rows: int

    def at(self, offset: int) -> Point:
        key, tie = self.start
        return (key + offset, tie) if self.axis == 0 else (key, tie + offset)


def hashed(*columns: Column) -> Column:
    """A key without order of its own, between 0 and 2**62."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(SPACE - 1))


def _points(points: list[Point]) -> Column:
    return F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(t).cast("long").alias("t")) for k, t in points])


def at_most(points: list[Point], key: str = KEY, tie: str = TIE) -> Column:
    """How many of the sorted points are not after the row, by bisection."""
    if not points:
        return F.lit(0)
    found, wanted = _points(points), F.struct(F.col(key).alias("k"), F.col(tie).alias("t"))
    steps = [1 << b for b in range(len(points).bit_length() - 1, -1, -1)]

    def step(place: Column, by: Column) -> Column:
        return F.when(F.get(found, place + by - 1) <= wanted, place + by).otherwise(place)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def find_splitters(keyed: DataFrame, parts: int, rows: int, weight: int, tolerance: float) -> Splitters:
    """Boundaries of ``parts`` parts of equal weight over a table of KEY, TIE and WEIGHT."""
    slack = tolerance * weight / parts
    whole = _Gap(0, (-1, -1), SPACE + 1, 0, 0)
    found: dict[int, tuple[Point, int, int]] = {}
    open_: dict[int, _Gap] = {j: whole for j in range(1, parts)} if rows else {}
    rounds = 0
    while open_:
        rounds += 1
        gaps = sorted(set(open_.values()), key=lambda g: g.start)
        per_gap = max(16, PROBES // len(gaps))
        widths = [-(-g.span // per_gap) for g in gaps]
        counts = _count(keyed, gaps, widths)
        for place, gap in enumerate(gaps):
            width, bins = widths[place], counts.get(place, [])
            wanted = {j: weight * j / parts for j, g in open_.items() if g == gap}
            for j, target in wanted.items():
                del open_[j]
                below, below_rows = gap.weight, gap.rows
                for bin_, bin_weight, bin_rows in bins:
                    if below + bin_weight < target:
                        below, below_rows = below + bin_weight, below_rows + bin_rows
                        continue
                    low = (gap.at(bin_ * width), below, below_rows)
                    high_at = bin_ * width + width
                    high = (gap.at(high_at), below + bin_weight, below_rows + bin_rows)
                    if gap.axis == 1 and width == 1 or min(target - low[1], high[1] - target) <= slack:
                        found[j] = low if target - low[1] <= high[1] - target else high
                    elif width > 1:
                        open_[j] = _Gap(gap.axis, low[0], min(width, gap.span - bin_ * width), below, below_rows)
                    else:
                        open_[j] = _Gap(1, (low[0][0], -1), SPACE + 1, below, below_rows)
                    break
    if not rows:
        found = {j: ((-1, -1), 0, 0) for j in range(1, parts)}
    ordered = [found[j] for j in range(1, parts)]
    return Splitters([p for p, _, _ in ordered], [w for _, w, _ in ordered], [r for _, _, r in ordered], rounds)


def _count(keyed: DataFrame, gaps: list[_Gap], widths: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """Weight and rows of each gap's bins that are not empty, in order."""

    def of(values: list[int]) -> Column:
        return F.get(F.array(*[F.lit(v).cast("long") for v in values]), F.col("gap"))

    offset = F.when(of([g.axis for g in gaps]) == 0, F.col(KEY)).otherwise(F.col(TIE)) - of([g.start[g.axis] for g in gaps])
    inside = (F.col("gap") >= 0) & (F.col("offset") < of([g.span for g in gaps]))
    single = F.lit(True) if all(g.axis == 0 for g in gaps) else (of([g.axis for g in gaps]) == 0) | (F.col(KEY) == of([g.start[0] for g in gaps]))
    rows = (
        keyed.withColumn("gap", at_most([g.start for g in gaps]) - 1)
        .where((F.col("gap") >= 0) & single)
        .withColumn("offset", offset)
        .where(inside)
        .withColumn("width", of(widths))
        .groupBy("gap", F.expr("offset div width").alias("bin"))
        .agg(F.sum(WEIGHT).alias("weight"), F.count(F.lit(1)).alias("n"))
    )
    out: dict[int, list[tuple[int, int, int]]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["gap"], r["bin"])):
        out.setdefault(r["gap"], []).append((r["bin"], r["weight"], r["n"]))
    return out


def shard_rows(
    df: DataFrame, key: Column, tie: Column, weight: Column, workspace: Workspace, shards: int = 16,
    tolerance: float = 0.001, part_bytes: int = 256 << 20, order: str = "slot",
) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard, in key order).

    ``key`` and ``tie`` are longs between 0 and 2**62 (see ``hashed``). Shards have nearly equal sums of
    ``weight``: each boundary is off by at most ``tolerance`` of a part or half of its row. A shard moves as
    several consecutive parts of about ``part_bytes``, so no task takes a whole shard however large it is.
    """
    spark = prepared(df.sparkSession)
    rows = df.drop("shard", order).withColumns(
        {KEY: F.coalesce(key, F.lit(-1)).cast("long"), TIE: F.coalesce(tie, F.lit(-1)).cast("long"), WEIGHT: weight.cast("long")}
    )
    keyed = workspace.stage(rows.select(KEY, TIE, WEIGHT), "keys")
    n, total = size_of(keyed, F.col(WEIGHT))
    each = max(1, -(-total // (shards * part_bytes)))
    parts = shards * each
    cut = find_splitters(keyed, parts, n, total, tolerance)
    below = [0, *cut.rows_below]
    start = [below[p] - below[p - p % each] for p in range(parts)]
    # The one exchange: part numbers are partition numbers, so a row's place in its partition is its place in the part.
    moved = rows.withColumn(PART, at_most(cut.points)).repartitionById(parts, F.col(PART)).sortWithinPartitions(KEY, TIE)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.get(F.array(*[F.lit(s).cast("long") for s in start]), F.col(PART))
    return moved.withColumns({"shard": F.expr(f"int({PART} div {each})"), order: place + first}).drop(KEY, TIE, WEIGHT, PART)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; every task writes the part that it holds."""
    sharded.write.partitionBy("shard").parquet(path)


def document_shards(documents: DataFrame, workspace: Workspace, shards: int = 16, **options) -> DataFrame:
    """Documents in shards of nearly equal bytes (UTF-8 bytes of the text plus 1). Copies of a text lie side
    by side; a group of copies is cut only where a shard would get too large otherwise."""
    return shard_rows(
        documents, hashed(F.col("text")), hashed(F.col("doc_id"), F.lit(1)), text_bytes() + 1, workspace, shards, **options
    )
