"""Connected components by large and small stars, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import few_tasks
from barloom.session import Workspace


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """``node`` and ``component`` (the least node linked with it) for every node of ``links`` (a, b: long).

    Each step joins edges with the least neighbour of a node. That table is written first: both sides of the
    join are then plain scans, and adaptive execution can split a node with very many neighbours. It ends when
    every edge goes from a node that has no other to one that has none downwards: the least of its component.
    """
    edges = workspace.stage(_oriented(links.select("a", "b"), links.count()), "edges")
    while not _are_stars(edges, n := edges.count()):
        edges = workspace.stage(_oriented(_star(edges, n, workspace, small=False), n), "edges")
        edges = workspace.stage(_oriented(_star(edges, n, workspace, small=True), n), "edges")
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(tops)


def _are_stars(edges: DataFrame, n: int) -> bool:
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down")).unionAll(edges.select(F.col("b"), F.lit(0)))
    nodes = few_tasks(ends.groupBy("node").agg(F.sum("down").alias("down"), F.count(F.lit(1)).alias("n")), n)
    return not nodes.agg(F.max((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("n") > F.col("down"))))).first()[0]


def _oriented(edges: DataFrame, n: int) -> DataFrame:
    """Distinct edges, about ``n``, from the greater node to the lesser."""
    return few_tasks(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), n)


def _star(edges: DataFrame, n: int, workspace: Workspace, small: bool) -> DataFrame:
    """Edges to the least neighbour of a node from its lesser (small) or its greater (large) neighbours."""
    if small:
        least = workspace.stage(few_tasks(edges.groupBy("a").agg(F.min("b").alias("least")), n), "least")
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.unionAll(least.select("a", F.col("least").alias("b")))
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("least"))
    least = workspace.stage(few_tasks(least, n), "least")
    greater = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(least, "u").select(F.col("v").alias("a"), F.col("least").alias("b"))
    return greater
