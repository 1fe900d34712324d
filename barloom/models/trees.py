"""Forests of many models, grown level by level in one job for all of them.

A model is named by a string (a series and a strategy, say), a fit is one forest of it: its parameters and the fold
that it leaves out. Rows are cut into blocks of bounded size, their features into bins, and a block is one packed
row. For each level of all trees of all fits there is one job: every block meets the units (some trees of a fit) of
its model, puts its rows into the open nodes of their trees and sends one histogram (feature, bin, class) for each
node; histograms of a node are added up where they meet, and its best split follows. So a thousand fits take as many
jobs as the deepest tree has levels, a model with many rows is spread over its blocks, and nothing but the number of
open nodes comes to the driver.

Scoring takes the nodes as a table: blocks meet units in the same way, trees are walked as arrays, and the plan is
the same for one model and for thousands.

Trees are those of a random forest by weighted Gini impurity: bootstrap draws are Poisson(1) counts, a node looks at a
random part of the features, and a split needs ``min_split`` draws in the node and ``min_leaf`` in each child. What is
drawn depends on the seed, the fit, the tree, and the block or node, and not on how work is spread.

Defined cases: rows without a label or with a null feature do not belong here (they are incomplete). A model without
rows has no trees; a fit whose fold leaves no rows has none, and its rows get no score. Rows that repeat count each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barloom.operators.blocks import join_per_group
from barloom.session import ship_package, stage

BINS = 32
BLOCK_ROWS = 16_384
UNIT_TREES = 16
DEEPEST = 60  # a node's number has one bit for each level
SEED = 42

ROWS = "model string, row_id string, features array<double>, label int, weight double, fold int"
PARAMS = "fold int, trees int, depth int, min_leaf int, min_split int, subset string, allowed array<int>"
FIT = f"model string, fit string, {PARAMS}"
NODES = "model string, fit string, unit int, tree int, node long, feature int, bin int, threshold double, value array<double>"
_BLOCK = "model string, block long, n int, width int, row_ids array<string>, bins binary, labels binary, weights binary, folds binary, edges array<array<double>>"
_NODE_KEYS = ("model", "fit", "tree", "node")


# --- blocks ----------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, bins: int = BINS) -> DataFrame:
    """``edges`` of each model: for each feature the distinct quantiles that part its values into ``bins``."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    values = rows.select("model", F.posexplode("features").alias("place", "value"))
    quantiles = values.groupBy("model", "place").agg(F.array_distinct(F.percentile_approx("value", shares, F.lit(10_000))).alias("edges"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "edges")))
    return quantiles.groupBy("model").agg(F.transform(ordered, lambda e: e["edges"]).alias("edges"))


def packed(rows: DataFrame, edges: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` (see ROWS) in blocks of about ``block_rows``, each one row with its features in bins; written once."""
    counts = rows.groupBy("model").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks"))
    dealt = join_per_group(rows, counts, ["model"], ["row_id"]).withColumn("block", F.pmod(F.xxhash64("row_id"), F.col("_blocks")))
    held = F.array_sort(F.collect_list(F.struct("row_id", "features", "label", "weight", "fold"))).alias("rows")
    blocks = dealt.groupBy("model", "block").agg(held).join(edges, "model")

    def pack(block: dict) -> dict:
        held, edges = block.pop("rows"), block["edges"]
        width = len(edges)
        x = np.array([(*r["features"], *[0.0] * width)[:width] for r in held], np.float64).reshape(len(held), width)
        bins = np.column_stack([np.searchsorted(np.array(e), x[:, f]) for f, e in enumerate(edges)]).astype(np.uint8)

        def of(name: str, kind: str, missing: float) -> bytes:
            return np.array([missing if r[name] is None else r[name] for r in held], kind).tobytes()

        return block | {
            "n": len(held), "width": len(edges), "row_ids": [r["row_id"] for r in held], "bins": bins.tobytes(),
            "labels": of("label", "i4", 0), "weights": of("weight", "f8", 1.0), "folds": of("fold", "i4", -1),
        }

    return stage(_each(blocks, _BLOCK, lambda block: [pack(block)]), "blocks")


class Block(NamedTuple):
    bins: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    folds: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        bins = np.frombuffer(row["bins"], np.uint8).reshape(row["n"], row["width"])
        return cls(bins, *[np.frombuffer(row[c], k) for c, k in (("labels", "i4"), ("weights", "f8"), ("folds", "i4"))])


def _each(df: DataFrame, schema: str, work) -> DataFrame:
    """Rows that ``work`` makes of each row (as dicts), a batch of few rows at a time."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(work(batch.slice(i, 1).to_pylist()[0]))
                if made:
                    yield pa.RecordBatch.from_pylist(made, schema=out)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


# --- one tree --------------------------------------------------------------------------------------


def _generator(*parts: object) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=xxhash.xxh3_64_intdigest("|".join(map(str, parts)))))


def bootstrap(seed: int, fit: str, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree."""
    return _generator(seed, fit, tree, "rows", block).poisson(1.0, n)


def looked_at(seed: int, fit: str, tree: int, node: int, allowed: list[int], subset: str) -> np.ndarray:
    """The features that a node looks at, in order."""
    share = {"sqrt": math.sqrt, "log2": math.log2, "all": float}[subset](len(allowed))
    return np.sort(_generator(seed, fit, tree, "features", node).permutation(np.array(allowed))[: max(1, int(share))])


class Walk:
    """The nodes of one tree as arrays."""

    def __init__(self, nodes: list[dict]):
        nodes = sorted(nodes, key=lambda n: n["node"])
        self.node = np.array([n["node"] for n in nodes], np.int64)
        self.feature = np.array([n["feature"] for n in nodes], np.int64)
        self.bin = np.array([n["bin"] for n in nodes], np.int64)

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The number of the node that each row ends in."""
        at = np.ones(len(bins), np.int64)
        moving = np.arange(len(bins))
        while len(moving) and len(self.node):
            place = np.minimum(np.searchsorted(self.node, at[moving]), len(self.node) - 1)
            inner = (self.node[place] == at[moving]) & (self.feature[place] >= 0)
            moving, place = moving[inner], place[inner]
            at[moving] = 2 * at[moving] + (bins[moving, self.feature[place]] > self.bin[place])
        return at


def histograms(block: Block, at: np.ndarray, open_: np.ndarray, draws: np.ndarray, classes: int) -> np.ndarray:
    """Of each open node: weight by feature, bin and class, and in the last place of a bin its draws."""
    use = np.flatnonzero((draws > 0) & np.isin(at, open_))
    node = np.searchsorted(open_, at[use])
    n, width = len(open_), block.bins.shape[1]
    out = np.zeros((n, width, BINS, classes + 1))
    weights, drawn = block.weights[use] * draws[use], draws[use].astype(np.float64)
    for f in range(width):
        cell = node * BINS + block.bins[use, f]
        out[:, f, :, :classes] = np.bincount(cell * classes + block.labels[use], weights, n * BINS * classes).reshape(n, BINS, classes)
        out[:, f, :, classes] = np.bincount(cell, drawn, n * BINS).reshape(n, BINS)
    return out


def impurity(weights: np.ndarray) -> np.ndarray:
    """Gini impurity times the weight, over the last axis."""
    total = weights.sum(axis=-1)
    return total - np.divide((weights**2).sum(axis=-1), total, out=np.zeros_like(total), where=total > 0)


class Split(NamedTuple):
    feature: int
    bin: int
    left: np.ndarray
    right: np.ndarray


def best_split(histogram: np.ndarray, features: np.ndarray, min_leaf: int) -> Split | None:
    """The split that lowers impurity most (of equals that of the first feature and bin), or None."""
    left = histogram[features].cumsum(axis=1)[:, :-1]
    right = histogram[features].sum(axis=1)[:, None] - left
    gain = impurity(histogram[0].sum(axis=0)[:-1]) - impurity(left[..., :-1]) - impurity(right[..., :-1])
    fits = (left[..., -1] >= min_leaf) & (right[..., -1] >= min_leaf)
    gain = np.where(fits, np.round(gain, 9), 0.0)
    if not gain.size or gain.max() <= 0:
        return None
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return Split(int(features[f]), int(b), left[f, b], right[f, b])


def is_open(weights: np.ndarray, level: int, params: dict) -> bool:
    """Whether a node of this level is to be split. ``weights``: by class, then the draws."""
    enough = weights[-1] >= max(params["min_split"], 2 * params["min_leaf"])
    return bool(enough and level < min(params["depth"], DEEPEST) and np.round(impurity(weights[:-1]), 9) > 0)


# --- growing ---------------------------------------------------------------------------------------

_PARAMS = ("fold", "depth", "min_leaf", "min_split", "subset", "allowed")
_STATE = "array<struct<tree:int,node:long,feature:int,bin:int>>"
_HISTOGRAM = f"model string, fit string, unit int, tree int, node long, histogram binary, width int, {PARAMS}"
_MADE = f"{NODES}, open boolean".replace("threshold double, ", "")


def grown(blocks: DataFrame, fits: DataFrame, classes: int, seed: int = SEED) -> DataFrame:
    """The nodes (see NODES) of all trees of all ``fits`` (see FIT), as a written table.

    An inner node has the feature and the bin whose rows go left; a leaf has feature -1 and class weights.
    """
    numbered = fits.withColumn("unit", F.explode(F.sequence(F.lit(0), F.expr(f"int((trees - 1) div {UNIT_TREES})"))))
    first = F.col("unit") * UNIT_TREES
    roots = F.transform(F.sequence(first, F.least(F.col("trees"), first + UNIT_TREES) - 1), lambda t: F.struct(t.alias("tree"), F.lit(1).cast("long").alias("node")))
    units = stage(numbered, "units")
    state = units.withColumns({"open": roots, "splits": F.array().cast(_STATE)})
    levels: list[DataFrame] = []
    while True:
        made = stage(_level(blocks, state, classes, seed), f"level{len(levels)}")
        levels.append(made)
        waiting = made.where("open").groupBy("model", "fit", "unit").agg(F.collect_list(F.struct("tree", "node")).alias("open"))
        waiting = stage(waiting, "open")
        if waiting.isEmpty():
            break
        splits = _union(levels).where("feature >= 0").groupBy("model", "fit", "unit")
        splits = splits.agg(F.collect_list(F.struct("tree", "node", "feature", "bin")).alias("splits"))
        state = units.join(waiting, ["model", "fit", "unit"]).join(splits, ["model", "fit", "unit"])
    edges = blocks.groupBy("model").agg(F.first("edges").alias("edges"))
    threshold = F.when(F.col("feature") >= 0, F.get(F.get("edges", F.col("feature")), F.col("bin")))
    nodes = _union(levels).where("not open").join(edges, "model").withColumn("threshold", threshold)
    return nodes.select(*[c.split()[0] for c in NODES.split(", ")])


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _level(blocks: DataFrame, state: DataFrame, classes: int, seed: int) -> DataFrame:
    """Split the open nodes of all trees: the nodes that were split or are leaves, and children that are still open."""

    def count(row: dict) -> Iterator[dict]:
        block = Block.of(row)
        inside = block.folds != (-2 if row["fold"] is None else row["fold"])
        splits, open_ = _by_tree(row["splits"]), _by_tree(row["open"])
        common = {c: row[c] for c in ("model", "fit", "unit", "width", *_PARAMS)} | {"trees": 0}
        for tree, nodes in open_.items():
            draws = bootstrap(seed, row["fit"], tree, row["block"], row["n"]) * inside
            at = Walk(splits.get(tree, [])).leaves(block.bins)
            open_nodes = np.sort(np.array([n["node"] for n in nodes], np.int64))
            for node, histogram in zip(open_nodes.tolist(), histograms(block, at, open_nodes, draws, classes), strict=True):
                if histogram.any():
                    yield common | {"tree": tree, "node": node, "histogram": histogram.tobytes()}

    def decide(row: dict, histogram: np.ndarray) -> Iterator[dict]:
        node, level = row["node"], row["node"].bit_length() - 1
        weights = histogram[0].sum(axis=0)
        common = {c: row[c] for c in ("model", "fit", "unit", "tree")}
        leaf = {"feature": -1, "bin": 0}
        features = looked_at(seed, row["fit"], row["tree"], node, row["allowed"] or list(range(row["width"])), row["subset"])
        split = best_split(histogram, features, row["min_leaf"]) if is_open(weights, level, row) else None
        if split is None:
            yield common | leaf | {"node": node, "value": weights[:-1].tolist(), "open": False}
            return
        yield common | {"node": node, "feature": split.feature, "bin": split.bin, "value": weights[:-1].tolist(), "open": False}
        for child, own in ((2 * node, split.left), (2 * node + 1, split.right)):
            yield common | leaf | {"node": child, "value": own[:-1].tolist(), "open": is_open(own, level + 1, row)}

    met = _each(state.drop("trees").join(blocks.drop("row_ids", "edges"), "model"), _HISTOGRAM, count)
    shape = (-1, BINS, classes + 1)
    return _summed(met, _NODE_KEYS, "histogram", _MADE, lambda row, total: decide(row, total.reshape(shape)))


def _by_tree(nodes: list[dict]) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for n in nodes:
        out.setdefault(n["tree"], []).append(n)
    return out


def _summed(df: DataFrame, keys: tuple[str, ...], array: str, schema: str, work) -> DataFrame:
    """Rows that ``work`` makes of each key's first row and the sum of its packed arrays, of which one is held."""
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, total = None, None, None
        made: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                own = np.frombuffer(row.pop(array), np.float64)
                key = tuple(row[k] for k in keys)
                if key != at:
                    if at is not None:
                        made += work(first, total)
                    at, first, total = key, row, own.copy()
                else:
                    total += own
                    first |= {c: v for c, v in row.items() if v is not None and first[c] is None}
            if len(made) >= 1024:
                yield pa.RecordBatch.from_pylist(made, schema=out)
                made = []
        if at is not None:
            made += work(first, total)
        if made:
            yield pa.RecordBatch.from_pylist(made, schema=out)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


# --- scoring ---------------------------------------------------------------------------------------

SCORED = "model string, fit string, row_id string, label int, fold int, probability array<double>"
_PART = "model string, fit string, block long, unit int, total binary, row_ids array<string>, labels array<int>, folds array<int>"


def scored(blocks: DataFrame, nodes: DataFrame, classes: int, fits: DataFrame | None = None) -> DataFrame:
    """``probability`` (mean over the trees of a fit) of the rows of each block by every fit of its model. With
    ``fits`` a fit scores only the rows of the fold that it left out."""
    units = nodes.groupBy("model", "fit", "unit").agg(F.collect_list(F.struct("tree", "node", "feature", "bin", "value")).alias("nodes"))
    least = nodes.groupBy("model", "fit").agg(F.min("unit").alias("first_unit"))
    units = units.join(least, ["model", "fit"])
    only = F.lit(None).cast("int") if fits is None else F.col("only")
    if fits is not None:
        units = units.join(fits.select("model", "fit", F.col("fold").alias("only")), ["model", "fit"])
    units = units.withColumn("only", only)

    def walk(row: dict) -> Iterator[dict]:
        block = Block.of(row)
        use = np.arange(row["n"]) if row["only"] is None else np.flatnonzero(block.folds == row["only"])
        if not len(use):
            return
        total = np.zeros((len(use), classes + 1))
        for nodes in _by_tree(row["nodes"]).values():
            at = Walk(nodes).leaves(block.bins[use])
            order = sorted(nodes, key=lambda n: n["node"])
            values = np.array([n["value"] for n in order])[np.searchsorted([n["node"] for n in order], at)]
            total[:, :classes] += values / values.sum(axis=1, keepdims=True)
            total[:, classes] += 1
        named = row["unit"] == row["first_unit"]  # one unit of a fit brings what the rows are
        yield {
            "model": row["model"], "fit": row["fit"], "block": row["block"], "unit": row["unit"], "total": total.tobytes(),
            "row_ids": [row["row_ids"][i] for i in use] if named else None, "labels": block.labels[use].tolist() if named else None,
            "folds": block.folds[use].tolist() if named else None,
        }

    def mean(row: dict, total: np.ndarray) -> Iterator[dict]:
        total = total.reshape(-1, classes + 1)
        for id_, label, fold, sums in zip(row["row_ids"], row["labels"], row["folds"], total, strict=True):
            yield {"model": row["model"], "fit": row["fit"], "row_id": id_, "label": label, "fold": fold, "probability": (sums[:-1] / sums[-1]).tolist()}

    met = _each(units.join(blocks.drop("edges"), "model"), _PART, walk)
    return _summed(met, ("model", "fit", "block"), "total", SCORED, mean)
