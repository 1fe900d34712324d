"""Merkle manifest of a table: leaves, nodes labelled with the leaf ranks they cover, and a proof for every row.

A row's leaf is the hash of its fields. Rows of one group (a language, say) form a tree in the order of their key,
two consecutive nodes to a parent; the trees' roots, in the order of the groups, form one more tree by the same rule.

Ranks. Leaves are dealt out once by ranges of (group, key); a row's rank is its place in its range plus the rows of
its group in earlier ranges. A node at some level carries the interval [lo, hi) of leaf ranks that it covers, so
intervals of a tree nest, and a parent's interval is its children's.

Level buckets. ``BITS`` levels at a time, the nodes that lie below one node of the next level bucket have the same
``lo >> level``: at most 2**BITS of them meet in a task, however large the tree, whose levels are built there and
written with their intervals. Paths then run from the top down. The nodes of a bucket join the path of the ancestor
that contains them all; inside, an ancestor is the node whose interval contains the row's, and a sibling covers the
difference between a parent's interval and the own one. A path is passed on once for each bucket and not for each
row below, and each row's proof is hashed and folded where it is completed.

Defined cases: a null field is hashed as ``-``. A null group is a group of its own and comes first. Null keys come
first; rows that agree in the key are ordered by their leaf, and rows that agree in both are leaves each. A group of
one row has its leaf as root, and a table of one group that group's root. Very long texts are hashed whole, by Spark.
An empty table gives no rows. Other columns of the input take no part and are not returned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barloom.llm.common import give_back, prepared
from barloom.session import Workspace, ship_package

#: Levels that are built and searched together; 2**BITS nodes meet in a task.
BITS = 10
#: Rows of a range when leaves are ranked.
RANGE_ROWS = 250_000
ALONE, LEFT, RIGHT = 0, 1, 2  # where a sibling stands
ENTRY = 33  # bytes of a step of a path: where the sibling stands, and its digest
NODE = "tree string, total long, level int, lo long, hi long, digest binary"
PATH_END = "tree string, bucket long, path binary, subroot binary"


# --- hashes ----------------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """``-`` for null, else the bytes of the text, ``:`` and the text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def parent(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(c.hex().encode() for c in children)).digest()


def height(total: int) -> int:
    """Levels above the leaves of a tree."""
    return max(0, total - 1).bit_length()


def folded(digest: bytes, steps: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that follows from a leaf and (where the sibling stands, its digest in hex) of each level."""
    own = digest.hex().encode()
    for side, other in steps:
        own = sha256(own + other if side == RIGHT else other + own if side == LEFT else own).hexdigest().encode()
    return bytes.fromhex(own.decode())


def steps_of(path: bytes) -> list[tuple[int, bytes]]:
    return [(path[at], path[at + 1 : at + ENTRY].hex().encode()) for at in range(0, len(path), ENTRY)]


# --- ranks -----------------------------------------------------------------------------------------


def ranked(rows: DataFrame, order: Sequence[str], workspace: Workspace) -> DataFrame:
    """``rows`` (written ones) with ``rank``, the place in its tree by ``order``, and ``total``, the rows of the tree."""
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // RANGE_ROWS)
    dealt = rows.repartitionByRange(ranges, "tree", *order).sortWithinPartitions("tree", *order)
    placed = workspace.stage(dealt.withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    # One row for each range and tree in it.
    parts = placed.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.expr("sum(n) over (partition by tree order by part) - n")
    parts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.expr("sum(n) over (partition by tree)").alias("total"))
    found = placed.join(workspace.stage(parts, "ranges"), ["tree", "part"])
    return found.withColumn("rank", F.col("place") + F.col("shift")).drop("place", "part", "shift")


# --- tasks -----------------------------------------------------------------------------------------


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that agree in tree and bucket, which follow one another."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        keys = list(zip(batch.column("tree").to_pylist(), batch.column("bucket").to_pylist(), strict=True))
        start = 0
        for i, own in enumerate(keys):
            if own != key:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, key = [], i, own
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _map(rows: DataFrame, schema: str, work: Callable[[pa.Table], dict[str, object]]) -> DataFrame:
    """``work`` sees all rows of a tree and bucket, ends of paths first, then nodes, then items, each by level and lo."""
    ship_package(rows.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in _groups(batches):
            made = work(group)
            arrays = [made[f.name] if isinstance(made[f.name], pa.Array | pa.ChunkedArray) else pa.array(made[f.name], f.type) for f in out]
            held.append(pa.Table.from_arrays(arrays, schema=out))
            size += len(held[-1])
            if size >= 1 << BITS:  # small groups leave together
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
        if size:
            yield from pa.concat_tables(held).combine_chunks().to_batches()
        give_back()

    order = ["tree", "bucket", "kind", "level", "lo"]
    return rows.repartition("tree", "bucket").sortWithinPartitions(*order).mapInArrow(run, schema)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _built(group: pa.Table, low: int, bits: int) -> dict[str, list]:
    """All nodes above the items of a group, up to ``bits`` levels or the root; the root of a single leaf is the leaf."""
    total = group.column("total")[0].as_py()
    nodes = list(zip(group.column("lo").to_pylist(), group.column("hi").to_pylist(), group.column("digest").to_pylist(), strict=True))
    out = [(low, *n) for n in nodes] if total == 1 else []
    for level in range(low + 1, min(low + bits, height(total)) + 1):
        runs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
        nodes = [(run[0][0], run[-1][1], parent([digest for _, _, digest in run])) for run in runs]
        out += [(level, *n) for n in nodes]
    levels, lo, hi, digests = zip(*out, strict=True)
    return {"tree": [group.column("tree")[0].as_py()] * len(out), "total": [total] * len(out), "level": levels, "lo": lo, "hi": hi, "digest": digests}


class Level:
    """The nodes of one level in a group, by interval."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, digests: list[bytes]):
        self.lo, self.hi = lo, hi
        self.digests = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)

    def containing(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The node whose interval contains each of the given ones."""
        at = np.searchsorted(self.lo, lo, "right") - 1
        if (at < 0).any() or (hi > self.hi[at]).any():
            raise ValueError("a node has no ancestor at the next level")
        return at

    def covering(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The node of exactly each interval."""
        at = self.containing(lo, hi)
        if (self.lo[at] != lo).any() or (self.hi[at] != hi).any():
            raise ValueError("no node covers the difference of two intervals")
        return at


def sibling_steps(levels: list[Level]) -> np.ndarray:
    """Of each node of the first level, the steps of its path below the last: nodes x levels x ENTRY bytes."""
    lo, hi = levels[0].lo, levels[0].hi
    out = np.zeros((len(lo), len(levels) - 1, ENTRY), np.uint8)
    for i, (level, above) in enumerate(zip(levels, levels[1:], strict=False)):
        own, up = level.containing(lo, hi), above.containing(lo, hi)
        # The parent's interval without the own one is a sibling's, on one side at most.
        left, right = above.lo[up] < level.lo[own], level.hi[own] < above.hi[up]
        for side, rows in ((LEFT, np.flatnonzero(left)), (RIGHT, np.flatnonzero(right))):
            if len(rows):
                own_rows, up_rows = own[rows], up[rows]
                rest = (above.lo[up_rows], level.lo[own_rows]) if side == LEFT else (level.hi[own_rows], above.hi[up_rows])
                out[rows, i, 0] = side
                out[rows, i, 1:] = level.digests[level.covering(*rest)]
    return out


def _split(group: pa.Table) -> tuple[bytes, bytes, pa.Table, list[Level]]:
    """The path and the root that the group hangs on, its items, and its levels from the items up."""
    kind = _numbers(group, "kind")
    ends = group.filter(pa.array(kind == 0))
    items, nodes = group.filter(pa.array(kind == 2)), group.filter(pa.array(kind == 1))
    level, lo, hi, digests = _numbers(nodes, "level"), _numbers(nodes, "lo"), _numbers(nodes, "hi"), nodes.column("digest").to_pylist()
    levels = [Level(_numbers(items, "lo"), _numbers(items, "hi"), items.column("digest").to_pylist())]
    for own in np.unique(level).tolist():
        a, b = np.searchsorted(level, [own, own + 1])
        levels.append(Level(lo[a:b], hi[a:b], digests[a:b]))
    return ends.column("path")[0].as_py(), ends.column("subroot")[0].as_py(), items, levels


# --- forests ---------------------------------------------------------------------------------------


class Forest:
    """Trees over ``items`` (tree, total, rank, digest, carried), built up by level buckets.

    ``carried`` is a struct of the caller's that comes back with the item's path.
    """

    def __init__(self, items: DataFrame, workspace: Workspace, bits: int = BITS):
        self.workspace, self.bits = workspace, bits
        rank = F.col("rank").alias("lo")
        self.items = items.select("tree", "total", F.lit(0).alias("level"), rank, (rank + 1).alias("hi"), "digest", "carried")
        self.nodes: list[DataFrame] = []
        most = items.agg(F.max("total")).first()[0] or 1
        below = self.items
        for low in range(0, max(1, height(most)), bits):
            placed = self._placed(below, low).withColumn("kind", F.lit(2)).drop("carried")
            made = _map(placed, NODE, lambda group, low=low: _built(group, low, bits))
            self.nodes.append(workspace.stage(made, f"nodes{low}"))
            below = self._open(len(self.nodes))

    def _placed(self, nodes: DataFrame, low: int) -> DataFrame:
        return nodes.withColumn("bucket", F.shiftright("lo", low + self.bits))

    @staticmethod
    def _height() -> Column:
        """Levels above the leaves: bits of total - 1."""
        return F.when(F.col("total") > 1, F.length(F.bin(F.col("total") - 1))).otherwise(0)

    def _open(self, bucket: int) -> DataFrame:
        """Nodes on top of a level bucket that are not roots: the items of the next one."""
        return self.nodes[bucket - 1].where((F.col("level") == bucket * self.bits) & (self._height() > F.col("level")))

    def roots(self) -> DataFrame:
        out = [n.where(F.col("level") == self._height()).select("tree", "total", "digest") for n in self.nodes]
        whole = out[0]
        for more in out[1:]:
            whole = whole.unionAll(more)
        return whole

    def paths(self, ends: DataFrame, schema: str, finish: Callable[[pa.Table, np.ndarray, bytes, bytes], dict[str, object]]) -> DataFrame:
        """What ``finish`` makes of the items of each group, their steps in the group, the path of the group's top and
        the tree's root. ``ends``: tree, total, path and subroot of each tree, the path being that of its root."""
        last = F.greatest(F.floor((self._height() - 1) / self.bits), F.lit(0)).cast("int")
        ends = self.workspace.stage(ends.select("tree", F.lit(0).cast("long").alias("bucket"), "path", "subroot", last.alias("at")), "ends")
        passed: DataFrame | None = None
        out = None
        for at in range(len(self.nodes) - 1, -1, -1):
            low, mine = at * self.bits, ends.where(F.col("at") == at).drop("at")
            tops = mine if passed is None else mine.unionByName(passed)
            items = self.items if at == 0 else self._open(at)
            carried = "carried" if at == 0 else F.lit(None).cast(self.items.schema["carried"].dataType).alias("carried")
            common = [F.lit(None).cast("binary").alias("path"), F.lit(None).cast("binary").alias("subroot")]
            names = ["tree", "bucket", "level", "lo", "hi", "digest"]
            # A single leaf is its tree's root, which is no level above it.
            above = self._placed(self.nodes[at].where(F.col("level") > low), low)
            nowhere = F.lit(None).cast(self.items.schema["carried"].dataType).alias("carried")
            none = [F.lit(0).alias("level"), *[F.lit(None).cast("long").alias(c) for c in ("lo", "hi")], F.lit(None).cast("binary").alias("digest")]
            rows = (
                self._placed(items, low).select(*names, carried, *common, F.lit(2).alias("kind"))
                .unionAll(above.select(*names, nowhere, *common, F.lit(1).alias("kind")))
                .unionAll(tops.select("tree", "bucket", *none, nowhere, "path", "subroot", F.lit(0).alias("kind")))
            )
            if at == 0:
                out = _map(rows, schema, lambda group: _finished(group, finish))
            else:
                made = _map(rows, PATH_END, lambda group, low=low: _passed_on(group, low))
                passed = self.workspace.stage(made, f"paths{at}")
        return out


def _finished(group: pa.Table, finish: Callable) -> dict[str, object]:
    path, subroot, items, levels = _split(group)
    return finish(items, sibling_steps(levels), path, subroot)


def _passed_on(group: pa.Table, low: int) -> dict[str, object]:
    """Paths of the items, each of which is the top of a bucket below."""
    path, subroot, items, levels = _split(group)
    own = sibling_steps(levels).reshape(len(items), -1)
    n = len(items)
    return {
        "tree": items.column("tree").combine_chunks(), "bucket": _numbers(items, "lo") >> low,
        "path": [row.tobytes() + path for row in own], "subroot": [subroot] * n,
    }


# --- the manifest ----------------------------------------------------------------------------------

CHECKED = "id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _checker(root: bytes) -> Callable[[pa.Table, np.ndarray, bytes, bytes], dict[str, object]]:
    """Hashes and folds the proof of each item."""

    def finish(items: pa.Table, steps: np.ndarray, path: bytes, subroot: bytes) -> dict[str, object]:
        carried = items.column("carried").combine_chunks()
        leaves, claimed = items.column("digest").to_pylist(), carried.field("claimed").to_pylist()
        upper = steps_of(path)
        proofs, roots = [], []
        for own, row, claim in zip(leaves, steps, claimed, strict=True):
            whole = steps_of(row.tobytes()) + upper
            proofs.append(sha256(b"".join(other for side, other in whole if side != ALONE)).hexdigest())
            roots.append(folded(own if claim is None else claim, whole))
        n = len(leaves)
        return {
            "id": carried.field("id"), "leaf": [own.hex() for own in leaves], "subroot": [subroot.hex()] * n, "root": [root.hex()] * n,
            "proof_sha256": proofs, "folded_root": [r.hex() for r in roots], "verified": [r == root for r in roots],
        }

    return finish


def _path_of_item(items: pa.Table, steps: np.ndarray, path: bytes, subroot: bytes) -> dict[str, object]:
    carried = items.column("carried").combine_chunks()
    own = steps.reshape(len(items), -1)
    return {
        "tree": carried.field("tree"), "total": carried.field("total"), "path": [row.tobytes() + path for row in own],
        "subroot": items.column("digest").combine_chunks(),
    }


def leaves(rows: DataFrame, fields: Sequence[Column], group: str, id: str, claimed: Column | None = None) -> DataFrame:
    """tree, id, digest and claimed (a leaf to be checked in place of the own one, or null) of each row.

    The tree's name is the group's behind a sign that keeps the order of its bytes; a null group's name is empty.
    """
    name = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    claim = F.lit(None).cast("binary") if claimed is None else claimed
    return rows.select(name.alias("tree"), F.col(id).alias("id"), leaf(fields).alias("digest"), claim.alias("claimed"))


def checked(hashed: DataFrame, workspace: Workspace, bits: int = BITS) -> DataFrame:
    """Build the manifest of ``hashed`` (see ``leaves``) and return for each row: id, leaf, subroot, root,
    proof_sha256 (hash of its siblings, from the leaf up), folded_root (what the claimed leaf, or else its own, and
    the proof give) and verified (whether that is the root)."""
    spark: SparkSession = prepared(hashed.sparkSession)
    kind = dict(hashed.dtypes)["id"]
    hashed = workspace.stage(hashed.withColumn("row", F.monotonically_increasing_id()), "leaves")
    if hashed.isEmpty():
        return spark.createDataFrame([], CHECKED.format(kind=kind))
    # Spark sorts nulls first. The row number only splits rows that are alike in everything.
    placed = ranked(hashed, ["id", "digest", "row"], workspace)
    items = workspace.stage(placed.select("tree", "total", "rank", "digest", F.struct("id", "claimed").alias("carried")), "items")
    lower = Forest(items, workspace, bits)

    roots = workspace.stage(lower.roots(), "roots")
    named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("total").alias("leaves"), "digest")
    named = ranked(named, ["name"], workspace)
    carried = F.struct(F.col("name").alias("tree"), F.col("leaves").alias("total")).alias("carried")
    upper = Forest(workspace.stage(named.select("tree", "total", "rank", "digest", carried), "trees"), workspace, bits)
    top = upper.roots().first()
    root = bytes(top["digest"])
    no_path = spark.createDataFrame([("", top["total"], b"", root)], "tree string, total long, path binary, subroot binary")
    ends = upper.paths(no_path, "tree string, total long, path binary, subroot binary", _path_of_item)
    return lower.paths(ends, CHECKED.format(kind=kind), _checker(root))
