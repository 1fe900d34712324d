"""Whitening of embeddings from exact cross-products, which are counted by bits.

Vectors become whole numbers, x = floor(scale * c) + shift. The cross-products of all dimensions are exact: in each
block of rows a dimension is shifted to begin at 0, its bit planes are packed across the rows into 64-bit words, and
sum(x_i * x_j) is the sum over planes of 2**(b + c) * popcount(plane_ib & plane_jc). A task adds its blocks up and
sends one number for each pair of dimensions; Spark sums them as decimals. What reaches the driver is the matrix of
cross-products, bounded by the dimensions and not by the rows. There it is centred in whole numbers, n * C - S * S',
and only then divided and decomposed, so that no digits cancel. A second pass projects the rows.

Defined cases: rows whose vector is null or empty, holds a null, NaN or infinite entry or one of 2**40 or more in size
are dropped, and so are vectors that have not the most common length (of lengths that are equally common, the
greatest). Repeated rows count each. A null id is an id like others. Components without variance (also those that
only rounding gives one) have null as whitened value and take no part in ``identity_error``, which is null if there
is none with variance. A ``deviation`` beyond a long is null. Dimensions of any number of bits and vectors of any
length are counted alike; memory is that of a block of ``BLOCK`` rows. An empty table gives no rows. Other columns
take no part and are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import give_back, prepared
from barloom.session import Workspace, ship_package

SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**40
BLOCK = 4096
COMPONENTS = 8
LONG = 2**63 - 1
SUMS = "i int, j int, value decimal(38,0)"


def whole_numbers(entries: np.ndarray, scale: int = SCALE, shift: int = SHIFT) -> np.ndarray:
    return np.floor(entries.astype(np.float64) * scale).astype(np.int64) + shift


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of the columns of whole numbers from 0 (planes x words), the bit of each plane, the first plane of each column."""
    bits = np.maximum(1, [int(most).bit_length() for most in y.max(axis=0)])
    starts = np.cumsum(bits) - bits
    of = np.repeat(np.arange(y.shape[1]), bits)
    bit = np.arange(len(of)) - starts[of]
    packed = np.zeros((len(of), -(-len(y) // 64) * 8), np.uint8)
    for b in range(int(bits.max())):
        planes = np.flatnonzero(bit == b)
        rows = np.packbits((y[:, of[planes]] >> b & 1).astype(np.uint8).T, axis=1)
        packed[planes, : rows.shape[1]] = rows
    return packed.view(np.uint64), bit, starts


def cross_products(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns and, in the upper triangle, of their products, from popcounts of bit planes."""
    planes, bit, starts = bit_planes(y)
    d = y.shape[1]
    # All partial sums stay in range if the largest does; else numbers without limit are used.
    wide = 2 * (int(bit.max()) + 1) + len(y).bit_length() > 62
    kind = object if wide else np.int64
    weights = np.array([1 << int(b) for b in bit], kind)
    products = np.zeros((d, d), kind)
    for i in range(d):
        first = starts[i]
        rest, rest_weights, rest_starts = planes[first:], weights[first:], starts[i:] - first
        for k in range(first, starts[i + 1] if i + 1 < d else len(planes)):
            count = np.bitwise_count(rest & planes[k]).sum(axis=1, dtype=np.int64)
            products[i, i:] += np.add.reduceat(count.astype(kind) * rest_weights, rest_starts) * weights[k]
    sums = np.add.reduceat(np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(kind) * weights, starts)
    return sums, products


class Totals:
    """Rows, sums and sums of products of all blocks added so far, exact."""

    def __init__(self, dimensions: int):
        self.n = 0
        self.sums = np.zeros(dimensions, object)
        self.products = np.zeros((dimensions, dimensions), object)

    def add(self, x: np.ndarray) -> None:
        low = x.min(axis=0)
        sums, products = cross_products(x - low)
        low, sums, n = low.astype(object), sums.astype(object), len(x)
        self.n += n
        self.sums += sums + n * low
        # (y + low) * (y' + low'); only the upper triangle is read.
        self.products += products.astype(object) + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)

    def rows(self) -> Iterator[tuple[int, int, int]]:
        """n as (-1, -1), sums as (-1, i), products as (i, j) with i <= j."""
        yield -1, -1, self.n
        for i, s in enumerate(self.sums):
            yield -1, i, s
            yield from ((i, j, self.products[i, j]) for j in range(i, len(self.sums)))


@dataclass
class Whitening:
    """What the fit gives: rows and exact sums, the components (rows), their eigenvalues and the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    scale: int
    shift: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if most < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares of each row; null where a long does not hold them."""
        most = int(np.abs(centred).max(initial=0))
        if most * most * max(1, centred.shape[1]) <= LONG:
            return (centred * centred).sum(axis=1).tolist()
        return [v if v <= LONG else None for v in (centred.astype(object) ** 2).sum(axis=1).tolist()]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Rows by components; NaN where a component has no variance."""
        known = self.eigenvalues > 0
        roots = np.where(known, np.sqrt(np.where(known, self.eigenvalues, 1.0)), np.nan)
        return centred.astype(np.float64) / self.n @ self.components.T / roots


def usable(vectors: DataFrame, id: str, column: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of the rows whose entries are all known and finite."""
    kept = vectors.select(F.col(id).alias("id"), F.col(column).cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return kept.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & good)


def _entries(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def covariance(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """Centred in whole numbers; each entry is then rounded once."""
    v = np.empty((len(sums), len(sums)))
    for (i, j), p in products.items():
        v[i, j] = v[j, i] = (n * p - sums[i] * sums[j]) / (n * n)
    return v


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of all ``rows`` (of ``usable``) of the most common length; None without rows."""
    spark = prepared(rows.sparkSession)
    common = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = common.agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    if most is None:
        return None
    d = most["d"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, held, size = Totals(d), [], 0
        for batch in batches:
            held.append(whole_numbers(_entries(batch.column(0), d), scale, shift))
            size += len(held[-1])
            while size >= BLOCK:
                block = np.concatenate(held)
                totals.add(block[:BLOCK])
                held, size = [block[BLOCK:]], size - BLOCK
        if size:
            totals.add(np.concatenate(held))
        if totals.n:
            i, j, value = zip(*totals.rows(), strict=True)
            values = pa.array([Decimal(int(v)) for v in value], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], ["i", "j", "value"])
        give_back()

    ship_package(spark)
    summed = rows.where(F.size("vector") == d).select("vector").mapInArrow(work, SUMS).groupBy("i", "j").agg(F.sum("value").alias("value"))
    found = {(r["i"], r["j"]): int(r["value"]) for r in summed.collect()}  # as many as pairs of dimensions
    n = found.pop((-1, -1))
    sums = [found.pop((-1, i)) for i in range(d)]
    v = covariance(n, sums, found)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components].T
    # Below this, rounding alone gives an eigenvalue.
    values = np.where(values > 4 * d * np.finfo(float).eps * max(values.max(), 0.0), values, 0.0)
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], 1)
    return Whitening(n, sums, vectors * np.sign(largest), values, float(np.trace(v)), scale, shift)


def projected(rows: DataFrame, model: Whitening, kind: str) -> DataFrame:
    """id, deviation and whitened (an array by component) of the rows (of ``usable``) that the model fits."""
    d = model.dimensions

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = model.centred(whole_numbers(_entries(batch.column(1), d), model.scale, model.shift))
            white = model.whitened(centred)
            flat = pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel()))
            arrays = pa.ListArray.from_arrays(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1], flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviations(centred), pa.int64()), arrays], ["id", "deviation", "whitened"])
        give_back()

    ship_package(rows.sparkSession)
    return rows.where(F.size("vector") == d).mapInArrow(work, f"id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the covariance of ``whitened`` (of all rows that were fitted) minus the identity."""
    known = np.flatnonzero(model.eigenvalues > 0).tolist()
    if not known:
        return None
    value = {k: F.get("whitened", F.lit(k)) for k in known}
    pairs = [(i, j) for i in known for j in known if i <= j]
    # Spark's covar_pop centres as it goes and merges centred sums.
    row = white.agg(*[F.covar_pop(value[i], value[j]).alias(f"{i}_{j}") for i, j in pairs]).first()
    return max(abs(row[f"{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened_rows(vectors: DataFrame, workspace: Workspace, id: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows and return for each of them and each component: the id, component (from 1), n,
    deviation (sum over dimensions of (n * x - S)**2), whitened, explained and identity_error."""
    kind = dict(vectors.dtypes)[id]
    rows = usable(vectors, id, column)
    model = fit(rows, components)
    if model is None:
        schema = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    white = workspace.stage(projected(rows, model, kind), "whitened")
    error = identity_error(white, model)
    explained = [float(e / model.trace) if model.trace > 0 else 0.0 for e in model.eigenvalues]
    return white.select(
        F.col("id").alias(id), F.col("deviation"), F.posexplode("whitened").alias("place", "whitened")
    ).select(
        id,
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(e) for e in explained]), F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
