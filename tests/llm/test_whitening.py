"""Whitening against whole-number sums by brute force, and on the defined cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def whole(vector):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in vector]


def usable(rows):
    good = [r for r in rows if r[1] and all(c is not None and math.isfinite(c) and abs(c) < 2**40 for c in r[1])]
    lengths = [len(r[1]) for r in good]
    common = max(set(lengths), key=lambda n: (lengths.count(n), n), default=0)
    return [(r[0], whole(r[1])) for r in good if len(r[1]) == common]


def brute_force(rows):
    """(n, S, V as rounded once from whole numbers) of the usable rows."""
    xs = [x for _, x in rows]
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    v = np.array([[sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in xs) / n**3 for j in range(d)] for i in range(d)])
    return n, sums, v


def check(got, rows, components=8):
    rows = usable(rows)
    n, sums, v = brute_force(rows)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    got = got.collect()
    assert len(got) == len(rows) * len(values)
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["deviation"]), []).append(r)
    for id_, x in rows:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))
        mine = {r["component"]: r for r in by_id[id_, deviation if deviation < 2**63 else None]}
        centred = np.array([c - s / n for c, s in zip(x, sums, strict=True)])
        for k in range(len(values)):
            r = mine[k + 1]
            assert r["n"] == n and abs(r["explained"] - values[k] / np.trace(v)) <= 1e-9
            assert abs(abs(r["whitened"]) - abs(centred @ vectors[:, k] / math.sqrt(values[k]))) < 1e-6
            assert r["identity_error"] < 1e-9
    signs = {}  # one sign for all rows
    for id_, x in rows:
        for r in by_id.get((id_, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))), []):
            k = r["component"] - 1
            plain = np.array([c - s / n for c, s in zip(x, sums, strict=True)]) @ vectors[:, k]
            if abs(plain) > 1:
                signs.setdefault(k, set()).add(bool(plain > 0) == (r["whitened"] > 0))
    assert all(len(s) == 1 for s in signs.values())


def vectors(seed=3, n=300, d=10):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.3
    rows = [(i, [float(np.float32(c)) for c in x], i % 5) for i, x in enumerate(mixed)]
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [1.0] * (d - 1) + [None], 1), (n + 3, [float("nan")] + [0.0] * (d - 1), 1)]
    rows += [(n + 4, [float("inf")] * d, 1), (n + 5, [1.0] * (d + 2), 1), (n + 6, [1e30] * d, 1), rows[4], rows[4], (None, rows[5][1], None)]
    return rows


@pytest.mark.parametrize("most", [1, 2, 5_000, 2**21, 2**40])
def test_popcounts_are_cross_products(most):
    """Of columns with few and with many bits, and of numbers of rows that do not fill a word."""
    rng = np.random.default_rng(most)
    for rows in (1, 63, 64, 65, 1000):
        y = rng.integers(0, most, size=(rows, 5))
        y[:, 2] = 0
        sums, products = whitening.cross_products(y)
        wanted = y.astype(object).T @ y.astype(object)
        assert sums.tolist() == y.astype(object).sum(axis=0).tolist()
        assert all(products[i, j] == wanted[i, j] for i in range(5) for j in range(i, 5))


def test_totals_of_blocks():
    rng = np.random.default_rng(1)
    x = rng.integers(-(10**6), 10**9, size=(500, 4))
    totals = whitening.Totals(4)
    for part in np.array_split(x, 7):
        totals.add(part)
    wanted = x.astype(object).T @ x.astype(object)
    assert totals.n == 500 and all(totals.products[i, j] == wanted[i, j] for i in range(4) for j in range(i, 4))


def test_rows(spark, workspace, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK", 64)
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    check(whitening.whitened_rows(frame, workspace), rows)
    clashing = frame.withColumns({c: F.lit("x") for c in ("id", "vector", "component", "n", "whitened", "d", "i", "j", "value", "place")})
    check(whitening.whitened_rows(clashing, workspace, components=3), rows, 3)


def test_large_entries(spark, workspace):
    """Entries of 50 bits: deviations beyond a long are null, the rest stays exact."""
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * 2.0**38]) for i in range(50)]
    rows = [(i, v) for i, v in rows if max(map(abs, v)) < 2**40]
    got = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), workspace).collect()
    assert {r["deviation"] for r in got} == {None} and len(got) == 3 * len(rows)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_without_variance(spark, workspace):
    """Constant, doubled and single rows: components that have no variance are null."""
    rows = [(i, [float(i % 3), 2.0 * (i % 3), 5.0]) for i in range(9)]
    got = whitening.whitened_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), workspace).collect()
    assert len(got) == 27
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in got)
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-9 and r["identity_error"] < 1e-9 for r in got)
    one = whitening.whitened_rows(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<float>"), workspace).collect()
    assert [(r["whitened"], r["deviation"], r["identity_error"]) for r in one] == [(None, 0, None)] * 2


def test_empty(spark, workspace):
    assert whitening.whitened_rows(spark.createDataFrame([], SCHEMA), workspace).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1), (2, [None], 1)], SCHEMA)
    assert whitening.whitened_rows(only_bad, workspace).count() == 0


def test_query(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(queries.QUERIES["op12_embedding_whitening"](spark, sf_dir), rows[:0] + rows)
