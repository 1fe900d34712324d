"""Exact copies against a brute-force grouping, with hashes that collide, and on the defined cases."""

import hashlib
from collections import defaultdict

import corpus_cases as cases
import pytest
from pyspark.sql import functions as F

from barloom.llm import exact_copies, queries

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def lowered(text):
    return (text or "").translate(UPPER)


def brute_force(rows, pick=max):
    """(id, kept id, size) of each row, sorted."""
    groups = defaultdict(list)
    for r in rows:
        groups[lowered(r[1])].append(r[0])
    order = lambda i: (i is not None, i or 0)
    out = [(r[0], pick(groups[lowered(r[1])], key=order), len(groups[lowered(r[1])])) for r in rows]
    return sorted(out, key=str), len(groups)


def check(got, rows, pick=max):
    want, n_groups = brute_force(rows, pick)
    got = got.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=str) == want
    assert sum(r.kept for r in got) == n_groups  # ties in the id too: one row stays
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def corpus():
    rows = cases.rows()
    rows += [(900 + i, t, "en", "s", 1) for i, t in enumerate(["STRASSE", "straße", "strasse", "ÄRGER", "ärger", "ärgeR", "İ", "i̇", "K", "K", "k"])]
    return rows + [(None, rows[7][1], "en", None, 1), (None, None, None, None, None), (None, "only here", None, None, 9), (None, "only here", None, None, 9)]


@pytest.mark.parametrize("keep, pick", [("greatest", max), ("least", min)])
def test_groups(spark, workspace, keep, pick):
    check(exact_copies.marked(cases.frame(spark, corpus()), workspace, keep=keep), corpus(), pick)


@pytest.mark.parametrize("weak", [lambda t: F.lit(b"same"), lambda t: F.md5(F.substring(t, 1, 3)).cast("binary")])
def test_collisions_are_told_apart(spark, workspace, weak):
    """With a hash that many texts share, only equal bytes make a group."""
    check(exact_copies.marked(cases.frame(spark, corpus()), workspace, keep="greatest", content_hash=weak), corpus())


def test_collisions_without_broadcast(spark, workspace, monkeypatch):
    monkeypatch.setattr(exact_copies, "BROADCAST", 0)
    weak = lambda t: F.md5(F.substring(t, 1, 3)).cast("binary")
    check(exact_copies.marked(cases.frame(spark, corpus()), workspace, keep="greatest", content_hash=weak), corpus())


def test_clashing_columns_and_empty(spark, workspace):
    rows = cases.clashing(cases.frame(spark, corpus()), "key", "row", "id", "size", "keep_id", "kept", "salt", "n", "stays")
    check(exact_copies.marked(rows, workspace, keep="greatest"), corpus())
    assert exact_copies.marked(cases.frame(spark, []), workspace).count() == 0
    with pytest.raises(ValueError):
        exact_copies.marked(rows, workspace, keep="any")


def test_other_id_types(spark, workspace):
    rows = [("b", "X y"), ("a", "x Y"), ("c", "z")]
    got = exact_copies.marked(spark.createDataFrame(rows, "name string, body string"), workspace, text="body", id="name").collect()
    assert sorted((r.name, r.keep_id, r.group_size, r.kept) for r in got) == [("a", "a", 2, True), ("b", "a", 2, False), ("c", "c", 1, True)]


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = queries.QUERIES["op11_exact_copies"](spark, sf_dir)
    assert not any("Python" in line or "Arrow" in line for line in got._jdf.queryExecution().toString().splitlines())
    check(got, [(r.doc_id, r.text) for r in rows])
    hashes = {r.doc_id: hashlib.sha256(lowered(r.text).encode()).hexdigest() for r in rows}
    assert {r.doc_id: r.text_sha256 for r in got.collect()} == hashes
