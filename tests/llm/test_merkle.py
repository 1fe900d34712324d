"""Manifests against a tree built in plain Python, level by level, and on the defined cases."""

import zlib
from hashlib import sha256

import corpus_cases as cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import merkle, queries

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves):
    """All levels of a tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def path_in(levels, place):
    """(side, sibling) at each level from the leaf up."""
    out = []
    for level in levels[:-1]:
        other = place ^ 1
        out.append(("alone", "") if other >= len(level) else ("left" if other < place else "right", level[other]))
        place >>= 1
    return out


def fold(own, path):
    for side, other in path:
        own = h(other + own if side == "left" else own + other)
    return own


def brute_force(rows):
    """rows: (doc_id, text, lang, source, n_chars). All result rows, sorted."""
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        own = leaf_of((doc_id, source, lang, n_chars, text))
        other = leaf_of((doc_id, source, lang, None if n_chars is None else n_chars + 1, text)) if tampered else own
        groups.setdefault(lang, []).append((doc_id, own, other))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = tree_of([own for _, own, _ in groups[lang]])
    upper = tree_of([trees[lang][-1][0] for lang in langs])
    root = upper[-1][0]
    out = []
    for i, lang in enumerate(langs):
        for place, (doc_id, own, other) in enumerate(groups[lang]):
            path = path_in(trees[lang], place) + path_in(upper, i)
            back = fold(other, path)
            out.append((doc_id, own, trees[lang][-1][0], root, h("".join(s for _, s in path)), back, back == root))
    return sorted(out, key=str)


def checked(df, workspace, bits):
    fields = [F.col(c) for c in FIELDS]
    longer = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    claimed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf(longer))
    got = merkle.checked(merkle.leaves(df, fields, "lang", "doc_id", claimed), workspace, bits)
    return sorted(map(tuple, got.collect()), key=str)


def corpus():
    rows = cases.rows()
    out = [(r[0], r[1], ["en", "fr", None, "", "é", "z"][i % 6] if i % 2 else "en", *r[3:]) for i, r in enumerate(rows)]
    return out + [(7_000 + i, None, f"lang{i}", None, None) for i in range(5)] + [(None, None, None, None, None)] * 3


@pytest.mark.parametrize("bits", [1, 2, 3, 10])
def test_levels_in_buckets(spark, workspace, bits):
    """Any number of levels at a time gives the same tree."""
    assert checked(cases.frame(spark, corpus()), workspace, bits) == brute_force(corpus())


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 64, 65])
def test_sizes(spark, workspace, n):
    """Trees that are whole, and trees whose last runs are single nodes on several levels."""
    rows = [(i, f"text {i}", "en", "s", i) for i in range(n)]
    assert checked(cases.frame(spark, rows), workspace, 2) == brute_force(rows)


def test_ranges(spark, workspace, monkeypatch):
    """Groups over many ranges, and ranges with many groups."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", 7)
    rows = [(i * 37 % 1000, "t", "en" if i % 3 else f"l{i % 60}", "s", 1) for i in range(1000)]
    assert checked(cases.frame(spark, rows), workspace, 4) == brute_force(rows)


def test_clashing_columns_and_empty(spark, workspace):
    names = ("tree", "id", "digest", "claimed", "row", "rank", "total", "place", "part", "level", "lo", "hi", "bucket", "kind", "path", "root", "leaf")
    assert checked(cases.clashing(cases.frame(spark, corpus()), *names), workspace, 10) == brute_force(corpus())
    assert checked(cases.frame(spark, []), workspace, 10) == []


def test_changed_nodes_are_found():
    """A node that does not nest is an error, and a changed leaf or sibling does not fold to the root."""
    lo = np.arange(4)
    level = merkle.Level(lo, lo + 1, [bytes(32)] * 4)
    with pytest.raises(ValueError):
        merkle.Level(np.array([0]), np.array([3]), [bytes(32)]).containing(lo, lo + 1)
    with pytest.raises(ValueError):
        level.covering(np.array([0]), np.array([2]))
    leaves = [sha256(str(i).encode()).digest() for i in range(2)]
    root = merkle.parent(leaves)
    right = leaves[1].hex().encode()
    assert merkle.folded(leaves[0], [(merkle.RIGHT, right)]) == root
    assert merkle.folded(leaves[0], [(merkle.LEFT, right)]) != root and merkle.folded(leaves[1], [(merkle.RIGHT, right)]) != root


def test_query(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.QUERIES["op13_merkle_manifest"](spark, sf_dir)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)
