import hashlib
import random
import re

import numpy as np
import pytest
from corpus_cases import clashing, frame, prose, rows

from barloom.llm import decontamination as dc


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(data, items):
    """(n_words, hit words, items) of each (doc_id, text)."""
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in data:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), sorted(hit), sorted(found)))
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def assert_equal(spark, workspace, data, items):
    df = clashing(frame(spark, data), "row", "runs", "fp", "item_id", "n_words_", "start", "left", "gram")
    found = dc.contamination(df, benchmark(spark, items), workspace).collect()
    got = [(r["doc_id"], r["n_words"], [i for s in r["spans"] for i in range(s["start"], s["end"])], list(r["items"])) for r in found]
    assert all(r["n_hit"] == len(g[2]) for r, g in zip(found, got, strict=True))
    key = lambda t: (t[0] is not None, t[0], t[1:])
    assert sorted(got, key=key) == sorted(brute([(r[0], r[1]) for r in data], items), key=key)


def test_every_shared_window_is_found(spark, workspace):
    rng = random.Random(8)
    items = [(i, prose(rng, rng.randrange(8, 40))) for i in range(12)] + [(12, None), (13, ""), (14, "?!"), (15, "one rare"), (16, "rare"), (16, "rare")]
    items += [(20, items[0][1]), (21, items[0][1].upper())]
    data = rows(n=20)
    for i in range(30):
        source = words(items[i % 12][1])
        first = rng.randrange(len(source))
        piece = source[first : first + rng.randrange(1, 25)]
        data.append((200 + i, f"{prose(rng, 30)}; {', '.join(piece).title()} - {prose(rng, 20)} rare", "en", "s", 0))
    data.append((300, " ".join(items[3][1].split() * 30), "en", "s", 0))
    assert_equal(spark, workspace, data, items)


def test_no_benchmark_and_no_documents(spark, workspace):
    assert_equal(spark, workspace, rows(n=5), [])
    assert dc.contamination(frame(spark, []), benchmark(spark, [(1, "a b c")]), workspace).collect() == []


def test_winnowing_selects_a_run_of_every_window():
    rng = np.random.default_rng(1)
    for hashes in (rng.integers(0, 2**63, 200).astype(np.uint64), rng.integers(0, 3, 200).astype(np.uint64), np.zeros(40, np.uint64)):
        places, found = dc.fingerprints(hashes)
        runs = dc.run_hashes(hashes, dc.K)
        wide, n = dc.SPAN - dc.K + 1, len(hashes) - dc.SPAN + 1
        least = [max(range(i, i + wide), key=lambda j: (-int(runs[j]), j)) for i in range(n)]  # the rightmost of equals
        assert places.tolist() == sorted(set(least)) and (found == runs[places]).all()
        for i in (0, n // 2, n - 1):  # a span alone selects the run that it selects in its text
            alone, _ = dc.fingerprints(hashes[i : i + dc.SPAN])
            assert alone.tolist() == [least[i] - i]
    places, _ = dc.fingerprints(rng.integers(0, 2**63, 100_000).astype(np.uint64))
    assert len(places) < 0.52 * 100_000  # 2 of every wide + 1 runs
    assert len(dc.fingerprints(np.zeros(dc.SPAN - 1, np.uint64))[0]) == 0


def test_equal_runs_and_only_they_have_equal_hashes():
    hashes = np.random.default_rng(3).integers(0, 3, 400).astype(np.uint64)
    for k in range(1, 10):
        found = dc.run_hashes(hashes, k)
        runs = [tuple(hashes[i : i + k].tolist()) for i in range(len(hashes) - k + 1)]
        assert len(found) == len(runs) and len(set(zip(runs, found.tolist(), strict=True))) == len(set(runs)) == len(set(found.tolist()))
    assert len(dc.run_hashes(hashes[:3], 4)) == 0


def test_runs_that_match_without_a_whole_window_are_no_hits(spark, workspace):
    item = " ".join(f"w{i}" for i in range(40))
    near = [f"a{k} {' '.join(f'w{i}' for i in range(k, k + n))} b{k}" for k in range(30) for n in (8, 9, 10, 11)]
    assert_equal(spark, workspace, [(i, t, "en", "s", 0) for i, t in enumerate(near)], [(1, item), (2, " ".join(f"w{i}" for i in range(5, 14)))])


def test_repeated_words_and_long_texts(spark, workspace):
    data = [(1, "la " * 9, "en", "s", 0), (2, "la " * 10, "en", "s", 0), (3, "la " * 500 + "x " + "la " * 9, "en", "s", 0), (4, "lo la " * 20_000, "en", "s", 0)]
    assert_equal(spark, workspace, data, [(1, "la " * 12), (2, "la lo " * 6), (3, "la la la")])


def test_bitmap_grows_with_the_fingerprints(spark):
    for n in (0, 3, 5000):
        found = spark.range(n).selectExpr("xxhash64(id) as fp")
        bits = np.frombuffer(dc.fingerprint_bitmap(found), np.uint64)
        assert 64 * len(bits) >= 16 * n
        for r in found.collect():
            low = r["fp"] & (64 * len(bits) - 1)
            assert int(bits[low >> 6]) >> (low & 63) & 1


@pytest.mark.parametrize("name", ["op9_winnowing_decontamination"])
def test_query(spark, sf_dir, name):
    from barloom.llm.queries import QUERIES

    data = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = {r["doc_id"]: r for r in QUERIES[name](spark, sf_dir).collect()}
    for doc, n, hit, ids in brute(data, items):
        r = found[doc]
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == (n, len(hit), len(ids), digest, bool(hit))


def test_items_without_an_id_count_for_hits(spark, workspace):
    rng = random.Random(12)
    passages = [prose(rng, 20) for _ in range(3)]
    items = [(None, passages[0]), (1, passages[1]), (None, passages[2]), (2, passages[2])]
    data = [(i, f"{prose(rng, 15)} {p} {prose(rng, 15)}", "en", "s", 0) for i, p in enumerate(passages)] + [(3, prose(rng, 40), "en", "s", 0)]
    found = dc.contamination(frame(spark, data), benchmark(spark, items), workspace).collect()
    want = brute([(r[0], r[1]) for r in data], items)
    assert sorted((r["doc_id"], r["n_hit"], list(r["items"])) for r in found) == [(d, len(hit), [i for i in ids if i != "None"]) for d, _, hit, ids in want]
    assert [len(hit) for _, _, hit, _ in want][:3] == [20, 20, 20]
