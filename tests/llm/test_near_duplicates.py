import random
from collections import defaultdict

import numpy as np
import pytest
from corpus_cases import clashing, frame, prose, rows

from barloom.llm import near_duplicates as nd
from barloom.llm.components import components


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_equals_dynamic_programming():
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.randrange(rng.choice([3, 30])) for _ in range(rng.randrange(1, 30))]
        b = [x for x in a if rng.random() > 0.1] + [rng.randrange(9) for _ in range(rng.randrange(4))]
        if not b:
            continue
        x, y = np.array(a, np.uint64), np.array(b, np.uint64)
        m = lcs(a, b)
        assert nd.common_kmers(x, y, 0) == m
        assert nd.similar(x, y) == (m >= 0.8 * (len(a) + len(b) - m) - 1e-9)


def test_sketches_feel_order_and_repeats():
    runs = np.arange(100, 200, dtype=np.uint64)
    moved = np.concatenate([runs[50:], runs[:50]])
    same = (nd.sketches(runs) == nd.sketches(moved)).mean()
    assert same < 0.7 and (nd.sketches(runs) == nd.sketches(runs.copy())).all()
    assert (nd.sketches(runs) != nd.sketches(np.repeat(runs, 2))).any()


def changed(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


def corpus(seed=9):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(120, 300)) for _ in range(40)]
    shared = prose(rng, 60)
    texts = base + [changed(t, rng, 1 + i % 3) for i, t in enumerate(base[:20])] + [t.upper() + " !" for t in base[20:25]]
    texts += [changed(base[0], rng, 2) for _ in range(120)]  # many near copies of one text
    texts += [shared + " " + prose(rng, 60) for _ in range(80)]  # a passage that many share
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def brute_classes(data):
    runs = {r[0]: nd.Runs().of(r[1]) for r in data}
    parent = {d: d for d in runs}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(runs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if top(a) != top(b) and nd.similar(runs[a], runs[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {d: top(d) for d in ids}


@pytest.mark.parametrize("chunk", [32, 3])
def test_classes_equal_all_pairs(spark, workspace, monkeypatch, chunk):
    monkeypatch.setattr(nd, "CHUNK", chunk)
    data = corpus()
    found = nd.duplicate_classes(frame(spark, data), workspace).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == brute_classes(data)
    assert sorted(r["doc_id"] for r in found if r["kept"]) == sorted({r["class_id"] for r in found})


def test_odd_rows(spark, workspace):
    df = clashing(frame(spark), "node", "copy_of", "leader", "kept", "row")
    found = nd.duplicate_classes(df, workspace).collect()
    assert len(found) == len(rows())
    by_class = defaultdict(list)
    for r in found:
        by_class[r["class_id"]].append(r)
    assert all(sum(r["kept"] for r in members) == 1 for members in by_class.values())
    classes = {r["doc_id"]: r["class_id"] for r in found}
    assert classes[60] == 60 and classes[61] == 60  # null and empty texts
    assert classes[62] == 62 and classes[63] == 63 and classes[65] == 64
    assert {classes[66 + i] for i in range(20)} == {7}
    assert nd.duplicate_classes(frame(spark, []), workspace).collect() == []


def test_components_of_chains_and_stars(spark, workspace):
    links = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 500)] + [(-5, -9), (-9, -7)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), workspace).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **{1000 + i: 1000 for i in range(500)}, -5: -9, -9: -9, -7: -9}
    assert components(spark.createDataFrame([], "a long, b long"), workspace).count() == 0


def test_query(spark, sf_dir):
    from barloom.llm.queries import QUERIES

    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op6_order_minhash"](spark, sf_dir).collect()
    runs = defaultdict(list)
    for r in data:
        runs[tuple(nd.WORD.findall(r[1].lower()))].append(r[0])
    want = {w: min(ids) for w, ids in runs.items()}
    brute = brute_classes([(i, " ".join(w)) for w, i in want.items()])
    assert {r["doc_id"]: r["class_id"] for r in found} == {d: brute[min(ids)] for ids in runs.values() for d in ids}


def with_new(words, places, tag):
    return " ".join(f"{tag}{i}" if i in places else w for i, w in enumerate(words))


def chains():
    """Texts A ~ C ~ B with A not ~ B: C and a copy differ in up to six words, A and B in twelve."""
    rng, families = random.Random(31), []
    for _ in range(6):
        words = prose(rng, 300).split()
        spots = rng.sample(range(5, 295, 10), 12)
        texts = [with_new(words, spots[:6], "left"), with_new(words, spots[6:], "right"), " ".join(words)]
        rng.shuffle(texts)
        families.append(texts)
    return families


def two_labels(n=150, m=10):
    """A large family, a small one not similar to it, and one text that is similar to both."""
    rng = random.Random(32)
    words = prose(rng, 300).split()
    spots = rng.sample(range(5, 295, 10), 12)
    large = [with_new(words, {*spots[:6], rng.randrange(150)}, f"a{i}x") for i in range(n)]
    small = [with_new(with_new(words, spots[6:], "far").split(), {rng.randrange(150, 295)}, f"b{i}x") for i in range(m)]
    texts = [*large, *small, " ".join(words)]
    rng.shuffle(texts)
    return [texts]


@pytest.mark.parametrize(("chunk", "block"), [(32, 64), (2, 3)])
@pytest.mark.parametrize("made", [chains, two_labels])
def test_no_link_between_different_texts_is_lost(spark, workspace, monkeypatch, made, chunk, block):
    """Each family shares one sketch and no other, so its pairs meet there or nowhere."""
    monkeypatch.setattr(nd, "CHUNK", chunk)
    monkeypatch.setattr(nd, "BLOCK", block * 300)
    data = [(i, t, f) for i, (f, t) in enumerate((f, t) for f, texts in enumerate(made()) for t in texts)]
    texts = [(i, [f, *(1000 + i * nd.SKETCHES + j for j in range(1, nd.SKETCHES))]) for i, _, f in data]
    links = nd.duplicate_links(
        spark.createDataFrame(texts, "node long, sketches array<long>"), spark.createDataFrame([r[:2] for r in data], "node long, text string"), workspace, 0.8
    )
    found = {r["node"]: r["component"] for r in components(links, workspace).collect()}
    assert {i: found.get(i, i) for i, _, _ in data} == brute_classes(data)


def test_block_compares_what_a_leader_would_hide():
    runs = {r[0]: nd.Runs().of(r[1]) for r in enumerate(chains()[0])}
    pairs = {(a, b) for a in runs for b in runs if a < b and nd.similar(runs[a], runs[b])}
    assert len(pairs) == 2  # one pair of the three is not similar
    texts = [nd.Text(n, n, r, nd.labelled(r), nd.labelled(r)) for n, r in runs.items()]
    for order in ([0, 1, 2], [2, 0, 1], [1, 2, 0]):
        found = nd.block_matches([texts[i] for i in order], None, None, 0.8)
        assert {tuple(sorted(p)) for p in found} == pairs


def test_rare_kmers_are_shared_by_similar_texts():
    """In whatever order, similar texts share one of their first k-mers; unlike texts with a common passage don't."""
    rng = random.Random(41)
    shared = prose(rng, 100)
    texts = [shared + " " + prose(rng, 100) for _ in range(60)]
    runs = [nd.Runs().of(t) for t in texts + [changed(t, rng, 1 + i % 5) for i, t in enumerate(texts)]]
    marks = [nd.labelled(r) for r in runs]
    for counts in (np.zeros(4, np.int32), np.bincount((np.concatenate(marks) % np.uint64(4096)).astype(int), minlength=4096)):
        first = [set(nd.rarest(m, counts, 0.8).tolist()) for m in marks]
        for i in range(len(runs)):
            for j in range(i):
                if nd.similar(runs[i], runs[j]):
                    assert first[i] & first[j]
                elif len(counts) > 4 and i % 60 != j % 60:
                    assert not first[i] & first[j]
    one = np.array([7], np.uint64)
    assert nd.longest_partner(np.array([1, 100, 100]), np.array([0, 0, 20]), 0.8).tolist() == [1, 125, 80]
    assert nd.rarest(one, np.zeros(4, np.int32), 0.8).tolist() == [7]


def test_kmer_counts_have_as_many_rows_for_any_texts(spark, monkeypatch):
    """Near copies, whose k-mers all tasks count; the rows handed on are bounded by the tasks, and the sums are exact."""
    rng, made, real = random.Random(45), [], nd.map_batches
    base = prose(rng, 150)
    texts = [None, "", *(changed(base, rng, 20) for _ in range(400)), "a b a b a b a b a b a b a b a b"]

    def counted(*args):
        made.append(real(*args).count())
        return real(*args)

    monkeypatch.setattr(nd, "map_batches", counted)
    found = nd.kmer_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(4))
    marks = np.concatenate([nd.labelled(r) for r in map(nd.Runs().of, texts) if len(r)])
    assert (found == np.bincount((marks % np.uint64(nd.COUNTERS)).astype(int), minlength=nd.COUNTERS)).all()
    assert len(np.unique(marks)) > 10_000 and made[0] <= 4 * 256 and sum(made[1:]) <= 256
    assert not nd.kmer_counts(spark.createDataFrame([], "text string")).any()


def links_and_rows(spark, workspace, monkeypatch, texts):
    """Classes of texts that all share one sketch, and the rows with texts that are dealt to find them."""
    dealt, real = [], nd.verified

    def counted(rows, *options):
        dealt.append(rows.count())
        return real(rows, *options)

    monkeypatch.setattr(nd, "verified", counted)
    sketches = [(i, [0, *(1000 + i * nd.SKETCHES + j for j in range(1, nd.SKETCHES))]) for i in range(len(texts))]
    links = nd.duplicate_links(
        spark.createDataFrame(sketches, "node long, sketches array<long>"), spark.createDataFrame(list(enumerate(texts)), "node long, text string"), workspace, 0.8
    )
    found = {r["node"]: r["component"] for r in components(links, workspace).collect()}
    monkeypatch.setattr(nd, "verified", real)
    return {i: found.get(i, i) for i in range(len(texts))}, sum(dealt)


def test_rows_of_a_large_bucket_grow_with_its_members(spark, workspace, monkeypatch):
    """Unlike texts that share a passage, and a noisy family of which half is just not similar to anything."""
    rng = random.Random(43)
    shared, base = prose(rng, 60), prose(rng, 120)
    texts = [shared + " " + prose(rng, 60) for _ in range(2000)]
    rows = [links_and_rows(spark, workspace, monkeypatch, texts[:n])[1] for n in (500, 1000, 2000)]
    assert rows[1] <= 2.1 * rows[0] and rows[2] <= 2.1 * rows[1], rows
    monkeypatch.setattr(nd, "BLOCK", 1 << 15)
    noisy = [changed(base, rng, rng.choice([1, 3, 8, 20])) for _ in range(2000)]
    assert links_and_rows(spark, workspace, monkeypatch, noisy)[1] <= 10 * len(noisy)


@pytest.mark.parametrize("block", [1 << 18, 1 << 13, 1 << 10])
def test_noisy_family_equals_all_pairs(spark, workspace, monkeypatch, block):
    """Members from nearly equal to unlike, in one block, in several, and met again by the k-mers of what is left."""
    monkeypatch.setattr(nd, "BLOCK", block)
    rng = random.Random(44)
    base = prose(rng, 150)
    texts = [changed(base, rng, rng.randrange(25)) for _ in range(250)] + [prose(rng, 40) + " " + base[:300] for _ in range(40)]
    found, _ = links_and_rows(spark, workspace, monkeypatch, texts)
    assert found == brute_classes(list(enumerate(texts)))
