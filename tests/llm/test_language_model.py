import math
import re
from collections import Counter, defaultdict

import pytest
from corpus_cases import clashing, frame, prose, rows

from barloom.llm import language_model as lm


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "</s>"]


def discounts(counts):
    n = [sum(1 for c in counts.values() if c == i) for i in (1, 2, 3, 4)]
    if not n[0] or not n[1]:
        return [0, 0.5, 1.0, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    raw = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return [0, *(d if 0 < d <= i else i / 2 for i, d in enumerate(raw, 1))]


class Brute:
    """The model with dictionaries of words."""

    def __init__(self, texts, order, min_count):
        self.order, self.min_count = order, min_count
        top = Counter()
        self.words = Counter()
        for text in texts:
            tokens = tokens_of(text)
            self.words.update(tokens)
            padded = ["<s>"] * (order - 1) + tokens
            top.update(tuple(padded[i : i + order]) for i in range(len(tokens)))
        self.counts = {order: top}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d = {k: discounts(c) for k, c in self.counts.items()}
        self.total, self.mass = defaultdict(Counter), defaultdict(Counter)
        for k, c in self.counts.items():
            for g, n in c.items():
                left_out = k == order and k > 1 and n < min_count
                self.total[k][g[:-1]] += n
                self.mass[k][g[:-1]] += n if left_out else self.d[k][min(n, 3)]

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(self.words) + 1)
        total = self.total[k][gram[:-1]]
        lower = self.p(gram[1:])
        if not total:
            return lower
        n = self.counts[k].get(gram, 0)
        if k == self.order and k > 1 and n < self.min_count:
            n = 0
        own = max(n - self.d[k][min(n, 3)], 0)
        return (own + self.mass[k][gram[:-1]] * lower) / total

    def score(self, text):
        tokens = tokens_of(text)
        padded = ["<s>"] * (self.order - 1) + tokens
        return sum(math.log10(self.p(tuple(padded[i : i + self.order]))) for i in range(len(tokens)))

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[t] + 1) / (n + v + 1)) for t in tokens_of(text))


@pytest.mark.parametrize(("order", "min_count"), [(1, 1), (2, 1), (2, 2), (3, 1), (3, 2)])
def test_scores_equal_the_model_by_hand(spark, workspace, order, min_count):
    data = [r for r in rows() if r[0] is not None and (r[1] is None or len(r[1]) < 5000)]
    train = [r for r in data if r[0] % 5]
    model = lm.train(frame(spark, train), workspace, order, min_count, bucket_bytes=2000)
    brute = Brute([r[1] for r in train], order, min_count)
    found = lm.score(clashing(frame(spark, data), "score", "kind"), model).collect()
    assert len(found) == len(data) and model.levels[1].raw == sum(brute.words.values())
    texts = {r[0]: r[1] for r in data}
    for r in found:
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == len(tokens_of(text)) and r["n_known"] == sum(brute.words[t] > 0 for t in tokens_of(text))
        assert r["base_score"] == pytest.approx(brute.base(text), rel=1e-9)
        assert r["score"] == pytest.approx(brute.score(text), rel=1e-9)


def test_probabilities_sum_to_one():
    brute = Brute([prose(__import__("random").Random(i), 80) for i in range(30)], 2, 2)
    for context in ["alpha", "<s>", "never"]:
        assert sum(brute.p((context, w)) for w in brute.words) + brute.p((context, "unseen")) == pytest.approx(1)


def test_very_long_texts_and_stretches(spark, workspace):
    data = rows()
    texts = frame(spark, data)
    one = lm.score(texts, lm.train(texts, workspace)).orderBy("doc_id", "n_tokens").collect()
    assert len(one) == len(data) and all(r["n_known"] == r["n_tokens"] for r in one)
    few = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(few)
    spark.conf.set(few, "5")
    try:
        assert lm.counted(texts, 2, 16, stretch=500).count() > lm.counted(texts, 2, 16).count()
    finally:
        spark.conf.set(few, before)


def test_nothing_to_learn_from(spark, workspace):
    model = lm.train(frame(spark, []), workspace)
    found = lm.score(frame(spark, [(1, "a b", "en", "s", 3)]), model).collect()
    assert (found[0]["n_tokens"], found[0]["n_known"], found[0]["score"], found[0]["base_score"]) == (3, 0, 0.0, 0.0)
    assert lm.score(frame(spark, []), model).collect() == []


def test_held_out_texts_are_likelier_by_the_model_than_by_single_words(spark, sf_dir):
    from barloom.llm.queries import QUERIES

    found = QUERIES["op8_kneser_ney"](spark, sf_dir).toPandas()
    held = found[found["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    learnt = [texts[i] for i in found[~found["held_out"]]["doc_id"]]
    brute = Brute(learnt, 2, 1)
    for r in found.itertuples():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), rel=1e-6)
        assert r.base_score == pytest.approx(brute.base(texts[r.doc_id]), rel=1e-6)
