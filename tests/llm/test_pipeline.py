import zlib

import numpy as np
from corpus_cases import clashing, frame, rows

import corpus_pipeline
from barloom.llm import decontamination, near_duplicates, quality
from barloom.llm.queries import tokenizer_path


def test_stages_keep_the_columns_and_stand_odd_rows(spark, sf_dir, workspace):
    for data in (rows(), []):
        docs = clashing(frame(spark, data), "node", "row", "copy", "kept")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = workspace.stage(stage(spark, docs, sf_dir), name.split()[0])
            assert docs.columns == columns, name
        assert docs.count() == 0 or data
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_stages_against_brute_force(spark, sf_dir, workspace):
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in given.collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]

    def ids(df):
        return sorted(r["doc_id"] for r in df.select("doc_id").collect())

    stages = dict(corpus_pipeline.STAGES)
    good = workspace.stage(stages["quality rules"](spark, given, sf_dir), "good")
    passing = sorted(i for i, t in texts.items() if quality.passes(t))
    assert ids(good) == passing

    single = workspace.stage(stages["near duplicates"](spark, good, sf_dir), "single")
    runs = {i: near_duplicates.Runs().of(texts[i]) for i in passing}
    parent = {i: i for i in passing}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, i in enumerate(passing):
        for j in passing[:n]:
            if top(i) != top(j) and near_duplicates.similar(runs[i], runs[j]):
                a, b = sorted((top(i), top(j)))
                parent[b] = a
    left = sorted({top(i) for i in passing})
    assert ids(single) == left

    clean = workspace.stage(stages["decontamination"](spark, single, sf_dir), "clean")
    windows = set()
    for text in items:
        w = decontamination.words_of(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}

    def contaminated(text):
        w = decontamination.words_of(text)
        return any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert ids(clean) == [i for i in left if not contaminated(texts[i])]

    mixed = workspace.stage(stages["mixture"](spark, clean, sf_dir), "mixed")
    assert set(ids(mixed)) <= set(ids(clean)) and 0.5 < mixed.count() / clean.count() < 1.5

    from tokenizers import Tokenizer

    tokenizer, want = Tokenizer.from_file(tokenizer_path()), []
    for r in mixed.collect():
        raw = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1], "<u4").tobytes()
        want.append((r["doc_id"], len(raw) // 4, zlib.crc32(raw)))
    found = stages["token files"](spark, mixed, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == sorted(want)
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    rising = sum(a < b for a, b in zip(order, order[1:], strict=False)) / len(order)
    assert order != sorted(order) and 0.3 < rising < 0.7  # a shuffle: about half of the neighbours rise


def test_rows_that_differ_in_their_id_only_by_hash_are_told_apart(spark, sf_dir, workspace, monkeypatch):
    """With a hash that tells nothing apart the ids still do."""
    from pyspark.sql import functions as F

    data = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect() if quality.passes(r["text"])]
    docs = spark.createDataFrame(data, spark.read.parquet(f"{sf_dir}/documents.parquet").schema)
    stages = dict(corpus_pipeline.STAGES)
    want = sorted(r["doc_id"] for r in workspace.stage(stages["decontamination"](spark, docs, sf_dir), "plain").collect())
    monkeypatch.setattr(corpus_pipeline, "_with_node", lambda d: d.withColumn(corpus_pipeline.NODE, F.lit(1).cast("long")))
    found = sorted(r["doc_id"] for r in workspace.stage(stages["decontamination"](spark, docs, sf_dir), "same").collect())
    assert found == want and len(found) < len(data)


def test_run_is_the_stages_in_order(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir).orderBy("start").collect()
    assert found and [r["start"] for r in found] == [0, *np.cumsum([r["n_tokens"] for r in found])[:-1].tolist()]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "decontamination", "mixture", "token files"]
