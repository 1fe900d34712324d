import zlib

import pytest
from corpus_cases import clashing, frame
from pyspark.sql import functions as F

from barloom.llm import sharding


def laid_out(spark, workspace, df, **options):
    return sharding.document_shards(df, workspace, **options).toPandas()


@pytest.mark.parametrize("part_bytes", [256 << 20, 20_000])
def test_shards_are_whole_even_and_gapless(spark, workspace, part_bytes):
    df = clashing(frame(spark), "shard", "slot", "weight")
    found = laid_out(spark, workspace, df, shards=4, part_bytes=part_bytes)
    assert len(found) == df.count() and set(found["weight"]) == {"x"}
    sizes = found["text"].map(lambda t: len((t or "").encode()) + 1)
    by_shard = sizes.groupby(found["shard"]).sum()
    # A boundary is at most half of its document away from where it should be, and so is the other one.
    assert abs(by_shard - sizes.sum() / 4).max() <= sizes.max()
    for _, slots in found.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))


def test_copies_lie_side_by_side_and_the_order_is_that_of_the_key(spark, workspace):
    found = laid_out(spark, workspace, frame(spark), shards=4, part_bytes=20_000).sort_values(["shard", "slot"])
    texts = found["text"].fillna("\0null").tolist()
    runs = [t for i, t in enumerate(texts) if i == 0 or texts[i - 1] != t]
    assert len(runs) == len(set(runs))


def test_boundaries_meet_the_tolerance_on_many_small_rows(spark, workspace):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    found = laid_out(spark, workspace, df, shards=16)
    sizes = (found["text"].str.len() + 1).groupby(found["shard"]).sum()
    assert abs(sizes / sizes.mean() - 1).max() < 0.003


def test_one_text_on_most_rows_is_cut_by_id(spark, workspace):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 > 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    found = laid_out(spark, workspace, df, shards=8)
    assert found.groupby("shard").size().between(340, 410).all()


def test_probing_narrows_down_in_few_rounds(spark, workspace):
    keyed = spark.range(50_000).select(sharding.hashed(F.col("id")).alias(sharding.KEY), F.col("id").alias(sharding.TIE), F.lit(1).cast("long").alias(sharding.WEIGHT))
    cut = sharding.find_splitters(keyed, 16, 50_000, 50_000, 0.001)
    assert cut.rounds <= 3 and max(abs(w - 3125 * j) for j, w in enumerate(cut.weight_below, 1)) <= 4
    assert cut.weight_below == cut.rows_below and cut.points == sorted(cut.points)


def test_nothing_gives_nothing(spark, workspace):
    assert len(laid_out(spark, workspace, frame(spark, []))) == 0


def test_no_python_on_the_way(spark, workspace):
    plan = sharding.document_shards(frame(spark), workspace)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_files_hold_the_shards(spark, workspace):
    path = workspace.path("shards")
    sharding.write_shards(sharding.document_shards(frame(spark), workspace, shards=4), path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 4


def test_query(spark, sf_dir):
    from barloom.llm.queries import QUERIES

    found = QUERIES["op1_histogram_shards"](spark, sf_dir).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(found["doc_id"]) == sorted(texts)
    for r in found.itertuples():
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
