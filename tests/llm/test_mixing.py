from collections import Counter

import pytest
from corpus_cases import clashing, frame, rows
from pyspark.sql import functions as F

from barloom.llm import mixing


def many(spark, n=20_000):
    """One source with two thirds of the rows."""
    source = F.when(F.col("id") % 3 < 2, "big").when(F.col("id") % 2 == 0, "small").otherwise(F.lit(None))
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("x" * 99).alias("text"), source.alias("source"))


def test_sources_meet_their_targets(spark):
    weights = {"big": 1.0, "small": 2.0, "": 1.0}
    found = Counter(r["source"] for r in mixing.mixed(many(spark), weights=weights).select("source").collect())
    assert found["big"] == pytest.approx(5000, rel=0.05)
    assert found["small"] == pytest.approx(10_000, rel=0.05)
    assert found[None] == pytest.approx(5000, rel=0.05)


def test_a_source_without_weight_is_left_out(spark):
    found = Counter(r["source"] for r in mixing.mixed(many(spark), weights={"small": 1.0}).select("source").collect())
    assert set(found) == {"small"} and found["small"] == pytest.approx(20_000, rel=0.05)


def test_counts_are_poisson(spark):
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    rates = mixing.source_rates(df).withColumn("rate", F.lit(40.0))
    rates = mixing.source_rates(df.limit(1), weights={"s": 1}).select("mix_source", "bytes", F.lit(1.0).alias("rate"), "draws", "cdf")
    copies = Counter(r["doc_id"] for r in mixing.mixed(df, rates).select("doc_id").collect())
    shares = Counter(copies.values())
    for k, p in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert shares[k] / 30_000 == pytest.approx(p, abs=0.012)


def test_large_rates_are_sums_of_draws(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "rare").otherwise("x" * 50).alias("text"), F.when(F.col("id") < 20, "rare").otherwise("rest").alias("source"))
    facts = {r["mix_source"]: r for r in mixing.source_rates(df, weights={"rare": 1.0, "rest": 9.0}).collect()}
    assert facts["rare"]["rate"] > 60 and facts["rare"]["draws"] >= 4
    found = Counter(r["source"] for r in mixing.mixed(df, weights={"rare": 1.0, "rest": 9.0}).select("source").collect())
    assert found["rare"] / 20 == pytest.approx(facts["rare"]["rate"], rel=0.2)


def test_many_sources_take_the_salted_join(spark, monkeypatch):
    one = sorted((r["doc_id"], r["copy"]) for r in mixing.mixed(many(spark, 500)).collect())
    monkeypatch.setattr(mixing, "MOST_BROADCAST", 0)
    assert sorted((r["doc_id"], r["copy"]) for r in mixing.mixed(many(spark, 500)).collect()) == one


def test_odd_rows(spark):
    df = clashing(frame(spark), "copy", "mix_salt_", "rate_", "weight")
    found = mixing.mixed(df).collect()
    assert {"copy", "copies", "mix_order", "weight"} <= set(found[0].asDict())
    given = Counter((r[0], r[1]) for r in rows())
    for (doc, text), n in Counter((r["doc_id"], r["text"]) for r in found).items():
        copies = {r["copies"] for r in found if (r["doc_id"], r["text"]) == (doc, text)}
        assert len(copies) == 1 and n == given[doc, text] * copies.pop()
    assert mixing.mixed(frame(spark, [])).collect() == []


def test_rows_come_in_global_hash_order(spark):
    found = [r["mix_order"] for r in mixing.mixed(many(spark, 2000)).select("mix_order").collect()]
    assert found == sorted(found)


def test_large_mixtures_are_dealt_over_parts_of_bounded_size(spark):
    df = many(spark, 2000)
    wanted = mixing.source_rates(df).withColumn("bytes", F.lit(1e9) / (3 * F.col("rate")))  # 3 sources, 1e9 bytes
    found = mixing.mixed(df, wanted).withColumn("part", F.spark_partition_id()).select("part", "mix_order").collect()
    assert len({r["part"] for r in found}) == 30  # 32 MB each
    ends = [(min(x), max(x)) for x in ([r["mix_order"] for r in found if r["part"] == p] for p in range(30))]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_the_largest_mixtures_have_larger_parts_and_not_more(spark):
    df = many(spark, 300)
    wanted = mixing.source_rates(df).withColumn("bytes", F.lit(1e13) / (3 * F.col("rate")))
    plan = mixing.mixed(df, wanted)._jdf.queryExecution().optimizedPlan().toString()
    assert str(mixing.MOST_PARTS + 1) in plan
