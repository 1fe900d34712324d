import random
import re

import pytest
from corpus_cases import clashing, frame, prose, rows
from pyspark.sql import functions as F

from barloom.llm import quality


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    repeated = {j for places in windows.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_measures():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice(["a", "b", "é", "#", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "|<>", "ab ab ab "]) for _ in range(rng.randrange(60)))
        assert quality.measure_text(text) == brute(text)
    assert quality.measure_text(None) == (0,) * 5


def test_a_bad_host_is_rejected_and_a_small_one_is_not(spark, workspace):
    rng = random.Random(1)
    data = [(i, prose(rng, 80), "en", f"good{i % 10}", 0) for i in range(400)]
    data += [(1000 + i, "too short" if i % 10 else prose(rng, 80), "en", "bad", 0) for i in range(100)]
    data += [(2000, "short", "en", "tiny", 0), (2001, prose(rng, 80), "en", "tiny", 0)]
    found = {r["doc_id"]: r for r in quality.judge(frame(spark, data), workspace).collect()}
    assert all(found[i]["kept"] for i in range(400))
    assert not any(found[1000 + i]["kept"] for i in range(100)) and not found[1010]["base_failed"]
    assert found[2001]["kept"] and not found[2000]["kept"]
    assert 0.8 < found[1000]["host_rate"] < 0.9 and found[2000]["host_rate"] < 0.5
    kept = quality.kept_documents(frame(spark, data), workspace).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, r in found.items() if r["kept"])


def test_a_host_is_rejected_by_any_one_rule_that_it_surely_breaks(spark, workspace):
    rng = random.Random(4)
    noisy = {
        "symbols": lambda t: t.replace(" ", "#$ "),
        "repeated_lines": lambda t: "".join(w + ("\nsame\n" if i % 4 == 3 else " ") for i, w in enumerate(t.split())),
        "odd_words": lambda t: t.replace(" ", "q" * 20 + " "),
    }
    data = [(i, prose(rng, 80), "en", f"good{i % 8}", 0) for i in range(320)]
    for k, (name, change) in enumerate(noisy.items()):
        data += [(1000 * (k + 1) + i, change(prose(rng, 80)) if i % 12 else prose(rng, 80), "en", name, 0) for i in range(60)]
        data += [(5000 + 10 * k + i, change(prose(rng, 80)), "en", f"few-{name}", 0) for i in range(2)]
    found = {r["doc_id"]: r for r in quality.judge(frame(spark, data), workspace).collect()}
    for i, _, _, host, _ in data:
        r = found[i]
        assert not r["base_failed"] and r["kept"] == (host not in noisy), (host, r)
        assert r["kept"] or r["host_rule"] == host
    kept = quality.kept_documents(frame(spark, data), workspace).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(i for i, r in found.items() if r["kept"])


def test_posteriors_by_hand(spark, workspace):
    counts = {"a": (100, 10), "b": (100, 30), "c": (100, 50), "d": (1, 1), "e": (300, 290)}
    flags = [*quality.RULES, *quality.SIGNS]
    data = [(host, *[i < bad and f == "symbols" for f in flags]) for host, (n, bad) in counts.items() for i in range(n)]
    rows = spark.createDataFrame(data, "host string, " + ", ".join(f"{f} boolean" for f in flags))
    n, f = sum(c[0] for c in counts.values()), sum(c[1] for c in counts.values())
    mean = (f + 0.5) / (n + 1)
    between = sum(b * b / m for m, b in counts.values()) / n - (f / n) ** 2 - mean * (1 - mean) * len(counts) / n
    strength = max(mean * (1 - mean) / between - 1, 1.0)
    for r in quality.host_rates(rows).collect():
        docs, bad = counts[r["host"]]
        rate = (bad + mean * strength) / (docs + strength)
        bound = rate - 2 * (rate * (1 - rate) / (docs + strength + 1)) ** 0.5
        assert (r["host_docs"], r["host_kept"]) == (docs, bound <= 0.5) and r["host_kept"] == (r["host"] != "e")
        if r["host_rule"] == "symbols":
            assert (r["host_rate"], r["host_bound"]) == pytest.approx((rate, bound))
    assert quality.host_rates(rows.limit(0)).collect() == []


def test_odd_rows(spark, workspace):
    df = clashing(frame(spark), "host", "n_words", "kept", "base_failed", "host_rule", "symbols")
    found = quality.judge(df, workspace).collect()
    assert len(found) == len(rows())
    texts = {(r[0], r[1]) for r in rows()}
    by_id = {i: t for i, t in texts}
    for r in found:
        assert tuple(r[m] for m in quality.MEASURES) == brute(by_id[r["doc_id"]])
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    kept = quality.kept_documents(df, workspace)
    assert kept.columns == df.columns and kept.count() == sum(r["kept"] for r in found)
    assert quality.judge(frame(spark, []), workspace).collect() == []
    assert quality.kept_documents(frame(spark, []), workspace).collect() == []


@pytest.mark.parametrize("name", ["op10_host_quality"])
def test_query(spark, sf_dir, name):
    from barloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES[name](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(texts)
    assert all(tuple(r[m] for m in quality.MEASURES) == brute(texts[r["doc_id"]]) for r in found)
