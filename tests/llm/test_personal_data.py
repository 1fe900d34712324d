import hashlib
import random
import re

from corpus_cases import clashing, frame, rows

from barloom.llm import personal_data as pii


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(v // 10 + v % 10 for v in doubled) % 10 == 0


def brute(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(1, *m.span())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        out += [(2, *m.span())] if 16 <= len(digits) <= 19 and luhn(digits) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(3, *m.span())] if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return out


PARTS = ["1", "2", "25", "4111 1111 1111 1111", ".", "-", " ", "@", "a", "b.c", "+", "(", ")", "%", "x@y.z", "1.2.3.4", "256.1.1.1", "é", "٣", "\n", "+49 (30) 1234567"]


def test_base_patterns_equal_the_plain_expressions():
    rng = random.Random(3)
    for _ in range(5000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(24)))
        assert pii.base_spans(text) == brute(text)


def test_very_long_runs_are_no_trap():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1" + "(" * 200_000, "+" * 200_000, "1 " * 100_000):
        pii.base_spans(text)


def found(spark, workspace, df, **options):
    return {r["doc_id"]: r for r in pii.find(df, workspace, **options).collect()}


def test_contexts_find_identifiers_that_no_pattern_knows(spark, workspace):
    texts = [f"some words call number +1 (555) 555-{1000 + i} right away please" for i in range(40)]
    texts += [f"other words call number XK-{7000 + i}-Z right away thanks" for i in range(5)]
    texts += [f"model year name AB-{7000 + i}-Z of the car" for i in range(20)]
    rows_ = found(spark, workspace, frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]))
    added = {i: [s for s in r["spans"] if s["kind"] == 4] for i, r in rows_.items()}
    for i, text in enumerate(texts):
        want = [text[s["start"] : s["end"]] for s in added[i]]
        assert want == ([f"XK-{7000 + i - 40}-Z"] if 40 <= i < 45 else [])
        assert [s for s in rows_[i]["spans"] if s["kind"] < 4] == rows_[i]["base"]


def test_an_instance_that_occurs_often_proves_no_more_than_once(spark, workspace):
    texts = ["please call number +1 (555) 555-1000 right away"] * 40 + ["please call number XK-7000-Z right away"]
    rows_ = found(spark, workspace, frame(spark, [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]))
    assert not any(s["kind"] == 4 for r in rows_.values() for s in r["spans"])


def test_odd_rows(spark, workspace):
    df = clashing(frame(spark), "row", "base", "spans", "instance", "seen")
    assert pii.find(df, workspace).count() == len(rows())
    assert found(spark, workspace, frame(spark, [])) == {}


def test_query(spark, sf_dir):
    from barloom.llm.queries import QUERIES

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    result = QUERIES["op3_contextual_personal_data"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in result) == sorted(texts)
    for r in result:
        base = brute(texts[r["doc_id"]])
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert [r[f"n_{k}"] for k in pii.KINDS[:4]] == [sum(b[0] == k for b in base) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["spans"].startswith(text)
