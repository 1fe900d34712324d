import random
from functools import lru_cache
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from barloom.llm import chat

SCHEMA = "conv_id long, turn int, role string, text string"
INDEX = {"system": 1, "user": 2, "assistant": 3}


def least_cost(roles):
    """Over all actions, without the tables of the operator."""

    @lru_cache(None)
    def best(i, state):
        if i == len(roles):
            return {0: 0, 3: 0, 2: chat.INSERT, 1: 2 * chat.INSERT}[state]
        own = INDEX.get(roles[i], -1)
        price = lambda s: 0 if s == own else chat.RELABEL
        options = [chat.MERGE + price(state) + best(i + 1, state)] if state else []
        for x in chat.NEXT[state]:
            options.append(price(x) + best(i + 1, x))
            options += [chat.INSERT + price(y) + best(i + 1, y) for y in chat.NEXT[x]]
        return min(options)

    return best(0, 0)


def repaired(spark, workspace, data):
    df = spark.createDataFrame(data, SCHEMA).withColumns({"block": F.lit("x"), "place": F.lit("y"), "piece": F.lit(0)}).repartition(4)
    by_conv = defaultdict(list)
    for r in chat.repaired(df, workspace).collect():
        by_conv[r["conv_id"]].append(r)
    return {k: sorted(v, key=lambda r: (r["out_turn"], r["piece"])) for k, v in by_conv.items()}


def assert_legal_and_cheapest(data, found):
    given = defaultdict(list)
    for conv, turn, role, text in data:
        given[conv].append((turn, role, text))
    assert set(found) == set(given)
    for conv, turns in given.items():
        roles = [r.strip().lower() if r else None for _, r, _ in sorted(turns)]
        roles = [r if r in INDEX else None for r in roles]
        pieces, cost, state = found[conv], 0, 0
        heads = [p for p in pieces if p["piece"] == 0]
        assert [p["out_turn"] for p in heads] == list(range(len(heads)))
        for p in heads:
            assert INDEX[p["role"]] in chat.NEXT[state]
            state = INDEX[p["role"]]
        assert state == chat.ASSISTANT
        kept = [p for p in pieces if p["action"] != "insert"]
        assert [p["turn"] for p in kept] == [t for t, _, _ in sorted(turns)]
        for p, role in zip(kept, roles, strict=True):
            cost += (chat.MERGE if p["action"] == "merge" else 0) + (0 if p["role"] == role else chat.RELABEL)
        cost += chat.INSERT * sum(p["action"] == "insert" for p in pieces)
        assert cost == least_cost(tuple(roles))


def conversations(seed, n, longest):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "User ", "tool", None]
    return [(c, t, rng.choice(roles), f"text {c}.{t}") for c in range(n) for t in range(rng.randrange(1, longest))]


def test_repairs_are_legal_and_cheapest(spark, workspace):
    data = conversations(2, 60, 12)
    assert_legal_and_cheapest(data, repaired(spark, workspace, data))


def test_a_conversation_of_many_blocks(spark, workspace, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_BITS", 4)
    data = [(7, t, r, "t") for t, (_, _, r, _) in enumerate(conversations(3, 200, 8))] + conversations(4, 5, 6)
    assert_legal_and_cheapest(data, repaired(spark, workspace, data))


def test_rendering(spark, workspace):
    found = repaired(spark, workspace, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", None), (1, 3, "user", "c")])
    assert "".join(p["rendered"] for p in found[1]) == (
        "<|im_start|>user\na\n\nb<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n<|im_start|>user\nc<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    )


def test_equal_turns_nulls_and_nothing(spark, workspace):
    data = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (None, 1, None, None), (None, 2, "assistant", "")]
    found = repaired(spark, workspace, data)
    assert [p["action"] for p in found[1]] == ["keep", "keep", "relabel"]
    assert [p["role"] for p in found[None] if p["turn"] is not None] == ["user", "assistant"]
    assert repaired(spark, workspace, []) == {}


def test_very_long_turns_and_clashing_columns(spark, workspace):
    long = ["word " * 400_000, "é" * 1_000_000, "x"]
    data = [(1, 0, "user", long[0]), (1, 1, "user", long[1]), (1, 2, "assistant", long[2])]
    names = ("place", "block", "copy", "tie", "state", "action", "rendered", "out_turn", "piece")
    rows = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit(c) for c in names})
    found = sorted(chat.repaired(rows, workspace).collect(), key=lambda r: (r["out_turn"], r["piece"]))
    assert "".join(p["rendered"] for p in found) == f"<|im_start|>user\n{long[0]}\n\n{long[1]}<|im_end|>\n<|im_start|>assistant\nx<|im_end|>\n"


@pytest.mark.parametrize("name", ["op5_role_repair"])
def test_query(spark, sf_dir, name):
    from barloom.llm.queries import QUERIES

    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = defaultdict(list)
    for r in QUERIES[name](spark, sf_dir).collect():
        found[r["conv_id"]].append(r)
    assert_legal_and_cheapest(data, {k: sorted(v, key=lambda r: (r["out_turn"], r["piece"])) for k, v in found.items()})
