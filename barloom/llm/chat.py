"""Chat formatting: the cheapest repair of a conversation's roles.

A legal conversation is nothing, or one optional system turn and then user and assistant turns by turns,
the assistant last. Every turn is kept, given another role, or merged into the turn before it, and empty
turns may be inserted; each has a cost, and dynamic programming over the states of the automaton finds the
least total. Turns then become rendered pieces; the pieces of a conversation in order of (out_turn, piece)
are its text.

A conversation may hold any share of the rows. Rows are range-partitioned in order of (conversation, turn)
and cut into blocks of bounded rows. What a block does to a conversation is one small matrix (least cost
from each state to each state), and matrices combine like products. So three passes suffice: a matrix for
each fragment, the best states between the fragments of a conversation, and the actions in each fragment.

Defined cases: role names are trimmed and lower-cased; a null or unknown role fits no turn and is always
relabelled or merged. A null text is empty. Rows of equal (conversation, turn) are ordered by role and
text. A null conversation is one conversation, a null turn comes first. An empty table gives no rows. Rows that repeat
are turns each. A very long turn is one row like others and its text is rendered whole. Only the four columns are read,
so others may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, prepared
from barloom.session import Workspace

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The states that may follow each state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs. Longer runs of one role are cheaper to relabel by turns than to merge into one unbounded turn.
RELABEL, MERGE, INSERT = 10, 6, 12
FAR = 1 << 60
BLOCK_BITS = 12


def moves(role: str | None) -> list[list[tuple[int, int, str, int]]]:
    """For each state: (state after, cost, action, inserted state or -1) of a turn of ``role``, best first among equals."""
    own = ROLES.index(role) + 1 if role in ROLES else -1
    out = []
    for state in STATES:
        found: dict[int, tuple[int, int, str, int]] = {}

        def offer(after: int, cost: int, action: str, inserted: int = -1, found=found) -> None:
            if after not in found or cost < found[after][1]:
                found[after] = (after, cost, action, inserted)

        for after in NEXT[state]:
            offer(after, 0 if after == own else RELABEL, "keep" if after == own else "relabel")
        if state != START:
            offer(state, MERGE if state == own else MERGE + RELABEL, "merge")
        for between in NEXT[state]:
            for after in NEXT[between]:
                offer(after, INSERT + (0 if after == own else RELABEL), "keep" if after == own else "relabel", between)
        out.append(sorted(found.values()))
    return out


MOVES = {role: moves(role) for role in (*ROLES, None)}


def closing(state: int) -> tuple[int, list[int]]:
    """Cost and turns to insert so that a conversation may end in ``state``."""
    return {START: (0, []), ASSISTANT: (0, []), USER: (INSERT, [ASSISTANT]), SYSTEM: (2 * INSERT, [USER, ASSISTANT])}[state]


def _walk(roles: list[str | None], start: int) -> tuple[list[int], list[list[tuple[int, str, int] | None]], list[int]]:
    """Least cost to each state from ``start``, the last step to each state after each turn, and turns made."""
    cost, made = [FAR] * 4, [0] * 4
    cost[start] = 0
    back = []
    for role in roles:
        then, step, count = [FAR] * 4, [None] * 4, [0] * 4
        for state in STATES:
            if cost[state] < FAR:
                for after, price, action, inserted in MOVES[role][state]:
                    if cost[state] + price < then[after]:
                        then[after], step[after] = cost[state] + price, (state, action, inserted)
                        count[after] = made[state] + (action != "merge") + (inserted >= 0)
        back.append(step)
        cost, made = then, count
    return cost, back, made


def matrix(roles: list[str | None]) -> list[int]:
    """16 costs and 16 counts of turns made, by (state before, state after)."""
    rows = [_walk(roles, start) for start in STATES]
    return [c for cost, _, _ in rows for c in cost] + [m for _, _, made in rows for m in made]


def states_between(matrices: list[list[int]]) -> list[int]:
    """The states before each fragment and after the last on the cheapest way through all."""
    cost, back = [0, FAR, FAR, FAR], []
    for m in matrices:
        options = [min((cost[s] + m[4 * s + t], s) for s in STATES) for t in STATES]
        back.append([s for _, s in options])
        cost = [min(c, FAR) for c, _ in options]
    state = min(STATES, key=lambda s: (cost[s] + closing(s)[0], s))
    out = [state]
    for step in reversed(back):
        out.append(step[out[-1]])
    return out[::-1]


def actions(roles: list[str | None], start: int, end: int) -> list[tuple[int, str, int]]:
    """(state after, action, inserted state before it or -1) of each turn of a fragment."""
    _, back, _ = _walk(roles, start)
    out, state = [], end
    for step in reversed(back):
        before, action, inserted = step[state]
        out.append((state, action, inserted))
        state = before
    return out[::-1]


def _runs(batches: Iterator[dict[str, list]], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows of equal keys, across batches."""
    rows = (dict(zip(b, values, strict=True)) for b in batches for values in zip(*b.values(), strict=True))
    for key, run in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(run)


def _header(out_turn: int, state: int) -> str:
    return ("<|im_end|>\n" if out_turn else "") + f"<|im_start|>{ROLES[state - 1]}\n"


def repaired(conversations: DataFrame, workspace: Workspace) -> DataFrame:
    """conv_id, out_turn, piece, role, turn (null where inserted), action and rendered, one row for each piece."""
    spark = prepared(conversations.sparkSession)
    kinds = dict(conversations.dtypes)
    role = F.lower(F.trim("role"))
    rows = conversations.select(
        "conv_id", "turn", F.when(role.isin(*ROLES), role).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("role", "text").alias("tie"),
    )
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv_id", "turn", "tie"]
    placed = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "copy").sortWithinPartitions(*order, "copy")
    placed = placed.drop("tie", "copy").withColumn("place", F.monotonically_increasing_id())
    # Where a conversation is cut follows from the places written here, so later passes agree on it.
    placed = workspace.stage(placed.withColumn("block", F.shiftright("place", BLOCK_BITS)), "placed")
    conv = kinds["conv_id"]

    def summed(batches):
        for (name, block), run in _runs(batches, ("conv_id", "block")):
            yield {"conv_id": [name], "block": [block], "matrix": [matrix([r["role"] for r in run])]}

    slim = placed.select("conv_id", "block", "place", "role").repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    fragments = map_batches(slim, f"conv_id {conv}, block long, matrix array<long>", lambda b: _batched(summed(b)))

    def joined(batches):
        for (name,), run in _runs(batches, ("conv_id",)):
            between, before = states_between([r["matrix"] for r in run]), 0
            for i, r in enumerate(run):
                s, t = between[i], between[i + 1]
                yield {"conv_id": [name], "block": [r["block"]], "enter": [s], "leave": [t], "before": [before], "last": [i == len(run) - 1]}
                before += r["matrix"][16 + 4 * s + t]

    ordered = fragments.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    states = map_batches(ordered, f"conv_id {conv}, block long, enter int, leave int, before long, last boolean", lambda b: _batched(joined(b)))
    states = workspace.stage(states, "states")

    def acted(batches):
        for (name, _), run in _runs(batches, ("conv_id", "block")):
            out, made = [], run[0]["before"]
            for r, (state, action, inserted) in zip(run, actions([r["role"] for r in run], run[0]["enter"], run[0]["leave"]), strict=True):
                if inserted >= 0:
                    out.append((made, 0, inserted, None, "insert", _header(made, inserted)))
                    made += 1
                if action == "merge":
                    out.append((made - 1, r["place"] + 1, state, r["turn"], action, "\n\n" + r["text"]))
                else:
                    out.append((made, 0, state, r["turn"], action, _header(made, state) + r["text"]))
                    made += 1
            if run[0]["last"]:
                for state in closing(run[0]["leave"])[1]:
                    out.append((made, 0, state, None, "insert", _header(made, state)))
                    made += 1
                out[-1] = (*out[-1][:5], out[-1][5] + "<|im_end|>\n")
            columns = list(zip(*out, strict=True))
            yield {
                "conv_id": [name] * len(out), "out_turn": columns[0], "piece": columns[1], "role": [ROLES[s - 1] for s in columns[2]],
                "turn": columns[3], "action": columns[4], "rendered": columns[5],
            }

    whole = placed.join(states.withColumnRenamed("conv_id", "conv"), F.col("conv_id").eqNullSafe(F.col("conv")) & (placed["block"] == states["block"]))
    whole = whole.select("conv_id", placed["block"], "place", "turn", "role", "text", "enter", "leave", "before", "last")
    whole = whole.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    return map_batches(
        whole, f"conv_id {conv}, out_turn long, piece long, role string, turn {kinds['turn']}, action string, rendered string", lambda b: _batched(acted(b))
    )


def _batched(rows: Iterator[dict[str, list]], most: int = 2000) -> Iterator[dict[str, list]]:
    """Small results joined into batches."""
    held: dict[str, list] = {}
    for row in rows:
        if not held:
            held = {k: [] for k in row}
        for k, v in row.items():
            held[k] += v
        if len(next(iter(held.values()))) >= most:
            yield held
            held = {}
    if held:
        yield held
