"""Personal data: fixed patterns as seeds, and contextual extraction bootstrapped from them.

Base patterns (email, ip, card, phone) find the seed entities in every whole text. Around each of them, and
around every other token that looks like an identifier (it has a digit), the words next to it form lexical
patterns: two words before, one before and one after, two after. Patterns and instances are a graph whose
scores Spark improves in turns: a pattern is as good as the share of its distinct instances that are believed
(smoothed, so that few instances prove little), an instance is believed when any of its patterns is good
(noisy or). A candidate in the context of an accepted pattern becomes a span of kind ``id``.

Texts are scanned once; a table of occurrences is written, and only hashes of contexts and instances are
joined. A frequent pattern is one row of partial sums, and the joins read written tables, so that adaptive
execution can split it.

Defined cases: a null text is empty. Copies of an instance count once for a pattern, however often they
occur. Rows that repeat are judged each. An empty table gives no rows. Positions are code points.
Patterns with equal scores, and instances with equal beliefs, are treated alike; a place that several patterns accept
is one span. Very long texts are read whole, each in one task. Only the kept columns and the text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import map_batches, prepared
from barloom.session import Workspace

#: Kinds in the order of results; the last is what the method finds.
KINDS = ("email", "ip", "card", "phone", "id")
#: Parts of the base patterns (fixed values).
MAIL_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Characters of tokens that may be identifiers.
TOKEN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._@%+-")
LEAST_TOKEN, CONTEXT = 6, 96
Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    floor = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in MAIL_NAME:
            start -= 1
        match = MAIL_HOST.match(text, at) if start < at else None
        if match:
            yield start, match.end()
        floor = match.end() if match else at + 1
        at = text.find("@", floor)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def numbers(text: str, runs: list[tuple[int, int]], pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Matches of a pattern that begins with all digits of a run."""
    floor = 0
    for start, _ in runs:
        if start >= floor and (match := pattern.match(text, start)):
            floor = match.end()
            yield start, floor


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        match = PHONE.match(text, at)
        if match:
            yield at, match.end()
        at = text.find("+", match.end() if match else at + 1)


def _count_digits(text: str) -> int:
    return sum("0" <= c <= "9" for c in text)


def base_spans(text: str, runs: list[tuple[int, int]] | None = None) -> list[Span]:
    """(kind, start, end) of the base patterns, by kind and start."""
    runs = [m.span() for m in DIGITS.finditer(text)] if runs is None else runs
    out = [(0, s, e) for s, e in emails(text)]
    if runs:
        for s, e in numbers(text, runs, IP):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[s:e].split(".")):
                out.append((1, s, e))
        for s, e in numbers(text, runs, CARD):
            digits = text[s:e].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, s, e))
        out += [(3, s, e) for s, e in phones(text) if 8 <= _count_digits(text[s:e]) <= 15]
    return out


def candidates(text: str, runs: list[tuple[int, int]], base: list[Span]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit that touch no base span."""
    taken = sorted((s, e) for _, s, e in base)
    floor = place = 0
    for first, last in runs:
        if first < floor:
            continue
        start, end = first, last
        while start > floor and text[start - 1] in TOKEN:
            start -= 1
        while end < len(text) and text[end] in TOKEN:
            end += 1
        floor = end
        while end > last and not text[end - 1].isalnum():
            end -= 1
        while place < len(taken) and taken[place][1] <= start:
            place += 1
        if end - start >= LEAST_TOKEN and (place == len(taken) or taken[place][0] >= end):
            yield start, end


def _key(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def patterns(text: str, start: int, end: int) -> list[int]:
    """Hashes of the lexical patterns around a span; a pattern needs words, not marks or the text's edges."""
    before = text[max(0, start - CONTEXT) : start].lower().split()[-2:]
    after = text[end : end + CONTEXT].lower().split()[:2]
    before, after = ["", "", *before][-2:], [*after, "", ""][:2]
    made = (("before", *before), ("around", before[1], after[0]), ("after", *after))
    return [_key(*p) for p in made if all(any(map(str.isalpha, w)) for w in p[1:])]


def scanned(documents: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, base (kind, start, end) and seen (every span or candidate with its instance and patterns)."""
    kinds = dict(documents.dtypes)
    schema = ", ".join(
        [*[f"`{c}` {kinds[c]}" for c in keep], "base array<struct<kind: int, start: long, `end`: long>>",
         "seen array<struct<seed: boolean, start: long, `end`: long, instance: long, patterns: array<long>>>"]
    )

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            bases, seens = [], []
            for text in batch.pop("text"):
                base, seen = [], []
                if text:
                    runs = [m.span() for m in DIGITS.finditer(text)]
                    base = base_spans(text, runs)
                    found = [(True, s, e) for _, s, e in base] + [(False, s, e) for s, e in candidates(text, runs, base)]
                    seen = [
                        {"seed": seed, "start": s, "end": e, "instance": _key(text[s:e].lower()), "patterns": patterns(text, s, e)} for seed, s, e in found
                    ]
                bases.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
                seens.append(seen)
            yield batch | {"base": bases, "seen": seens}

    return map_batches(documents.select(*keep, "text"), schema, work)


def learn(seen: DataFrame, workspace: Workspace, rounds: int = 3, doubt: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns (pattern, score) and belief in instances (instance, belief) after ``rounds`` turns.

    ``seen`` has instance, seed and pattern. ``doubt`` is how many unbelieved instances every pattern is
    credited with at first.
    """
    edges = seen.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    edges = workspace.stage(edges, "edges")
    belief = workspace.stage(edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("belief"), F.max("seed").alias("seed")), "belief")
    scores = None
    for _ in range(rounds):
        # A pattern without any belief can't gain weight, so edges to unbelieved instances only count.
        believed = edges.select("pattern", "instance").join(belief, "instance")
        scores = believed.groupBy("pattern").agg((F.sum("belief") / (F.count(F.lit(1)) + F.lit(doubt))).alias("score"))
        scores = workspace.stage(scores.where("score > 0"), "scores")
        doubts = edges.join(scores, "pattern", "left").groupBy("instance").agg(
            F.max("seed").alias("seed"), F.sum(F.log1p(-F.coalesce("score", F.lit(0.0)))).alias("doubts")
        )
        new = F.when(F.col("seed"), F.lit(1.0)).otherwise(1 - F.exp("doubts"))
        belief = workspace.stage(doubts.select("instance", new.alias("belief"), "seed"), "belief")
    return scores, belief


def find(
    documents: DataFrame, workspace: Workspace, keep: tuple[str, ...] = ("doc_id",), least_score: float = 0.7, least_belief: float = 0.8, **options
) -> DataFrame:
    """``keep``, base and spans (base and what the method adds) of every document, each (kind, start, end) in order."""
    prepared(documents.sparkSession)
    rows = workspace.stage(scanned(documents, keep).withColumn("row", F.monotonically_increasing_id()), "scanned")
    seen = rows.select("row", F.explode("seen").alias("s")).select("row", "s.*")
    by_pattern = seen.select("row", "seed", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    scores, belief = learn(by_pattern.select("pattern", "instance", "seed"), workspace, **options)
    good = workspace.stage(scores.where(F.col("score") >= least_score).select("pattern"), "good")
    trusted = workspace.stage(belief.where(~F.col("seed") & (F.col("belief") >= least_belief)).select("instance"), "trusted")
    added = by_pattern.where(~F.col("seed")).join(trusted, "instance").join(good, "pattern").select("row", "start", "end").distinct()
    added = added.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct(F.lit(len(KINDS) - 1).alias("kind"), "start", "end"))).alias("added")
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    spans = F.concat("base", F.coalesce("added", none))
    return rows.join(added, "row", "left").select(*keep, "base", spans.alias("spans"))
