"""Benchmark decontamination by winnowing.

Words are hashed in runs of ``K``. Of every window of consecutive runs that spans ``SPAN`` words the least hash (the
rightmost of equals) is selected with its position; neighbouring windows mostly select the same one. Equal spans of
``SPAN`` words select the same run at the same place, so a join of the selected fingerprints of documents and
benchmark misses no shared span of ``SPAN`` words or more. A match is then extended word by word to both sides in its pair
of texts, as far as a window around the run can reach; it is a hit if it grows to ``SPAN`` words. Hits that overlap
grow into one span. An item of fewer words than a window is looked up as one run of its length.

A fingerprint travels with the words that its extension needs, so no text is joined, and equal contexts of the
benchmark are one row. A bitmap of the benchmark's fingerprints goes to every task, so that document
fingerprints that cannot match are not shuffled. It has 16 bits for each fingerprint, but at most ``MOST_BITS``, and decides
nothing: what passes is joined. Documents are scanned once; nothing is collected but the bitmap's words and the set of
short item lengths.

Defined cases: a null text has no words and no hits, an item without words has no windows, rows that repeat are judged
each, an item without an id counts for hits and is left out of the items only, equal items are each listed, empty
tables give no hits or no rows. Very long texts are read whole, each in one task. Only the id columns and the text are
read, so other columns may have any names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, combine, map_batches, mix, prepared
from barloom.session import Workspace

#: Words: ASCII letters and digits and everything beyond ASCII, with A-Z lower-cased (fixed).
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
K, SPAN = 8, 10
MOST_BITS = 1 << 27


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, from runs of half the length (which overlap unless ``k`` is a power of two)."""
    if len(hashes) < k:
        return np.empty(0, np.uint64)
    out, length = mix(hashes), 1
    while length < k:
        step = min(length, k - length)
        out, length = combine(out[: len(out) - step], out[step:]), length + step
    return out


def fingerprints(hashes: np.ndarray, k: int = K, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Selected positions, ascending, and their hashes: of each window of ``span`` words the least of its runs of ``k``."""
    runs = run_hashes(hashes, k)
    wide = span - k + 1
    n = len(runs) - wide + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place = np.arange(wide - 1, wide - 1 + n)
    for i in range(wide - 2, -1, -1):
        place = np.where(runs[i : i + n] < runs[place], np.arange(i, i + n), place)
    place = place[np.append(True, place[1:] != place[:-1])]  # they never go back
    return place, runs[place]


def short_fingerprints(hashes: np.ndarray, length: int) -> np.ndarray:
    """A run that is shorter than a window is its own fingerprint."""
    return combine(run_hashes(hashes, length), np.uint64(length)) if len(hashes) >= length else np.empty(0, np.uint64)


def selections(words: list[bytes], hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Positions and hashes of what is looked up for items of ``length`` words (``SPAN``: or more), and the words of a run."""
    if length == SPAN:
        return *fingerprints(hashes), K
    found = short_fingerprints(hashes, length)
    return np.arange(len(found)), found, length


def _context(words: list[bytes], at: int, run: int, length: int) -> tuple[str, list[str], list[str]]:
    """The run, and the words before (nearest first) and after it that its extension can use."""
    reach = length - run
    before, after = words[max(0, at - reach) : at][::-1], words[at + run : at + run + reach]
    text = b" ".join([*words[at : at + run], *before, *after]).decode("utf-8", "surrogatepass").split(" ")
    return " ".join(text[:run]), text[run : run + len(before)], text[run + len(before) :]


def benchmark_fingerprints(benchmark: DataFrame) -> DataFrame:
    """The selected runs of every item: item_id (as text), fp, gram (the run's words), before, after, length."""
    prepared(benchmark.sparkSession)

    def work(batches):
        known = WordHashes()
        for batch in batches:
            out: dict[str, list] = {"item_id": [], "fp": [], "gram": [], "before": [], "after": [], "length": []}
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = words_of(text)
                if not words:
                    continue
                length = min(len(words), SPAN)
                places, found, run = selections(words, known.of(words), length)
                for at in places.tolist():
                    for name, value in zip(("gram", "before", "after"), _context(words, at, run, length), strict=True):
                        out[name].append(value)
                out["item_id"] += [item] * len(found)
                out["fp"] += found.view(np.int64).tolist()
                out["length"] += [length] * len(found)
            yield out

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    schema = "item_id string, fp long, gram string, before array<string>, after array<string>, length int"
    return map_batches(rows, schema, work).distinct()


def fingerprint_bitmap(found: DataFrame) -> bytes:
    """One bit for each fingerprint's low bits; at most ``MOST_BITS`` / 64 words are collected."""
    n = found.count()
    size = min(MOST_BITS, 1 << max(16, (16 * n).bit_length()))
    bit = F.col("fp").bitwiseAND(F.lit(size - 1))
    words = (
        found.select(F.shiftright(bit, 6).cast("int").alias("at"), F.expr("shiftleft(1L, int(fp & 63))").alias("bit"))
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(size // 64, np.int64)
    bitmap[words["at"].to_numpy()] = words["bits"].to_numpy()
    return bitmap.tobytes()


def document_fingerprints(documents: DataFrame, bitmap: bytes, short: list[int], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Of each document: ``keep``, n_words and the selected runs whose fingerprint is in the bitmap."""
    kinds = dict(documents.dtypes)
    sent = documents.sparkSession.sparkContext.broadcast(bitmap)
    runs = "runs array<struct<fp: long, gram: string, `left`: array<string>, `right`: array<string>, at: int, length: int>>"
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_words long", runs])

    def work(batches):
        bits, known = np.frombuffer(sent.value, np.uint64), WordHashes()
        low_bits = np.uint64(64 * len(bits) - 1)

        def candidates(words: list[bytes], hashes: np.ndarray):
            for length in [*short, SPAN]:
                places, found, run = selections(words, hashes, length)
                low = found & low_bits
                there = (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)
                for i in np.flatnonzero(there).tolist():
                    at = int(places[i])
                    gram, left, right = _context(words, at, run, length)
                    yield {"fp": int(found[i].view(np.int64)), "gram": gram, "left": left, "right": right, "at": at, "length": length}

        for batch in batches:
            texts = [words_of(t) for t in batch.pop("text")]
            yield batch | {"n_words": [len(w) for w in texts], "runs": [list(candidates(w, known.of(w))) if w else [] for w in texts]}

    return map_batches(documents.select(*keep, "text"), schema, work)


def _agreeing(one: str, two: str, most: int) -> Column:
    """How many words two lists have in common from their start."""
    agreed = F.lit(0)
    for i in reversed(range(most)):
        same = F.get(one, F.lit(i)) == F.get(two, F.lit(i))  # null past the end of a text
        agreed = F.when(same, agreed + 1).otherwise(0)
    return agreed


def contamination(documents: DataFrame, benchmark: DataFrame, workspace: Workspace, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Of each document: ``keep``, n_words, n_hit, spans (of words, end exclusive), items (ids as text, sorted)."""
    prepared(documents.sparkSession)
    items = workspace.stage(benchmark_fingerprints(benchmark), "benchmark")
    short = sorted(r["length"] for r in items.where(F.col("length") < SPAN).select("length").distinct().collect())
    scanned = document_fingerprints(documents, fingerprint_bitmap(items), short, keep)
    scanned = workspace.stage(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    candidates = scanned.select("row", F.explode("runs").alias("r")).select("row", "r.*")
    context = ["fp", "gram", "length", "before", "after"]
    known = workspace.stage(items.select(*context).distinct(), "contexts")
    run = F.when(F.col("length") == SPAN, F.lit(K)).otherwise(F.col("length"))
    start = F.col("at") - _agreeing("left", "before", SPAN - K)
    end = F.col("at") + run + _agreeing("right", "after", SPAN - K)
    matched = candidates.join(known, ["fp", "gram", "length"]).select("row", *context, start.alias("start"), end.alias("end"))
    hits = workspace.stage(matched.where(F.col("end") - F.col("start") >= F.col("length")), "hits")

    order = Window.partitionBy("row").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (before < F.col("start"))).cast("int")
    spans = (
        hits.select("row", "start", "end").distinct()
        .withColumn("opens", opens)
        .withColumn("span", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "span")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("row")
        .agg(
            F.sum(F.col("end") - F.col("start")).cast("long").alias("n_hit"),
            F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        )
    )
    found = (
        hits.select("row", *context).distinct().join(items.select(*context, "item_id"), context)
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return (
        scanned.drop("runs").join(spans, "row", "left").join(found, "row", "left")
        .withColumns({
            "n_hit": F.coalesce("n_hit", F.lit(0).cast("long")),
            "items": F.coalesce("items", F.array().cast("array<string>")),
            "spans": F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")),
        })
        .drop("row")
    )
