"""Near-duplicate documents by Order MinHash.

A document is the sequence of its runs of ``K`` words (k-mers; fewer words are one run). Each k-mer is
labelled with its occurrence number, so repeats count. A sketch takes the ``TAKE`` labelled k-mers of least
hash and keeps them in text order; documents that share a sketch are candidates. Unlike sets of minima, a
sketch changes when passages change places.

Candidates are verified by banded alignment: the longest common subsequence of k-mers m of sequences of a
and b k-mers must give m / (a + b - m) >= ``SIMILAR``. The band holds every alignment that can reach that.

Copies (equal words) are reduced to one document first. All buckets that have one leader (the member that
shares most with others) are dealt into chunks of bounded size. In a chunk all pairs are compared, but for those
that matches have joined already, so buckets in groups of one chunk are settled. What has matched gets one label.

Texts of the other buckets meet again by their rare k-mers, which loses no similar pair: if k-mers m of a text's n are
aligned with another's, m >= ``SIMILAR`` * n, so two similar texts share one of the n - ceil(SIMILAR * n) + 1 labelled
k-mers that come first in any order that is common to all. The order taken is from the rarest to the most frequent.
If the first k-mer that two texts share has place q in a text's order, no more than n - q can be aligned, which bounds
the length of the other text. The k-mers of a passage that many unlike texts hold are frequent, so such texts do not
meet, however many they are; near copies do. Where those that meet hold several labels, all their pairs of different labels are compared, each at the
first k-mer that it shares: in one block, or, where they are more than a block holds, first by the rare k-mers of
those texts alone, and what stays too large by pairs of blocks (but those of one and the same label). No pair list is
made, and the classes are the connected components of all similar pairs that share a sketch: none is left out, in
groups of any size. Work is linear in the members of a group that few labels are left of; it grows with their pairs
only where many texts share rare k-mers and are not joined, that is, where they are only just not similar.
Before an alignment, k-mers in common are counted for a whole block at once.

With 16 sketches of 3 k-mers a pair of similarity 0.8 is missed with a probability of about 1e-5.

Defined cases: words are runs of letters, digits and underscores, in lower case. Documents without words
are copies of each other when their texts are equal (null as empty). Repeated rows are copies. The
document that stays is the one of least doc_id (null first). An empty table gives no rows.
Very long texts are compared whole; a block is bounded by the k-mers of its texts, and one text may fill it alone.
Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, combine, few_tasks, map_batches, mix, prepared, rolling
from barloom.llm.components import components
from barloom.session import Workspace

WORD = re.compile(r"\w+")
K, SIMILAR = 5, 0.8
SKETCHES, TAKE = 16, 3
CHUNK = 32
#: K-mers of the texts of a block, which a task holds two of (some 15 MB each).
BLOCK = 1 << 18
#: Counters that tell frequent k-mers from rare ones, 4 MB in a worker. A k-mer shares its counter with others; that
#: affects the order of k-mers and so the work, but not what is found.
COUNTERS = 1 << 20
#: Counters that a task hands on in one row, so that its rows are as many for any texts.
SECTION = 1 << 12
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def kmers(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the runs of ``k`` words; a shorter text is one run."""
    return rolling(hashes, min(k, len(hashes))) if len(hashes) else hashes


def labelled(runs: np.ndarray) -> np.ndarray:
    """Each k-mer combined with how many equal ones come before it."""
    order = np.argsort(runs, kind="stable")
    sorted_ = runs[order]
    new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    if new.all():
        return combine(runs, np.uint64(0))
    starts = np.flatnonzero(new)
    occurrence = np.empty(len(runs), np.uint64)
    occurrence[order] = np.arange(len(runs)) - np.repeat(starts, np.diff(np.append(starts, len(runs))))
    return combine(runs, occurrence)


def sketches(runs: np.ndarray, take: int = TAKE) -> np.ndarray:
    """For each seed, the hash of the chosen k-mers in text order."""
    marks, out = labelled(runs), np.empty(SKETCHES, np.uint64)
    step = max(1, (1 << 20) // len(runs))  # bounds memory for very long texts
    for first in range(0, SKETCHES, step):
        seeds = _SEEDS[first : first + step]
        if len(runs) > take:
            least = np.argpartition(mix(marks ^ seeds[:, None]), take - 1, axis=1)[:, :take]
            chosen = runs[np.sort(least, axis=1)]
        else:
            chosen = np.broadcast_to(runs, (len(seeds), len(runs)))
        key = seeds + np.uint64(len(runs) <= take)
        for i in range(chosen.shape[1]):
            key = combine(key, chosen[:, i])
        out[first : first + step] = key
    return out


def common_kmers(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Length of the longest common subsequence, or less than ``need`` if it is less; bit-parallel, within the band."""
    n = min(len(a), len(b))
    same = a[:n] == b[:n]
    head = n if same.all() else int(same.argmin())
    same = a[len(a) - (n - head) :][::-1] == b[len(b) - (n - head) :][::-1]
    tail = n - head if same.all() else int(same.argmin())
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    ends = head + tail
    if not len(a) or not len(b):
        return ends
    if ends + len(np.intersect1d(labelled(a), labelled(b), assume_unique=True)) < need:
        return 0
    band = max(len(a), len(b)) + ends - need
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    window, whole = (1 << 2 * band + 1) - 1, (1 << len(a)) - 1
    free = whole
    for j, x in enumerate(b.tolist()):
        match = places.get(x)
        if match:
            match &= window << j - band if j >= band else window >> band - j
            used = free & match
            free = (free + used | free - used) & whole
    return ends + len(a) - free.bit_count()


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> bool:
    """Whether aligned k-mers make up at least ``least`` of all k-mers of both."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    return common_kmers(a, b, need) >= need


class Runs:
    """K-mers of texts."""

    def __init__(self) -> None:
        self.known = WordHashes()

    def of(self, text: str | None) -> np.ndarray:
        return kmers(self.known.of(WORD.findall(text.lower()))) if text else np.empty(0, np.uint64)


def sketched(documents: DataFrame) -> DataFrame:
    """doc_id, node (a hash of id and text), copy_of (what copies share) and sketches of each document."""
    kind = dict(documents.dtypes)["doc_id"]

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        known = WordHashes()
        for batch in batches:
            copies, found = [], []
            for text in batch["text"]:
                words = WORD.findall(text.lower()) if text else []
                copies.append(xxhash.xxh3_128_digest(" ".join(words) if words else "\0" + (text or "")))
                found.append(sketches(kmers(known.of(words))).view(np.int64) if words else np.empty(0, np.int64))
            yield {"doc_id": batch["doc_id"], "node": batch["node"], "copy_of": copies, "sketches": found}

    rows = documents.select("doc_id", F.xxhash64("doc_id", "text").alias("node"), "text")
    return map_batches(rows, f"doc_id {kind}, node long, copy_of binary, sketches array<long>", work)


def longest_partner(size: np.ndarray, place: np.ndarray, least: float) -> np.ndarray:
    """K-mers of the longest text that can be similar to one of ``size`` k-mers if the first k-mer they share has this
    place in the order of the latter: all before it can't be aligned."""
    return np.floor((size - place) * (1 + least) / least - size + 1e-6).astype(np.int64)


def rarest(marks: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The labelled k-mers of a text by which it meets all that are similar to it: the first in order of their counts."""
    n = len(marks)
    first = n - int(np.ceil(least * n - 1e-9)) + 1
    return marks[np.lexsort((marks, counts[(marks % np.uint64(len(counts))).astype(np.int64)]))[:first]]


def kmer_counts(texts: DataFrame) -> np.ndarray:
    """How often labelled k-mers occur in all ``texts``, by counter; what reaches the driver is COUNTERS numbers at most."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        runs, counts = Runs(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            marks = [labelled(own) for own in map(runs.of, batch["text"]) if len(own)]
            if marks:
                counts += np.bincount((np.concatenate(marks) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        yield _sections({i: counts[i : i + SECTION] for i in range(0, COUNTERS, SECTION)})

    def added(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for start, counts in zip(batch["start"], batch["counts"], strict=True):
                sums[start] = sums.get(start, 0) + np.frombuffer(counts, np.int64)
        yield _sections(sums)

    schema = "start int, counts binary"
    rows = map_batches(map_batches(texts.select("text"), schema, work).repartition("start"), schema, added).collect()
    counts = np.zeros(COUNTERS, np.int64)
    for row in rows:
        counts[row["start"] : row["start"] + SECTION] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(counts, np.iinfo(np.int32).max).astype(np.int32)


def _sections(counts: dict[int, np.ndarray]) -> dict[str, list]:
    """Rows of the sections, by their first counter, that are not all zero."""
    some = {start: own for start, own in counts.items() if own.any()}
    return {"start": list(some), "counts": [own.tobytes() for own in some.values()]}


def meetings(texts: DataFrame, counts: Broadcast, least: float) -> DataFrame:
    """Of each text and each of its rare k-mers: bucket (the k-mer), node, size (k-mers of the text) and partner (the
    longest text that can be similar if this k-mer is the first they share)."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        runs = Runs()
        for batch in batches:
            texts = [(node, own) for node, own in zip(batch["node"], map(runs.of, batch["text"]), strict=True) if len(own)]
            marks = [rarest(labelled(own), counts.value, least) for _, own in texts]
            if marks:
                each = np.array([len(m) for m in marks])
                node, size = np.repeat(np.array([(node, len(own)) for node, own in texts], np.int64), each, axis=0).T
                place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                yield {"bucket": np.concatenate(marks).view(np.int64), "node": node, "size": size, "partner": longest_partner(size, place, least)}

    return map_batches(texts.select("node", "text"), "bucket long, node long, size long, partner long", work)


class Text(NamedTuple):
    """One text of a block; ``keys`` are its rare k-mers, in their order."""

    node: int
    label: int
    runs: np.ndarray
    marks: np.ndarray
    keys: np.ndarray


def _partner(text: Text, met_at: int | None, least: float) -> float:
    if met_at is None:
        return np.inf
    return float(longest_partner(np.array(len(text.marks)), np.flatnonzero(text.keys == met_at)[0], least))


def block_matches(left: list[Text], right: list[Text] | None, met_at: int | None, least: float) -> Iterator[tuple[int, int]]:
    """Similar pairs of a left and a right text (of two left ones, if ``right`` is None) that connect all similar pairs
    of different labels. With ``met_at`` only pairs whose first common key it is count."""
    sizes = np.array([len(t.marks) for t in left])
    marks, owner = np.concatenate([t.marks for t in left]), np.repeat(np.arange(len(left)), sizes)
    order = np.argsort(marks, kind="stable")
    marks, owner = marks[order], owner[order]
    above: dict[int, int] = {}
    partners = np.array([_partner(t, met_at, least) for t in left])

    def top(label: int) -> int:
        while label in above:
            label = above[label]
        return label

    for j, own in enumerate(left if right is None else right):
        first = np.searchsorted(marks, own.marks, "left")
        n = np.searchsorted(marks, own.marks, "right") - first
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        common = np.bincount(owner[at], minlength=len(left))  # at least as many as can be aligned
        fits = common >= np.ceil(least * (sizes + len(own.marks)) / (1 + least) - 1e-9)
        fits &= (len(own.marks) <= partners) & (sizes <= _partner(own, met_at, least))
        if right is None:
            fits[j:] = False
        for i in np.flatnonzero(fits).tolist():
            other = left[i]
            a, b = top(other.label), top(own.label)
            if a == b or met_at is not None and other.keys[np.isin(other.keys, own.keys).argmax()] != met_at:
                continue
            if similar(other.runs, own.runs, least):
                above[a] = b
                yield other.node, own.node


def verified(rows: DataFrame, least: float, counts: Broadcast | None = None) -> DataFrame:
    """Matches (a, b) in each block. ``rows``: one, two, three (the block), side, node, label, text. With ``counts``
    texts have met by rare k-mers, ``one`` being the k-mer."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        runs, at = Runs(), None
        sides: tuple[list[Text], list[Text]] = ([], [])

        def matches() -> dict[str, list]:
            met_at = None if counts is None or at is None else np.int64(at[0]).view(np.uint64)
            found = list(block_matches(sides[0], sides[1] or None, met_at, least)) if sides[0] else []
            return {"a": [a for a, _ in found], "b": [b for _, b in found]}

        names = ("one", "two", "three", "side", "node", "label", "text")
        for batch in batches:
            for one, two, three, side, node, label, text in zip(*(batch[c] for c in names), strict=True):
                if (one, two, three) != at:
                    yield matches()
                    at, sides = (one, two, three), ([], [])
                own = runs.of(text)
                marks = labelled(own)
                sides[side].append(Text(node, label, own, marks, marks[:0] if counts is None else rarest(marks, counts.value, least)))
        yield matches()

    order = ["one", "two", "three", "side", "node"]
    dealt = rows.select(*order, "label", "text").repartition("one", "two", "three").sortWithinPartitions(*order)
    return map_batches(dealt, "a long, b long", work)


def duplicate_links(texts: DataFrame, documents: DataFrame, workspace: Workspace, least: float) -> DataFrame:
    """Verified pairs (a, b) of nodes of ``texts`` (node, sketches), whose texts are in ``documents`` (node, text),
    enough to connect all similar ones that share a sketch."""
    placed = texts.select("node", F.posexplode("sketches").alias("place", "sketch")).select(
        "node", F.xxhash64("place", "sketch").alias("bucket")
    )
    n = SKETCHES * texts.count()
    shared = _narrow(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), n, workspace, "shared")
    members = _narrow(placed.join(shared, "bucket"), n, workspace, "members")
    # Texts of all that share a bucket, once for all passes. Both sides are shuffled at every size.
    asked = members.select("node").distinct().hint("merge")
    once = documents.join(asked, "node").select("node", "text").dropDuplicates(["node"])
    held = workspace.stage(once, "texts").hint("merge")
    leaders = _narrow(_central_leaders(members), n, workspace, "leaders")
    pairs = members.join(leaders, "bucket").where("node != leader").select("leader", "node")
    pairs = _narrow(pairs.distinct(), n, workspace, "pairs")
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    sizes = _narrow(sizes, n, workspace, "sizes")
    roles = _narrow(_roles(pairs, sizes), n, workspace, "roles")
    found = workspace.stage(verified(roles.join(held, "node"), least), "matches")
    # All pairs of a group of one chunk have been settled, and so have the buckets in it.
    settled = leaders.join(sizes.where("chunks = 1"), "leader", "left_semi").select("bucket")
    open_ = members.join(settled, "bucket", "left_anti").select("node").distinct()
    return _by_rare_kmers(_narrow(open_, n, workspace, "open"), held, found, workspace, least)


def _narrow(df: DataFrame, rows: int, workspace: Workspace, name: str) -> DataFrame:
    return workspace.stage(few_tasks(df, rows), name)


def _by_rare_kmers(nodes: DataFrame, held: DataFrame, found: DataFrame, workspace: Workspace, least: float) -> DataFrame:
    """``found`` and what connects all similar pairs of ``nodes`` beside it."""
    spark, n = nodes.sparkSession, nodes.count()
    while n:
        own = workspace.stage(held.join(nodes, "node", "left_semi"), "texts")
        counts = spark.sparkContext.broadcast(kmer_counts(own))
        index = workspace.stage(meetings(own, counts, least), "meetings")
        size = index.count()
        blocks = _narrow(_in_blocks(_labels(index, found, workspace), size, workspace), size, workspace, "blocks")
        # Those of one block meet now. The others' rare k-mers are rarer among themselves.
        rest = _narrow(blocks.where("blocks > 1").select("node").distinct(), size, workspace, "rest")
        left = rest.count()
        once_more = 2 * left < n
        rows = _block_rows(blocks.where("blocks = 1") if once_more else blocks, size, workspace)
        matches = verified(rows.join(own.hint("merge"), "node"), least, counts)
        found = found.unionAll(workspace.stage(matches, "matches"))
        nodes, n = rest, left if once_more else 0
    return found


def _central_leaders(members: DataFrame) -> DataFrame:
    """Of each bucket, the member that shares its sketches with most others; of a family of near copies that is
    the text that they were made from."""
    central = members.groupBy("node").agg(F.sum("n").alias("central"))
    ranked = members.join(central, "node")
    return ranked.groupBy("bucket").agg(F.max(F.struct("central", "node")).alias("l")).select("bucket", F.col("l.node").alias("leader"))


def _roles(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members and leaders by chunk. A member of several large groups takes part in the largest; what that joins need
    not be compared in blocks, and all else is."""
    sized = pairs.join(sizes, "leader").select("leader", "node", "chunks")
    largest = sized.where("chunks > 1").groupBy("node").agg(F.max(F.struct("chunks", "leader")).alias("g"))
    sized = sized.where("chunks = 1").unionAll(largest.select("g.leader", "node", "g.chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    heads = sizes.select("leader", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    rows = sized.select("leader", chunk.alias("chunk"), "node").unionAll(heads.select("leader", "chunk", F.col("leader").alias("node")))
    return rows.select(
        F.col("leader").alias("one"), F.col("chunk").cast("long").alias("two"), F.lit(0).cast("long").alias("three"),
        F.lit(0).alias("side"), "node", F.col("node").alias("label"),
    )


def _in_blocks(members: DataFrame, n: int, workspace: Workspace) -> DataFrame:
    """Members of the buckets that hold several labels, with their block of about ``BLOCK`` k-mers (of one label where
    it has so many, or else of several) and the ``blocks`` that the bucket's members would fill."""
    members = _narrow(members, n, workspace, "labelled")
    # Whose partners would have to be shorter than all members has none.
    shortest = members.groupBy("bucket").agg(F.min("size").alias("shortest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shortest = _narrow(shortest.drop("n"), n, workspace, "shortest")
    members = members.join(shortest, "bucket").where("partner >= shortest").drop("shortest", "partner")
    members = _narrow(members, n, workspace, "meeting")
    counts = _narrow(members.groupBy("bucket", "label").agg(F.sum("size").alias("same")), n, workspace, "counts")
    few = F.sum(F.when(F.col("same") < BLOCK, F.col("same")).otherwise(0)).alias("few")
    several = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"), few, F.sum("same").alias("all")).where("labels > 1")
    several = several.select("bucket", "few", F.ceil(F.col("all") / BLOCK).alias("blocks"))
    counts = _narrow(counts.join(_narrow(several, n, workspace, "several"), "bucket"), n, workspace, "counts")
    alone = F.xxhash64("label", F.pmod(F.xxhash64("node"), F.ceil(F.col("same") / BLOCK)))
    mixed = F.when(F.col("same") >= BLOCK, alone).otherwise(F.pmod(F.xxhash64("label"), F.greatest(F.ceil(F.col("few") / BLOCK), F.lit(1))))
    block = F.when(F.col("blocks") == 1, F.lit(0)).otherwise(mixed)
    return members.join(counts, ["bucket", "label"]).select("bucket", "node", "label", block.cast("long").alias("block"), "blocks")


def _block_rows(blocks: DataFrame, n: int, workspace: Workspace) -> DataFrame:
    """Members by pair of blocks of a bucket, of each block with itself and with every other, where labels differ."""
    ends = _narrow(blocks.groupBy("bucket", "block").agg(F.min("label").alias("low"), F.max("label").alias("high")), n, workspace, "ends")
    met = ends.where("low != high").select("bucket", F.col("block").alias("two"), F.col("block").alias("three"))
    second = ends.select("bucket", F.col("block").alias("three"), F.col("low").alias("low3"), F.col("high").alias("high3"))
    two = ends.withColumnRenamed("block", "two").join(second, "bucket").where("two < three and least(low, low3) != greatest(high, high3)")
    met = _narrow(met.unionAll(two.select("bucket", "two", "three")), n, workspace, "met")
    rows = [
        blocks.join(pairs.withColumn("block", F.col(c)), ["bucket", "block"])
        .select(F.col("bucket").alias("one"), "two", "three", F.lit(side).alias("side"), "node", "label")
        for pairs, c, side in ((met, "two", 0), (met.where("two < three"), "three", 1))
    ]
    return _narrow(rows[0].unionAll(rows[1]), n, workspace, "rows")


def _labels(members: DataFrame, links: DataFrame, workspace: Workspace) -> DataFrame:
    """Members with the label of all that links connect so far."""
    groups = components(links, workspace)
    return members.join(groups, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")


def duplicate_classes(documents: DataFrame, workspace: Workspace, least: float = SIMILAR) -> DataFrame:
    """Of each document: doc_id, node, class_id (the least doc_id of its class) and kept (one of each class)."""
    prepared(documents.sparkSession)
    rows = workspace.stage(sketched(documents).withColumn("row", F.monotonically_increasing_id()), "sketched")
    texts = rows.groupBy("copy_of").agg(F.min(F.struct("doc_id", "row", "node", "sketches")).alias("one"))
    n = rows.count()
    texts = workspace.stage(few_tasks(texts.select("copy_of", "one.*"), n, 32 + 8 * SKETCHES), "texts")
    by_node = documents.select(F.xxhash64("doc_id", "text").alias("node"), "text")
    links = duplicate_links(texts.select("node", "sketches"), by_node, workspace, least)
    groups = _narrow(components(links, workspace), n, workspace, "components")
    of_text = texts.select("copy_of", "doc_id", "row", "node").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least_of = of_text.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    classes = of_text.join(_narrow(least_of, n, workspace, "firsts"), "component").select(
        "copy_of", F.col("first.doc_id").alias("class_id"), F.col("first.row").alias("class_row")
    )
    classes = _narrow(classes, n, workspace, "classes")
    return rows.select("doc_id", "node", "copy_of", "row").join(classes, "copy_of").select(
        "doc_id", "node", "class_id", (F.col("row") == F.col("class_row")).alias("kept")
    )
