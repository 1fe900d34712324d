"""Token ids in directly addressable codes.

A segment holds the ids of some documents. Each id is cut into bytes; level 0 has the lowest byte of every
id, level 1 the next byte of those ids that have one, and so on. A continuation bitmap for each level but
the last says which entries go on, and a rank directory (ones before every 512 bits) finds the entry in
the next level, so any token is read by a few lookups and no block is decoded (``token_at``).

Layout, little endian: magic, tokens (u64), documents (u64), levels (u64); document ends (u64 each); then
for each level its entries (u64), its bytes, its bitmap and its ranks (u64), each padded to 8 bytes.

Segments are rows of a Parquet table (Spark commits them, and lost tasks are done again), in files by
ranges of the document id. Part numbers and the token count before a segment within its part are stored
beside it; one total for each part is all that is needed to number the tokens of the corpus.

Defined cases: a null or empty text has just the end id. Documents with equal ids are ordered by a hash of
their text, and equal rows by their place. A null id sorts first. Rows that repeat are written each. A very long text is
encoded whole by one task and stays in one segment. Only the ids and the text are read, so other columns may have any
names. An empty table gives no segments.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import combine, map_batches, mix, prepared, size_of, text_bytes

MAGIC = b"BLDAC001"
RANK_BITS = 512
END_ID = 1
MOST_PARTS = 20_000
BREAK = re.compile(rb"[\t\n\x0b\x0c\r ]")


def _padded(raw: bytes) -> bytes:
    return raw + b"\0" * (-len(raw) % 8)


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The segment of ``ids`` whose documents end before the positions ``ends``."""
    ids = ids.astype(np.uint64)
    levels = max(1, (int(ids.max()).bit_length() + 7) // 8) if len(ids) else 1
    out = [MAGIC, np.array([len(ids), len(ends), levels], "<u8").tobytes(), ends.astype("<u8").tobytes()]
    for level in range(levels):
        more = ids > 0xFF
        out += [np.array([len(ids)], "<u8").tobytes(), _padded((ids & np.uint64(0xFF)).astype(np.uint8).tobytes())]
        if level < levels - 1:
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint64) if len(more) else np.empty(0, np.uint64)
            ranks = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ones, dtype=np.uint64)])[: len(ones)]
            out += [_padded(bits.tobytes()), ranks.astype("<u8").tobytes()]
        ids = ids[more] >> np.uint64(8)
    return b"".join(out)


class Segment:
    """Views into a packed segment; nothing is copied."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token segment")
        self.tokens, documents, levels = (int(x) for x in np.frombuffer(raw, "<u8", 3, 8))
        at = 32
        self.ends = np.frombuffer(raw, "<u8", documents, at)
        at += 8 * documents
        self.chunks, self.bits, self.ranks = [], [], []
        for level in range(levels):
            n = int(np.frombuffer(raw, "<u8", 1, at)[0])
            at += 8
            self.chunks.append(np.frombuffer(raw, np.uint8, n, at))
            at += n + -n % 8
            if level < levels - 1:
                size, blocks = -(-n // 8), -(-n // RANK_BITS)
                self.bits.append(np.frombuffer(raw, np.uint8, size, at))
                at += size + -size % 8
                self.ranks.append(np.frombuffer(raw, "<u8", blocks, at))
                at += 8 * blocks

    def token_at(self, place: int) -> int:
        """One token, without decoding its neighbours."""
        if not 0 <= place < self.tokens:
            raise IndexError(place)
        value = 0
        for level, chunk in enumerate(self.chunks):
            value |= int(chunk[place]) << 8 * level
            if level == len(self.bits) or not self.bits[level][place >> 3] >> (place & 7) & 1:
                break
            block = place // RANK_BITS
            before = np.unpackbits(self.bits[level][block * RANK_BITS // 8 : (place >> 3) + 1], bitorder="little")
            place = int(self.ranks[level][block]) + int(before[: place - block * RANK_BITS].sum())
        return value

    def ids(self) -> np.ndarray:
        """All tokens."""
        value = np.zeros(0, np.uint32)
        for level in range(len(self.chunks) - 1, -1, -1):
            own = self.chunks[level].astype(np.uint32)
            if level < len(self.bits):
                more = np.unpackbits(self.bits[level], count=len(own), bitorder="little").astype(bool)
                own[more] |= value << np.uint32(8)
            value = own
        return value


#: Bytes between chunks, letters, and what may follow letters without touching their ids (fixed values; A-Z is lower-cased).
SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
LETTER = np.isin(np.arange(256), list(range(0x61, 0x7B)))
FOLLOWS = np.isin(np.arange(256), [b for b in range(0x80) if not chr(b).isalnum() and b != 0x27])
#: After the byte C3, these make a Latin-1 letter in UTF-8.
LATIN = np.isin(np.arange(256), [*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)])
LONGEST = 64  # bytes of a piece that is remembered by its hash
_BASE = 0x9E3779B97F4A7C15


def _gather(pool: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The pieces of ``pool`` that begin at ``start`` with ``size`` entries, one after the other."""
    ends = np.cumsum(size)
    return pool[np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class ChunkEncoder:
    """Ids of whole texts, from ids of their pieces.

    A tokenizer that lower-cases, drops white space and marks the ends of words looks at no piece's neighbours,
    so a text's ids are those of its pieces in order. Pieces are runs between white space; letters and the
    punctuation after them are two. They are found, hashed (64 bits) and looked up as arrays over many texts; each
    distinct one is encoded by the library once, until more than ``most`` are known. Pieces over ``LONGEST``
    bytes, texts with marks of special tokens, and all texts of other tokenizers go to the library as they are.
    """

    _last: tuple[str, ChunkEncoder] | None = None

    def __init__(self, path: str, most: int = 500_000, at_once: int = 50_000, window: int = 1 << 19):
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.at_once, self.window = Tokenizer.from_file(path), most, at_once, window
        kind = json.loads(self.tokenizer.to_str())
        self.by_piece = kind["model"].get("end_of_word_suffix") == "</w>" and '"Lowercase"' in json.dumps(kind["normalizer"]) and '"Removed"' in json.dumps(kind["pre_tokenizer"])
        if self.by_piece:
            words = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(words.values()) + 1, bool)
            self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.values = mix(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.inverse = np.empty(0, np.uint64)
        self._forget()

    @classmethod
    def of(cls, path: str) -> ChunkEncoder:
        """The encoder of this worker process, kept with what it knows for its next task."""
        if cls._last is None or cls._last[0] != path:
            cls._last = path, cls(path)
        return cls._last[1]

    def _forget(self) -> None:
        self.known, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.pool, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)

    def _grow_powers(self, length: int) -> None:
        if len(self.powers) < length:
            one = np.uint64(1)
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                setattr(self, name, np.concatenate([[one], np.cumprod(np.full(length, base, np.uint64))]))

    def _encoded(self, pieces: list[bytes], plain: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and sizes of new pieces, joined to texts of bounded size. A plain piece is one word of letters."""
        pools, sizes, first = [], [], 0
        while first < len(pieces):
            some, total = [], 0
            while first < len(pieces) and (total < self.at_once or not some):
                some.append(pieces[first].decode("utf-8", "replace"))
                total += len(some[-1]) + 1
                first += 1
            found = self.tokenizer.encode("\n".join(some), add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            if plain:
                own = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            else:
                at = np.fromiter((o[0] for o in found.offsets), np.int64, len(ids))
                begins = np.cumsum([0, *(len(s) + 1 for s in some)])
                own = np.bincount(np.searchsorted(begins, at, "right") - 1, minlength=len(some))
            if len(own) != len(some):
                raise ValueError("pieces and ids do not agree")
            pools.append(ids)
            sizes.append(own)
        return pools, sizes

    def _learn(self, raw: bytes, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, plain: np.ndarray) -> None:
        """Encode pieces of ``raw`` with new (sorted, distinct) hashes and remember them."""
        pools, sizes, order = [self.pool], [self.size], []
        for kind in (True, False):
            mine = np.flatnonzero(plain == kind)
            more = self._encoded([raw[i:j] for i, j in zip(begin[mine].tolist(), end[mine].tolist(), strict=True)], kind)
            pools += more[0]
            sizes += more[1]
            order.append(mine)
        slots = np.empty(len(hashes), np.int64)
        slots[np.concatenate(order)] = np.arange(len(self.size), len(self.size) + len(hashes))
        at = np.searchsorted(self.known, hashes)
        self.known, self.slots = np.insert(self.known, at, hashes), np.insert(self.slots, at, slots)
        self.pool, self.size = np.concatenate(pools), np.concatenate(sizes)

    def _pieces(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and end of each piece of a window of text in order, and whether it is plain."""
        space = SPACE[window]
        edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
        begin, end = edge[::2], edge[1::2]
        latin = (window[:-1] == 0xC3) & LATIN[window[1:]] if len(window) else np.empty(0, bool)
        letter = LETTER[window]
        letter[:-1] |= latin
        letter[1:] |= latin
        others = np.flatnonzero(~letter)
        before = np.cumsum(~letter)[begin] - ~letter[begin]  # bytes that are no letters before each chunk
        stop = np.minimum(np.append(others, len(window))[before], end)
        unsafe = np.concatenate([[0], np.cumsum(~FOLLOWS[window])])
        split = (stop > begin) & (unsafe[end] == unsafe[stop])
        second = split & (stop < end)
        place = np.arange(len(begin)) + np.cumsum(second) - second
        begins, ends, plain = (np.empty(len(begin) + int(second.sum()), k) for k in (np.int64, np.int64, bool))
        begins[place], ends[place], plain[place] = begin, np.where(split, stop, end), split
        rest = place[second] + 1
        begins[rest], ends[rest], plain[rest] = stop[second], end[second], False
        return begins, ends, plain

    def _window_ids(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the pieces of a window: where they begin, how many ids they have, and all ids."""
        window = np.frombuffer(raw, np.uint8)
        begin, end, plain = self._pieces(window)
        if not len(begin):
            return begin, np.empty(0, np.int64), np.empty(0, np.uint32)
        self._grow_powers(len(window))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[window] * self.powers[: len(window)], dtype=np.uint64)])
        hashes = combine((sums[end] - sums[begin]) * self.inverse[begin], (end - begin).astype(np.uint64))
        long = np.flatnonzero(end - begin > LONGEST)
        distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
        new = new[(end - begin)[first[new]] <= LONGEST]
        if len(new):
            self._learn(raw, distinct[new], begin[first[new]], end[first[new]], plain[first[new]])
            at = np.minimum(np.searchsorted(self.known, distinct), len(self.known) - 1)
        slots = self.slots[at][place] if len(self.known) else np.zeros(len(place), np.int64)
        start = np.cumsum(self.size) - self.size
        if not len(long):
            return begin, self.size[slots], _gather(self.pool, start[slots], self.size[slots])
        # Long pieces are encoded by themselves; their ids follow the pool for this window.
        more = [np.array(self.tokenizer.encode(raw[begin[i] : end[i]].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for i in long]
        sizes, starts = self.size[slots] if len(self.size) else np.zeros(len(slots), np.int64), start[slots] if len(start) else np.zeros(len(slots), np.int64)
        sizes[long] = [len(m) for m in more]
        starts[long] = len(self.pool) + np.cumsum(sizes[long]) - sizes[long]
        return begin, sizes, _gather(np.concatenate([self.pool, *more]), starts, sizes)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_piece:
            found = self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)
            return [np.array(f.ids, np.uint32) for f in found]
        raws = [t.encode("utf-8", "replace") if t else b"" for t in texts]
        special = [i for i, raw in enumerate(raws) if b"<|" in raw]
        found = {i: np.array(self.tokenizer.encode(raws[i].decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32) for i in special}
        raw = b"\n".join(b"" if i in found else r.lower() for i, r in enumerate(raws))
        lengths = np.array([0 if i in found else len(r) for i, r in enumerate(raws)], np.int64)
        begins = np.cumsum(lengths + 1) - lengths - 1
        places, sizes, ids, at = [], [], [], 0
        while at < len(raw):
            if len(self.known) > self.most:
                self._forget()
            cut = BREAK.search(raw, at + self.window)
            end = cut.end() if cut else len(raw)
            place, size, some = self._window_ids(raw[at:end])
            places.append(place + at)
            sizes.append(size)
            ids.append(some)
            at = end
        if not places:
            return [found.get(i, np.empty(0, np.uint32)) for i in range(len(texts))]
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        first = ends[np.searchsorted(np.concatenate(places), begins)]
        every = np.concatenate(ids)
        return [found[i] if i in found else every[a:b] for i, (a, b) in enumerate(itertools.pairwise([*first, ends[-1]]))]


def encoded_segments(
    documents: DataFrame,
    tokenizer_path: str,
    end_id: int = END_ID,
    part_bytes: int = 16 << 20,
    segment_tokens: int = 1 << 19,
    order_by: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Segments of the documents: part, seq, before (tokens before it in its part), tokens, doc_ids, data.

    Documents are in ascending order of doc_id, or of what ``order_by`` makes of a number that tells all rows apart.
    """
    prepared(documents.sparkSession)
    kind = dict(documents.dtypes)["doc_id"]
    _, total = size_of(documents, text_bytes())
    part_bytes = max(part_bytes, total // MOST_PARTS)
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("by_text"), F.monotonically_increasing_id().alias("by_place"))
    order = ["doc_id", "by_text", "by_place"]
    if order_by is not None:
        rows, order = rows.withColumn("by_order", order_by(F.col("by_place"))), ["by_order", *order]
    moved = rows.repartitionByRange(max(1, -(-total // part_bytes)), *order).sortWithinPartitions(*order).select("doc_id", "text")

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        part, encoder = TaskContext.get().partitionId(), ChunkEncoder.of(tokenizer_path)
        seq = before = held = 0
        names: list = []
        ids: list[np.ndarray] = []

        def segment() -> dict[str, list]:
            ends = np.cumsum([len(x) for x in ids])
            return {"part": [part], "seq": [seq], "before": [before], "tokens": [held], "doc_ids": [names], "data": [pack(np.concatenate(ids), ends)]}

        for batch in batches:
            for name, found in zip(batch["doc_id"], encoder.encode(batch["text"]), strict=True):
                names.append(name)
                ids.append(np.append(found, np.uint32(end_id)))
                held += len(ids[-1])
                if held >= segment_tokens:
                    yield segment()
                    seq, before, held, names, ids = seq + 1, before + held, 0, [], []
        if names:
            yield segment()

    return map_batches(moved, f"part int, seq int, before long, tokens long, doc_ids array<{kind}>, data binary", work)


def write_tokens(documents: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    encoded_segments(documents, tokenizer_path, **options).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return prepared(spark).read.parquet(path)


def read_documents(segments: DataFrame) -> DataFrame:
    """Of each document in the files: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32."""
    spark = segments.sparkSession
    kind = dict(segments.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    totals = segments.groupBy("part").agg(F.sum("tokens").alias("tokens")).orderBy("part").collect()  # one row a part
    starts = np.cumsum([0, *(t["tokens"] for t in totals)]).tolist()
    parts = spark.createDataFrame([(t["part"], s) for t, s in zip(totals, starts, strict=False)], "part int, part_start long")

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for part, before, names, data in zip(batch["part"], batch["before"], batch["doc_ids"], batch["data"], strict=True):
                segment = Segment(data)
                raw, ends = memoryview(segment.ids().astype("<u4").tobytes()), segment.ends.tolist()
                begins = [0, *ends[:-1]]
                yield {
                    "doc_id": names,
                    "part": [part] * len(names),
                    "at": [before + b for b in begins],
                    "n_tokens": [e - b for b, e in zip(begins, ends, strict=True)],
                    "ids_crc32": [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begins, ends, strict=True)],
                }

    read = map_batches(segments.select("part", "before", "doc_ids", "data"), f"doc_id {kind}, part int, at long, n_tokens long, ids_crc32 long", work)
    placed = read.join(parts, "part")
    return placed.select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
