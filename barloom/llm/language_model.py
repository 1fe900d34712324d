"""Interpolated modified Kneser-Ney n-gram model, counted in Spark and read through memory maps.

Counting. Every task turns its texts into word hashes (48 bits) and sends the distinct n-grams of each
stretch of tokens, with counts, as packed arrays to buckets of equal hash ranges. A bucket merges its arrays, keeps
its part of the table of n-grams as sorted hash arrays, and sends on what the next lower order needs: the
distinct continuations of each shorter n-gram (the adjusted counts of Kneser-Ney) and, for each context,
its total and how many words follow it once, twice, more often. A frequent word or pair is one entry of each
stretch, so no bucket is hot.

Storage. The tables are binary rows of uncompressed Parquet files in the shared folder. Workers map these
files and search the sorted arrays where they lie; nothing is loaded or copied. A store that is not a file
system has its files fetched to every node by Spark first.

All n-grams are kept. A greater ``min_count`` leaves rarer ones of highest order to the lower orders, with all of
their probability; contexts whose n-grams were all left out need no entry. Both are part of the model, not of
the counting, which covers all tokens. What one level has sent to the next is removed once that has read it. Words are
compared by hash: among V words V**2 / 2**49 collisions are expected.

Defined cases: a null text is empty, and every text has its end as last token. Without training tokens
every probability is 1 / (V + 1) = 1. Rows that repeat count and are scored each.
Very long texts are learnt and scored whole. Only the kept columns and the text are read.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WordHashes, combine, map_batches, prepared, size_of, text_bytes
from barloom.session import Workspace

MAGIC, CLOSE = b"BLNGRAM1", b"BLNGRAMZ"
WORD_BITS = 48
END, BEGIN = 0, 1  # hashes that stand for no word
DTYPES = ("u1", "<u2", "<u4", "<u8", "<f8")
ROW = "kind string, bucket int, data binary, facts array<long>"


# --- packed arrays -------------------------------------------------------------------------------


def _slim(values: np.ndarray) -> np.ndarray:
    """Unsigned integers in the smallest type that holds them all."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in DTYPES[:4] if most <= np.iinfo(t).max))


def pack(arrays: list[np.ndarray]) -> bytes:
    head = [len(arrays)]
    body = []
    for a in arrays:
        head += [DTYPES.index(next(t for t in DTYPES if np.dtype(t) == a.dtype)), len(a)]
        raw = a.tobytes()
        body.append(raw + b"\0" * (-len(raw) % 8))
    inner = np.array(head, "<u8").tobytes() + b"".join(body)
    return MAGIC + len(inner).to_bytes(8, "little") + inner + CLOSE


def packed_at(raw: mmap.mmap) -> Iterator[int]:
    """Where packed arrays begin in a file; statistics that Parquet keeps of a value do not end as it does."""
    at = raw.find(MAGIC)
    while at >= 0:
        end = at + 16 + int.from_bytes(raw[at + 8 : at + 16], "little")
        whole = raw[end : end + 8] == CLOSE
        if whole:
            yield at
        at = raw.find(MAGIC, end if whole else at + 8)


def unpack(raw: bytes | mmap.mmap, at: int = 0) -> list[np.ndarray]:
    if raw[at : at + 8] != MAGIC:
        raise ValueError("not packed arrays")
    count = int(np.frombuffer(raw, "<u8", 1, at + 16)[0])
    head = np.frombuffer(raw, "<u8", 2 * count, at + 24).tolist()
    at += 24 + 16 * count
    out = []
    for kind, n in zip(head[::2], head[1::2], strict=True):
        out.append(np.frombuffer(raw, DTYPES[kind], n, at))
        at += out[-1].nbytes + -out[-1].nbytes % 8
    return out


def _short(words: np.ndarray) -> np.ndarray:
    return words.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : WORD_BITS // 8].ravel()


def _long(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) * 8 // WORD_BITS, 8), np.uint8)
    out[:, : WORD_BITS // 8] = raw.reshape(-1, WORD_BITS // 8)
    return out.view("<u8").ravel()


# --- tokens --------------------------------------------------------------------------------------


class Tokens:
    """Hashes of the tokens of texts: words between white space, A-Z lower-cased, then the end."""

    def __init__(self) -> None:
        self.known = WordHashes()

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the texts in a row, and the tokens of each text."""
        split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
        sizes = np.array([len(s) + 1 for s in split], np.int64)
        out = np.full(int(sizes.sum()), END, np.uint64)
        words = np.ones(len(out), bool)
        words[np.cumsum(sizes) - 1] = False
        hashes = self.known.of([w for s in split for w in s]) >> np.uint64(64 - WORD_BITS)
        out[words] = np.maximum(hashes, np.uint64(2))
        return out, sizes


def grams(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each token the words of its n-gram, as one array for each place; texts begin with BEGIN."""
    begins = np.cumsum(sizes) - sizes
    places = np.arange(len(tokens)) - np.repeat(begins, sizes)
    out = [tokens]
    for back in range(1, order):
        earlier = np.full(len(tokens), BEGIN, np.uint64)
        has = places >= back
        earlier[has] = tokens[np.flatnonzero(has) - back]
        out.append(earlier)
    return out[::-1]


def key_of(columns: list[np.ndarray]) -> np.ndarray:
    out = columns[0]
    for column in columns[1:]:
        out = combine(out, column)
    return out


def bits_of(words: int) -> int:
    return WORD_BITS if words == 1 else 64


def bucket_of(keys: np.ndarray, bits: int, buckets: int) -> np.ndarray:
    """Ranges of equal width, so that the buckets in order are the keys in order."""
    return ((keys >> np.uint64(bits - 32)) * np.uint64(buckets)) >> np.uint64(32)


def _summed(keys: np.ndarray, columns: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct keys, the columns of each, and the sums of the values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    sums = [np.add.reduceat(v[order], first, dtype=np.uint64) if len(first) else np.empty(0, np.uint64) for v in values]
    return keys[first], [c[order[first]] for c in columns], sums


def _sent(kind: str, keys: np.ndarray, words: int, buckets: int, arrays: list[np.ndarray]) -> Iterator[dict[str, list]]:
    """Rows of the arrays by bucket; the keys are sorted."""
    edges = np.searchsorted(bucket_of(keys, bits_of(words), buckets), np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[bucket], edges[bucket + 1])
        packed = pack([_short(a[part]) if a.dtype == np.uint64 and i < words else _slim(a[part]) for i, a in enumerate(arrays)])
        yield {"kind": [kind], "bucket": [bucket], "data": [packed], "facts": [None]}


# --- counting ------------------------------------------------------------------------------------


def counted(texts: DataFrame, order: int, buckets: int, stretch: int = 2_000_000) -> DataFrame:
    """The n-grams of all texts, summed over stretches of tokens, by bucket."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokens, held, size = Tokens(), [], 0

        def flush() -> Iterator[dict[str, list]]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            keys, columns, counts = _summed(key_of(columns), columns, [np.ones(len(columns[0]), np.uint64)])
            yield from _sent("count", keys, order, buckets, [*columns, *counts])

        for batch in batches:
            held.append(grams(*tokens.of(batch["text"]), order))
            size += len(held[-1][0])
            if size >= stretch:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return map_batches(texts.select("text"), ROW, work)


def _merged(batches: Iterator[dict[str, list]], words: int) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
    """Of each bucket, rows in its order: the columns and the values of all its arrays."""
    bucket, held = None, []
    for batch in batches:
        for b, data in zip(batch["bucket"], batch["data"], strict=True):
            if held and b != bucket:
                yield bucket, *_joined(held, words)
                held = []
            bucket = b
            held.append(unpack(data))
    if held:
        yield bucket, *_joined(held, words)


def _joined(held: list[list[np.ndarray]], words: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    arrays = [np.concatenate(a) for a in zip(*held, strict=True)]
    return [_long(a) for a in arrays[:words]], arrays[words:]


def reduced(rows: DataFrame, words: int, top: bool, buckets: int, min_count: int) -> DataFrame:
    """From the counts of n-grams of ``words`` words: their table, facts, contexts and the next lower order."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for bucket, columns, values in _merged(batches, words):
            keys, columns, sums = _summed(key_of(columns), columns, values)
            raw, adjusted = sums[0], sums[0] if top else sums[1]
            facts = [len(keys), int(adjusted.sum()), int(raw.sum()), *(int((adjusted == i).sum()) for i in range(1, 5))]
            yield {"kind": ["facts"], "bucket": [bucket], "data": [None], "facts": [facts]}
            if words == 1:
                yield {"kind": ["table"], "bucket": [bucket], "data": [pack([keys, raw, adjusted])], "facts": [None]}
                continue
            kept = adjusted >= (min_count if top else 1)
            yield {"kind": ["table"], "bucket": [bucket], "data": [pack([keys[kept], adjusted[kept]])], "facts": [None]}
            context = key_of(columns[:-1])
            seen = [adjusted, adjusted == 1, adjusted == 2, adjusted > 2, kept]
            found, _, sums = _summed(context, [], seen)
            if words == 2:
                yield from _sent("context", found, 1, buckets, [found, *sums])
            else:
                low, high = found & np.uint64(0xFFFFFFFF), found >> np.uint64(32)
                yield from _sent("context", found, words - 1, buckets, [low.astype("<u4"), high.astype("<u4"), *sums])
            shorter, rest, sums = _summed(key_of(columns[1:]), columns[1:], [raw, np.ones(len(keys), np.uint64)])
            yield from _sent("next", shorter, words - 1, buckets, [*rest, *sums])

    return map_batches(rows.select("bucket", "data"), ROW, work)


def contexts(rows: DataFrame, words: int, only_kept: bool) -> DataFrame:
    """Table of the contexts of n-grams of ``words`` words: total and how many words follow once, twice, more often."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for bucket, columns, values in _merged(batches, 1 if words == 2 else 0):
            if words == 2:
                keys = columns[0]
            else:
                keys, values = values[0].astype(np.uint64) | values[1].astype(np.uint64) << np.uint64(32), values[2:]
            keys, _, sums = _summed(keys, [], values)
            need = sums[4] > 0 if only_kept else np.ones(len(keys), bool)
            yield {"kind": ["table"], "bucket": [bucket], "data": [pack([keys[need], *(s[need] for s in sums[:4])])], "facts": [None]}

    return map_batches(rows.select("bucket", "data"), ROW, work)


# --- the model -----------------------------------------------------------------------------------


@dataclass
class Level:
    """Discounts of n-grams with adjusted counts of 1, 2 and more, and the sums of their table."""

    entries: int
    adjusted: int
    raw: int
    discounts: tuple[float, float, float]
    by_count: tuple[int, int, int]


@dataclass
class Model:
    """Where the tables are and the few numbers beside them. Tables: (order, "grams" or "contexts") to files."""

    order: int
    buckets: int
    min_count: int
    levels: dict[int, Level]
    files: dict[tuple[int, str], list[str]]
    local: bool


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams that occur 1, 2, 3 and 4 times.

    Where so few n-grams occur that a discount would leave nothing to the lower orders, or more than there is,
    half of the count is taken.
    """
    if not n[0] or not n[1]:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    out = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2] if n[2] else 1.5]
    return tuple(d if 0.0 < d <= i else i / 2 for i, d in enumerate(out, 1))


def train(texts: DataFrame, workspace: Workspace, order: int = 3, min_count: int = 1, bucket_bytes: int = 8 << 20) -> Model:
    """Count ``texts`` (column text) and write the tables of the model to the workspace."""
    spark = prepared(texts.sparkSession)
    _, total = size_of(texts, text_bytes() + 1)
    buckets = max(16, -(-total // bucket_bytes))
    plain = {"compression": "none", "parquet.enable.dictionary": "false"}
    levels: dict[int, Level] = {}
    files: dict[tuple[int, str], list[str]] = {}

    def by_bucket(rows: DataFrame) -> DataFrame:
        return rows.repartitionById(buckets, F.col("bucket"))

    rows, read = counted(texts, order, buckets), None
    for words in range(order, 0, -1):
        path = workspace.path(f"level{words}")
        reduced(by_bucket(rows), words, words == order, buckets, min_count).write.options(**plain).partitionBy("kind").parquet(path)
        if read:
            workspace.drop(read)
        made = spark.read.schema(ROW).parquet(path)
        facts = made.where("kind = 'facts'").select(F.posexplode("facts").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
        n = [0] * 7
        for f in facts:
            n[f["i"]] = f["v"]
        levels[words] = Level(n[0], n[1], n[2], _discounts(n[3:]), (n[3], n[4], n[0] - n[3] - n[4]))
        files[words, "grams"] = _files(made.where("kind = 'table'"))
        if words > 1:
            at = workspace.path(f"contexts{words}")
            table = contexts(by_bucket(made.where("kind = 'context'")), words, words == order and min_count > 1)
            table.select("bucket", "data").write.options(**plain).parquet(at)
            files[words, "contexts"] = _files(spark.read.schema("bucket int, data binary").parquet(at))
            workspace.drop(f"{path}/kind=context")
            read = f"{path}/kind=next"
            rows = made.where("kind = 'next'").select("bucket", "data")
    local = all(urlparse(f).scheme in ("", "file") for fs in files.values() for f in fs)
    if not local:
        for f in {f for fs in files.values() for f in fs}:
            spark.sparkContext.addFile(f)
    return Model(order, buckets, min_count, levels, files, local)


def _files(df: DataFrame) -> list[str]:
    found = df.inputFiles()
    kind = "kind=table"
    return sorted(f for f in found if kind in f or "kind=" not in f)


class Mapped:
    """A model's tables as memory maps of their files."""

    _last: tuple[str, Mapped] | None = None

    def __init__(self, model: Model):
        self.model, self.maps = model, []
        self.tables = {name: self._shards(files, bits_of(name[0] if name[1] == "grams" else name[0] - 1)) for name, files in model.files.items()}

    @classmethod
    def of(cls, model: Model) -> Mapped:
        """The maps of this worker process, kept for its next task."""
        name = repr(sorted(model.files.items()))
        if cls._last is None or cls._last[0] != name:
            cls._last = name, cls(model)
        return cls._last[1]

    def _shards(self, files: list[str], bits: int) -> dict[int, list[np.ndarray]]:
        out = {}
        for uri in files:
            path = unquote(urlparse(uri).path)
            with open(path if self.model.local else SparkFiles.get(path.rsplit("/", 1)[1]), "rb") as file:
                view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            self.maps.append(view)
            for at in packed_at(view):
                arrays = unpack(view, at)
                if len(arrays[0]):
                    out[int(bucket_of(arrays[0][:1], bits, self.model.buckets)[0])] = arrays
        return out

    def lookup(self, table: tuple[int, str], keys: np.ndarray, values: int) -> list[np.ndarray]:
        """The values of sorted keys, 0 where the table has no such key."""
        out = [np.zeros(len(keys), np.float64) for _ in range(values)]
        bits = bits_of(table[0] if table[1] == "grams" else table[0] - 1)
        edges = np.searchsorted(bucket_of(keys, bits, self.model.buckets), np.arange(self.model.buckets + 1))
        for bucket, arrays in self.tables[table].items():
            lo, hi = edges[bucket], edges[bucket + 1]
            if lo < hi:
                asked = keys[lo:hi]
                at = np.minimum(np.searchsorted(arrays[0], asked), len(arrays[0]) - 1)
                there = arrays[0][at] == asked
                for o, a in zip(out, arrays[1:], strict=False):
                    o[lo:hi][there] = a[at[there]]
        return out

    def _discounted(self, level: int, counts: np.ndarray) -> np.ndarray:
        d = self.model.levels[level].discounts
        return np.maximum(counts - np.select([counts == 0, counts == 1, counts == 2], [0.0, d[0], d[1]], d[2]), 0.0)

    def token_scores(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For n-grams given by columns: the last word's count and the log10 probability by the model."""
        word, place = np.unique(columns[-1], return_inverse=True)
        count, adjusted = self.lookup((1, "grams"), word, 2)
        base = self.model.levels[1]
        total = max(base.adjusted, 1)
        spare = sum(d * n for d, n in zip(base.discounts, base.by_count, strict=True)) / total if base.adjusted else 1.0
        p = (self._discounted(1, adjusted) / total + spare / (base.entries + 1))[place]
        for words in range(2, self.model.order + 1):
            own, own_place = np.unique(key_of(columns[-words:]), return_inverse=True)
            seen = self._discounted(words, self.lookup((words, "grams"), own, 1)[0])[own_place]
            context, context_place = np.unique(key_of(columns[-words:-1]), return_inverse=True)
            sums = self.lookup((words, "contexts"), context, 4)
            d = list(self.model.levels[words].discounts)
            if words == self.model.order and self.model.min_count > 1:
                d[0] = 1.0  # what occurs once has been left to the lower orders wholly
            mass = sum(x * s for x, s in zip(d, sums[1:], strict=True))
            known = sums[0] > 0
            total_of = np.where(known, sums[0], 1.0)[context_place]
            p = np.where(known[context_place], (seen + mass[context_place] * p) / total_of, p)
        return count[place], np.log10(p)


def score(documents: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_tokens, n_known, base_score (add-one unigrams), score and perplexity of each text."""
    kinds = dict(documents.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_tokens long, n_known long, base_score double, score double, perplexity double"])
    tokens_seen, words_seen = model.levels[1].raw, model.levels[1].entries

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        mapped, tokens = Mapped.of(model), Tokens()
        for batch in batches:
            texts = batch.pop("text")
            if not texts:
                continue
            flat, sizes = tokens.of(texts)
            count, logs = mapped.token_scores(grams(flat, sizes, model.order))
            begins = np.cumsum(sizes) - sizes
            base = np.log10((count + 1) / (tokens_seen + words_seen + 1))
            total = np.add.reduceat(logs, begins)
            yield batch | {
                "n_tokens": sizes, "n_known": np.add.reduceat((count > 0).astype(np.int64), begins),
                "base_score": np.add.reduceat(base, begins), "score": total, "perplexity": 10 ** (-total / sizes),
            }

    return map_batches(documents.select(*keep, "text"), schema, work)


def held_out(id_column: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    """Documents that the model does not learn from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(0)) % parts == part
