"""What the corpus operators share: session limits, word hashing, row-wise Arrow helpers."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from barloom.session import ship_package

LIMITS = {
    # Long texts: a batch that goes to a Python worker is bounded in bytes, not only in rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}


def prepared(spark: SparkSession) -> SparkSession:
    for name, value in LIMITS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterator[dict[str, list]]], Iterable[dict[str, list]]]) -> DataFrame:
    """``work`` sees the batches of one partition as dicts of Python lists and yields dicts of lists or arrays."""
    ship_package(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches)
        for made in work(columns):
            arrays = [pa.array(made[f.name], type=f.type) for f in out]
            if len(arrays[0]):
                yield pa.RecordBatch.from_arrays(arrays, schema=out)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system. Workers are used again by later stages, which count with their own needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def size_of(df: DataFrame, each: Column) -> tuple[int, int]:
    """Rows and the sum of ``each`` over them, one partial aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("s")).first()
    return int(row["n"]), int(row["s"])


def few_tasks(df: DataFrame, rows: int, row_bytes: int = 32) -> DataFrame:
    """``df``, a shuffled table of about ``rows`` narrow rows, in no more tasks than its size and the cluster's cores ask
    for: rounds over small tables would else spend their time on starting tasks and on files of a few rows."""
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, rows * row_bytes // (64 << 20)))


def join_facts(rows: DataFrame, facts: DataFrame, keys: list[str], spread: Column, salts: int = 64) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row for each key. ``spread`` deals the rows of a key,
    however many, over ``salts`` tasks, each with its copy of the key's facts."""
    copied = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")).join(copied, [*keys, "_salt"]).drop("_salt")


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; a null has none."""
    return F.coalesce(F.octet_length(F.col(text) if isinstance(text, str) else text), F.lit(0)).cast("long")


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads nearby ones (finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def combine(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second)


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = mix(words[:n])
    for i in range(1, k):
        out = combine(out, words[i : i + n])
    return out


class WordHashes(dict):
    """64-bit hash of each word, remembered up to a bound of distinct words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes | str) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
