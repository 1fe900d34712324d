"""Exact copies of texts, in DataFrame operations only.

Rows are grouped by a 128-bit hash of their normalised text, and one row of each group stays: that of the least
(or greatest) id. A hash alone proves nothing, so the texts of every group of several rows are then compared byte by
byte: equal texts of a task are merged before they move, those of a hash meet by salt first and then whole, and a
hash that is left with more than one text has collided. The rows of such hashes are grouped by hash and text.

What is shuffled for all rows is narrow (id, hash, carried columns); texts move only if their hash occurs more than
once, and then once for each task and text, so a text of any number of copies gives no large task. Where the
repeated hashes are too many to be broadcast (``BROADCAST`` rows of 16 bytes), all texts move that way.

Defined cases: a null text counts as empty. A null id comes before all others. Rows that agree in id and text are
copies of one another, of which one stays. Very long texts are compared whole. An empty table gives no rows. Other
columns of the input, whatever their names, take no part and are not returned, unless they are carried.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import prepared
from barloom.session import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Most repeated hashes that are broadcast: some 60 MB in an executor.
BROADCAST = 500_000
#: Tasks over which the equal texts of a hash are merged before they meet.
SALTS = 16


def ascii_lower(text: Column) -> Column:
    """The text with A to Z in lower case and nothing else changed; null gives an empty text."""
    known = F.coalesce(text, F.lit(""))
    # All characters of one byte: here the general function changes the same letters, and much faster.
    return F.when(F.octet_length(known) == F.char_length(known), F.lower(known)).otherwise(F.translate(known, UPPER, LOWER))


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _with_several_texts(texts: DataFrame, keys: DataFrame, workspace: Workspace) -> DataFrame:
    """Hashes (``key``) under which texts differ. ``texts``: key, text."""
    repeated = workspace.stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "repeated")
    if repeated.count() <= BROADCAST:
        texts = texts.join(F.broadcast(repeated), "key", "left_semi")
    merged = texts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS))).groupBy("key", "text", "salt").agg(F.count(F.lit(1)))
    distinct = merged.groupBy("key", "text").agg(F.count(F.lit(1)))
    return distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")


def marked(
    rows: DataFrame,
    workspace: Workspace,
    text: str = "text",
    id: str = "doc_id",
    keep: str = "least",
    normalised: Callable[[Column], Column] = ascii_lower,
    content_hash: Callable[[Column], Column] = md5_128,
    carried: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """A row for each row: the id, ``keep_id`` (id of the row of its group that stays), ``group_size``, ``kept`` and
    what ``carried`` makes of the normalised text. ``keep``: which id stays, "least" or "greatest"."""
    if keep not in ("least", "greatest"):
        raise ValueError(f"keep: {keep}")
    prepared(rows.sparkSession)
    extra = dict(carried or {})
    texts = rows.select(F.col(id).alias("id"), normalised(F.col(text)).alias("text")).withColumn("key", content_hash(F.col("text")))
    more = [make(F.col("text")).alias(f"more_{name}") for name, make in extra.items()]
    numbered = F.monotonically_increasing_id().alias("row")
    keys = workspace.stage(texts.select("id", numbered, "key", *more), "keys")

    collided = workspace.stage(_with_several_texts(texts.select("key", "text"), keys, workspace), "collided")
    if not collided.isEmpty():
        told = texts.join(collided, "key", "left_semi").withColumn("key", F.concat("key", F.col("text").cast("binary")))
        # Numbers of their own: rows of a group must differ in them, and no group has rows of both kinds.
        told = told.select("id", numbered, "key", *more)
        keys = workspace.stage(keys.join(collided, "key", "left_anti").unionByName(told), "keys")

    # A null id is the least. The row number tells apart rows that share the id.
    chosen = (F.min if keep == "least" else F.max)(F.struct(F.col("id").isNotNull(), F.col("id"), F.col("row")))
    groups = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), chosen.alias("stays")).where("size > 1")
    # Written first, so that both sides of the join are plain scans and a hot group can be split.
    groups = workspace.stage(groups.select("key", "size", F.col("stays.id").alias("keep_id"), F.col("stays.row").alias("keep_row")), "groups")
    alone = F.col("size").isNull()
    return keys.join(groups, "key", "left").select(
        F.col("id").alias(id),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        *[F.col(f"more_{name}").alias(name) for name in extra],
    )
