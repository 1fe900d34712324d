"""Mixing sources to target weights by Poisson replication, in DataFrame operations.

A document of a source whose repetition rate is r is copied as often as a Poisson variable of mean r says.
The variable is found by inversion from a hash of the document's id and a seed, so every document decides
alone, and the expected bytes of a source are exactly its target. Rates over ``SPLIT`` are sums of several
independent draws. The copies then get a hash order and one exchange puts them in it globally.

Sources are one row each after partial aggregation. That table is joined by broadcast when it has at most
``MOST_BROADCAST`` rows, and by a salted join beyond.

Defined cases: a null source is the source "". Rows of equal id get equal counts. A null text has no bytes.
Very long texts are moved whole and only their size is read. Rows that repeat are told apart by their copy's number only,
so they can tie in the order. A document without a target weight is left out (weight 0). An empty table gives no rows. Input columns
named like the result's are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import prepared, text_bytes

SPLIT, TERMS = 16, 96
MOST_BROADCAST, SALTS = 10_000, 64
MOST_PARTS = 20_000
ORDER_SPACE = 1 << 60


def _digits(label: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(label), 1, digits), 16, 10).cast("long")


def uniform(label: Column) -> Column:
    """A number from 0 up to 1 that the label alone decides."""
    return _digits(label, 13) / F.lit(float(1 << 52))


def source_rates(documents: DataFrame, alpha: float = 0.7, source: str = "source", weights: dict[str, float] | None = None) -> DataFrame:
    """Of each source: mix_source, bytes, rate, draws and the cumulative distribution of one draw.

    Targets sum to the bytes of the whole input. A source's share is its weight in ``weights``, or else its
    own bytes to the power ``alpha``: below 1, small sources are repeated and large ones thinned out.
    """
    key = F.coalesce(F.col(source).cast("string"), F.lit(""))
    sizes = documents.groupBy(key.alias("mix_source")).agg(F.sum(text_bytes() + 1).cast("double").alias("bytes"))
    if weights is None:
        weight = F.pow("bytes", F.lit(alpha))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        weight = F.coalesce(F.element_at(F.create_map(*pairs), F.col("mix_source")), F.lit(0.0)) if pairs else F.lit(0.0)
    weighted = sizes.withColumn("weight", weight)
    total = weighted.agg(F.sum("bytes").alias("b"), F.sum("weight").alias("w")).first()
    share = F.col("weight") / F.lit(total["w"] or 1.0)
    rate = share * F.lit(total["b"] or 0.0) / F.col("bytes")
    draws = F.greatest(F.ceil(F.col("rate") / SPLIT), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("draws")
    first = F.exp(-mean)
    table = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(first.alias("p"), F.array(first).alias("c")),
        lambda s, k: F.struct(
            (s["p"] * mean / k).alias("p"),
            F.concat(s["c"], F.array(F.element_at(s["c"], -1) + s["p"] * mean / k)).alias("c"),
        ),
        lambda s: s["c"],
    )
    return weighted.withColumn("rate", rate).withColumn("draws", draws).withColumn("cdf", table).select("mix_source", "bytes", "rate", "draws", "cdf")


def _label(id_column: str, seed: int) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(str(seed)))


def hash_order(copy: Column, seed: int = 17, id_column: str = "doc_id") -> Column:
    """Place in a global shuffle of what tells the copies of a document apart."""
    return _digits(F.concat_ws(":", _label(id_column, seed), F.lit("order"), copy.cast("string")), 15)


def mixed(
    documents: DataFrame, rates: DataFrame | None = None, seed: int = 17, source: str = "source", id_column: str = "doc_id", part_bytes: int = 32 << 20, **options
) -> DataFrame:
    """The documents' columns with copy (from 1), copies and mix_order; one row for each copy, in global hash order.

    A task sorts about ``part_bytes`` of text in memory and writes them; a Parquet file of them is then read by row groups, so
    large parts cost memory twice. Beyond ``MOST_PARTS`` parts, parts grow instead.
    """
    spark = prepared(documents.sparkSession)
    rates = source_rates(documents, source=source, **options) if rates is None else rates
    facts = rates.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bytes") * F.col("rate")).alias("b")).first()
    rows = documents.drop("copy", "copies", "mix_order")
    own = rows.columns
    label = _label(id_column, seed)
    keyed = rows.withColumn("mix_source", F.coalesce(F.col(source).cast("string"), F.lit("")))
    if facts["n"] <= MOST_BROADCAST:
        joined = keyed.join(F.broadcast(rates), "mix_source")
    else:
        salted = rates.withColumn("mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("mix_salt", F.pmod(F.xxhash64(label), F.lit(SALTS)).cast("int")).join(salted, ["mix_source", "mix_salt"])

    def draw(number: Column) -> Column:
        u = uniform(F.concat_ws(":", label, number.cast("string")))
        return F.size(F.filter("cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("draws")), F.lit(0), lambda s, k: s + draw(k))
    counted = joined.withColumn("copies", copies).where((F.col("copies") > 0) & (F.col("rate") > 0))
    copied = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = hash_order(F.col("copy"), seed, id_column)
    total = int(facts["b"] or 0)
    parts = max(1, total // max(part_bytes, total // MOST_PARTS) + 1, spark.sparkContext.defaultParallelism)
    placed = copied.select(*own, "copy", "copies", order.alias("mix_order"))
    part = F.expr(f"int(mix_order div {-(-ORDER_SPACE // parts)})")
    return placed.repartitionById(parts, part).sortWithinPartitions("mix_order", id_column)
