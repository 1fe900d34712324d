"""ARIMA order search and unit-root test over all series at once.

Least squares on lagged values needs sums of products only. One pass over the bars makes them for every
series; what is solved per series is a matrix of fixed size, however long the series.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import kernels
from barloom.operators import indicators as ind
from barloom.operators.blocks import BLOCK_BARS, INDEX, KEYS, TIME, join_per_series, with_bar_index
from barloom.operators.evaluate import best_of
from barloom.session import stage
from barloom.sources.bars import scaled_prices

# Orders tried, order of the autoregression that estimates shocks, lags tried by the unit-root
# test, its 5 % point with a constant.
LARGEST_ORDER = 5
LONG_ORDER = 12
LAGS = 18
UNIT_ROOT_LIMIT = -2.86
SIZE = LAGS + 3  # entries of v in lagged_sums


def unit_root(bars: DataFrame, column: str = "close", block_bars: int = BLOCK_BARS) -> DataFrame:
    """Dickey-Fuller statistic without added lags, and the differencing ``d`` it asks for.

    A regression on one variable is a set of sums, so this is one aggregation per series.
    """
    steps = [ind.Step("_before", lambda rows: rows.lag(column), (column,), 1)]
    lagged = ind.apply_steps(bars, steps, ["_before"], block_bars).where(F.col("_before").isNotNull())
    change = F.col(column) - F.col("_before")
    sums = lagged.groupBy(*KEYS).agg(
        F.regr_count(change, F.col("_before")).alias("n"),
        F.regr_sxx(change, F.col("_before")).alias("sxx"),
        F.regr_sxy(change, F.col("_before")).alias("sxy"),
        F.regr_syy(change, F.col("_before")).alias("syy"),
    )
    slope = F.try_divide("sxy", "sxx")
    rest = F.col("syy") - F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx"))
    error = F.sqrt(F.try_divide(F.try_divide(rest, F.col("n") - 2), F.col("sxx")))
    tau = F.when((F.col("sxx") > 0) & (F.col("n") > 2) & (rest > 0), F.try_divide(slope, error))
    return with_differencing(sums.select(*KEYS, tau.alias("tau")))


def with_differencing(tests: DataFrame) -> DataFrame:
    return tests.withColumn("d", F.when(F.col("tau").isNull() | (F.col("tau") > UNIT_ROOT_LIMIT), 1).otherwise(0))


def lagged_sums(bars: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """All that a series' models need, over the whole series and of bounded size; one pass over the bars.

    Of each bar with enough bars before it, take v = (1, the price before, its change, the ``LAGS`` changes before).
    ``sums`` is the sum of v v' over those ``rows`` (row by row), to which every regression on lagged prices,
    changes or shocks reduces. ``head`` and ``tail`` are the first and last prices, from which the rows at a
    seam between two stretches of a series can be made. Prices are scaled and reduced by ``center``, the mean of
    the series or what ``stored`` has. Bars whose v lacks a price are left out.
    """
    scaled = scaled_prices(bars)
    center = scaled.groupBy(*KEYS).agg(F.avg("scaled_close").alias("center"))
    if stored is not None:
        known = stored.select(*KEYS, F.col("center").alias("_known"))
        center = center.join(known, list(KEYS), "left").select(*KEYS, F.coalesce("_known", "center").alias("center"))
    values = join_per_series(scaled, center).withColumn("_x", F.col("scaled_close") - F.col("center"))
    values = stage(with_bar_index(values).select(*KEYS, TIME, INDEX, "_x"), "prices")
    steps = [
        ind.Step("_before", lambda rows: rows.lag("_x"), ("_x",), 1),
        ind.Step("_change", lambda rows: F.col("_x") - F.col("_before"), ("_x", "_before")),
        *[ind.Step(f"_lag{i}", lambda rows, i=i: rows.lag("_change", i), ("_change",), i) for i in range(1, LAGS + 1)],
    ]
    parts = ["_before", "_change", *[f"_lag{i}" for i in range(1, LAGS + 1)]]
    lagged = ind.apply_steps(values, steps, parts).na.drop("any", subset=parts)
    vectors = lagged.select(*KEYS, F.array(F.lit(1.0), *[F.col(c) for c in parts]).alias("v"))
    schema = T.StructType([bars.schema[k] for k in KEYS]).add("rows", T.LongType()).add("sums", T.ArrayType(T.DoubleType()))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return kernels.partial_products(batches, SIZE)

    entries = vectors.mapInArrow(partial, schema).select(*KEYS, "rows", F.posexplode("sums").alias("place", "value"))
    summed = entries.groupBy(*KEYS, "place").agg(F.sum("value").alias("value"), F.sum("rows").alias("rows"))
    whole = summed.groupBy(*KEYS).agg(
        F.max("rows").alias("rows"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda e: e["value"]).alias("sums"),
    )
    zeros = F.array_repeat(F.lit(0.0), SIZE * SIZE)
    return (
        center.join(_ends(values), list(KEYS), "left")
        .join(whole, list(KEYS), "left")
        .withColumns({"rows": F.coalesce("rows", F.lit(0).cast("long")), "sums": F.coalesce("sums", zeros)})
    )


def _ends(values: DataFrame) -> DataFrame:
    """First and last LAGS + 1 prices of every series, in order."""

    def of(order: Column, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*KEYS).orderBy(order))
        few = values.select(*KEYS, INDEX, "_x", place.alias("_place")).where(F.col("_place") <= LAGS + 1)
        ordered = F.array_sort(F.collect_list(F.struct(INDEX, "_x")))
        return few.groupBy(*KEYS).agg(F.transform(ordered, lambda e: e["_x"]).alias(name))

    return of(F.col(INDEX).asc(), "head").join(of(F.col(INDEX).desc(), "tail"), list(KEYS))


def augmented_unit_root(sums: DataFrame) -> DataFrame:
    """Dickey-Fuller statistic with as many lags, up to ``LAGS``, as the Akaike criterion likes best."""
    schema = T.StructType([sums.schema[k] for k in KEYS]).add("tau", T.DoubleType())

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield kernels.dickey_fuller_batch(batch, SIZE)[schema.names]

    return with_differencing(sums.select(*KEYS, "rows", "sums").mapInPandas(test, schema))


def candidate_orders(series: DataFrame) -> DataFrame:
    """Every (p, q) up to the largest order, for every series."""
    orders = F.sequence(F.lit(0), F.lit(LARGEST_ORDER))
    return series.withColumn("p", F.explode(orders)).withColumn("q", F.explode(orders))


def order_criteria(sums: DataFrame, tests: DataFrame | None = None) -> DataFrame:
    """Akaike criterion of every candidate order of every series."""
    tests = augmented_unit_root(sums) if tests is None else tests
    return _criteria(candidate_orders(sums.join(tests.select(*KEYS, "d"), list(KEYS))))


def _criteria(orders: DataFrame) -> DataFrame:
    schema = T.StructType([orders.schema[k] for k in KEYS])
    for name in ("p", "d", "q"):
        schema = schema.add(name, T.IntegerType())
    schema = schema.add("aic", T.DoubleType())

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield kernels.arima_criteria(batch, SIZE, LONG_ORDER)[schema.names]

    return orders.select(*KEYS, "p", "d", "q", "rows", "sums").mapInPandas(fit, schema)


def best_orders(criteria: DataFrame) -> DataFrame:
    """Order of the lowest criterion; the first in (p, q) order wins a tie. A series without any fit gets nulls."""
    ranked = criteria.withColumn("_order", F.col("p") * (LARGEST_ORDER + 1) + F.col("q"))
    return best_of(ranked, -F.col("aic"), "_order", ["p", "d", "q", "aic"])


def require_orders(orders: DataFrame) -> DataFrame:
    problem = F.raise_error(F.concat(F.lit("no order fits "), F.concat_ws("_", *KEYS)))
    return orders.withColumn("aic", F.when(F.col("aic").isNull(), problem.cast("double")).otherwise(F.col("aic")))


MODEL = (*KEYS, "p", "d", "q", "aic", "center", "rows", "sums", "tail")


def fitted(orders: DataFrame, sums: DataFrame) -> DataFrame:
    """Models of new series: their order and the sums that a later stretch is added to."""
    return orders.join(sums, list(KEYS)).select(*MODEL)


def extended(stored: DataFrame, sums: DataFrame) -> DataFrame:
    """Stored models whose series goes on with the stretch of ``sums``: both sums and the rows at the seam."""
    old = stored.select(*KEYS, "p", "d", "q", "center", *[F.col(c).alias(f"_old_{c}") for c in ("rows", "sums", "tail")])
    both = sums.drop("center").join(old, list(KEYS))
    schema = T.StructType([stored.schema[c] for c in MODEL if c != "aic"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield kernels.joined_products(batch, SIZE)[schema.names]

    return both.mapInPandas(add, schema)


def refit(extended_sums: DataFrame) -> DataFrame:
    """Models with the criterion of their stored order on all that they have seen."""
    found = _criteria(extended_sums).select(*KEYS, "aic")
    return extended_sums.join(found, list(KEYS)).select(*MODEL)
