"""Inputs of the registered queries, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import Workspace, prepare
from barloom.sources.bars import bars_from_ticks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def symbol_of(event_type):
    market = F.when(event_type == "signup", "SPOT_").otherwise("PERP_")
    return F.concat(market, F.upper(event_type), F.lit("_USDC"))


def ticks_of(events: DataFrame) -> DataFrame:
    return events.select(
        symbol_of(F.col("event_type")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("amount"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


_STORED: dict[tuple[str, str], tuple[Workspace, DataFrame]] = {}


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars table: all four sizes over all ticks, written once per session as an ingest would.

    Operators read stored bars, so their plans start at a scan of that table.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED or not _STORED[key][0].is_open:
        # Below the query's own workspace, which must stay the innermost one.
        workspace = Workspace(spark, "stored-bars", innermost=False)
        _STORED[key] = workspace, workspace.stage(bars_from_ticks(ticks(spark, sf_dir)), "bars")
    return _STORED[key][1]
