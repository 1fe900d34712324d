"""The stored bars: idempotent append and metrics rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.blocks import TIME
from barloom.sources.bars import BARS_SCHEMA

BAR_KEYS = ("symbol", "interval", TIME)

METRICS_SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in ("asset", "interval", "strategy")],
        *[T.StructField(name, T.DoubleType()) for name in ("accuracy", "precision", "recall", "f1_score", "roc_auc")],
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def with_time(bars: DataFrame) -> DataFrame:
    return bars.where(F.col(TIME).isNotNull())


def unseen(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Bars of the batch whose (symbol, interval, time) is not stored yet.

    The stored side is first reduced to the keys of the batch. A small batch is then the broadcast
    side and prunes the stored folders; the anti join only meets what was found.
    """
    asked = batch.select(*BAR_KEYS)
    found = stored.select(*BAR_KEYS).join(asked, list(BAR_KEYS), "left_semi")
    return batch.join(found, list(BAR_KEYS), "left_anti")


def first_of_each(batch: DataFrame, arrival: str = "arrival") -> DataFrame:
    """One bar per key: the one that arrived first, or the one of least values where nothing tells the order.

    Copies collapse before the shuffle: this is an aggregate.
    """
    values = [c for c in batch.columns if c not in (*BAR_KEYS, arrival)]
    whole = F.struct(*values)
    order = F.struct(F.col(arrival), *values) if arrival in batch.columns else whole
    return batch.groupBy(*BAR_KEYS).agg(F.min_by(whole, order).alias("_first")).select(*BAR_KEYS, "_first.*").select(*[c for c in batch.columns if c != arrival])


def merged(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored bars after an append: the old ones and the unseen ones, each once, none without a time."""
    return with_time(stored.unionByName(unseen(first_of_each(batch), stored)))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the folder holds a finished write."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(hadoop_path) and len(files.listStatus(hadoop_path)) > 0


def append_bars(batch: DataFrame, path: str) -> None:
    """Add unseen bars, one folder per (interval, symbol), files sorted by time.

    Of copies in the batch the first stays (see ``first_of_each``). Running it twice with the same batch adds
    nothing the second time, so a retried batch is safe.
    """
    spark = batch.sparkSession
    arrival = [c for c in ("arrival",) if c in batch.columns]
    fresh = first_of_each(with_time(batch.select(*BARS_SCHEMA.names, *arrival)))
    if table_exists(spark, path):
        fresh = unseen(fresh, spark.read.schema(BARS_SCHEMA).parquet(path))
    # Months spread a large first load of one series over many tasks and files.
    spread = fresh.repartition("interval", "symbol", F.trunc(F.col(TIME).cast("date"), "month"))
    (
        spread.sortWithinPartitions("interval", "symbol", TIME)
        .write.mode("append")
        .partitionBy("interval", "symbol")
        .parquet(path)
    )


def append_metrics(metrics: DataFrame, path: str, replace: bool = False) -> None:
    """Add metrics rows; ``replace`` keeps only the newest write."""
    rows = metrics.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in METRICS_SCHEMA.fields])
    rows.write.mode("overwrite" if replace else "append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).parquet(path)
