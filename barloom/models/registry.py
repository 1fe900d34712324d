"""Stored models: where they are, what they were trained on, and which jobs update or train."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.sources.store import table_exists

JOB_KEYS = ("symbol", "interval", "strategy")

REGISTRY_SCHEMA = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in ("kind", *JOB_KEYS, "model_key")],
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("stored_at", T.TimestampType()),
    ]
)


class ModelStore:
    """Models under one folder. A model is there once its note is written, after its parts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, key: str, part: str) -> str:
        return f"{self.root}/{key.replace(' ', '')}/{part}"

    def exists(self, key: str) -> bool:
        return table_exists(self.spark, self.path(key, "note"))

    def save(self, key: str, parts: dict[str, object], note: dict) -> None:
        """Write new versions of the parts, then the note that points at them."""
        version = self.note(key)["version"] + 1 if self.exists(key) else 0
        for name, part in parts.items():
            part.write().overwrite().save(self.path(key, f"v{version}/{name}"))
        text = json.dumps({**note, "version": version, "parts": sorted(parts)})
        self.spark.createDataFrame([(version, text)], "version int, note string").write.mode("append").parquet(
            self.path(key, "note")
        )

    def note(self, key: str) -> dict:
        rows = self.spark.read.schema("version int, note string").parquet(self.path(key, "note"))
        return json.loads(rows.agg(F.max_by("note", "version")).first()[0])

    def save_table(self, key: str, table: DataFrame, keys: Iterable[str]) -> None:
        """Write a new version of a table of models; rows of keys that are not in it are carried over."""
        version, rows = 0, table
        if self.exists(key):
            version = self.note(key)["version"] + 1
            kept = self.table(key).join(table.select(*keys), list(keys), "left_anti")
            rows = table.unionByName(kept)
        rows.write.mode("overwrite").parquet(self.path(key, f"v{version}/table"))
        text = json.dumps({"version": version, "parts": ["table"]})
        self.spark.createDataFrame([(version, text)], "version int, note string").write.mode("append").parquet(
            self.path(key, "note")
        )

    def table(self, key: str) -> DataFrame | None:
        """Newest version of a table of models, or None."""
        if not self.exists(key):
            return None
        return self.spark.read.parquet(self.path(key, f"v{self.note(key)['version']}/table"))

    def report_path(self, label: str) -> str:
        """Where the report of one training run goes."""
        return f"{self.root}/reports/{label}-{uuid.uuid4().hex[:12]}"

    def register(self, models: DataFrame) -> None:
        """Note models (kind, symbol, interval, strategy, model_key, features) as stored; one writer at a time."""
        rows = models.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA.fields if f.name != "stored_at"])
        rows.withColumn("stored_at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/registry")

    def registered(self, kind: str) -> DataFrame:
        """The stored models of a kind, the newest note of each."""
        if not table_exists(self.spark, f"{self.root}/registry"):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        rows = self.spark.read.schema(REGISTRY_SCHEMA).parquet(f"{self.root}/registry").where(F.col("kind") == kind)
        others = [c for c in rows.columns if c not in ("kind", *JOB_KEYS)]
        newest = F.max_by(F.struct(*others), "stored_at").alias("_newest")
        return rows.groupBy("kind", *JOB_KEYS).agg(newest).select("kind", *JOB_KEYS, "_newest.*")

    def load(self, key: str, name: str, reader) -> object:
        return reader.load(self.path(key, f"v{self.note(key)['version']}/{name}"))


def split_jobs(jobs: DataFrame, registered: DataFrame, keys: Iterable[str] = JOB_KEYS) -> tuple[DataFrame, DataFrame]:
    """Jobs whose model is registered (update) and the others (train)."""
    keys = list(keys)
    return jobs.join(registered, keys, "left_semi"), jobs.join(registered, keys, "left_anti")


def run_jobs(
    spark: SparkSession,
    jobs: DataFrame,
    work: Callable[[Row], Mapping | None],
    path: str,
    keys: Iterable[str] = JOB_KEYS,
    results: str = "",
    parallelism: int = 4,
    wave: int = 256,
) -> DataFrame:
    """Run ``work`` for every job and report ``ok`` or the error; one failure does not stop the rest.

    A job is one model to fit: its row names it, its data stays in the cluster. Jobs are drawn from their
    table in waves of bounded size, a wave runs in a thread pool, and its report (the keys, the status and
    what ``work`` returns of the columns ``results``) is appended to the table at ``path`` by this thread
    before the next wave begins. So the driver holds one wave, and no two writers share a folder.
    """
    keys, names = list(keys), T.StructType.fromDDL(results).names if results else []
    schema = ", ".join([*[f"`{k}` string" for k in keys], "status string", *([results] if results else [])])

    def attempt(job: Row) -> tuple:
        found: Mapping = {}
        try:
            found = work(job) or {}
            status = "ok"
        except Exception as error:  # noqa: BLE001 - reported per job
            status = f"{type(error).__name__}: {error}".splitlines()[0]
        return (*[job[k] for k in keys], status, *[found.get(n) for n in names])

    waiting = jobs.select(*jobs.columns).toLocalIterator()
    with ThreadPoolExecutor(parallelism) as pool:
        while taken := list(islice(waiting, wave)):
            done = list(pool.map(inheritable_thread_target(spark)(attempt), taken))
            spark.createDataFrame(done, schema).write.mode("append").parquet(path)
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)
