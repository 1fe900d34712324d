"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from contextlib import suppress
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Blocks have a bounded number of rows; windows keep one in memory instead of sorting it to disk.
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session time zone (bar times are UTC) and keep small window stages parallel.

    Windows cost far more CPU per byte than a scan. Adaptive execution merges shuffle partitions up
    to 1 MB even when cores stay idle; a lower floor only matters for small inputs, large ones still
    merge up to the advisory size.
    """
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let the Python workers of this application import this package, wherever it lies on the driver.

    Spark brings the zipped sources to each executor, as for any dependency given with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="barloom-code-")) / "barloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as package:
        for file in sorted(root.rglob("*.py")):
            package.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if not named:
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return named.rstrip("/")


def for_local_runs(spark: SparkSession) -> SparkSession:
    """Where no shared folder is named and all runs in this machine's one process, take a temporary one."""
    if not spark.conf.get(CHECKPOINT_DIR, None) and re.fullmatch(r"local(\[[^-]*\])?", spark.conf.get("spark.master", "")):
        spark.conf.set(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="barloom-"))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/barloom/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, workspace: Workspace | None = None) -> DataFrame:
    """Write ``df`` once to a workspace (the innermost open one, if none is given) and read it back.

    Used where a result feeds several later passes (selection, scaling, balancing, folds): one
    computation instead of one per pass, and a lost executor re-reads files instead of replaying
    the whole lineage. Without an open workspace there is nobody to remove the files, which is an error.
    """
    return (workspace or Workspace.current(df.sparkSession)).stage(df, label)


class Workspace:
    """A folder in the shared place that one run owns; everything staged in it goes with ``close()``.

    ``with Workspace(spark, "label") as ws`` removes it at the end of the block. A run whose result is
    still to be read from it (a query that returns a DataFrame) leaves it open; ``release(spark)``
    closes every workspace of the session that is still open.
    """

    _open: dict[str, list[Workspace]] = {}

    def __init__(self, spark: SparkSession, label: str, innermost: bool = True):
        self.spark, self.folder = spark, scratch_path(spark, label)
        # Hadoop's file system reaches whatever store the shared folder is in, also after the session has been stopped.
        self._place = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._store = self._place.getFileSystem(spark._jsc.hadoopConfiguration())
        self._app = spark.sparkContext.applicationId
        mine = self._open.setdefault(self._app, [])
        mine.insert(len(mine) if innermost else 0, self)

    @property
    def is_open(self) -> bool:
        return self in self._open.get(self._app, [])

    @classmethod
    def current(cls, spark: SparkSession) -> Workspace:
        """The workspace of this session that was opened last and is still open."""
        mine = cls._open.get(spark.sparkContext.applicationId)
        if not mine:
            raise ValueError("open a Workspace first: staged tables need an owner that removes them")
        return mine[-1]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str, **options: Any) -> DataFrame:
        """Write ``df`` once and read it back; lost executors then re-read files, not the lineage."""
        path = self.path(name)
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        """Remove one table of this folder that nothing reads any more, before the rest goes."""
        if not path.startswith(f"{self.folder}/"):
            raise ValueError(f"{path} is not in {self.folder}")
        self._store.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def close(self) -> None:
        if self.is_open:
            self._open[self._app].remove(self)
            self._store.delete(self._place, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


@atexit.register
def _close_all() -> None:
    """What is still open at the end of the driver program goes with it, if its JVM is there to do so."""
    for mine in Workspace._open.values():
        for workspace in list(mine):
            with suppress(Exception):
                workspace.close()


def open_workspaces(spark: SparkSession) -> list[Workspace]:
    return list(Workspace._open.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, keep: Iterable[Workspace] = ()) -> None:
    """Close the workspaces of this session that are still open, but for those to ``keep``."""
    for workspace in open_workspaces(spark):
        if workspace not in keep:
            workspace.close()
