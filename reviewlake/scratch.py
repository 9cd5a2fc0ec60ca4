"""Intermediate results that outlive the executors that made them.

They are Parquet tables below the folder named by ``spark.checkpoint.dir``. A
written table cuts the lineage, survives the loss of an executor, keeps column
pruning for its readers and gives the optimizer a real size to plan with. Results may
read them for as long as the session lives; then they are deleted.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    A session without that setting uses its warehouse folder, which is shared too.
    If that is on a local disk, only a session on one machine may use it.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if urlsplit(base).scheme in ("", "file") and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = f"{base.rstrip('/')}/reviewlake-{context.applicationId}"
    _delete_at_exit(spark, own)
    return f"{own}/run-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Deletes a folder, if it is there, in whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Has the file system delete the application's folder when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)


#: The folders written within each open scope, innermost last.
_scopes: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Deletes what ``materialize`` wrote within it, but for what the frames given to it read.

    Also has Spark look for shuffle files that nothing refers to any more. ``None`` is no frame.
    """
    made: list[str] = []
    kept: set[str] = set()

    def keep(*frames: DataFrame | None) -> None:
        for df in frames:
            files = df.inputFiles() if df is not None else []
            kept.update(part for file in files for part in file.split("/") if part.startswith("run-"))

    _scopes.append(made)
    try:
        yield keep
    finally:
        _scopes.pop()
        for folder in made:
            if folder.rsplit("/", 1)[1] not in kept:
                delete_folder(spark, folder)
            elif _scopes:
                _scopes[-1].append(folder)
        gc.collect()
        spark._jvm.System.gc()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back as a plain table scan."""
    return materialize_counted(df)[0]


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``materialize``, and the number of rows, counted as they are written."""
    path = scratch_dir(df.sparkSession)
    if _scopes:
        _scopes[-1].append(path)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), counted.get["rows"]

