"""Tables written once to the folder all executors share.

A staged table cuts lineage: a lost executor costs a re-read, never a recomputation, and row
positions fixed at write time stay fixed for every later reader.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}

# Removes the shuffle files of a job when it ends, instead of when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _writers, _before = threading.Lock(), 0, "false"


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="marginalia-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/marginalia/{app}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside leave no shuffle files behind; fits side by side share the setting."""
    global _writers, _before
    with _writing:
        if not _writers:
            _before = spark.conf.get(CLEANUP, "false")
            spark.conf.set(CLEANUP, "true")
        _writers += 1
    try:
        yield
    finally:
        with _writing:
            _writers -= 1
            if not _writers:
                spark.conf.set(CLEANUP, _before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and return the table read back.

    Readers go to the files, so the write's own shuffles are of no more use and are removed.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write
    if partition_by:
        # Rebalancing splits a hot partition value over several files and merges tiny ones.
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a staged ``table`` whose last reader has written its result.

    Only folders that ``stage`` made are deleted, and frames that read from it cannot be used any
    more. A table without files is left for ``release``.
    """
    spark = table.sparkSession
    home = f"/marginalia/{spark.sparkContext.applicationId}/"
    for folder in {file.split(home, 1)[1].split("/", 1)[0] for file in table.inputFiles() if home in file}:
        _delete(spark, f"{shared_root(spark)}{home}{folder}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written to a ``new_path`` by other means than ``stage``."""
    _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete every table this application has staged, for when it ends.

    Only the application's own folder goes; frames that read from it cannot be used any more.
    """
    _delete(spark, f"{shared_root(spark)}/marginalia/{spark.sparkContext.applicationId}")
