"""Intermediate tables in the cluster's shared folder.

A materialised step cuts lineage, survives the loss of executors, and gives
Catalyst real file sizes: a derived dimension is then broadcast only when its
files are under ``spark.sql.autoBroadcastJoinThreshold``, and sort-merge joined
(with AQE skew splitting) when they are not. No broadcast hint is used anywhere.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lendwatch-")
        context.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lendwatch/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The path's own file system, as Spark sees it, and the path for it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where it does not exist."""
    system, folder = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    system, folder = _file_system(spark, path)
    return system.getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.delete(folder, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder whose target must not exist."""
    system, folder = _file_system(spark, source)
    _, there = _file_system(spark, target)
    if system.exists(there):
        raise FileExistsError(target)
    system.mkdirs(there.getParent())
    if not system.rename(folder, there):
        raise OSError(f"{source} could not be moved to {target}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run within go when it ends, not when the driver next collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def drop_intermediates(spark: SparkSession) -> bool:
    """Delete every intermediate this application wrote; without a shared folder there is none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and spark.sparkContext.applicationId not in _local_roots:
        return False
    return remove(spark, f"{shared_folder(spark)}/lendwatch/{spark.sparkContext.applicationId}")
