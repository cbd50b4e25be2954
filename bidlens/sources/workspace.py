"""Shared folders for checkpoints and intermediate tables, and path helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without it and gets a temporary folder; on a
    cluster every executor must see the folder, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="bidlens-")
    return _local_roots[context.applicationId]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unique folder path below the checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """A new shared folder path whose content is deleted at the end of the block."""
    home = work_dir(spark, label)
    try:
        yield home
    finally:
        drop_path(spark, home)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, write to the checkpoint folder and forget the lineage."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder that must not exist yet."""
    fs, p = _file_system(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    fs.mkdirs(p)


def put_marker(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.create(p, True).close()


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all it holds; false if it was not there."""
    fs, p = _file_system(spark, path)
    return fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below ``path``; none if it is missing."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p))
