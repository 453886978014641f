"""Folders for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share.

    Without the setting, a session whose executor is the driver's own process
    gets a temporary folder, which goes with the process.
    """
    named = spark.conf.get(SETTING, None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
    return _local_folder()


def _store(spark: SparkSession, path: str) -> tuple:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark can reach."""
    files, place = _store(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    files, place = _store(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    files, place = _store(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder that this library wrote another place in the same store."""
    files, place = _store(spark, path)
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    files.mkdirs(to.getParent())
    if not files.rename(place, to):
        raise OSError(f"{path} could not be moved to {target}")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/tidemark/{purpose}-{uuid.uuid4().hex}"
