"""Shared folders and file-system checks that work on a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only on a local master."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    if context.applicationId not in _own:
        folder = tempfile.mkdtemp(prefix="gridtide-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own[context.applicationId] = folder
    return _own[context.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/gridtide-{label}-{uuid.uuid4().hex}"


def _handle(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _handle(spark, path)
    return files.exists(location)


def make_dir(spark: SparkSession, path: str) -> None:
    files, location = _handle(spark, path)
    files.mkdirs(location)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a file or folder in the place of another; a source that is gone was moved before."""
    files, origin = _handle(spark, source)
    if not files.exists(origin):
        return
    _, goal = _handle(spark, target)
    files.delete(goal, True)
    files.mkdirs(goal.getParent())
    if not files.rename(origin, goal):
        raise OSError(f"could not move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    files, location = _handle(spark, path)
    files.delete(location, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when it does not exist."""
    files, location = _handle(spark, path)
    if not files.exists(location):
        return []
    return sorted(entry.getPath().getName() for entry in files.listStatus(location))


def modified(spark: SparkSession, path: str) -> datetime:
    files, location = _handle(spark, path)
    return datetime.fromtimestamp(files.getFileStatus(location).getModificationTime() / 1000, timezone.utc)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written in one go."""
    files, location = _handle(spark, path)
    stream = files.create(location, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None when there is none."""
    files, location = _handle(spark, path)
    if not files.exists(location):
        return None
    stream = files.open(location)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
