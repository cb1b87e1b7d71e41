"""Folders for what is written on the way: seen by every executor, removed when the driver's process ends."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor sees, from spark.checkpoint.dir.

    Where that is unset, a local session gets a temporary folder of its own; on a cluster it is an error, as executors
    wouldn't see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


_made: list[tuple[SparkSession, str]] = []


def fresh(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/tallyloom-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    _made[:] = [x for x in _made if x[1] != path]


@atexit.register
def _clean() -> None:
    for spark, path in list(_made):
        with contextlib.suppress(Exception):  # the session may have ended before
            remove(spark, path)
