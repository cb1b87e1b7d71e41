"""Helpers that several text operators share."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words: space and the control characters 9 to 13.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


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


#: Folders that cut() has written in this process, removed when it ends.
_written: list[tuple[SparkSession, str]] = []


def _remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def drop(*frames: DataFrame) -> None:
    """Remove what cut() wrote for these frames, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            _remove(df.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        with contextlib.suppress(Exception):  # the session may have ended before
            _remove(spark, path)


def cut(df: DataFrame) -> DataFrame:
    """Write df once to the shared folder and read it back: lineage ends there and a lost executor costs no recomputation.

    What is written goes with drop(), or when the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tallyloom-{uuid.uuid4().hex}"
    _written.append((spark, path))
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._cut_path = path
    return back


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
