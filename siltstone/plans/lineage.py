"""Cutting lineage with tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Only a local session without that setting (tests) gets a folder of its own;
    a cluster without it is an error, as its executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), f"siltstone-{os.getpid()}")
    os.makedirs(folder, exist_ok=True)
    return f"file://{folder}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df once as Parquet and return a DataFrame that reads it.

    Unlike a cache it survives the loss of executors, and unlike repeated use of
    a plan it runs Python stages and wide shuffles once.  The table is removed
    at the end of the ``scope`` that it was written in, else when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """Path of a new folder among the materialized tables, removed with them."""
    path = f"{shared_folder(spark).rstrip('/')}/siltstone/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def broadcast_if_small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """df as a broadcast side if it has at most so many rows, checked by running it.

    Beyond that df itself is returned, and the join shuffles both sides.
    """
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(found, df.schema))


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scope() -> Iterator[None]:
    """Tables that are materialized inside are removed at the end, for programs whose results are written by then."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            _remove(*_written.pop())


def sweep(spark: SparkSession, hours: float = 24) -> int:
    """Remove tables older than so many hours, which drivers that were killed left behind; returns their number."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/siltstone")
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return 0
    old = [f.getPath() for f in system.listStatus(root) if f.getModificationTime() < (time.time() - hours * 3600) * 1000]
    for path in old:
        system.delete(path, True)
    return len(old)


@atexit.register
def _clean() -> None:
    while _written:
        try:
            _remove(*_written.pop())
        except Exception:  # the session is gone; sweep removes what remains
            pass
