"""Files by URI on any file system that PyArrow knows (local, HDFS, S3, GCS), on the driver and in tasks."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

FILES_PER_TASK = 64

# Schemes of Hadoop's connectors and what PyArrow calls them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "viewfs": "viewfs"}


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path in it of a URI or a plain local path."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def kind(path: str) -> fs.FileType:
    system, inner = located(path)
    return system.get_file_info(inner).type


def exists(path: str) -> bool:
    return kind(path) != fs.FileType.NotFound


def below(root: str) -> list[str]:
    """Paths, relative to root, of all files at any depth; ValueError if root is no folder."""
    return list(sizes(root))


def sizes(root: str) -> dict[str, int]:
    """Bytes of each file below root by its relative path."""
    system, inner = located(root)
    if system.get_file_info(inner).type != fs.FileType.Directory:
        raise ValueError(f"no folder: {root}")
    found = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return {posixpath.relpath(f.path, inner): f.size for f in found if f.type == fs.FileType.File}


def read_text(path: str) -> str | None:
    """A small file's content, None if there is none."""
    system, inner = located(path)
    try:
        with system.open_input_stream(inner) as f:
            return f.read().decode("utf-8")
    except OSError:
        return None


def write_text(path: str, content: str) -> None:
    """A small file, written aside and renamed, so that it appears whole."""
    system, inner = located(path)
    if posixpath.dirname(inner):
        system.create_dir(posixpath.dirname(inner), recursive=True)
    with system.open_output_stream(f"{inner}.part") as f:
        f.write(content.encode("utf-8"))
    system.move(f"{inner}.part", inner)


def make_folder(path: str) -> None:
    system, inner = located(path)
    system.create_dir(inner, recursive=True)


def separate(source: str, target: str) -> None:
    """ValueError if target is source or lies below it, on any file system."""
    system, a = located(source)
    other, b = located(target)
    if type(system) is not type(other):
        return
    if isinstance(system, fs.LocalFileSystem):
        import os

        a, b = os.path.realpath(a), os.path.realpath(b)
    if posixpath.commonpath([posixpath.join("/", a), posixpath.join("/", b)]) == posixpath.normpath(posixpath.join("/", a)):
        raise ValueError("the output must lie outside of the input")


def by_file(spark: SparkSession, paths: Sequence[str], schema: str, function: Callable[[str], list[dict]]) -> DataFrame:
    """The rows that a function makes of each path, FILES_PER_TASK or fewer paths a task."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([[r[n] for n in names] for p in batch["path"] for r in function(p)], columns=names, dtype=object)

    return path_table(spark, paths).mapInPandas(run, schema)


def path_table(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    tasks = max(1, min(len(paths), max(spark.sparkContext.defaultParallelism, -(-len(paths) // FILES_PER_TASK))))
    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
