"""Parquet files whose schemas differ, row counts and single rows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import PROJECTION, project
from ..operators.shuffling import Hash, xx
from . import storage


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[list[str]]:
    """Paths grouped by equal schema; footers are read in parallel."""
    groups = footers(spark, paths).groupBy("schema").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [r["paths"] for r in groups.orderBy(F.col("paths")[0]).collect()]  # the given paths, one row a schema


def footers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, rows, row_groups, schema, created_by) from the footers alone."""

    def read(path: str) -> list[dict]:
        import pyarrow.parquet as pq

        system, inner = storage.located(path)
        meta = pq.read_metadata(inner, filesystem=system)
        schema = str(meta.schema.to_arrow_schema().remove_metadata())
        return [{"path": path, "rows": meta.num_rows, "row_groups": meta.num_row_groups, "schema": schema, "created_by": meta.created_by}]

    return storage.by_file(spark, paths, "path string, rows bigint, row_groups int, schema string, created_by string", read)


def union_projected(frames: Sequence[DataFrame], wanted: Mapping[str, str] = PROJECTION) -> DataFrame:
    """UNION ALL of frames of different schemas, each projected to the wanted typed columns."""
    return reduce(DataFrame.unionByName, [project(f, wanted) for f in frames])


def read_projected(spark: SparkSession, paths: Sequence[str], wanted: Mapping[str, str] = PROJECTION) -> DataFrame:
    """All files as one frame of the wanted columns, planned as one scan per distinct schema."""
    return union_projected([spark.read.parquet(*group) for group in schema_groups(spark, paths)], wanted)


def cast_to(df: DataFrame, like: DataFrame) -> DataFrame:
    """df with the columns, order and types of `like`; missing columns are typed nulls, others dropped."""
    cells = []
    for f in like.schema.fields:
        value = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)
        cells.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cells)


def count(spark: SparkSession, path: str) -> int:
    """Rows of a file or folder; no column is read."""
    return spark.read.option("recursiveFileLookup", True).parquet(path).count()


def count_by_folder(spark: SparkSession, root: str) -> DataFrame:
    """(category, n) for each folder directly below root that holds Parquet files at any depth."""
    rows = spark.read.option("recursiveFileLookup", True).parquet(root).select(F.col("_metadata.file_path").alias("p"))
    inside = F.substring_index(F.col("p"), root.rstrip("/") + "/", -1)
    return rows.filter(F.contains(inside, F.lit("/"))).groupBy(F.split(inside, "/")[0].alias("category")).agg(F.count("*").alias("n"))


def with_row_number(df: DataFrame) -> DataFrame:
    """df with each row's place in its file, ``file`` and ``line_number`` (from 0)."""
    return df.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line_number"))


def row_at(df: DataFrame, index: int) -> Row:
    """The row of a zero-based index of one file; ValueError if there is none."""
    if index < 0:
        raise ValueError("the index must be 0 or more")
    rows = with_row_number(df).filter(F.col("line_number") == index).limit(1).collect()
    if not rows:
        raise ValueError(f"index {index} is out of range")
    return rows[0]


def head(df: DataFrame, rows: int = 2_000) -> DataFrame:
    """The first rows of a file in file order."""
    return with_row_number(df).filter(F.col("line_number") < rows)


def sample_group(spark: SparkSession, path: str, seed: int = 0, rows: int = 2_000) -> DataFrame:
    """The first rows of one row group of a file, chosen by seed, with their places in the file."""
    import pyarrow.parquet as pq

    system, inner = storage.located(path)
    meta = pq.read_metadata(inner, filesystem=system)
    sizes = [meta.row_group(g).num_rows for g in range(meta.num_row_groups)]
    group = min(range(len(sizes)), key=lambda g: hashlib.md5(f"{seed}:{g}".encode()).hexdigest(), default=0)
    start = sum(sizes[:group])
    size = min(rows, sizes[group]) if sizes else 0
    numbered = with_row_number(spark.read.parquet(path))
    return numbered.filter((F.col("line_number") >= start) & (F.col("line_number") < start + size))


def write_npy(df: DataFrame, column: str, folder: str) -> None:
    """One ``part-NNNNN.npy`` per non-empty partition with a column's values, in a folder that all executors share."""

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        import numpy as np
        from pyspark import TaskContext

        values = [v for b in batches for v in b[column]]
        if values:
            content = io.BytesIO()
            np.save(content, np.array(values))
            path = f"{folder}/part-{TaskContext.get().partitionId():05d}.npy"
            system, inner = storage.located(path)
            with system.open_output_stream(f"{inner}.tmp") as f:
                f.write(content.getbuffer())
            system.move(f"{inner}.tmp", inner)
        yield pd.DataFrame({"n": [len(values)]})

    storage.make_folder(folder)
    df.select(column).mapInPandas(save, "n bigint").agg(F.sum("n")).collect()  # one number


def sample_one(df: DataFrame, key: str, seed: int = 0, hashed: Hash = xx) -> DataFrame:
    """One row, uniform over rows and the same for any partitioning: the least hash of seed and key."""
    return df.orderBy(hashed(seed, "sample", F.col(f"`{key}`")), F.col(f"`{key}`")).limit(1)
