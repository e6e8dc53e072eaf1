"""Incremental annotation: only files that a checkpoint has not seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def new_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl*", files_per_batch: int = 1000) -> DataFrame:
    """Stream of (file, line) of the files of a folder, each file once."""
    lines = (
        spark.readStream.option("lineSep", "\n").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch).text(folder)
    )
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def process_new(lines: DataFrame, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Append the transformed new files to a Parquet table and stop.

    Files are marked in the checkpoint, so a file whose result was deleted isn't
    done again; ``operators.resume.pending`` looks at the results instead.
    """
    query = (
        transform(lines).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .option("compression", "zstd").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
