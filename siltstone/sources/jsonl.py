"""JSON Lines in and out.

Files are read as text and parsed explicitly, since Spark's JSON source skips
blank lines, turns broken ones to nulls and splits at lone carriage returns.
Plain and gzip files are told apart by extension.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import json_line
from ..operators.joins import spread_join
from ..plans.lineage import materialize


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line) for every line, blank ones included; only a line feed ends a line."""
    lines = spark.read.option("lineSep", "\n").text(paths)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def is_object(value: Column) -> Column:
    """Whether a line is a JSON object; false for null and blank ones."""
    return F.coalesce(F.try_parse_json(value).isNotNull() & F.ltrim(value).startswith("{"), F.lit(False))


def strict(lines: DataFrame, column: str = "line") -> DataFrame:
    """lines with ``record`` (VARIANT); a blank, malformed or non-object line is an error."""
    value = F.col(f"`{column}`")
    wrong = F.raise_error(F.concat(F.lit("malformed JSON line: "), F.substring(F.coalesce(value, F.lit("null")), 1, 200)))
    good = F.try_parse_json(value).isNotNull() & F.ltrim(value).startswith("{")
    return lines.withColumn("record", F.parse_json(F.when(good, value).otherwise(wrong.cast("string"))))


def lenient(lines: DataFrame, column: str = "line") -> DataFrame:
    """lines with ``record``; lines that are no valid JSON objects are left out."""
    value = F.col(f"`{column}`")
    return lines.withColumn("record", F.try_parse_json(value)).filter(F.col("record").isNotNull() & F.ltrim(value).startswith("{"))


def with_schema(lines: DataFrame, schema: T.StructType | str, column: str = "line", strictly: bool = True) -> DataFrame:
    """Columns of a schema parsed from each line, FAILFAST or with bad lines left out."""
    if strictly:
        value = F.col(f"`{column}`")
        value = F.when(F.length(F.trim(value)) > 0, value).otherwise(F.raise_error(F.lit("blank JSON line")).cast("string"))
        parsed = lines.withColumn("_r", F.from_json(value, schema, {"mode": "FAILFAST"}))
        return parsed.select("_r.*")
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    wide = T.StructType([*kind.fields, T.StructField("_broken", T.StringType())])
    parsed = lines.withColumn("_r", F.from_json(F.col(f"`{column}`"), wide, {"columnNameOfCorruptRecord": "_broken"}))
    good = F.col("_r").isNotNull() & F.col("_r._broken").isNull() & (F.length(F.trim(F.col(f"`{column}`"))) > 0)
    return parsed.filter(good).select(*[F.col("_r")[n].alias(n) for n in kind.names])


def infer(lines: DataFrame, column: str = "line") -> str:
    """DDL of the merged schema of all valid lines, found in one aggregation."""
    shape = lenient(lines, column).agg(F.schema_of_variant_agg("record").alias("s")).first()["s"]  # one row
    return shape.replace("OBJECT<", "STRUCT<") if shape else "STRUCT<>"


def numbered(lines: DataFrame, file: str = "file") -> DataFrame:
    """lines of small files with ``line_number`` from 0 in file order, each file by one task.

    For files that are read in one split; ``numbered_files`` reads files of any size.
    """
    order = F.monotonically_increasing_id()
    tagged = lines.withColumn("_at", order)
    return tagged.withColumn("line_number", F.row_number().over(W.partitionBy(file).orderBy("_at")) - 1).drop("_at")


def numbered_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, line, line_number) of files of any size, numbered from 0 in file order.

    A file is read in splits by many tasks.  Lines keep their order within a split,
    so a line's number is its place in the split behind the lines of the splits before.
    """
    rows = spark.read.option("lineSep", "\n").text(paths)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    rows = materialize(rows.select(*place, F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")), "lines")
    splits = rows.groupBy("file", "split").agg(F.min("_at").alias("_first"), F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1))  # one row a split
    splits = splits.select("file", "split", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    joined = spread_join(rows, splits, ["file", "split"], by=["_at"])
    return joined.select("file", "line", (F.col("_at") + F.col("_shift")).alias("line_number"))


def line_at(lines: DataFrame, index: int) -> str:
    """The line of a zero-based index of one file; ValueError if negative, out of range or blank."""
    if index < 0:
        raise ValueError("the index must be 0 or more")
    rows = (lines if "line_number" in lines.columns else numbered(lines)).filter(F.col("line_number") == index).limit(1).collect()
    if not rows:
        raise ValueError(f"index {index} is out of range")
    if not rows[0]["line"].strip():
        raise ValueError(f"line {index} is empty")
    return rows[0]["line"]


def documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, record): one row per item of a JSON file's top-level list, or the whole value."""
    whole = spark.read.option("wholetext", True).text(paths).select(F.col("_metadata.file_path").alias("file"), F.parse_json("value").alias("v"))
    return whole.sparkSession.sql(
        """SELECT d.file, e.value AS record FROM {whole} d, LATERAL variant_explode(d.v) AS e WHERE e.key IS NULL
           UNION ALL SELECT file, v FROM {whole} WHERE NOT startswith(schema_of_variant(v), 'ARRAY')""",
        whole=whole,
    )


def write(df: DataFrame, path: str, lines_per_file: int = 0, compression: str = "none", mode: str = "errorifexists") -> None:
    """One JSON object a row, all columns written, at most lines_per_file a file.

    Files appear when the job commits; empty partitions leave none.
    """
    writer = df.select(json_line(df).alias("value")).write.mode(mode).option("compression", compression)
    writer.option("maxRecordsPerFile", lines_per_file).text(path)
