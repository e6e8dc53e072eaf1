"""Queries on files as such: footers, damage, counts."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import scratch
from ..sources import parquet, recovery, storage

TABLES = ["classify", "documents", "raw_lines"]
GROUP_ROWS = 500


def _paths(spark: SparkSession, folder: str, name: str) -> list[str]:
    return sorted(spark.read.parquet(f"{folder}/{name}.parquet").inputFiles())


def _damaged(spark: SparkSession, folder: str) -> list[str]:
    """Copies of the documents' files in row groups of GROUP_ROWS rows; in the second one of each file the title can't be read."""
    target = scratch(spark, "damaged")
    storage.make_folder(target)

    def copy(path: str) -> list[dict]:
        import pyarrow.parquet as pq

        system, inner = storage.located(path)
        other, goal = storage.located(f"{target}/{posixpath.basename(inner)}")
        source = pq.ParquetFile(inner, filesystem=system)
        with other.open_output_stream(goal) as f, pq.ParquetWriter(f, source.schema_arrow, compression="zstd", use_dictionary=False) as writer:
            for batch in source.iter_batches(batch_size=GROUP_ROWS):
                writer.write_batch(batch, row_group_size=GROUP_ROWS)
        meta = pq.read_metadata(goal, filesystem=other)
        if meta.num_row_groups > 1:
            chunk = meta.row_group(1).column(meta.schema.names.index("title"))
            with other.open_input_file(goal) as f:
                content = bytearray(f.read())
            content[chunk.data_page_offset + 8 : chunk.data_page_offset + 72] = b"\x00\xff" * 32
            with other.open_output_stream(goal) as f:
                f.write(bytes(content))
        return [{"path": f"{target}/{posixpath.basename(inner)}"}]

    return [r["path"] for r in storage.by_file(spark, _paths(spark, folder, "documents"), "path string", copy).collect()]  # one row a file


def salvage_report(spark: SparkSession, folder: str) -> DataFrame:
    """Row groups of damaged copies of the documents by whether they can be read."""
    return recovery.summary(recovery.report(spark, _damaged(spark, folder)))


def salvaged_rows(spark: SparkSession, folder: str) -> DataFrame:
    """What the salvaging reader gets out of the damaged copies."""
    return recovery.salvage(spark, _damaged(spark, folder))


def magic_check(spark: SparkSession, folder: str) -> DataFrame:
    """Whether all files of a table have their magic bytes and sound footer bounds."""
    parts = []
    for name in TABLES:
        found = recovery.magic(spark, _paths(spark, folder, name))
        parts.append(found.agg(F.bool_and(F.col("magic_ok") & (F.size("warnings") == 0) & (F.size("errors") == 0)).alias("sound")).select(F.lit(name).alias("name"), "sound"))
    return parts[0].union(parts[1]).union(parts[2])


def column_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and nulls of each column of the documents by the facts of their footers."""
    found = recovery.describe(spark, _paths(spark, folder, "documents"))
    return found.groupBy("column").agg(F.sum("rows").alias("n"), F.sum("nulls").alias("nulls"))


def footer_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of three tables by their footers."""
    parts = [parquet.footers(spark, _paths(spark, folder, n)).agg(F.sum("rows").alias("n")).select(F.lit(n).alias("name"), "n") for n in TABLES]
    return parts[0].union(parts[1]).union(parts[2])


QUERIES = {f.__name__: f for f in (salvage_report, salvaged_rows, magic_check, column_chunks, footer_counts)}

_LOST = f"row_number() OVER () BETWEEN {GROUP_ROWS + 1} AND {2 * GROUP_ROWS}"
_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "site", "title", "fetched_at"]
ORACLE_SQL = {
    "salvaged_rows": f"SELECT * REPLACE (CASE WHEN {_LOST} THEN NULL ELSE title END AS title) FROM documents",
    "salvage_report": f"""WITH c AS (SELECT count(*) AS n, ceil(count(*) / {GROUP_ROWS})::BIGINT AS k FROM documents), l AS (SELECT greatest(0, least({GROUP_ROWS}, n - {GROUP_ROWS})) AS lost, n, k FROM c)
        SELECT 'full' AS status, k - (CASE WHEN lost > 0 THEN 1 ELSE 0 END) AS row_groups, n - lost AS rows, []::VARCHAR[] AS bad_columns FROM l
        UNION ALL SELECT 'partial', 1, lost, ['title'] FROM l WHERE lost > 0""",
    "magic_check": "SELECT name, true AS sound FROM (VALUES ('classify'), ('documents'), ('raw_lines')) t(name)",
    "column_chunks": " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, count(*) - count({c}) AS nulls FROM documents" for c in _COLUMNS),
    "footer_counts": " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in TABLES),
}
