"""Queries on schemas that drift between files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import drift
from ..plans.lineage import materialize


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/raw_lines.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.changes(drift.profiles(_lines(spark, folder))).select("feed", "file_no", "field", "change")


def p1_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The ordered log of changes with names and types before and after."""
    return drift.changes(drift.profiles(_lines(spark, folder))).orderBy("feed", "file_no", "field", "change")


def p1_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The union schema of all files under the promotion lattice."""
    return drift.union_schema(drift.profiles(_lines(spark, folder)))


def p1_unified(spark: SparkSession, folder: str) -> DataFrame:
    """All valid lines of all feeds in one table of consistent columns."""
    lines = _lines(spark, folder)
    return drift.unified(lines, drift.canonical_names(materialize(drift.profiles(lines), "profiles")))


QUERIES = {f.__name__: f for f in (p1_found, p1_changes, p1_schema, p1_unified)}

_FIELDS = """
WITH objects AS (
  SELECT feed, file_no, CAST(line AS JSON) AS o FROM raw_lines
  WHERE feed IS NOT NULL AND file_no IS NOT NULL AND json_valid(line) AND json_type(line) = 'OBJECT'),
tops AS (SELECT feed, file_no, unnest(map_entries(CAST(o AS MAP(VARCHAR, JSON)))) AS e FROM objects),
fields AS (
  SELECT feed, file_no, e.key AS field, json_type(e.value) AS t FROM tops
  WHERE NOT (e.key = 'meta' AND (e.value IS NULL OR json_type(e.value) IN ('OBJECT', 'NULL')))
  UNION ALL
  SELECT feed, file_no, 'meta.' || m.key, json_type(m.value)
  FROM (SELECT feed, file_no, unnest(map_entries(CAST(e.value AS MAP(VARCHAR, JSON)))) AS m FROM tops WHERE e.key = 'meta' AND json_type(e.value) = 'OBJECT')),
typed AS (
  SELECT feed, file_no, field, CASE t WHEN 'BOOLEAN' THEN 0 WHEN 'BIGINT' THEN 1 WHEN 'UBIGINT' THEN 1 WHEN 'DOUBLE' THEN 2
    WHEN 'ARRAY' THEN 3 WHEN 'OBJECT' THEN 4 WHEN 'VARCHAR' THEN 5 END AS k FROM fields),
files AS (
  SELECT feed, file_no, field, list_filter([0, 1, 2, 3, 4, 5], lambda x: n[x + 1] = list_max(n) AND list_max(n) > 0)[1] AS k
  FROM (SELECT feed, file_no, field, [count(*) FILTER (k = 0), count(*) FILTER (k = 1), count(*) FILTER (k = 2),
          count(*) FILTER (k = 3), count(*) FILTER (k = 4), count(*) FILTER (k = 5)] AS n FROM typed GROUP BY 1, 2, 3))
"""

ORACLE_SQL = {
    "p1_schema": _FIELDS
    + """SELECT field, type, files, feeds, CASE type WHEN 'integer' THEN 'bigint' WHEN 'number' THEN 'double' WHEN 'boolean' THEN 'boolean' ELSE 'string' END AS spark_type
         FROM (SELECT field, count(*) AS files, count(DISTINCT feed) AS feeds,
                 CASE WHEN count(DISTINCT k) = 1 THEN ['boolean', 'integer', 'number', 'array', 'object', 'string'][max(k) + 1]
                      WHEN min(k) = 1 AND max(k) = 2 THEN 'number' ELSE 'string' END AS type FROM files GROUP BY 1)""",
}
