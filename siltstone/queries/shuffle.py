"""Queries on the global shuffle, on ranks, rows by place and resuming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import resume, shuffling
from ..operators.ranking import numbered
from ..sources import parquet, token_files

PILES, LINES, SEED, WORLD = 16, 50, 7, 4


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pile_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return shuffling.with_pile(_table(spark, folder, "documents").select("doc_id"), "doc_id", PILES, SEED, shuffling.md5)


def pile_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return shuffling.pile_sizes(_table(spark, folder, "documents").select("doc_id"), "doc_id", PILES, SEED, shuffling.md5)


def pile_permutation(spark: SparkSession, folder: str) -> DataFrame:
    return shuffling.permuted(_table(spark, folder, "documents").select("doc_id"), "doc_id", PILES, SEED, shuffling.md5)


def shard_numbering(spark: SparkSession, folder: str) -> DataFrame:
    rows = shuffling.permuted(_table(spark, folder, "documents").select("doc_id"), "doc_id", PILES, SEED, shuffling.md5)
    return rows.select("doc_id", "pile", shuffling.shard_of(F.col("pos"), LINES).alias("shard"))


def shuffled_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as the production shuffle lays them out: pile and place are those of the physical partitions."""
    docs = _table(spark, folder, "documents")
    rows = shuffling.laid_out(docs, "doc_id", PILES, SEED, shuffling.md5)
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + 1
    return rows.select(*docs.columns, F.spark_partition_id().alias("pile"), place.alias("pos"))


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, place) in path order."""
    files = _table(spark, folder, "classify").select("source_file").filter("source_file is not null").distinct()
    return numbered(files, F.split("source_file", "/"), name="place")


def round_robin_rank(spark: SparkSession, folder: str) -> DataFrame:
    """Rank of each source file when files are dealt out in path order."""
    return _files(spark, folder).select("source_file", F.pmod("place", F.lit(WORLD)).cast("int").alias("rank"))


def block_partition(spark: SparkSession, folder: str) -> DataFrame:
    """The same files in contiguous blocks."""
    files = _files(spark, folder)
    return files.select("source_file", shuffling.block_of(F.col("place"), WORLD, F.lit(files.count())).alias("block"))


def manifest_check(spark: SparkSession, folder: str) -> DataFrame:
    return shuffling.check_manifests(_table(spark, folder, "pile_manifests"))


def row_at_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = parquet.with_row_number(_table(spark, folder, "classify"))
    return rows.filter("line_number = 1234").select("row_id", "record_id", "text", "line_number")


def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    return parquet.head(_table(spark, folder, "documents"), 20).select("doc_id", "source", "title", "line_number")


def resume_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled areas aside, the records that still have none."""
    done = _table(spark, folder, "topic_labels")
    return resume.pending(_table(spark, folder, "classify").select("row_id", "record_id"), done, "record_id")


def set_rows(spark: SparkSession, folder: str) -> DataFrame:
    """UNION ALL of two tables' keys."""
    return _table(spark, folder, "topic_labels").select("record_id").union(_table(spark, folder, "review_lists").select("record_id"))


def eos_split(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's events as a token stream whose documents end with token 0."""
    token = F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0)) % 10
    stream = _table(spark, folder, "events").select("user_id", "event_id", token.alias("token"))
    return token_files.documents_of(stream, "user_id", "event_id", "token", 0)


def first_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The first ten documents of each stream."""
    return eos_split(spark, folder).filter("doc_index < 10")


def sample_one(spark: SparkSession, folder: str) -> DataFrame:
    return parquet.sample_one(_table(spark, folder, "documents").select("doc_id", "source", "title"), "doc_id", SEED, shuffling.md5)


def row_count(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each table; no column is read."""
    names = ["classify", "documents", "raw_lines"]
    counts = [_table(spark, folder, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n in names]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


QUERIES = {
    f.__name__: f
    for f in (
        pile_assignment, pile_sizes, pile_permutation, shard_numbering, shuffled_rows, round_robin_rank, block_partition, manifest_check,
        row_at_index, head_rows, resume_anti, set_rows, eos_split, first_documents, sample_one, row_count,
    )
}

_HASH = lambda purpose: f"CAST('0x' || substr(md5('{SEED}:{purpose}:' || doc_id), 1, 13) AS BIGINT)"
_PERMUTED = f"""SELECT doc_id, pile, row_number() OVER (PARTITION BY pile ORDER BY o, doc_id)::INT AS pos
  FROM (SELECT doc_id, ({_HASH('pile')} % {PILES})::INT AS pile, {_HASH('order')} AS o FROM documents)"""
_FILES = """SELECT source_file, row_number() OVER (ORDER BY string_split(source_file, '/')) - 1 AS place, count(*) OVER () AS total
  FROM (SELECT DISTINCT source_file FROM classify WHERE source_file IS NOT NULL)"""
_DOCUMENTS = """WITH s AS (SELECT user_id, event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) % 10 AS token FROM events),
  n AS (SELECT *, coalesce(sum(CASE WHEN token = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INT AS doc_index FROM s)
  SELECT user_id, doc_index, list(token ORDER BY event_id) AS tokens FROM n GROUP BY 1, 2"""

ORACLE_SQL = {
    "pile_assignment": f"SELECT doc_id, pile FROM ({_PERMUTED})",
    "pile_sizes": f"SELECT pile, count(*) AS n FROM ({_PERMUTED}) GROUP BY 1",
    "pile_permutation": _PERMUTED,
    "shard_numbering": f"SELECT doc_id, pile, floor((pos - 1) / {LINES})::INT AS shard FROM ({_PERMUTED})",
    "shuffled_rows": f"SELECT d.*, p.pile, p.pos::BIGINT AS pos FROM documents d JOIN ({_PERMUTED}) p USING (doc_id)",
    "sample_one": f"SELECT doc_id, source, title FROM documents ORDER BY {_HASH('sample')}, doc_id LIMIT 1",
    "round_robin_rank": f"SELECT source_file, (place % {WORLD})::INT AS rank FROM ({_FILES})",
    "block_partition": f"SELECT source_file, floor(place / ceil(total / {WORLD}))::INT AS block FROM ({_FILES})",
    "manifest_check": """SELECT run_id, max(world_size) AS world_size, max(num_piles) AS num_piles, count(DISTINCT rank) AS ranks,
        (max(world_size) - count(DISTINCT CASE WHEN rank >= 0 THEN rank END))::BIGINT AS missing,
        coalesce(min(world_size) = max(world_size) AND min(num_piles) = max(num_piles) AND count(DISTINCT rank) = max(world_size)
          AND count(DISTINCT CASE WHEN rank >= 0 THEN rank END) = count(DISTINCT rank) AND max(rank) = max(world_size) - 1, false) AS ok
        FROM pile_manifests GROUP BY 1""",
    "row_at_index": "SELECT row_id, record_id, text, line_number FROM (SELECT *, row_number() OVER () - 1 AS line_number FROM classify) WHERE line_number = 1234",
    "head_rows": "SELECT doc_id, source, title, line_number FROM (SELECT *, row_number() OVER () - 1 AS line_number FROM documents) WHERE line_number < 20",
    "resume_anti": "SELECT row_id, record_id FROM classify c WHERE NOT EXISTS (SELECT 1 FROM topic_labels t WHERE t.record_id = c.record_id)",
    "set_rows": "SELECT record_id FROM topic_labels UNION ALL SELECT record_id FROM review_lists",
    "eos_split": _DOCUMENTS,
    "first_documents": f"SELECT * FROM ({_DOCUMENTS}) WHERE doc_index < 10",
    "row_count": "SELECT 'classify' AS name, count(*) AS n FROM classify UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'raw_lines', count(*) FROM raw_lines",
}
