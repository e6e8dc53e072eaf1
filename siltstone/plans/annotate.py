"""The annotation, classification and shuffle pipelines as plans."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import adapters, quality, resume, scoring, shuffling
from ..sources import jsonl, listing, parquet, storage
from .runtime import positive, rank_and_world, separate

STATUS = "_status"  # table beside the results: one row per input that was tried
FILES_PER_JOB = 1_000


def annotate(lines: DataFrame, adapter: adapters.Adapter | None = None, registry: scoring.Registry | None = None,
             text: str = "text", more: tuple[str, ...] = ("meta.url",)) -> DataFrame:
    """Typed, flattened and scored records of JSON lines (file, line)."""
    adapter = adapter or adapters.Adapter("plain")
    typed = adapters.apply(lines, adapter, more=more)
    return scoring.score(typed, registry or scoring.lexical(), text, "meta.url" if "meta.url" in more else None, list(scoring.CONTRACTS))


def annotate_files(spark: SparkSession, source: str, target: str, registry: scoring.Registry | None = None, files_per_job: int = FILES_PER_JOB) -> DataFrame:
    """Annotate each JSONL file below source, with the adapter that its path names; returns the status of the files.

    The rows of a file go to a partition of their own, ``adapter=<name>/source_file=<path>``.
    Files that the status table calls done are skipped; a file whose results were
    written but not noted is written anew in place of them.  A file with a line that is no JSON
    object gives no results and is noted as failed; the others go on, and
    RuntimeError at the end names the failed ones.  Files without lines give no results.
    """
    separate(source, target)
    paths = listing.files(source, (".jsonl", ".jsonl.gz"))
    listing.outputs([f"{source}/{p}" for p in paths], source, target)
    paths = listing.shard(paths, *rank_and_world())  # several drivers may share the work
    rows = [(p, c.name if (c := adapters.choose(f"{source}/{p}")) else "none") for p in paths]
    inputs = spark.createDataFrame(rows, "source_file string, adapter string")
    noted = f"{target}/{STATUS}"
    if storage.exists(noted):
        inputs = resume.pending(inputs, spark.read.parquet(noted).filter("failed = 0"), "source_file")
    todo: dict[str, list[str]] = {}
    for r in inputs.orderBy("source_file").collect():  # the listing itself
        todo.setdefault(r["adapter"], []).append(r["source_file"])
    for name, members in todo.items():
        for at in range(0, len(members), files_per_job):
            _annotate_job(spark, source, target, name, members[at : at + files_per_job], registry)
    status = spark.read.parquet(noted) if storage.exists(noted) else spark.createDataFrame([], resume.STATUS)
    latest = status.groupBy("source_file").agg(F.max_by(F.struct("rows", "failed", "first_error"), "noted_at").alias("s")).select("source_file", "s.*")
    resume.raise_if_failed(latest, "source_file")
    return latest


def _annotate_job(spark: SparkSession, source: str, target: str, name: str, members: list[str], registry: scoring.Registry | None) -> None:
    relative = lambda: F.substring_index(F.col("file"), source.rstrip("/").rpartition(":")[2].lstrip("/") + "/", -1)
    lines = jsonl.read_lines(spark, [f"{source}/{p}" for p in members]).withColumn("file", F.url_decode("file"))
    wrong = F.when(~jsonl.is_object(F.col("line")), F.concat(F.lit("no JSON object: "), F.substring("line", 1, 80)))
    found = resume.file_status(lines.select(relative().alias("source_file"), wrong.alias("error")), "source_file", "error")
    every = spark.createDataFrame([(p,) for p in members], "source_file string")
    found = every.join(found, "source_file", "left").fillna(0, ["rows", "failed"]).withColumn("noted_at", F.current_timestamp())
    checked = {r["source_file"]: r for r in found.collect()}  # one row a file of the job
    good = [f"{source}/{p}" for p in members if not checked[p]["failed"] and checked[p]["rows"]]
    if good:
        adapter = next((a for a in adapters.ADAPTERS if a.name == name), None)
        lines = jsonl.read_lines(spark, good).withColumn("file", F.url_decode("file"))
        out = annotate(lines, adapter, registry).withColumn("source_file", relative()).drop("file").withColumn("adapter", F.lit(name))
        out = out.repartition(F.col("source_file"), F.pmod(F.xxhash64("text"), F.lit(16)))  # few files a partition, a large input spread
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("adapter", "source_file").parquet(target)
    found.select("source_file", "rows", "failed", "first_error", "noted_at").write.mode("append").parquet(f"{target}/{STATUS}")


def classify_table(df: DataFrame, target: str, breaks_dir: str | None = None) -> None:
    """Project, bucket and write a table of annotated records by category."""
    quality.write_categories(quality.classify(quality.project(df), quality.load_breaks(breaks_dir)), target)


def classify_files(spark: SparkSession, source: str, target: str, breaks_dir: str | None = None, rows_per_file: int = quality.ROWS_PER_FILE) -> None:
    separate(source, target)
    positive(rows_per_file=rows_per_file)
    if storage.exists(target):
        raise ValueError("the output exists already")
    paths = [f"{source}/{p}" for p in listing.files(source, (".parquet",), hidden=False, any_case=True) if f"/{STATUS}/" not in f"/{p}"]
    if not paths:
        raise ValueError("no Parquet files")
    rows = parquet.read_projected(spark, paths)
    quality.write_categories(quality.classify(rows, quality.load_breaks(breaks_dir)), target, rows_per_file)


def shuffle_files(spark: SparkSession, source: str, target: str, piles: int, lines: int, seed: int = 0, key: str | None = None) -> dict:
    """Shuffle all Parquet files below source into JSONL shards, check them and write the manifest, which is returned.

    All files must have the same names, types and nullability, else ValueError
    lists the files that differ; so it does if there are no files.  Without a key, a row
    is named by its file and place in it.  Inputs without rows give no
    shards and a manifest that says so.  After writing, the shards on disk
    are compared with those that the pile sizes ask for.
    """
    separate(source, target)
    positive(piles=piles, lines=lines)
    if storage.exists(target):
        raise ValueError("the output exists already")
    paths = [f"{source}/{p}" for p in listing.files(source, (".parquet",), any_case=True)]
    if not paths:
        raise ValueError("no Parquet files")
    groups = parquet.schema_groups(spark, paths)
    if len(groups) > 1:
        odd = [p for g in sorted(groups, key=len)[:-1] for p in g]
        raise ValueError(f"{len(odd)} files differ in schema from the others, such as {', '.join(odd[:5])}")
    df = spark.read.parquet(*paths)
    names = df.columns
    if key is None:
        key = "_row_name"
        df = df.select("*", F.concat_ws("#", F.col("_metadata.file_path"), F.format_string("%020d", F.col("_metadata.row_index"))).alias(key))
    empty = df.isEmpty()
    if not empty:
        shuffling.write_shards(df, target, key, piles, lines, seed, columns=names)
        wrong = shuffling.wrong_parts(shuffling.pile_sizes(df, key, piles, seed), shuffling.parts_on_disk(spark, target), lines).limit(20).collect()
        if wrong:
            raise ValueError("shards don't fit their piles: " + ", ".join(f"pile {r['pile']} has {r['found']} of {r['expected']}" for r in wrong))
    manifest = {"rank": 0, "world_size": 1, "num_piles": piles, "empty": empty}
    storage.write_text(f"{target}/_manifest.json", json.dumps(manifest))
    return manifest
