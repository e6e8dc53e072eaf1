"""Flat files of token ids (``.ds`` with ``.ds.metadata``)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ranking import cumulative
from ..plans.lineage import broadcast_if_small, materialize
from . import storage

RANGE_TOKENS = 16 << 20
WINDOW_ROWS = 1_000_000
# Tokens that end a document, the most usual first.
END_TOKENS = ("<|endoftext|>", "</s>", "<|end_of_text|>", "<eos>", "[SEP]")


def metadata(path: str) -> tuple[str | None, int, int | None]:
    """(tokenizer, bytes per token, number of tokens) from the file beside path.

    Without the file or with a short one: (None, 2, None); a number that is no
    number is None.
    """
    rows = (storage.read_text(f"{path}.metadata") or "").splitlines()
    if len(rows) < 2:
        return None, 2, None
    name, *size = rows[0].strip().split("|")
    return name or None, int(size[0]) if size else 2, int(rows[1]) if rows[1].strip().isdigit() else None


def decode_ids(content: bytes, size: int) -> np.ndarray:
    """Little-endian unsigned ids; a trailing partial token is ignored."""
    if size not in (2, 4):
        raise ValueError("tokens have 2 or 4 bytes")
    return np.frombuffer(content[: len(content) // size * size], dtype=f"<u{size}").astype(np.int64)


def split_documents(ids: np.ndarray, eos: int) -> list[np.ndarray]:
    """Documents of a stream; each keeps its end id, an unended tail is one too."""
    ends = np.flatnonzero(ids == eos) + 1
    parts = np.split(ids, ends)
    return [p for p in parts if len(p)]


def _tokens(path: str, size: int, first: int, end: int, step: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
    """(place of its first token, ids) of successive parts of a file, from token first up to end."""
    system, inner = storage.located(path)
    with system.open_input_file(inner) as f:
        for at in range(first, end, step):
            yield at, decode_ids(f.read_at((min(end, at + step) - at) * size, at * size), size)


def _documents(path: str, size: int, eos: int, begin: int, end: int, total: int, first: int | None = None) -> Iterator[np.ndarray]:
    """The documents that start at tokens begin to end - 1 of a file; the last may go on behind end."""
    if begin > 0 and next(_tokens(path, size, begin - 1, begin))[1][0] != eos:  # begin lies inside a document
        for at, ids in _tokens(path, size, begin, end):
            hit = np.flatnonzero(ids == eos)
            if len(hit):
                begin = at + int(hit[0]) + 1
                break
        else:
            return
    if begin >= end:
        return
    held, found = [], 0
    for at, ids in _tokens(path, size, begin, total):
        for part in split_documents(ids, eos):
            held.append(part)
            if part[-1] == eos:
                yield np.concatenate(held)
                held, found = [], found + 1
                if found == first:
                    return
            at += len(part)
            if not held and at >= end:
                return
    if held:
        yield np.concatenate(held)


def read(spark: SparkSession, path: str, eos: int, first: int | None = None, range_tokens: int = RANGE_TOKENS) -> DataFrame:
    """(file, doc_index, tokens): the documents of token files, or the first of each file.

    A file is read in ranges of so many tokens by as many tasks; a document belongs
    to the range that it starts in.  The numbers of documents before each range
    come from a pass that counts.  With `first`, a file is read only as far as needed.
    """
    paths = [f"{path}/{p}" for p in storage.below(path) if p.endswith(".ds")] if storage.kind(path) == fs.FileType.Directory else [path]

    def ranges(file: str) -> list[dict]:
        _, size, _ = metadata(file)
        system, inner = storage.located(file)
        total = system.get_file_info(inner).size // size
        step = range_tokens if first is None else max(1, total)
        return [{"file": file, "size": size, "total": total, "begin": b, "end": min(total, b + step)} for b in range(0, total, step)]

    columns = "file string, size int, total bigint, begin bigint, end bigint"
    table = storage.by_file(spark, paths, columns, ranges)
    table = table.repartition(max(1, spark.sparkContext.defaultParallelism), "file", "begin")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [sum(1 for _ in _documents(file, size, eos, begin, end, total)) for file, size, total, begin, end in batch.itertuples(index=False)]
            yield batch.assign(n=n)

    if first is None:
        counted = materialize(table.mapInPandas(count, columns + ", n bigint"), "ranges")  # one row a range
        before = F.sum("n").over(W.partitionBy("file").orderBy("begin").rowsBetween(W.unboundedPreceding, -1))
        table = counted.withColumn("base", F.coalesce(before, F.lit(0))).drop("n").repartition(max(1, spark.sparkContext.defaultParallelism), "file", "begin")
    else:
        table = table.withColumn("base", F.lit(0).cast("bigint"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, size, total, begin, end, base in batch.itertuples(index=False):
                docs = _documents(file, size, eos, begin, end, total, first) if first != 0 else ()
                for i, tokens in enumerate(docs):
                    yield pd.DataFrame({"file": [file], "doc_index": [base + i], "tokens": [tokens.tolist()]})

    return table.mapInPandas(run, "file string, doc_index bigint, tokens array<bigint>")


def end_id(name: str, folder: str) -> int:
    """Id that ends a document under a tokenizer, from its file ``<name>.json`` in a folder.

    The first of END_TOKENS that the tokenizer knows; ValueError if it knows none or has no file.
    """
    content = storage.read_text(f"{folder}/{name}.json")
    if content is None:
        raise ValueError(f"no tokenizer file for {name}")
    known = json.loads(content)
    ids = dict(known.get("model", {}).get("vocab", {})) if isinstance(known.get("model", {}).get("vocab"), dict) else {}
    ids |= {t["content"]: t["id"] for t in known.get("added_tokens", [])}
    for token in END_TOKENS:
        if token in ids:
            return ids[token]
    raise ValueError(f"the tokenizer {name} has no token that ends a document")


def records(spark: SparkSession, path: str, eos: int, decoder: Callable[[], Callable[[list[int]], str]] | None = None, first: int = 10) -> DataFrame:
    """The first documents of one token file with its metadata and decoded text.

    decoder makes a function from ids to text, once per worker; without one the
    text is null.  ValueError if the file names no tokenizer.
    """
    name, size, count = metadata(path)
    if name is None:
        raise ValueError("the token file has no metadata")
    docs = read(spark, path, eos, first)

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode = decoder()
        for tokens in batches:
            yield tokens.map(lambda ids: decode([int(i) for i in ids]))

    return docs.select(
        F.lit(path).alias("filename"), F.lit(name).alias("tokenizer"), F.lit(size).alias("token_size"), F.lit(count).cast("bigint").alias("token_count"),
        "doc_index", "tokens", (text("tokens") if decoder else F.lit(None).cast("string")).alias("decoded"),
    )


def write(path: str, ids, size: int, tokenizer: str) -> None:
    """A token file and its metadata."""
    values = np.asarray(ids, dtype=f"<u{size}")
    system, inner = storage.located(path)
    with system.open_output_stream(inner) as f:
        f.write(values.tobytes())
    storage.write_text(f"{path}.metadata", f"{tokenizer}|{size}\n{len(values)}\n")


def documents_of(stream: DataFrame, group: str, order: str, token: str, eos: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """(group, doc_index, tokens) of token rows: a running count of end ids numbers the documents.

    order must be unique in a group, and numeric where a group has more than
    window_rows rows: such groups are summed by buckets (``cumulative``) instead
    of being sorted by one task.
    """
    ends = (F.col(token) == eos).cast("bigint")
    rows = stream.select(group, order, token)
    sizes = materialize(rows.groupBy(group).count().filter(F.col("count") > window_rows).select(group), "long")
    long = broadcast_if_small(sizes)
    before = F.sum(ends).over(W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1))
    docs = rows.join(long, group, "left_anti").select(group, order, token, F.coalesce(before, F.lit(0)).cast("int").alias("doc_index"))
    if sizes.count():
        hot = rows.join(long, group, "left_semi")
        places = cumulative(hot, [group], order, F.coalesce(ends, F.lit(0))).select(group, order, F.col("n_before").cast("int").alias("doc_index"))
        docs = docs.union(hot.join(places, [group, order]).select(group, order, token, "doc_index"))
    docs = docs.groupBy(group, "doc_index").agg(F.array_sort(F.collect_list(F.struct(order, token))).alias("_t"))
    return docs.select(group, "doc_index", F.transform("_t", lambda t: t[token]).alias("tokens"))
