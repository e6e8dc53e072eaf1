"""Token ids and token budgets under a public tokenizer."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import cumulative
from . import bpe
from .batches import map_texts, texts_of
from .language import normalized

WRONG_FACTOR = 2.0


def ids(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = bpe.BYTE_BPE_50K, folder: str = bpe.VOCABULARY_DIR, offsets: bool = False) -> DataFrame:
    """(key, ids): the ids of each text without special tokens; none for null and empty texts.

    offsets adds ``starts``: for each id the character at which its slice of the
    text begins.  The ids of one slice have the same start and decode together.
    """

    def encode(batch: pa.RecordBatch) -> dict:
        found = bpe.load(vocabulary, folder).encoded(texts_of(batch))
        bounds = pa.array(found.offsets, pa.int32())
        out = {key: batch.column(key), "ids": pa.ListArray.from_arrays(bounds, pa.array(found.ids, pa.int32()))}
        return out | {"starts": pa.ListArray.from_arrays(bounds, pa.array(found.id_starts(), pa.int32()))} if offsets else out

    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, ids array<int>" + (", starts array<int>" if offsets else "")
    return map_texts(documents.select(key, F.col(text).alias("text")), encode, schema)


def counts(documents: DataFrame, text: str = "text", vocabulary: str = bpe.BYTE_BPE_50K, folder: str = bpe.VOCABULARY_DIR) -> DataFrame:
    """The columns of documents with n_tokens in place of the text; 0 for null and empty texts."""
    others = [c for c in documents.columns if c not in (text, "n_tokens")]
    body = "_text" + "_" * sum(c.startswith("_text") for c in others)

    def count(batch: pa.RecordBatch) -> dict:
        number = bpe.load(vocabulary, folder).count(texts_of(batch, body))
        return {**{c: batch.column(c) for c in others}, "n_tokens": pa.array(number, pa.int64())}

    schema = "".join(f"`{c}` {documents.schema[c].dataType.simpleString()}, " for c in others) + "n_tokens bigint"
    source = documents.select(*[f"`{c}`" for c in others], F.col(f"`{text}`").alias(body))
    return map_texts(source, count, schema)


def record_counts(records: DataFrame, **options) -> DataFrame:
    """One row per row of classified records: record_id, source, lang (normalized
    label), domain, has_text, the given jais_token_count and meta_tokens, n_tokens."""
    slim = records.select(
        "record_id",
        F.coalesce("subset", F.lit("unknown")).alias("source"),
        normalized(F.col("`meta.lang`")).alias("lang"),
        F.col("`meta.domain`").alias("domain"),
        "jais_token_count",
        F.col("`meta.token_count`").alias("meta_tokens"),
        (F.coalesce(F.length("text"), F.lit(0)) > 0).alias("has_text"),
        "text",
    )
    return counts(slim, **options)


def rates(counted: DataFrame, given: str = "jais_token_count") -> DataFrame:
    """(lang, rate): how many tokens of the other tokenizer a token counted here stands for.

    The exact lower median over all rows of a language that have both numbers;
    wrong ones on both sides don't move it.  Rows without a language have a rate
    of their own.
    """
    sound = counted.filter(f"has_text and n_tokens > 0 and {given} > 0").select("lang", (F.col(given) / F.col("n_tokens")).alias("rate"))
    steps = cumulative(sound, ["lang"], "rate").filter(2 * (F.col("n_before") + F.col("n")) >= F.col("n_group"))
    return steps.groupBy("lang").agg(F.min("rate").alias("rate"))


def wrong_counts(counted: DataFrame, given: str = "jais_token_count", factor: float = WRONG_FACTOR) -> DataFrame:
    """(record_id, lang, given, expected): rows whose given count is present but
    less than 1/factor or more than factor times the expected one.

    Texts that are null or empty are no cases; nor are languages without any
    sound row.
    """
    known = F.broadcast(rates(counted, given).select(F.col("lang").alias("_lang"), "rate"))  # one row a language
    rows = counted.filter(f"has_text and {given} is not null")
    rows = rows.join(known, rows["lang"].eqNullSafe(F.col("_lang"))).withColumn("expected", F.col("n_tokens") * F.col("rate"))
    wrong = (F.col(given) * factor < F.col("expected")) | (F.col(given) > F.col("expected") * factor)
    return rows.filter(wrong).select("record_id", "lang", F.col(given).alias("given"), "expected")


def budget(counted: DataFrame) -> DataFrame:
    """Token totals over the cube of source, language and domain.

    (source, lang, domain, level, records, n_tokens, jais_tokens): level is the
    grouping id (0: all three given, 7: grand total); repeats of a record count
    once (of differing rows the least one), rows with a null record_id each.  jais_tokens are the given counts where they are plausible, else the
    expected ones.  Null lang and domain are groups of their own.
    """
    known = F.broadcast(rates(counted).select(F.col("lang").alias("_lang"), "rate"))  # one row a language
    rows = counted.join(known, counted["lang"].eqNullSafe(F.col("_lang")), "left")
    expected = F.col("n_tokens") * F.coalesce("rate", F.lit(1.0))
    given = F.col("jais_token_count")
    sound = (given * WRONG_FACTOR >= expected) & (given <= expected * WRONG_FACTOR)
    rows = rows.withColumn("jais", F.when(sound, given).otherwise(F.round(expected)).cast("bigint"))
    values = F.struct("source", "lang", "domain", "n_tokens", "jais").alias("v")
    once = rows.filter("record_id is not null").groupBy("record_id").agg(F.min(values).alias("v")).select("v.*")
    once = once.union(rows.filter("record_id is null").select("source", "lang", "domain", "n_tokens", "jais"))
    # Summed to the finest level first: the cube then expands one row per group, not per record.
    fine = once.groupBy("source", "lang", "domain").agg(
        F.count("*").alias("records"), F.sum("n_tokens").alias("n_tokens"), F.sum("jais").alias("jais_tokens")
    )
    return fine.cube("source", "lang", "domain").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("records").alias("records"),
        F.sum("n_tokens").alias("n_tokens"), F.sum("jais_tokens").alias("jais_tokens"),
    )
