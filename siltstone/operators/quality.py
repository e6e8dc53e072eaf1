"""Quality buckets, categories and their counts."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORES = ["fineweb_edu_classifier_score", "fasttext_eli5_score", "fasttext_preselect_score"]
BUCKETS = {
    "fineweb_edu_classifier_score": "bucket_fineweb_edu_classifier",
    "fasttext_eli5_score": "bucket_fasttext_eli5",
    "fasttext_preselect_score": "bucket_fasttext_preselect",
}
CATEGORIES = ["High", "Medium-High", "Medium", "Medium-Low", "Low", "Unknown"]
BOUNDARIES = 19
ROWS_PER_FILE = 50_000

# The typed columns that a classified record starts with.
PROJECTION = {
    "text": "string",
    "subset": "string",
    "FormatClassifier": "bigint",
    "TopicClassifier": "bigint",
    "fineweb_edu_classifier_score": "double",
    "fasttext_eli5_score": "double",
    "fasttext_preselect_score": "double",
    "jais_token_count": "bigint",
    "meta.token_count": "bigint",
    "meta.lang": "string",
    "meta.lang_score": "double",
}

# The published boundaries of the three scores.
DEFAULT_BREAKS = {
    "fineweb_edu_classifier_score": [
        0.18359375, 0.376953125, 0.50390625, 0.59765625, 0.67578125, 0.7421875, 0.80078125, 0.859375, 0.9140625,
        0.97265625, 1.0390625, 1.1015625, 1.1875, 1.28125, 1.3984375, 1.546875, 1.734375, 2.0, 2.4375,
    ],
    "fasttext_eli5_score": [
        1.0082116205012426e-05, 1.09394632090698e-05, 1.41167702167877e-05, 2.2188642105902545e-05, 3.934368214686401e-05,
        7.223255670396611e-05, 0.00013094865425955504, 0.00023124183644540608, 0.0003981294285040349, 0.0006686493870802224,
        0.0011070446344092488, 0.0018117539584636688, 0.0029605631716549397, 0.004873496480286121, 0.008218463510274887,
        0.014493285678327084, 0.02781173214316368, 0.06332914531230927, 0.21082207560539246,
    ],
    "fasttext_preselect_score": [
        0.019376244395971298, 0.07053251564502716, 0.14369410276412964, 0.22993989288806915, 0.32094627618789673,
        0.41147318482398987, 0.4972527325153351, 0.576099693775177, 0.6466524600982666, 0.708306074142456, 0.7613518238067627,
        0.8066352605819702, 0.8450499773025513, 0.8773530721664429, 0.9045843482017517, 0.9276708960533142,
        0.9476028084754944, 0.9652613997459412, 0.9817675948143005,
    ],
}


def checked(name: str, values: Sequence[float]) -> list[float]:
    """The boundaries of a score; ValueError unless they are 19 strictly increasing numbers."""
    values = [float(v) for v in values]
    if len(values) != BOUNDARIES or any(not a < b for a, b in zip(values, values[1:])):
        raise ValueError(f"{name} must have {BOUNDARIES} strictly increasing boundaries")
    return values


def load_breaks(folder: str | None = None) -> dict[str, list[float]]:
    """Boundaries of each score from ``breaks_<score>.json`` of a folder, or the published ones."""
    if folder is None:
        return {k: checked(k, v) for k, v in DEFAULT_BREAKS.items()}
    from ..sources import storage

    out = {}
    for score in SCORES:
        path = f"{folder}/breaks_{score.removesuffix('_score')}.json"
        content = storage.read_text(path)
        if content is None:
            raise ValueError(f"no boundaries at {path}")
        out[score] = checked(path, json.loads(content))
    return out


def breaks_of(table: DataFrame) -> dict[str, list[float]]:
    """Boundaries from a table (score_name, break_no, boundary) of at most 19 rows a score."""
    rows = table.filter(F.col("score_name").isin(SCORES)).orderBy("score_name", "break_no").limit(BOUNDARIES * len(SCORES) + 1).collect()
    return {s: checked(s, [r["boundary"] for r in rows if r["score_name"] == s]) for s in SCORES}


def bucket(score: Column, boundaries: Sequence[float]) -> Column:
    """0 to 19: how many boundaries lie strictly below the score; null and NaN give 0.

    A score equal to a boundary stays in the lower bucket.  Compared as doubles,
    also when the score is stored as float.
    """
    value = score.cast("double")
    below = [F.when(value > F.lit(float(b)), 1).otherwise(0) for b in boundaries]
    total = below[0]
    for step in below[1:]:
        total = total + step
    return F.when(value.isNull() | F.isnan(value), 0).otherwise(total).cast("int")


def category(final: Column) -> Column:
    """Name of a final bucket: 19 High, 18 Medium-High, 12 to 17 Medium, 7 to 11
    Medium-Low, 6 and less Low, anything else Unknown."""
    return (
        F.when(final == 19, "High")
        .when(final == 18, "Medium-High")
        .when(final.between(12, 17), "Medium")
        .when(final.between(7, 11), "Medium-Low")
        .when(final <= 6, "Low")
        .otherwise("Unknown")
    )


def with_buckets(df: DataFrame, breaks: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """df with one bucket per score; a missing score column counts as null."""
    breaks = breaks or load_breaks()
    cells = {b: bucket(F.col(f"`{s}`") if s in df.columns else F.lit(None), breaks[s]) for s, b in BUCKETS.items()}
    return df.withColumns(cells)


def classify(df: DataFrame, breaks: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """df with buckets, final_bucket (the highest of them) and quality_category."""
    df = with_buckets(df, breaks).withColumn("final_bucket", F.greatest(*BUCKETS.values()))
    return df.withColumn("quality_category", category(F.col("final_bucket")))


def field(schema: T.StructType, name: str) -> Column | None:
    """Column for a dotted name: the column so spelled, else a struct's field, else None."""
    if name in schema.names:
        return F.col(f"`{name}`")
    parent, _, child = name.partition(".")
    if child and parent in schema.names and isinstance(schema[parent].dataType, T.StructType) and child in schema[parent].dataType.names:
        return F.col(f"`{parent}`")[child]
    return None


def project(df: DataFrame, wanted: Mapping[str, str] = PROJECTION, keep: Sequence[str] = ()) -> DataFrame:
    """The wanted typed columns (and those to keep), typed nulls for missing ones;
    a null subset becomes ``unknown``.  Casts are strict: a value that does not
    fit is an error under ANSI mode."""
    cells = []
    for name, kind in wanted.items():
        source = field(df.schema, name)
        value = F.lit(None).cast(kind) if source is None else source.cast(kind)
        cells.append((F.coalesce(value, F.lit("unknown")) if name == "subset" else value).alias(name))
    return df.select(*[F.col(f"`{c}`") for c in keep], *cells)


def count_by_category(df: DataFrame, column: str = "quality_category") -> DataFrame:
    """(category, n) for each category that has rows."""
    return df.groupBy(F.col(column).alias("category")).agg(F.count("*").alias("n"))


def counts_with_total(df: DataFrame, column: str = "quality_category") -> DataFrame:
    """(category, n) for all categories, empty ones with 0, and TOTAL; other names as they occur.

    The data are read once; what is added up afterwards has a row a category.
    """
    names = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, CATEGORIES))).alias("category"), F.lit(0).cast("bigint").alias("n"))
    rows = count_by_category(df, column).unionByName(names)
    return rows.rollup("category").agg(F.sum("n").alias("n"), F.grouping("category").alias("_all")).select(
        F.when(F.col("_all") == 1, "TOTAL").otherwise(F.col("category")).alias("category"), "n"
    )


def write_categories(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One pass that writes each category to ``category=<name>`` below path, at most
    rows_per_file rows a file.  The category column stays in the files too.
    Categories without rows get an empty folder."""
    from ..sources import storage

    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be positive")
    (
        df.withColumn("category", F.col("quality_category"))
        .write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).option("compression", "zstd")
        .partitionBy("category").parquet(path)
    )
    for name in CATEGORIES:
        storage.make_folder(f"{path}/category={name}")


def write_counts(df: DataFrame, path: str, column: str = "quality_category") -> dict:
    """The counts as a JSON file, {"per_subdir": {...}, "TOTAL": n}, and as a result."""
    from ..sources import storage

    rows = {r["category"]: r["n"] for r in counts_with_total(df, column).collect()}  # one row a category
    total = rows.pop("TOTAL")
    out = {"per_subdir": dict(sorted((k or "", n) for k, n in rows.items())), "TOTAL": total}
    storage.write_text(path, json.dumps(out, indent=2))
    return out
