"""Queries on quality buckets, categories and projections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..sources import parquet


def _classified(spark: SparkSession, folder: str) -> tuple[DataFrame, dict]:
    breaks = quality.breaks_of(spark.read.parquet(f"{folder}/score_breaks.parquet"))
    return spark.read.parquet(f"{folder}/classify.parquet"), breaks


def bucket_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, breaks = _classified(spark, folder)
    return quality.with_buckets(rows.select("row_id", *quality.SCORES), breaks).select("row_id", *quality.BUCKETS.values())


def bucket_scores_published(spark: SparkSession, folder: str) -> DataFrame:
    """Buckets under the published boundaries instead of the table's."""
    rows, _ = _classified(spark, folder)
    return quality.with_buckets(rows.select("row_id", *quality.SCORES)).select("row_id", *quality.BUCKETS.values())


def final_bucket_category(spark: SparkSession, folder: str) -> DataFrame:
    rows, breaks = _classified(spark, folder)
    return quality.classify(rows.select("row_id", *quality.SCORES), breaks).select("row_id", "final_bucket", "quality_category")


def classify_projection(spark: SparkSession, folder: str) -> DataFrame:
    """The typed columns; a NaN score, which no comparison finds equal to itself, is shown as null with a flag."""
    rows, _ = _classified(spark, folder)
    out = quality.project(rows, keep=["row_id"])
    for s in quality.SCORES:
        out = out.withColumn(f"{s}_is_nan", F.coalesce(F.isnan(s), F.lit(False))).withColumn(s, F.when(~F.isnan(s), F.col(s)))
    return out.toDF(*[c.replace(".", "_") for c in out.columns])


def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows, breaks = _classified(spark, folder)
    return quality.count_by_category(quality.classify(rows.select(*quality.SCORES), breaks))


def counts_with_total(spark: SparkSession, folder: str) -> DataFrame:
    rows, breaks = _classified(spark, folder)
    return quality.counts_with_total(quality.classify(rows.select(*quality.SCORES), breaks))


def per_category_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of each of the six categories; the filters exclude each other, so one pass serves all."""
    rows, breaks = _classified(spark, folder)
    found = quality.classify(rows.select("row_id", *quality.SCORES), breaks)
    return found.filter(F.col("quality_category").isin(quality.CATEGORIES)).select("row_id", "final_bucket", F.col("quality_category").alias("category"))


def hetero_union(spark: SparkSession, folder: str) -> DataFrame:
    """Classified records and documents of another schema under one projection."""
    rows, _ = _classified(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", F.struct(F.col("lang"), F.lit(None).cast("double").alias("lang_score")).alias("meta"))
    out = parquet.union_projected([rows, docs], {k: quality.PROJECTION[k] for k in ("text", "subset", "TopicClassifier", "fasttext_eli5_score", "meta.lang")})
    return out.withColumnRenamed("meta.lang", "meta_lang")


def _bucket_sql(score: str) -> str:
    return f"""CASE WHEN c.{score} IS NULL OR isnan(c.{score}) THEN 0
        ELSE (SELECT count(*) FROM score_breaks b WHERE b.score_name = '{score}' AND b.boundary < c.{score}) END"""


def _published_sql(score: str) -> str:
    terms = " + ".join(f"(c.{score} > CAST({b!r} AS DOUBLE))::INT" for b in quality.DEFAULT_BREAKS[score])
    return f"(CASE WHEN c.{score} IS NULL OR isnan(c.{score}) THEN 0 ELSE {terms} END)::INT AS {quality.BUCKETS[score]}"


_BUCKETED = "SELECT row_id, " + ", ".join(f"({_bucket_sql(s)})::INT AS {b}" for s, b in quality.BUCKETS.items()) + " FROM classify c"
_FINAL = f"""SELECT row_id, final_bucket, CASE WHEN final_bucket = 19 THEN 'High' WHEN final_bucket = 18 THEN 'Medium-High'
  WHEN final_bucket >= 12 THEN 'Medium' WHEN final_bucket >= 7 THEN 'Medium-Low' ELSE 'Low' END AS quality_category
  FROM (SELECT row_id, greatest({', '.join(quality.BUCKETS.values())}) AS final_bucket FROM ({_BUCKETED}))"""

ORACLE_SQL = {
    "bucket_scores": _BUCKETED,
    "bucket_scores_published": "SELECT row_id, " + ", ".join(map(_published_sql, quality.SCORES)) + " FROM classify c",
    "final_bucket_category": _FINAL,
    "classify_projection": """SELECT row_id, text, coalesce(subset, 'unknown') AS subset, FormatClassifier, TopicClassifier,
        CASE WHEN NOT isnan(fineweb_edu_classifier_score) THEN fineweb_edu_classifier_score END AS fineweb_edu_classifier_score,
        CASE WHEN NOT isnan(fasttext_eli5_score) THEN fasttext_eli5_score END AS fasttext_eli5_score,
        CASE WHEN NOT isnan(fasttext_preselect_score) THEN fasttext_preselect_score END AS fasttext_preselect_score,
        coalesce(isnan(fineweb_edu_classifier_score), false) AS fineweb_edu_classifier_score_is_nan,
        coalesce(isnan(fasttext_eli5_score), false) AS fasttext_eli5_score_is_nan,
        coalesce(isnan(fasttext_preselect_score), false) AS fasttext_preselect_score_is_nan, jais_token_count, "meta.token_count" AS meta_token_count, "meta.lang" AS meta_lang,
        "meta.lang_score" AS meta_lang_score FROM classify""",
    "category_counts": f"SELECT quality_category AS category, count(*) AS n FROM ({_FINAL}) GROUP BY 1",
    "counts_with_total": f"""WITH f AS ({_FINAL}), names(category) AS (VALUES ('High'), ('Medium-High'), ('Medium'), ('Medium-Low'), ('Low'), ('Unknown'))
        SELECT category, (SELECT count(*) FROM f WHERE quality_category = category) AS n FROM names UNION ALL SELECT 'TOTAL', count(*) FROM f""",
    "per_category_filter": f"SELECT row_id, final_bucket, quality_category AS category FROM ({_FINAL})",
    "hetero_union": """SELECT text, coalesce(subset, 'unknown') AS subset, TopicClassifier, fasttext_eli5_score, "meta.lang" AS meta_lang FROM classify
        UNION ALL SELECT text, 'unknown', NULL, NULL, lang FROM documents""",
}

QUERIES = {
    f.__name__: f
    for f in (
        bucket_scores, bucket_scores_published, final_bucket_category, classify_projection, category_counts, counts_with_total, per_category_filter, hetero_union,
    )
}
