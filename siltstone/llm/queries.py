"""Queries of the language-model operators over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import materialize
from . import language, mixing, ranking, tokens, topics, truncation


MAX_SUBJECTS = 1000  # a model has a column a subject; more are an error


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _subject_ids(spark: SparkSession, folder: str) -> list[int]:
    names = _table(spark, folder, "class_names").filter("classifier = 'TopicClassifier' and class_id is not null")
    rows = names.select("class_id").distinct().limit(MAX_SUBJECTS + 1).collect()
    if len(rows) > MAX_SUBJECTS:
        raise ValueError(f"there are more than {MAX_SUBJECTS} subject areas")
    return sorted(r["class_id"] for r in rows)


def _mixtures(spark: SparkSession, folder: str) -> DataFrame:
    records = _table(spark, folder, "classify").select("record_id", "text", "TopicClassifier")
    areas = _subject_ids(spark, folder)
    factor = topics.fit(records, _table(spark, folder, "topic_labels"), areas)
    return topics.mixtures(records, factor, areas)


def p2_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Subjects of each record with the number of sentences about each and its weight."""
    return _mixtures(spark, folder).distinct()  # repeated rows have equal texts and so equal mixtures


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return topics.subjects(_mixtures(spark, folder))


def p2_composition(spark: SparkSession, folder: str) -> DataFrame:
    """Number of records and their subject weight by subject area, for the whole corpus."""
    mixture = p2_mixture(spark, folder).filter(F.col("sentences") >= topics.MIN_SENTENCES)
    return mixture.groupBy("topic_id").agg(F.count("*").alias("records"), F.sum("weight").alias("weight"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    counted = materialize(tokens.record_counts(_table(spark, folder, "classify")), "counted")
    return tokens.wrong_counts(counted).select("record_id").distinct()


def p3_budget(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.budget(materialize(tokens.record_counts(_table(spark, folder, "classify")), "counted"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.best_of_lists(_table(spark, folder, "classify"), _table(spark, folder, "review_lists"))


def p4_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """All records in leximin order of their score percentiles."""
    return ranking.ranking(_table(spark, folder, "classify"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.kept(_table(spark, folder, "classify"), _table(spark, folder, "keep_targets"))


def p5_cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.cutoffs(_table(spark, folder, "classify"), _table(spark, folder, "keep_targets"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    records = _table(spark, folder, "classify")
    return language.mislabelled(language.languages(records, language.fit(records)))


def p6_languages(spark: SparkSession, folder: str) -> DataFrame:
    """Language, confidence and all languages of each record."""
    records = _table(spark, folder, "classify")
    return language.languages(records, language.fit(records)).distinct()


def p6_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Language and confidence of each segment of each record's text."""
    records = _table(spark, folder, "classify")
    return language.segments(records, language.fit(records)).distinct()


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.ids(_table(spark, folder, "documents"))


def p7_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """The character of each text at which the slice of each id begins."""
    return tokens.ids(_table(spark, folder, "documents"), offsets=True).select("doc_id", "starts")


def _drawn(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    sized = tokens.counts(_table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixing.draws(sized, _table(spark, folder, "mix_targets"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(*_drawn(spark, folder)).filter("short").select("mix_id", "source")


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.shares(*_drawn(spark, folder))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of each mix with their training positions."""
    drawn, plan = _drawn(spark, folder)
    return mixing.ordered(drawn, mixing.shares(drawn, plan))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.verdicts(_table(spark, folder, "documents")).filter("cut").select("doc_id")


def p9_rates(spark: SparkSession, folder: str) -> DataFrame:
    """How many texts of each source are cut."""
    return truncation.rates(truncation.verdicts(_table(spark, folder, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        p2_found, p2_mixture, p2_composition, p3_found, p3_budget, p4_found, p4_ranking, p5_found, p5_cutoffs,
        p6_found, p6_languages, p6_segments, p7_ids, p7_offsets, p8_found, p8_shares, p8_mix, p9_found, p9_rates,
    )
}

# The cutoff of each target: the highest score that the target fraction reaches.
_KEPT = """
WITH records AS (
  SELECT record_id, coalesce(subset, 'unknown') AS subset,
         max(CASE WHEN NOT isnan(fineweb_edu_classifier_score) THEN fineweb_edu_classifier_score END) AS s0,
         max(CASE WHEN NOT isnan(fasttext_eli5_score) THEN fasttext_eli5_score END) AS s1,
         max(CASE WHEN NOT isnan(fasttext_preselect_score) THEN fasttext_preselect_score END) AS s2
  FROM classify GROUP BY 1, 2),
long AS (
  SELECT record_id, subset, 'fineweb_edu_classifier_score' AS score_name, s0 AS value FROM records WHERE s0 IS NOT NULL
  UNION ALL SELECT record_id, subset, 'fasttext_eli5_score', s1 FROM records WHERE s1 IS NOT NULL
  UNION ALL SELECT record_id, subset, 'fasttext_preselect_score', s2 FROM records WHERE s2 IS NOT NULL),
scored AS (
  SELECT t.target_id, l.record_id, l.value, CAST(t.target_fraction AS DECIMAL(20, 12)) AS goal,
         count(*) OVER (PARTITION BY t.target_id ORDER BY l.value DESC) AS n_from,
         count(*) OVER (PARTITION BY t.target_id) AS n_group
  FROM keep_targets t JOIN long l ON coalesce(t.subset, 'unknown') = l.subset AND t.score_name = l.score_name),
cut AS (
  SELECT target_id, max(value) AS cutoff, min(n_from) AS n_kept, max(n_group) AS n_counted
  FROM scored WHERE n_from >= goal * CAST(n_group AS DECIMAL(18, 0)) GROUP BY 1)
"""

_SHARES = """
WITH rows AS (
  SELECT record_id, max(CASE WHEN NOT isnan(fineweb_edu_classifier_score) THEN fineweb_edu_classifier_score END) AS s0,
         max(CASE WHEN NOT isnan(fasttext_eli5_score) THEN fasttext_eli5_score END) AS s1,
         max(CASE WHEN NOT isnan(fasttext_preselect_score) THEN fasttext_preselect_score END) AS s2
  FROM classify GROUP BY 1),
shares AS (
  SELECT record_id, list_sort([
    CASE WHEN s0 IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (PARTITION BY s0 IS NULL ORDER BY s0) - 1 + count(*) OVER (PARTITION BY s0) / 2) / count(*) OVER (PARTITION BY s0 IS NULL) END,
    CASE WHEN s1 IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (PARTITION BY s1 IS NULL ORDER BY s1) - 1 + count(*) OVER (PARTITION BY s1) / 2) / count(*) OVER (PARTITION BY s1 IS NULL) END,
    CASE WHEN s2 IS NULL THEN 0.0::DOUBLE ELSE (rank() OVER (PARTITION BY s2 IS NULL ORDER BY s2) - 1 + count(*) OVER (PARTITION BY s2) / 2) / count(*) OVER (PARTITION BY s2 IS NULL) END]) AS vector
  FROM rows)
"""

ORACLE_SQL = {
    "p5_found": _KEPT + "SELECT s.target_id, s.record_id FROM scored s JOIN cut c USING (target_id) WHERE s.value >= c.cutoff",
    "p5_cutoffs": _KEPT
    + """SELECT t.target_id, coalesce(t.subset, 'unknown') AS subset, t.score_name, t.target_fraction,
                coalesce(c.n_counted, 0) AS n_counted, c.cutoff, coalesce(c.n_kept, 0) AS n_kept
         FROM keep_targets t LEFT JOIN cut c USING (target_id)""",
    "p4_found": _SHARES
    + """SELECT list_id, record_id FROM (
           SELECT l.list_id, s.record_id, row_number() OVER (PARTITION BY l.list_id ORDER BY s.vector DESC, s.record_id) AS place
           FROM (SELECT DISTINCT list_id, record_id FROM review_lists) l JOIN shares s USING (record_id)) WHERE place = 1""",
    "p4_ranking": _SHARES + "SELECT record_id, vector, rank() OVER (ORDER BY vector DESC) AS position FROM shares",
}
