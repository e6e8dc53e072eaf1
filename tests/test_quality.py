import math

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltstone.operators import quality


def buckets(spark, values, boundaries, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v").cast(kind).alias("v"))
    return [r[0] for r in df.select(quality.bucket(F.col("v"), boundaries)).collect()]


def test_edges(spark):
    for boundaries in quality.DEFAULT_BREAKS.values():
        values = [b for x in boundaries for b in (math.nextafter(x, -math.inf), x, math.nextafter(x, math.inf))]
        assert buckets(spark, values, boundaries) == [sum(v > b for b in boundaries) for v in values]
        assert buckets(spark, [math.nan, None, math.inf, -math.inf], boundaries) == [0, 0, 19, 0]


def test_float_scores_compare_as_doubles(spark):
    assert buckets(spark, [0.1], [0.1 + i for i in range(19)], "float") == [1]


def test_categories(spark):
    rows = spark.range(-1, 21).select("id", quality.category(F.col("id").cast("int")).alias("c")).collect()
    names = {r["id"]: r["c"] for r in rows}
    assert [names[i] for i in (0, 6, 7, 11, 12, 17, 18, 19, 20)] == ["Low", "Low", "Medium-Low", "Medium-Low", "Medium", "Medium", "Medium-High", "High", "Unknown"]


def test_all_null_row_is_low(spark):
    row = quality.classify(spark.sql("SELECT cast(null AS double) AS fasttext_eli5_score")).first()
    assert row["final_bucket"] == 0 and row["quality_category"] == "Low"


@pytest.mark.parametrize("bad", [[1.0] * 19, list(range(18)), list(range(19, 0, -1)), [math.nan] * 19])
def test_bad_boundaries(bad):
    with pytest.raises(ValueError):
        quality.checked("x", bad)


@given(st.lists(st.floats(allow_nan=False), min_size=19, max_size=19, unique=True))
def test_increasing_boundaries_pass(values):
    assert quality.checked("x", sorted(values)) == sorted(values)


def test_projection(spark):
    df = spark.sql("SELECT 'a' AS text, named_struct('lang', 'en', 'x', 1) AS meta, 1 AS `meta.token_count`, cast(null AS string) AS subset, 5 AS extra")
    out = quality.project(df)
    assert out.dtypes == [(k, v) for k, v in quality.PROJECTION.items()]
    row = out.first()
    assert (row["subset"], row["meta.lang"], row["meta.token_count"], row["TopicClassifier"]) == ("unknown", "en", 1, None)


def test_strict_cast(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality.project(spark.sql("SELECT 'abc' AS jais_token_count")).collect()


def test_write_and_count(spark, tmp_path):
    df = quality.classify(spark.range(130).select((F.col("id") / 40).alias("fineweb_edu_classifier_score")))
    quality.write_categories(df, str(tmp_path / "out"), 20)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 130 and "quality_category" in back.columns
    counts = quality.write_counts(back, str(tmp_path / "counts.json"))
    assert counts["TOTAL"] == 130 and counts["per_subdir"]["Unknown"] == 0
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        quality.write_categories(df, str(tmp_path / "out"))


def test_empty_table_counts(spark):
    df = spark.createDataFrame([], "quality_category string")
    assert {r["category"]: r["n"] for r in quality.counts_with_total(df).collect()} == {c: 0 for c in [*quality.CATEGORIES, "TOTAL"]}
