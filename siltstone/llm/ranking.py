"""One ranking from several scores, and cutoffs that keep a target fraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import hot_join
from ..operators.ranking import cumulative
from ..plans.lineage import broadcast_if_small, materialize

SCORES = ["fineweb_edu_classifier_score", "fasttext_eli5_score", "fasttext_preselect_score"]
UNKNOWN = "unknown"
HOT = 1000  # a value that more than 1 / HOT of the records share is joined by broadcast


def _sound(column: str) -> F.Column:
    """The score as double; null where it is null or NaN."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value), value)


def scored_records(records: DataFrame, key: str = "record_id", scores: list[str] = SCORES) -> DataFrame:
    """(_key, _s0, _s1, ...): one row per record with its sound scores; of repeated rows that differ the highest counts."""
    rows = records.select(F.col(key).alias("_key"), *[_sound(s).alias(f"_s{i}") for i, s in enumerate(scores)])
    return materialize(rows.groupBy("_key").agg(*[F.max(f"_s{i}").alias(f"_s{i}") for i in range(len(scores))]), "records")


def _long(rows: DataFrame, scores: list[str]) -> DataFrame:
    """(_key, score_name, value) of rows of scored_records."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("score_name"), F.col(f"_s{i}").alias("value")) for i, s in enumerate(scores)]))
    return rows.select("_key", pairs.alias("p")).select("_key", "p.score_name", "p.value")


def percentiles(rows: DataFrame, scores: list[str] = SCORES) -> DataFrame:
    """(score_name, value, share, n, n_group): place of each score value among the records of scored_records.

    Null and NaN scores don't count.  The share is the mid-rank (smaller records
    plus half of the equal ones) over the records that have the score, so a value
    at which a classifier got stuck has the middle of its ties, and scale or
    range of a score don't matter.
    """
    return cumulative(_long(rows, scores).filter("value is not null"), ["score_name"], "value").select(
        "score_name", "value", ((F.col("n_before") + F.col("n") / 2) / F.col("n_group")).alias("share"), "n", "n_group"
    )


def leximin_vectors(records: DataFrame, wanted: DataFrame | None = None, key: str = "record_id", scores: list[str] = SCORES) -> DataFrame:
    """(key, vector) for each record, or for each key of `wanted` that `records` has.

    The vector holds the percentiles of the scores in ascending order, null and
    NaN as 0.  Vectors compare lexicographically: the weakest score decides
    first, so a strong score can't mask it.  Null keys are one record without `wanted`.
    """
    every = scored_records(records, key, scores)
    shares = materialize(percentiles(every, scores), "shares")
    rows = every
    if wanted is not None:
        rows = every.join(wanted.select(F.col(key).alias("_key")).filter("_key is not null").distinct(), "_key", "left_semi")
    # A value shared by more than 1 / HOT of the records of its score is hot: at most HOT values a score.
    placed = hot_join(_long(rows, scores), shares, ["score_name", "value"], f"n * {HOT} > n_group", by=["_key"])
    placed = placed.select("_key", F.coalesce("share", F.lit(0.0)).alias("share"))
    return placed.groupBy("_key").agg(F.sort_array(F.collect_list("share")).alias("vector")).withColumnRenamed("_key", key)


def best_of_lists(records: DataFrame, lists: DataFrame, list_key: str = "list_id", key: str = "record_id", scores: list[str] = SCORES) -> DataFrame:
    """(list_key, key): the leximin-best record of each list; ties go to the smallest key.

    Lists or records that are null, and listed records without a row, don't
    take part; a list without any is left out.  The aggregation keeps one record
    per list and task, so lists of any length are fine.
    """
    lists = lists.select(list_key, key).filter(F.col(list_key).isNotNull() & F.col(key).isNotNull()).distinct()
    vectors = leximin_vectors(records, lists, key, scores)
    best = lists.join(vectors, key).groupBy(list_key).agg(F.max(F.struct("vector", (-F.col(key)).alias("_first"))).alias("b"))
    return best.select(list_key, (-F.col("b._first")).alias(key))


def ranking(records: DataFrame, key: str = "record_id", scores: list[str] = SCORES) -> DataFrame:
    """(key, vector, position): all records in leximin order, best first.

    Records of equal vectors share the position of the first of them.
    """
    ranked = leximin_vectors(records, None, key, scores).filter(F.col(key).isNotNull()).withColumn("n_before", F.lit(0).cast("bigint"))
    done = []
    for level in range(1, len(scores) + 1):
        # Among records of equal vectors up to here; alone in its place, a record needs no further comparison.
        ranked = materialize(ranked.withColumn("_next", -F.element_at("vector", level)), "ties")
        limit = ranked.count() // HOT  # so that at most HOT places are hot
        steps = cumulative(ranked.select(F.col("n_before").alias("_base"), "_next"), ["_base"], "_next")
        steps = materialize(steps.select(F.col("_base").alias("n_before"), "_next", "n", F.col("n_before").alias("more")), "places")
        ranked = hot_join(ranked, steps, ["n_before", "_next"], f"n > {limit}", by=[key])
        ranked = materialize(ranked.select(key, "vector", (F.col("n_before") + F.col("more")).alias("n_before"), F.col("n").alias("_tied")), "ranked")
        done.append(ranked.filter("_tied = 1"))
        ranked = ranked.filter("_tied > 1").drop("_tied")
    out = reduce(DataFrame.union, [d.drop("_tied") for d in done], ranked)
    return out.select(key, "vector", (F.col("n_before") + 1).alias("position"))


def cutoffs(records: DataFrame, targets: DataFrame, key: str = "record_id", subset: str = "subset") -> DataFrame:
    """Cutoff of each target: (target_id, subset, score_name, target_fraction,
    n_counted, cutoff, n_kept).

    The records of the target's subset (null means unknown) with a score that is
    neither null nor NaN count, each once.  The cutoff is the highest score such
    that the records at or above it are at least target_fraction of them; equal
    scores are kept or dropped together.  The target count is compared as a
    decimal, so 0.1 of 30 is 3.  Targets without any such record have a null
    cutoff and keep none; unknown score names count as such.
    """
    return _cutoffs(_scored(records, targets, key, subset), targets)[1]


def kept(records: DataFrame, targets: DataFrame, key: str = "record_id", subset: str = "subset") -> DataFrame:
    """(target_id, key) of the records at or above the cutoff of each target."""
    scored, limits = _cutoffs(_scored(records, targets, key, subset), targets)
    limits = limits.select("target_id", "cutoff").filter("cutoff is not null")
    return scored.join(broadcast_if_small(limits), "target_id").filter("value >= cutoff").select("target_id", F.col("_key").alias(key))


def _scored(records: DataFrame, targets: DataFrame, key: str, subset: str) -> DataFrame:
    """(target_id, _key, value), one row per counted record of each target."""
    known = [s for s in SCORES if s in records.columns]
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("score_name"), _sound(s).alias("value")) for s in known]))
    group = lambda c: F.coalesce(c, F.lit(UNKNOWN))
    wanted = targets.select("target_id", group(F.col("subset")).alias("_subset"), "score_name").distinct()
    long = records.select(F.col(key).alias("_key"), group(F.col(subset)).alias("_subset"), pairs.alias("p"))
    long = long.select("_key", "_subset", "p.score_name", "p.value").filter("value is not null")
    joined = long.join(broadcast_if_small(wanted), ["_subset", "score_name"]).select("target_id", "_key", "value")
    # A target with a third of all rows is spread by record, not by target.
    return joined.dropDuplicates(["target_id", "_key", "value"])


def _cutoffs(scored: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    scored = materialize(scored, "scored")
    # Summed from the smallest: those at or above a value are the group without those before it.
    steps = cumulative(scored, ["target_id"], "value").withColumn("n_from", F.col("n_group") - F.col("n_before"))
    goals = targets.select("target_id", F.col("target_fraction").cast("decimal(20,12)").alias("_goal"))
    enough = steps.join(broadcast_if_small(goals), "target_id").filter(F.col("n_from").cast("decimal(20,0)") >= F.col("_goal") * F.col("n_group").cast("decimal(18,0)"))
    cut = enough.groupBy("target_id").agg(F.max("value").alias("cutoff"), F.min("n_from").alias("n_kept"), F.max("n_group").alias("n_counted"))
    report = targets.join(cut, "target_id", "left").select(
        "target_id", F.coalesce("subset", F.lit(UNKNOWN)).alias("subset"), "score_name", "target_fraction",
        F.coalesce("n_counted", F.lit(0)).alias("n_counted"), "cutoff", F.coalesce("n_kept", F.lit(0)).alias("n_kept"),
    )
    return scored, report
