"""Mixing sources to target shares of the total size.

Each source's documents, in a fixed random order, are laid end to end along an
axis of tokens, pass after pass up to the cap on repeats.  A source is used up to
its demand: its share of the mix's total.  Training positions follow a schedule
in which a source's weight changes over time t from 0 to 1,

    weight(t) = share * (1 + tilt * (2 t - 1)),

so it has used share * (t + tilt * (t * t - t)) by t.  A document's position is
the t at which its source has used the tokens before it (the integral inverted
in closed form), its end the t at which it is used up too, and the mix is sorted
by range of position.  A source whose last end lies before 1 falls short; its
positions are then stretched over the whole schedule.  The tilts of a mix
sum to 0 weighted by share, so the weights add up to 1 at every time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import cumulative
from ..plans.lineage import broadcast_if_small, materialize

TILT = 0.5  # how strongly sources that are repeated move to the end; 0 keeps all weights constant
ROUNDING = 1e-9  # of ends in the schedule


def draws(sized: DataFrame, targets: DataFrame, tilt: float = TILT, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(drawn, plan) for documents (key, source, n_tokens) and mix targets.

    drawn: (mix_id, key, source, pass, n_tokens, position, end), one row per use.
    plan: one row per mix and source with its demand in tokens.  Rows of one key
    and source share a position.  Documents of size 0 and without a source are never drawn.  The last
    document drawn of a source crosses its demand; it is used whole.
    """
    sized = materialize(sized.select(key, "source", "n_tokens"), "sized")
    total = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()["t"]  # one number
    usable = sized.filter("source is not null and n_tokens > 0").withColumn("_order", F.xxhash64(key))
    laid = cumulative(usable, ["source"], "_order", F.col("n_tokens"))  # xxhash64 of one bigint has no collisions
    laid = usable.join(laid.select("source", "_order", "n_before", F.col("n").alias("_n")), ["source", "_order"])
    own = sized.groupBy("source").agg(F.sum("n_tokens").alias("available")).withColumnRenamed("source", "_source")
    plan = targets.join(own, targets["source"] == own["_source"], "left").select(
        "mix_id", "source", "target_share", "max_repeats", "total_multiple",
        F.coalesce("available", F.lit(0)).alias("available"),
        (F.col("target_share").cast("decimal(14,10)") * F.col("total_multiple").cast("decimal(10,6)") * F.lit(total).cast("decimal(18,0)")).alias("demand"),
    )
    plan = plan.withColumn("_late", F.when(F.col("demand") > F.col("available"), 1.0).otherwise(0.0))
    late = plan.groupBy("mix_id").agg((F.sum(F.col("target_share") * F.col("_late")) / F.sum("target_share")).alias("_mean"))
    plan = plan.join(late, "mix_id").withColumn("tilt", tilt * (F.col("_late") - F.col("_mean"))).drop("_late", "_mean")
    steps = plan.filter("available > 0 and demand > 0").select(
        "mix_id", "source", "available", "tilt", F.col("demand").cast("double").alias("_demand"),
        F.explode(F.sequence(F.lit(0), F.least(F.col("max_repeats"), F.ceil(F.col("demand") / F.col("available"))).cast("int") - 1)).alias("pass"),
        "demand", "max_repeats",
    ).filter("max_repeats > 0")
    drawn = laid.join(broadcast_if_small(steps), "source").withColumn("_start", F.col("pass") * F.col("available") + F.col("n_before"))
    drawn = drawn.filter(F.col("_start") < F.col("demand"))
    rest = 1 - F.col("tilt")

    def reached(tokens: Column) -> Column:
        """The t at which a source has used so many tokens, by the integral of its schedule."""
        used = tokens.cast("double") / F.col("_demand")
        return 2 * used / (rest + F.sqrt(F.greatest(F.lit(0.0), rest * rest + 4 * F.col("tilt") * used)))

    places = [reached(F.col("_start")).alias("position"), reached(F.col("_start") + F.col("_n")).alias("end")]
    return drawn.select("mix_id", key, "source", "pass", "n_tokens", *places), plan


def ordered(drawn: DataFrame, found: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """The drawn documents in training order, sorted by range of (mix, position).

    Given the shares, the positions of a source that falls short are stretched to
    fill the schedule; else it runs out early.
    """
    if found is None:
        return drawn.drop("end").orderBy("mix_id", "position", key, "pass")
    until = broadcast_if_small(found.filter("short and until > 0").select("mix_id", "source", "until"))
    out = drawn.join(until, ["mix_id", "source"], "left").withColumn("position", F.col("position") / F.coalesce("until", F.lit(1.0)))
    return out.select("mix_id", key, "source", "pass", "n_tokens", "position").orderBy("mix_id", "position", key, "pass")


def shares(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """(mix_id, source, target_share, demand, reached, reached_share, documents, passes, until, short).

    until is the end of the source's last use in the schedule, 0 without any.
    short says that the schedule isn't filled up to 1: all documents, used as
    often as allowed, don't reach the demand, be it that the source has none.
    An end so near to 1 that it may be rounded is judged by the exact token sums.
    """
    got = drawn.groupBy("mix_id", "source").agg(
        F.sum("n_tokens").alias("reached"), F.count("*").alias("documents"), (F.max("pass") + 1).alias("passes"), F.max("end").alias("until")
    )
    out = plan.join(got, ["mix_id", "source"], "left").fillna(0, ["reached", "documents", "passes", "until"])
    whole = out.groupBy("mix_id").agg(F.sum("reached").alias("_whole"))
    return out.join(whole, "mix_id").select(
        "mix_id", "source", "target_share", "demand", "reached",
        F.try_divide(F.col("reached").cast("double"), F.col("_whole").cast("double")).alias("reached_share"), "documents", "passes", "until",
        ((F.col("until") < 1 + ROUNDING) & (F.col("reached") < F.col("demand"))).alias("short"),
    )
