"""Exact ranks and cumulative sums that need no single-task sort.

A window over a whole group sorts the group in one task; a third of all rows in
one group would then sit on one executor.  Here equal values are summed first
(a value shared by many rows becomes one row), each group is cut into buckets of
near-equal numbers of distinct values, the buckets are summed, and only the rows
of one bucket are sorted together.  The bucket bounds are approximate; the
cumulative sums are exact for any bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.lineage import broadcast_if_small, materialize
from .joins import spread_join

BUCKETS, MOST_BUCKETS = 128, 4096
BUCKET_ROWS = 1_000_000  # distinct values that a bucket should hold
BROADCAST_ROWS = 1_000  # groups whose bounds, and offsets, are broadcast; with more, the join shuffles


def cumulative(df: DataFrame, keys: list[str], value: str, weight: Column | None = None, buckets: int | None = None) -> DataFrame:
    """One row per (keys, value): ``n`` its weight, ``n_before`` the weight of
    smaller values of the group and ``n_group`` that of the whole group.

    ``value`` must be numeric and not null; weight defaults to one a row and
    must be of integral type for exact sums.  Null keys form a group.  An empty
    input gives no rows.  The number of buckets follows that of distinct values.
    """
    weight = F.lit(1).cast("bigint") if weight is None else weight
    agg = materialize(df.groupBy(*keys, value).agg(F.sum(weight).cast("bigint").alias("n")), "values")
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(BUCKETS, -(-agg.count() // BUCKET_ROWS)))  # counted from footers
    probs = [i / buckets for i in range(1, buckets)]
    bounds = agg.groupBy(*keys).agg(F.percentile_approx(value, probs, 20 * buckets).alias("_bounds"))
    agg = _join(agg, bounds, keys, value)
    agg = agg.withColumn("_bucket", F.size(F.filter("_bounds", lambda b: b < F.col(value)))).drop("_bounds")
    sums = agg.groupBy(*keys, "_bucket").agg(F.sum("n").alias("_sum"))
    group = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(1))
    offsets = sums.select(  # at most `buckets` rows a group
        *keys,
        "_bucket",
        F.coalesce(F.sum("_sum").over(group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(group).alias("n_group"),
    )
    inside = W.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    out = agg.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    out = _join(out, offsets, [*keys, "_bucket"], value)
    return out.select(*keys, value, "n", (F.col("_offset") + F.col("_inside")).alias("n_before"), "n_group")


def _join(left: DataFrame, right: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Inner join on keys, nulls equal, with a side of one row a key: broadcast if it is small, else spread over parts of each key."""
    if not keys:
        keys, left, right = ["_all"], left.withColumn("_all", F.lit(1)), right.withColumn("_all", F.lit(1))
    small = broadcast_if_small(right, BROADCAST_ROWS)
    if small is right:
        return spread_join(left, right, keys, by=[by]).drop("_all")
    small = small.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in small.columns])
    on = None
    for c in keys:
        same = left[c].eqNullSafe(small[f"_r_{c}"])
        on = same if on is None else on & same
    return left.join(F.broadcast(small), on).drop(*[f"_r_{c}" for c in keys], "_all")


def numbered(df: DataFrame, *order: Column | str, name: str = "row_number") -> DataFrame:
    """df with each row's place from 0 in a total order, without a single-task sort.

    Rows are sorted by range; a row's place is its place in the range behind the
    rows of the ranges before.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = materialize(ranged.select("*", F.monotonically_increasing_id().alias("_at")), "ranged")
    part = F.shiftright("_at", 33)  # the id holds the partition above its 33 bits of place
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))  # one row a range
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    rows = ranged.withColumn("_part", part).join(F.broadcast(sizes), "_part")  # as many rows as shuffle partitions
    return rows.select(*[f"`{c}`" for c in df.columns], (F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name))
