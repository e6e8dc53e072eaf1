"""Equi-joins in which one key may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTS = 16


def spread_join(big: DataFrame, small: DataFrame, keys: list[str], by: list[str], how: str = "inner", parts: int = PARTS) -> DataFrame:
    """big joined with a small side of few rows a key; null keys are equal.

    The rows of each key of big are cut into `parts` by a hash of its columns `by`,
    and small is repeated for each part, so the largest task of the shuffle has one
    part of a hot key.  how is inner or left; big's columns come first.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    left = big.withColumn("_part", F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int"))
    right = small.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in small.columns])
    right = right.withColumn("_r__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    on = [left["_part"] == right["_r__part"], *[left[c].eqNullSafe(right[f"_r_{c}"]) for c in keys]]
    return left.join(right, on, how).drop("_part", "_r__part", *[f"_r_{c}" for c in keys])


def hot_join(big: DataFrame, small: DataFrame, keys: list[str], hot: str, by: list[str], parts: int = 1024) -> DataFrame:
    """Left join of big with a side of one row a key, of which few keys are hot.

    The rows of small under the condition `hot` must be bounded in number; they
    are broadcast.  The rows of big that they match, or that have a null key, are
    spread by a hash of `by` in the shuffle for the other keys, which they can't match.
    """
    rest = [c for c in small.columns if c not in keys]
    named = small.select(*[F.col(f"`{c}`").alias(f"_k_{c}") for c in keys], *[F.col(f"`{c}`").alias(f"_v_{c}") for c in rest], F.coalesce(F.expr(hot), F.lit(False)).alias("_hot"))
    common = named.filter("_hot").select([F.col(c).alias(f"_h{c}") for c in named.columns])
    out = big.join(F.broadcast(common), [big[c] == common[f"_h_k_{c}"] for c in keys], "left")
    settled = F.col("_h_hot").isNotNull()
    for c in keys:
        settled = settled | F.col(c).isNull()
    out = out.withColumn("_spread", F.when(settled, 1 + F.pmod(F.xxhash64(*by), F.lit(parts))).otherwise(F.lit(0)))
    rare = named.filter("not _hot").withColumn("_r_spread", F.lit(0).cast("bigint"))
    out = out.join(rare, [out["_spread"] == rare["_r_spread"], *[out[c] == rare[f"_k_{c}"] for c in keys]], "left")
    return out.select(*[big[c] for c in big.columns], *[F.coalesce(f"_h_v_{c}", f"_v_{c}").alias(c) for c in rest])
