"""Ranking, top-k, keep-first and numbering.

All per-group picks are written as `row_number() <= constant`. Spark turns that
into a partial limit before the shuffle, so a group that holds a third of all
rows sends only k rows per input task to the one task that finishes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

RN = "_rn"


def top_n(df: DataFrame, keys: list, order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """First n rows per key in the given total order, optionally with their rank."""
    w = W.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank or RN, F.row_number().over(w)).filter(F.col(rank or RN) <= n)
    return ranked if rank else ranked.drop(RN)


def keep_first(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_n(df, keys, order, 1)


def newest(df: DataFrame, keys: list, collected: str, tie: str) -> DataFrame:
    """Newest row per key; equal times keep the earlier input row."""
    return keep_first(df, keys, [F.col(collected).desc_nulls_last(), F.col(tie).asc()])


def top_n_by_target(df: DataFrame, keys: list, order: list[Column], target: Column, largest: int, rank: str) -> DataFrame:
    """First `target` rows per key, where the target varies by row but never exceeds `largest`."""
    return top_n(df, keys, order, largest, rank).filter(F.col(rank) <= target)


def arrival_quota(df: DataFrame, group: str, bucket: str, arrival: str, text: str, quotas: dict[str, int]) -> DataFrame:
    """First rows of each bucket in arrival order; rows without text use up quota and are then dropped."""
    quota = F.coalesce(*[F.when(F.col(bucket) == b, F.lit(q)) for b, q in quotas.items()])
    kept = top_n_by_target(df, [group, bucket], [F.col(arrival).asc()], quota, max(quotas.values()), "quota_rank")
    return kept.filter(F.coalesce(F.col(text), F.lit("")) != "")


def hash_numbered(df: DataFrame, groups: list, order_hash: str, tie: str, name: str, bits: int = 10) -> DataFrame:
    """Dense numbering within groups in order of a 64-bit hash, without one task per group.

    The top bits of the hash cut every group into 2**bits ordered slices of
    equal expected size; a slice is numbered on its own and shifted by the rows
    of the slices before it. The offsets table has one row per group and slice.
    """
    cut = F.shiftright(F.col(order_hash), 64 - bits)
    sliced = df.withColumn("_slice", cut)
    return _numbered_by_slice(sliced, groups, [F.col(order_hash), F.col(tie)], name)


def ordered_numbered(df: DataFrame, key: str, name: str, slices: int = 64) -> DataFrame:
    """Dense numbering of a whole table by a unique key, range-sliced instead of sorted in one task.

    Slice bounds come from a small sample of the key (at most a few thousand
    values reach the driver); they steer balance only, never the result.
    """
    total = df.count()
    share = min(1.0, 2048.0 / max(total, 1))
    sample = sorted(r[0] for r in df.select(key).sample(False, share, 7).limit(8192).collect() if r[0] is not None)
    step = max(1, len(sample) // slices)
    bounds = sample[step::step]
    cut = F.lit(0)
    if bounds:
        cut = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key)))
    return _numbered_by_slice(df.withColumn("_slice", cut), [], [F.col(key)], name)


def _numbered_by_slice(sliced: DataFrame, groups: list, order: list[Column], name: str) -> DataFrame:
    sizes = sliced.groupBy(*groups, "_slice").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*(groups or [F.lit(0)])).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = sliced.withColumn(RN, F.row_number().over(W.partitionBy(*groups, "_slice").orderBy(*order)))
    return (
        local.join(offsets, [*groups, "_slice"])
        .withColumn(name, (F.col(RN) + F.col("_before")).cast("bigint"))
        .drop(RN, "_before", "_slice")
    )
