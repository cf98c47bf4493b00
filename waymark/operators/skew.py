"""Joins of many rows to one row per key, and joins of two large sides."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_one_per_key(facts: DataFrame, per_key: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join many-row facts to a table with one row per key (inner or left).

    One plain join: Spark broadcasts the side only while its size is below the session's limit, and otherwise splits the
    partitions of hot keys, and of rows without a key, among tasks (adaptive skew join; the facts are the side that is split).
    Nothing runs while the query is built.
    """
    values = [c for c in per_key.columns if c != key]
    side = per_key.select(F.col(key).alias("_side_key"), F.struct(*values).alias("_side"))
    return facts.join(side, F.col(key) == F.col("_side_key"), how).select(*facts.columns, *[F.col("_side")[v].alias(v) for v in values])


def join_shuffled(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join of two sides that both grow with the input, always by a shuffle.

    Spark's size of a side is the size of the files below it: it knows nothing of what `explode` adds, and Parquet of regular
    keys is much smaller than its rows. Left alone it would send such a side whole through the driver.
    """
    return left.join(right.hint("merge"), on, how)
