"""Counting, coverage, reconciliation and distribution tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def decision_counts(df: DataFrame, group: str, decision: str, labels: list[str]) -> DataFrame:
    """Rows and rows per decision for each group."""
    return df.groupBy(group).agg(
        F.count("*").alias("raw"), *[F.count_if(F.col(decision) == x).alias(x) for x in labels]
    )


def coverage(dimension: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """One row per dimension member with a count from each part; members without rows show 0.

    Every part is counted per key before it is joined, so each join is one row to one row.
    """
    out = dimension
    for name, part in parts.items():
        out = out.join(part.groupBy(key).agg(F.count("*").alias(name)), key, "left")
    return out.fillna(0, list(parts))


def percent_of(n: Column, total: Column, digits: int = 2) -> Column:
    """Share in percent, 0 when there is nothing to divide by."""
    return F.when(total > 0, F.round(n / total * 100, digits)).otherwise(F.lit(0.0))


def reconciliation(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Counts with share of the total and whether the parts add up to it."""
    names = list(parts)
    wide = df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in parts.items()])
    balanced = sum((F.col(n) for n in names), F.lit(0)) == F.col("total")
    rows = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("n")) for n in ["total", *names]])
    return wide.select(F.explode(rows).alias("r"), "total", balanced.alias("balanced")).select(
        "r.metric", F.col("r.n").alias("n"), percent_of(F.col("r.n"), F.col("total")).alias("pct"), "balanced"
    )


def source_overlap(df: DataFrame, key: str, is_a: Column, is_b: Column) -> DataFrame:
    """How many keys have rows of both kinds, only of the first, or only of the second."""
    per_key = df.groupBy(key).agg(F.bool_or(is_a).alias("a"), F.bool_or(is_b).alias("b"), F.count("*").alias("size"))
    kind = F.when(F.col("a") & F.col("b"), F.lit("both")).when(F.col("a"), F.lit("only_a")).when(
        F.col("b"), F.lit("only_b")).otherwise(F.lit("neither"))
    return per_key.groupBy(kind.alias("overlap")).agg(
        F.count("*").alias("n_keys"), F.max("size").alias("largest"))


def flag_summary(df: DataFrame, group: str, flags: list[str], score: str) -> DataFrame:
    """Count, sum of each flag and mean score per group."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"), *[F.sum(F.col(f).cast("bigint")).alias(f) for f in flags],
        F.round(F.avg(score), 6).alias("mean_score"),
    )


def rates(df: DataFrame, group: str, flags: dict[str, Column]) -> DataFrame:
    """Share of rows per group that meet each condition."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"), *[F.round(F.avg(F.coalesce(c, F.lit(False)).cast("double")), 6).alias(n) for n, c in flags.items()]
    )


def element_counts(df: DataFrame, elements: Column, label: str) -> DataFrame:
    """How often each element of a list column occurs."""
    return df.select(F.explode(elements).alias(label)).groupBy(label).agg(F.count("*").alias("n"))


def crosstab(df: DataFrame, row: Column, column: str, values: list[str]) -> DataFrame:
    """Counts of row label by column value; a missing label is shown as 'unknown'."""
    return df.groupBy(F.coalesce(row, F.lit("unknown")).alias("label")).pivot(column, values).count().fillna(0, values)


def stacked_counts(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Counts per value of each single dimension plus the grand total, in one pass."""
    sets = [[d] for d in dimensions] + [[]]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *dimensions).agg(
        F.count("*").alias("n"), *[F.grouping(d).alias(f"_g_{d}") for d in dimensions])
    dim, val = F.lit("total"), F.lit("total")
    for d in reversed(dimensions):
        dim = F.when(F.col(f"_g_{d}") == 0, F.lit(d)).otherwise(dim)
        val = F.when(F.col(f"_g_{d}") == 0, F.col(d).cast("string")).otherwise(val)
    return grouped.select(dim.alias("dimension"), val.alias("value"), "n")


def missing_counts(df: DataFrame, fields: list[str]) -> DataFrame:
    """Missing values per field with their share; blank text counts as missing."""
    def gone(c: str) -> Column:
        return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")

    wide = df.agg(F.count("*").alias("total"), *[F.count_if(gone(c)).alias(c) for c in fields])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("missing")) for c in fields])
    return wide.select("total", F.explode(rows).alias("r")).select(
        "r.field", "r.missing", percent_of(F.col("r.missing"), F.col("total")).alias("pct"))


def missing_list(fields: list[str]) -> Column:
    """Comma-separated names of the fields a row lacks."""
    gone = [F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), F.lit(c)) for c in fields]
    return F.array_join(F.filter(F.array(*gone), lambda x: x.isNotNull()), ", ")


def distribution(df: DataFrame, segment: Column, name: str) -> DataFrame:
    """Counts and percentages of a segment; the total is a scalar subquery, not a global window."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return df.groupBy(segment.alias(name)).agg(F.count("*").alias("n")).withColumn(
        "pct", percent_of(F.col("n"), total))


def group_stats(dimension: DataFrame, key: str, facts: DataFrame, value: str) -> DataFrame:
    """Count, mean, minimum and maximum per dimension member, members without facts included."""
    stats = facts.groupBy(key).agg(
        F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    return dimension.join(stats, key, "left").fillna(0, ["n"])
