"""Audits that measure: validation rules, duplicates, join growth, nulls, drift and version comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions.rules import yes


def check_rules(df: DataFrame, key: str, rules: dict[str, Column], expected_rows: int | Column | None = None, strict: bool = False) -> DataFrame:
    """Violations per rule in one aggregation, with the lowest offending key as an example.

    A rule is the condition of a violation. Duplicate keys and, if given, the row count are checked too.
    `strict` raises when anything is violated; otherwise the table is the result.
    """
    names = list(rules)
    wide = df.agg(
        F.count("*").alias("_rows"), F.count_distinct(key).alias("_keys"),
        *[F.count_if(yes(c)).alias(n) for n, c in rules.items()],
        *[F.min(F.when(yes(c), F.col(key))).cast("string").alias(f"_e_{n}") for n, c in rules.items()])
    rows = [F.struct(F.lit("unique_key").alias("rule"), (F.col("_rows") - F.col("_keys")).alias("violations"), F.lit(None).cast("string").alias("example"))]
    rows += [F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations"), F.col(f"_e_{n}").alias("example")) for n in names]
    if expected_rows is not None:
        want = expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)
        rows.append(F.struct(F.lit("row_count").alias("rule"), F.abs(F.col("_rows") - want).alias("violations"), F.lit(None).cast("string").alias("example")))
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("passed", F.col("violations") == 0)
    if strict:
        failed = [f"{r.rule}: {r.violations}" for r in out.filter("NOT passed").collect()]  # one row per rule
        if failed:
            raise ValueError("validation failed: " + "; ".join(failed))
    return out


def duplicate_audit(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """Surplus rows per key: rows minus distinct key values.

    Each key is grouped once with map-side counts, so a frequent value stays cheap.
    """
    out = None
    for name, cols in keys.items():
        part = df.groupBy(*cols).agg(F.count("*").alias("n")).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_keys"), F.coalesce(F.max("n"), F.lit(0)).alias("largest_group"),
        ).select(F.lit(name).alias("key_name"), "row_count", "distinct_keys", (F.col("row_count") - F.col("distinct_keys")).alias("surplus"), "largest_group")
        out = part if out is None else out.unionByName(part)
    return out


def join_growth(stage: str, left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Measured effect of a left join on its key: rows in and out, multiplier and cardinality.

    The output size is computed from the key counts of both sides; the join itself is not run.
    """
    a = left.groupBy(key).agg(F.count("*").alias("n_left"))
    b = right.groupBy(key).agg(F.count("*").alias("n_right"))
    both = a.join(b, key, "left").agg(
        F.sum("n_left").alias("rows_in"), F.count("*").alias("keys_in"),
        F.sum(F.col("n_left") * F.greatest(F.coalesce("n_right", F.lit(0)), F.lit(1))).alias("rows_out"),
        F.count_if(F.col("n_right").isNotNull()).alias("keys_matched"), F.max("n_left").alias("_ml"), F.max("n_right").alias("_mr"))
    many = lambda c: F.when(F.coalesce(F.col(c), F.lit(0)) > 1, F.lit("N")).otherwise(F.lit("1"))
    return both.select(
        F.lit(stage).alias("stage"), "rows_in", "rows_out", "keys_in", "keys_matched",
        F.round(F.try_divide(F.col("rows_out"), F.col("rows_in")), 6).alias("multiplier"),
        F.concat(many("_ml"), F.lit(":"), many("_mr")).alias("cardinality"), (F.col("rows_out") == F.col("rows_in")).alias("passed"))


def null_audit(df: DataFrame, fields: list[str], unknown: str = "unknown", not_applicable: str = "not_applicable") -> DataFrame:
    """What an empty value means per field: null, empty text, unknown, not applicable, false or zero."""
    def counts(c: str) -> Column:
        v = F.col(c)
        t = F.lower(F.trim(v.cast("string")))
        return F.struct(
            F.lit(c).alias("field"), F.count(v).alias("non_null"), F.count_if(v.isNull()).alias("nulls"),
            F.count_if(yes(t == unknown)).alias("unknown"), F.count_if(yes(t == "")).alias("empty"),
            F.count_if(yes(t == not_applicable)).alias("not_applicable"), F.count_if(yes(t == "false")).alias("false"),
            F.count_if(yes(t.try_cast("double") == 0)).alias("zero"))

    return df.agg(F.array(*[counts(c) for c in fields]).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def digest(df: DataFrame) -> DataFrame:
    """Content fingerprint that does not depend on row order or partitioning."""
    h = F.xxhash64(*sorted(df.columns))
    return df.agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("hash_sum"), F.bit_xor(h).alias("hash_xor"))


def difference(before: DataFrame, after: DataFrame) -> DataFrame:
    """Exact rows that were removed or added, duplicates counted."""
    gone = before.exceptAll(after).withColumn("change", F.lit("removed"))
    return gone.unionByName(after.select(before.columns).exceptAll(before).withColumn("change", F.lit("added")))


def expectations(df: DataFrame, allowed: dict[str, list], unique: list[str] = (), subset_of: dict[str, DataFrame] | None = None) -> DataFrame:
    """Allowed values, uniqueness and subset expectations with violation counts."""
    checks = [F.struct(F.lit(f"{c}_allowed").alias("expectation"), F.count_if(~yes(F.col(c).isin(vals))).alias("violations")) for c, vals in allowed.items()]
    checks += [F.struct(F.lit(f"{c}_unique").alias("expectation"), (F.count("*") - F.count_distinct(c)).alias("violations")) for c in unique]
    out = df.agg(F.array(*checks).alias("a")).select(F.explode("a").alias("r")).select("r.*")
    for c, parent in (subset_of or {}).items():
        loose = df.groupBy(c).agg(F.count("*").alias("n")).join(parent.select(F.col(parent.columns[0]).alias(c)), c, "left_anti")
        out = out.unionByName(loose.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(F.lit(f"{c}_subset").alias("expectation"), "violations"))
    return out.withColumn("passed", F.col("violations") == 0)


def compare_versions(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per field: compared rows and rows whose value changed (NULL equals NULL); keys on one side only."""
    a = old.select(key, F.struct(*fields).alias("a"))
    b = new.select(key, F.struct(*fields).alias("b"))
    both = a.join(b, key, "full")
    paired = F.col("a").isNotNull() & F.col("b").isNotNull()
    rows = [F.struct(F.lit(f).alias("field"), F.count_if(paired).alias("compared"),
                     F.count_if(paired & ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))).alias("changed")) for f in fields]
    rows.append(F.struct(F.lit("_only_one_side").alias("field"), F.count("*").alias("compared"), F.count_if(~paired).alias("changed")))
    return both.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def keyword_extract(df: DataFrame, text: Column, words: list[str]) -> DataFrame:
    """Rows whose text holds one of the words, with the words found."""
    hits = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.lower(text).contains(w))
    return df.withColumn("matched", hits).filter(F.size("matched") > 0)
