"""Catalog search, narrowing with fallback, routing and scoping."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions.rules import yes


def bare_region(c: Column, prefixes: tuple[str, ...] = ("kabupaten ", "kota ", "kab. ")) -> Column:
    """Lower-case region name without its administrative prefix."""
    out = F.lower(F.coalesce(c, F.lit("")))
    for p in prefixes:
        out = F.replace(out, F.lit(p), F.lit(""))
    return F.trim(out)


def search(items: DataFrame, category: str | None = None, region: str | None = None, keyword: str | None = None,
           any_label: str = "semua") -> DataFrame:
    """Rows matching all given parts; the keyword may be in name, region or address."""
    conds = [F.lit(True)]
    if category and category.lower() != any_label:
        conds.append(yes(F.lower("category").contains(category.lower().strip())))
    if region and region.lower() != any_label:
        want = bare_region(F.lit(region))
        conds.append(yes(bare_region(F.col("region")).contains(want) | F.lower("address").contains(want)))
    if keyword:
        k = keyword.lower().strip()
        conds.append(yes(F.lower("name").contains(k) | F.lower("region").contains(k) | F.lower("address").contains(k)))
    return items.filter(reduce(and_, conds))


def page(matches: DataFrame, key: str, number: int, size: int) -> DataFrame:
    """One page in key order with totals; missing ratings and counts get display defaults.

    The totals are a scalar subquery, so the page itself is a top-k, not a full sort.
    """
    total = matches.agg(F.count("*").alias("n")).scalar()
    rows = matches.orderBy(F.col(key)).offset((number - 1) * size).limit(size)
    return rows.withColumns({
        "rating": F.round(F.coalesce(F.col("rating"), F.lit(4.6)), 1),
        "review_count": F.coalesce(F.col("review_count"), F.lit(120)),
        "total_items": total,
        "total_pages": F.greatest(F.lit(1), F.ceil(total / F.lit(size))).cast("bigint"),
    })


def narrow_or_keep(items: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition; all rows when none does."""
    any_hit = items.agg(F.max(yes(condition)).alias("hit")).scalar()
    return items.filter(yes(condition) | ~F.coalesce(any_hit, F.lit(False)))


def exclude(items: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    return items.join(excluded.select(key), key, "left_anti")


def within_budget(ranked: DataFrame, price: str, limit: Column) -> DataFrame:
    """Budget filter after ranking: gaps in the rank stay; unknown prices pass."""
    return ranked.filter(F.col(price).isNull() | limit.isNull() | (F.col(price) <= limit))


def route(decision: Column) -> Column:
    """Where a classified row goes; everything not rejected continues downstream."""
    return F.when(decision == "accepted", F.lit("accepted")).when(
        decision == "rejected", F.lit("rejected")).otherwise(F.lit("manual_review"))


def verified_or_candidate(classification: Column, source: Column, trusted: list[str]) -> Column:
    return F.when(yes((classification == "accepted") | source.isin(trusted)), F.lit("verified")).otherwise(F.lit("candidate"))


def in_scope(df: DataFrame, priority: Column, wanted: list[str]) -> DataFrame:
    """Adds scope status and reason for a list of wanted priorities."""
    hit = yes(priority.isin(wanted))
    return df.withColumns({
        "scope_status": F.when(hit, F.lit("in_scope")).otherwise(F.lit("out_of_scope")),
        "scope_reason": F.when(hit, F.concat(F.lit("priority "), priority)).otherwise(F.lit("priority not selected")),
    })


def queue(df: DataFrame, key: str, done: DataFrame | None = None, only: object = None,
          first_batch: int | None = None, last_batch: int | None = None, limit: int | None = None) -> DataFrame:
    """Work queue: skips finished keys, then optional single key, batch range and size limit."""
    out = df if done is None else df.join(done.select(key), key, "left_anti")
    if only is not None:
        out = out.filter(F.col(key) == F.lit(only))
    if first_batch is not None:
        out = out.filter(F.col("batch") >= first_batch)
    if last_batch is not None:
        out = out.filter(F.col("batch") <= last_batch)
    return out.orderBy(key).limit(limit) if limit is not None else out
