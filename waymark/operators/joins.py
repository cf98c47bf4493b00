"""Keyed joins: summaries onto a population, orphans, waterfall mapping, preferred source, lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions.rules import first_match
from waymark.operators.durable import durable
from waymark.operators.nearby import nearest_named
from waymark.operators.ranking import keep_first
from waymark.operators.skew import join_one_per_key, join_shuffled


def attach(population: DataFrame, key: str, summaries: list[DataFrame], counts: list[str] = ()) -> DataFrame:
    """Left-join one-row-per-key summaries; missing counts become 0.

    All summaries are aggregated by the same key, so Spark shuffles each once
    and reuses the partitioning of the population across the whole chain.
    """
    out = population
    for s in summaries:
        out = out.join(s, key, "left")
    return out.fillna(0, list(counts)) if counts else out


def orphans(children: DataFrame, key: str, population: DataFrame, relation: str, severity: str = "error") -> DataFrame:
    """Child keys that the population lacks, with their row counts."""
    per_key = children.groupBy(key).agg(F.count("*").alias("orphan_rows"))
    return per_key.join(population.select(key), key, "left_anti").select(
        F.lit(relation).alias("relation"), key, "orphan_rows", F.lit(severity).alias("severity"))


def last_entry(mapping: DataFrame, key: str, seq: str) -> DataFrame:
    """Map entries with the last one kept per key."""
    return keep_first(mapping, [key], [F.col(seq).desc()]).drop(seq)


def map_records(records: DataFrame, by_record: DataFrame, by_place: DataFrame, by_url: DataFrame, population: DataFrame,
                strict: bool = False, region_ok: Column | None = None, radius_m: float = 100.0, cut: float = 0.85) -> DataFrame:
    """Map source records to places by record id, place id, URL key, then position and name.

    The first key type with a hit decides, even when the hit is outside the
    population: the record is then unmapped. `strict` leaves the last step out.

    records: record_id, source_place_id, url_key, name, lat, lon, region.
    by_record / by_place / by_url: one row per key with canonical_id.
    population: place_id, name, lat, lon, ord, region.
    """
    def step(df: DataFrame, mapping: DataFrame, key: str, method: str, confidence: float) -> DataFrame:
        # rows already decided carry a NULL key, so they take no part in the join
        probe = df.withColumn("_k", F.when(F.col("method").isNull(), F.col(key)))
        side = mapping.select(F.col(key).alias("_k"), F.col("canonical_id").alias("_hit"))
        if key == "record_id":  # unique: no hot keys
            found = probe.join(side, "_k", "left")
        else:
            found = join_one_per_key(probe, side, "_k")
        hit = F.col("_hit").isNotNull() & F.col("method").isNull()
        return found.withColumns({
            "canonical_id": F.coalesce("canonical_id", F.col("_hit")),
            "confidence": F.when(hit, F.lit(confidence)).otherwise(F.col("confidence")),
            "method": F.when(hit, F.lit(method)).otherwise(F.col("method")),
        }).drop("_k", "_hit")

    kind = population.schema["place_id"].dataType
    out = records.withColumns({
        "canonical_id": F.lit(None).cast(kind), "method": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    out = step(out, by_record, "record_id", "source_record_id", 1.0)
    out = step(out, by_place, "source_place_id", "google_place_id", 1.0)
    out = step(out, by_url, "url_key", "normalized_url", 0.95)
    out = durable(out)
    if not strict:
        left = out.filter(F.col("method").isNull())
        near = nearest_named(left, population, region_ok, radius_m, cut).select(
            "record_id", F.col("place_id").alias("_cid"), F.col("confidence").alias("_conf"))
        out = join_shuffled(out, near, "record_id", "left")
        hit = F.col("_cid").isNotNull() & F.col("method").isNull()
        out = out.withColumns({
            "canonical_id": F.coalesce("canonical_id", F.col("_cid")),
            "confidence": F.when(hit, F.col("_conf")).otherwise(F.col("confidence")),
            "method": F.when(hit, F.lit("coordinates_name_fallback")).otherwise(F.col("method")),
        }).drop("_cid", "_conf")
    members = population.select(F.col("place_id").alias("canonical_id"), F.lit(True).alias("_in"))
    out = join_one_per_key(out, members, "canonical_id")
    mapped = F.coalesce(F.col("_in"), F.lit(False))
    return out.select(
        "record_id", F.when(mapped, F.col("canonical_id")).alias("canonical_id"), F.when(mapped, F.col("method")).alias("method"),
        F.when(mapped, F.col("confidence")).alias("confidence"), mapped.alias("mapped"))


def preferred_source(records: DataFrame, key: str, source: Column, preferred: object, fallback: object, seq: str, values: list[str]) -> DataFrame:
    """First record of the preferred source per key, else the last one of the fallback source."""
    pick = F.struct(*values)
    # the values break ties, so the pick does not depend on row order
    best = F.min_by(pick, F.when(source == preferred, F.struct(seq, *values)))
    other = F.max_by(pick, F.when(source == fallback, F.struct(seq, *values)))
    return records.groupBy(key).agg(
        F.coalesce(best, other).alias("v"), F.bool_or(source == preferred).alias("from_preferred")
    ).select(key, *[F.col(f"v.{c}").alias(c) for c in values], F.coalesce("from_preferred", F.lit(False)).alias("from_preferred"))


def image_for(items: DataFrame, by_name: DataFrame, name_key: str, by_category: dict[str, str], default: str) -> DataFrame:
    """Image per item: by name, else by category, else the default."""
    found = join_one_per_key(items, by_name.select(name_key, F.col("image_url").alias("_by_name")), name_key)
    fallback = first_match([(F.lower(F.trim("category")) == c, u) for c, u in by_category.items()], default)
    return found.withColumn("image_url", F.coalesce("_by_name", fallback)).drop("_by_name")
