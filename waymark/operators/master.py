"""Consolidation: per-place summaries of every layer, the wide master row, scores and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions.rules import contains_any, first_match, flag_names, weighted_flags, yes
from waymark.functions.text import is_filled
from waymark.operators.metadata import completeness_class


def review_summary(population: DataFrame, reviews: DataFrame) -> DataFrame:
    """Counts and rating statistics per place; the median is exact (its state is one counter per distinct rating)."""
    per = reviews.groupBy("place_id").agg(
        F.count("*").alias("review_count"), F.avg("rating").alias("review_rating_mean"), F.median("rating").alias("review_rating_median"),
        F.min("rating").alias("review_rating_min"), F.max("rating").alias("review_rating_max"),
        F.count_if(is_filled(F.col("text"))).alias("review_text_count"),
        F.max("review_ts").alias("review_latest_at"), F.min("review_ts").alias("review_oldest_at"))
    df = population.join(per, "place_id", "left").fillna(0, ["review_count", "review_text_count"])
    status = first_match([(F.col("review_count") > 0, "scraped"), (yes(F.col("review_eligible")), "no_reviews")], "ineligible")
    return df.withColumns({"review_coverage_status": status, "has_reviews": F.col("review_count") > 0})


def hours_summary(hours_rows: DataFrame) -> DataFrame:
    """Opening-hours summary per place: all-day means any all-day row on each of its days."""
    per_day = hours_rows.groupBy("place_id", "day_of_week").agg(
        F.bool_or("is_24_hours").alias("all_day"), F.collect_set(F.when(is_filled(F.col("raw_value")), F.trim("raw_value"))).alias("texts"),
        F.collect_set("source_id").alias("sources"))
    per = per_day.groupBy("place_id").agg(
        F.count("*").alias("opening_days_count"), F.bool_and("all_day").alias("open_24_hours"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("texts")))).alias("texts"),
        F.size(F.array_distinct(F.flatten(F.collect_list("sources")))).cast("bigint").alias("opening_hours_source_count"))
    summary = F.when(F.size("texts") > 0, F.array_join("texts", "; ")).otherwise(F.lit("Observed schedules"))
    return per.select(
        "place_id", "opening_days_count", "open_24_hours", summary.alias("opening_hours_summary"), "opening_hours_source_count",
        F.when(F.col("open_24_hours") & (F.col("opening_days_count") == 7), F.lit("open_24_7")).otherwise(F.lit("observed")).alias("opening_hours_status"))


def facility_summary(facilities: DataFrame, words: dict[str, list[str]] = config.SUMMARY_FACILITY_WORDS, wheelchair: str = "has_wheelchair_access") -> DataFrame:
    """Facility flags per place. Flags are aggregated row by row, so no list of labels is built for them."""
    low = F.lower("facility_name")
    there = F.lower("availability") == "available"
    wheel = contains_any(low, words[wheelchair])
    per = facilities.groupBy("place_id").agg(
        F.count("*").alias("facility_count"),
        F.to_json(F.array_sort(F.collect_set(F.when(there, F.col("facility_name"))))).alias("facilities"),
        *[F.bool_or(there & contains_any(low, ws)).alias(f) for f, ws in words.items()],
        F.bool_or(there & wheel).alias("_can"), F.bool_or((F.lower("availability") == "unavailable") & wheel).alias("_cannot"))
    return per.withColumns({
        "accessibility_status": first_match([(F.col("_can"), "observed_accessible"), (F.col("_cannot"), "observed_inaccessible")], "missing"),
        "facility_data_status": F.when(F.col("facility_count") >= 5, F.lit("complete")).otherwise(F.lit("partial")),
    }).drop("_can", "_cannot")


def local_price_summary(observations: DataFrame) -> DataFrame:
    """Local price evidence per place, audited observations only (all of them are counted).

    observations: place_id, price_type, amount, amount_min, amount_max, confidence, audit_decision, price_data_status.
    """
    ok = F.col("audit_decision") == "accept"
    amounts = F.array("amount", "amount_min", "amount_max")
    state = F.when(F.col("price_data_status") == "historical_reference", F.lit("historical")).otherwise(F.col("price_data_status"))
    per = observations.groupBy("place_id").agg(
        F.count("*").alias("local_price_observation_count"), F.count_if(ok).alias("local_valid_price_observation_count"),
        F.array_sort(F.collect_set(F.when(ok, F.col("price_type")))).alias("_types"),
        F.min(F.when(ok, F.array_min(amounts))).alias("local_price_min"), F.max(F.when(ok, F.array_max(amounts))).alias("local_price_max"),
        F.max(F.when(ok, F.col("confidence"))).alias("local_price_best_confidence"),
        F.array_sort(F.collect_set(state)).alias("_states"))
    has = F.col("local_valid_price_observation_count") > 0
    return per.select(
        "place_id", has.alias("has_local_price_evidence"), "local_price_observation_count", "local_valid_price_observation_count",
        F.size("_types").cast("bigint").alias("local_price_type_count"), F.to_json("_types").alias("local_price_types"),
        "local_price_min", "local_price_max", "local_price_best_confidence", F.to_json("_states").alias("local_price_temporal_statuses"),
        first_match([(~has, "no_evidence"), (F.array_contains("_states", "current"), "current_present")], "historical_only").alias("local_price_data_status"))


def external_price_summary(population: DataFrame, coverage: DataFrame, prices: DataFrame) -> DataFrame:
    """External price state per place; a selected price overrides the verification status.

    coverage: one row per place with verification_status; prices: place_id, amount, temporal_status, is_unbounded.
    """
    per = prices.groupBy("place_id").agg(
        F.count("*").alias("external_selected_price_count"), F.min("amount").alias("external_price_min"), F.max("amount").alias("external_price_max"),
        F.bool_or(F.lower("temporal_status") == "current").alias("has_verified_current_price"),
        F.bool_or("is_unbounded").alias("has_official_live_unbounded_price"))
    df = population.join(coverage, "place_id", "left").join(per, "place_id", "left").fillna(0, ["external_selected_price_count"]).fillna(
        False, ["has_verified_current_price", "has_official_live_unbounded_price"])
    status = F.coalesce("verification_status", F.lit("not_verified"))
    return df.withColumns({
        "external_verification_status": status,
        "external_price_data_status": F.when(F.col("external_selected_price_count") > 0, F.lit("verified_present")).otherwise(status),
    }).drop("verification_status")


def source_flags(mappings: DataFrame, sources: dict[str, list[str]]) -> DataFrame:
    """Source types per place with one flag per group of sources."""
    per = mappings.groupBy("place_id").agg(
        F.array_sort(F.collect_set("source")).alias("_s"), *[F.bool_or(F.col("source").isin(m)).alias(f) for f, m in sources.items()])
    return per.select("place_id", *sources, F.to_json("_s").alias("source_types"))


def quality_warnings() -> Column:
    """Sorted array of the eleven quality warnings of a wide master row."""
    c = F.col
    no_point = c("latitude").isNull() | c("longitude").isNull() | (c("latitude") == 0) | (c("longitude") == 0)
    return F.array_sort(flag_names([
        (no_point, "missing_coordinates"),
        (F.coalesce("operational_status", F.lit("unknown")) == "unknown", "unknown_operational_status"),
        (~c("has_reviews"), "no_review_data"),
        (c("metadata_mapping_status") == "unmapped", "metadata_unmapped"),
        (~c("has_opening_hours"), "opening_hours_missing"),
        (c("facility_count") == 0, "facility_data_unknown"),
        (c("local_price_data_status") == "historical_only", "local_price_historical_only"),
        (c("external_verification_status") == "not_verified", "external_price_not_verified"),
        (c("external_verification_status") == "completed_unresolved", "external_price_unresolved"),
        (c("source_conflict_count") > 0, "source_conflict"),
        (c("classification_confidence") < 0.6, "low_identity_confidence"),
    ]))


def overall_completeness() -> Column:
    """Score of a wide master row from nine weighted parts; parts that do not apply are not held against it."""
    c = F.col
    no_reviews_needed = ~c("review_eligible")
    out_of_scope = c("price_validation_scope") == "out_of_scope"
    checked = c("external_verification_status").isin("completed_verified", "completed_no_price", "completed_unresolved")
    explained = c("has_local_price_evidence") | c("price_final_decision").isin("excluded_free", "excluded_non_attraction")
    site, w = is_filled(c("official_website")), c("quality_warning_count")
    return weighted_flags([
        (c("latitude").isNotNull() & c("longitude").isNotNull() & (c("latitude") != 0) & is_filled(c("name")), 20.0),
        (no_reviews_needed | c("has_reviews"), 15.0),
        (~no_reviews_needed & ~c("has_reviews") & (c("review_coverage_status") == "no_reviews"), 5.0),
        (is_filled(c("address")), 5.0), (is_filled(c("phone")), 5.0), (site, 5.0),
        (~site & (c("website_status") == "google_maps_only"), 2.0), (is_filled(c("description")), 5.0),
        (c("facility_count") > 0, 10.0), (c("has_opening_hours"), 10.0), (c("operational_status") != "unknown", 10.0),
        (out_of_scope | yes(explained), 5.0), (out_of_scope | checked, 5.0),
        (w == 0, 5.0), (w == 1, 4.0), (w == 2, 2.0),
    ])


def layer_flags() -> dict[str, Column]:
    c = F.col
    return {
        "has_identity_data": c("name").isNotNull() & c("latitude").isNotNull(),
        "has_review_data": c("has_reviews"),
        "has_metadata_data": c("metadata_mapping_status") == "mapped",
        "has_facility_data": c("facility_count") > 0,
        "has_opening_hours_data": c("has_opening_hours"),
        "has_local_price_data": c("has_local_price_evidence"),
        "has_external_price_data": c("external_selected_price_count") > 0,
    }


# Columns every wide row must carry for scoring, with the value of a place that lacks the layer.
LAYER_DEFAULTS = {
    "review_count": 0, "has_reviews": False, "review_eligible": False, "review_coverage_status": "ineligible",
    "facility_count": 0, "has_opening_hours": False, "opening_days_count": 0,
    "metadata_mapping_status": "unmapped", "operational_status": "unknown", "website_status": "missing",
    "price_validation_scope": "out_of_scope", "price_final_decision": "", "has_local_price_evidence": False,
    "local_price_data_status": "no_evidence", "external_verification_status": "not_verified",
    "external_selected_price_count": 0, "source_conflict_count": 0,
}


def consolidate(population: DataFrame, layers: list[DataFrame], key: str = "place_id") -> DataFrame:
    """Wide master: the population with every layer joined 1:1, defaults, warnings, scores and layer flags."""
    df = population
    for layer in layers:
        df = df.join(layer, key, "left")
    df = df.fillna({k: v for k, v in LAYER_DEFAULTS.items() if k in df.columns})
    df = df.withColumns({k: F.lit(v) for k, v in LAYER_DEFAULTS.items() if k not in df.columns})
    missing = [c for c in ("latitude", "longitude", "name", "address", "phone", "official_website", "description", "classification_confidence") if c not in df.columns]
    df = df.withColumns({c: F.lit(None).cast("double" if c in ("latitude", "longitude", "classification_confidence") else "string") for c in missing})
    df = df.withColumn("_w", quality_warnings())
    df = df.withColumns({"quality_warnings": F.to_json("_w"), "quality_warning_count": F.size("_w")}).drop("_w")
    df = df.withColumn("overall_completeness_score", overall_completeness())
    df = df.withColumn("overall_completeness_class", completeness_class(F.col("overall_completeness_score")))
    df = df.withColumns(layer_flags())
    counted = [f for f in layer_flags() if f != "has_identity_data"]
    total = sum((F.col(f).cast("int") for f in counted), F.lit(0)) + (F.col("operational_status") != "unknown").cast("int")
    return df.withColumn("enrichment_layer_count", total)


def layer_coverage(master: DataFrame, flags: list[str]) -> DataFrame:
    """Places and share per layer in one aggregation."""
    wide = master.agg(F.count("*").alias("total"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    rows = F.array(*[F.struct(F.lit(f).alias("layer"), F.col(f).alias("covered")) for f in flags])
    return wide.select("total", F.explode(rows).alias("r")).select(
        "r.layer", "r.covered", "total", F.round(F.coalesce(F.try_divide(F.col("r.covered") * 100.0, "total"), F.lit(0.0)), 2).alias("pct"))


def source_manifest(sources: dict[str, DataFrame], key: str, population: DataFrame) -> DataFrame:
    """Rows, distinct keys and keys found in the population, per source."""
    known = population.select(key, F.lit(True).alias("_in"))
    parts = []
    for name, df in sources.items():
        per_key = df.groupBy(key).agg(F.count("*").alias("n")).join(known, key, "left")
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("distinct_keys"), F.count_if(F.col("_in")).alias("matched_keys"),
        ).select(F.lit(name).alias("source"), "row_count", "distinct_keys", "matched_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
