"""Recommender features: one-hot and multi-hot vectors, eligibility, normalised values, penalty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions.rules import contains_any, first_match, weighted_flags, yes


def one_hot(c: Column, vocab: list[str]) -> Column:
    """Float vector over a fixed vocabulary; unknown values give all zeros."""
    return F.array(*[yes(c == v).cast("float") for v in vocab])


def multi_hot(members: Column, vocab: list[str]) -> Column:
    """Float vector marking the vocabulary entries contained in an array."""
    return F.array(*[yes(F.array_contains(members, v)).cast("float") for v in vocab])


def flat_columns(vector: Column, vocab: list[str], prefix: str) -> list[Column]:
    """A vector as one float column per vocabulary entry."""
    return [F.get(vector, F.lit(i)).alias(prefix + v.lower().replace(" ", "_")) for i, v in enumerate(vocab)]


def label_flags(labels: DataFrame, key: str, label: str, words: dict[str, list[str]] = config.FACILITY_LABEL_WORDS) -> DataFrame:
    """Facility flags of a place from its labels, aggregated label by label."""
    low = F.lower(label)
    return labels.groupBy(key).agg(*[F.bool_or(contains_any(low, ws)).alias(f) for f, ws in words.items()])


def eligible(status: Column, lat: Column, lon: Column) -> Column:
    closed = F.lower(F.trim(F.coalesce(status, F.lit("unknown")))) == "permanently_closed"
    return ~closed & lat.isNotNull() & lon.isNotNull()


def normalized_rating(coverage: Column, mean_rating: Column) -> Column:
    return F.when(coverage == "scraped", mean_rating / 5.0)


def price_status(status: Column, allowed: list[str], default: str = "unavailable") -> Column:
    return F.when(yes(status.isin(allowed)), status).otherwise(F.lit(default))


def quality_penalty(score: Column, warnings: Column, status: Column) -> Column:
    """0.001 per missing completeness point, 0.02 per warning, 0.10 if unknown, 1.00 if closed for good."""
    s = F.lower(F.trim(status))
    return (F.lit(100.0) - F.coalesce(score, F.lit(50.0))) * 0.001 + F.coalesce(warnings, F.lit(0)) * 0.02 + weighted_flags(
        [(s == "unknown", 0.10), (s == "permanently_closed", 1.00)])


def build_features(master: DataFrame, label_rows: DataFrame, sentiment: DataFrame, categories=config.CATEGORY_VOCAB, regions=config.REGION_VOCAB,
                   facilities=config.FACILITY_VOCAB, flag_facilities=config.FACILITY_VOCAB[:5],
                   price_states=("verified_current", "provisional", "historical", "unavailable")) -> DataFrame:
    """Recommender-ready rows: 21 base columns, then one flat float column per vocabulary entry.

    master: place_id, name, primary_category, city_or_regency, latitude, longitude, operational_status, the flag facilities,
    review_coverage_status, review_rating_mean, external_verification_status, external_price_min/max,
    overall_completeness_score, quality_warning_count. label_rows: place_id, raw_label.
    sentiment: place_id, sentiment_score_mean, sentiment_confidence_mean.
    """
    flags = label_flags(label_rows, "place_id", "raw_label")
    df = master.join(flags, "place_id", "left").join(sentiment, "place_id", "left")
    present = F.filter(F.array(*[F.when(yes(F.col(f)), F.lit(f)) for f in facilities if f in df.columns]), lambda x: x.isNotNull())
    c = F.col
    status = F.lower(F.trim(F.coalesce("operational_status", F.lit("unknown"))))
    df = df.select(
        "place_id", "name", "primary_category", "city_or_regency", c("latitude").cast("double"), c("longitude").cast("double"), "operational_status",
        eligible(c("operational_status"), c("latitude"), c("longitude")).alias("is_eligible_recommend"),
        one_hot(F.lower(F.trim("primary_category")), list(categories)).alias("category_vector"), one_hot(F.trim("city_or_regency"), list(regions)).alias("region_vector"),
        multi_hot(present, list(facilities)).alias("facility_vector"), "review_coverage_status",
        normalized_rating(c("review_coverage_status"), c("review_rating_mean")).alias("rating_normalized"), "sentiment_score_mean",
        F.coalesce("sentiment_confidence_mean", F.lit(0.0)).alias("sentiment_confidence"),
        price_status(c("external_verification_status"), list(price_states)).alias("price_status"),
        c("external_price_min").cast("double").alias("price_min_idr"), c("external_price_max").cast("double").alias("price_max_idr"),
        c("overall_completeness_score").cast("float"), c("quality_warning_count").cast("int"),
        quality_penalty(c("overall_completeness_score"), c("quality_warning_count"), status).alias("quality_penalty_score"))
    return df.select("*", *flat_columns(c("category_vector"), list(categories), "feat_cat_"), *flat_columns(c("region_vector"), list(regions), "feat_reg_"),
                     *flat_columns(c("facility_vector"), list(facilities), "feat_fac_"))
