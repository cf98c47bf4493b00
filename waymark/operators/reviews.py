"""Reviews: mapping to places, review facts, duplicates, selection, coverage and batch gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import text
from waymark.functions.rules import first_match
from waymark.operators import ranking
from waymark.operators.normalize import whole_stars
from waymark.operators.resolve import keep_first_of_groups
from waymark.operators.skew import join_one_per_key

BUCKETS = ["positive", "negative", "neutral"]


def review_time(c: Column) -> Column:
    """Review date with its zone replaced by UTC; unreadable dates sort first."""
    plain = F.regexp_replace(c, r"(Z|[+-][0-9]{2}:?[0-9]{2})$", "")
    return F.coalesce(F.try_to_timestamp(plain), F.lit("0001-01-01 00:00:00").cast("timestamp"))


def star_bucket(stars: Column) -> Column:
    return first_match([(stars >= 4, "positive"), (stars == 3, "neutral")], "negative")


def map_reviews(reviews: DataFrame, by_place: DataFrame, by_url: DataFrame, single_batches: DataFrame) -> DataFrame:
    """Place of each review: place id, else page URL, else the only member of its batch.

    reviews: source_place_id, url, batch_id. The mapping tables have one row per key with canonical_id.
    """
    def step(df, mapping, key, out):
        k = F.when(F.coalesce(*[F.col(c) for c in decided]).isNull(), F.col(key)) if decided else F.col(key)
        m = mapping.select(F.col(key).alias("_k"), F.col("canonical_id").alias(out))
        decided.append(out)
        return join_one_per_key(df.withColumn("_k", k), m, "_k").drop("_k")

    decided: list[str] = []
    df = step(reviews, by_place, "source_place_id", "_by_place")
    df = step(df, by_url, "url", "_by_url")
    df = step(df, single_batches, "batch_id", "_by_batch")
    cid = F.coalesce("_by_place", "_by_url", "_by_batch")
    reason = F.when(cid.isNull(), F.format_string(
        "Could not map placeId '%s' or url '%s' to any canonical_id", F.coalesce("source_place_id", F.lit("None")), F.coalesce("url", F.lit("None"))))
    return df.withColumns({"canonical_id": cid, "unmapped_reason": reason}).drop(*decided)


def review_facts(mapped: DataFrame, run_time: str) -> DataFrame:
    """Review rows with stars, bucket, content hash and a generated id where the source gave none."""
    body = F.coalesce("text", F.lit(""))
    stars = whole_stars(F.col("raw_rating"))
    made = F.concat(F.lit("gen_"), F.md5(F.concat_ws("_", body, F.coalesce("author", F.lit("")))))
    return mapped.select(
        "*", F.coalesce(text.blank_to_null(F.col("raw_id")), made).alias("review_id"), stars.alias("rating"),
        body.alias("review_text"), star_bucket(stars).alias("sentiment_bucket"), text.content_hash(body).alias("content_hash"),
        F.coalesce("collected", F.lit(run_time)).alias("collected_at"), (F.trim(body) == "").alias("is_empty"))


def unique_reviews(reviews: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Reviews kept by one ordered pass over (place, review id): a review is a duplicate when its id, or its
    text within the place, was seen on a kept review.

    Texts are compared without case and punctuation; texts that are empty after that by their hash.
    """
    similar = text.similarity_text(F.col("review_text"))
    body = F.when(similar != "", F.concat(F.lit("t:"), F.sha2(similar, 256))).otherwise(
        F.concat(F.lit("h:"), text.content_hash(F.col("review_text"))))
    narrow = reviews.select(row_id, "canonical_id", "review_id", body.alias("_body"))
    kept = keep_first_of_groups(
        narrow, row_id, ["canonical_id", "review_id"],
        [F.concat(F.lit("i:"), F.col("review_id").cast("string")), F.concat_ws("|", F.col("canonical_id").cast("string"), "_body")])
    return reviews.join(kept, row_id, "left_semi")


def representative(reviews: DataFrame, targets: DataFrame, largest_target: int, batch: str = "batch_id") -> DataFrame:
    """Newest, then longest reviews with text per place and bucket, up to the target of the place's batch.

    targets: batch_id, bucket, target - one row per batch and bucket.
    """
    usable = reviews.filter(F.trim(F.coalesce("review_text", F.lit(""))) != "")
    order = [F.col("review_ts").desc(), F.length("review_text").desc(), F.col("review_id").asc()]
    # the largest target bounds the rows per group before the per-batch target is looked up
    top = ranking.top_n(usable, ["canonical_id", "sentiment_bucket"], order, largest_target, "selection_rank")
    wanted = targets.withColumnRenamed("bucket", "sentiment_bucket")
    return top.join(wanted, [batch, "sentiment_bucket"]).filter("selection_rank <= target").withColumn(
        "selection_reason", F.format_string("top_representative_%s_rank_%d", "sentiment_bucket", "selection_rank")).drop("target")


def coverage(population: DataFrame, collected: DataFrame, selected: DataFrame) -> DataFrame:
    """Coverage status per place.

    population: canonical_id, eligible, batch_completed, listed_reviews, target_positive/negative/neutral.
    """
    got = collected.groupBy("canonical_id").agg(
        F.count("*").alias("total_collected"),
        *[F.count_if(F.col("sentiment_bucket") == b).alias(f"{b}_collected") for b in BUCKETS])
    sel = selected.groupBy("canonical_id").agg(
        *[F.count_if(F.col("sentiment_bucket") == b).alias(f"{b}_selected") for b in BUCKETS])
    counts = ["total_collected"] + [f"{b}_{w}" for b in BUCKETS for w in ("collected", "selected")]
    df = population.join(got, "canonical_id", "left").join(sel, "canonical_id", "left").fillna(0, counts)
    filled = F.lit(True)
    for b in BUCKETS:
        filled = filled & (F.col(f"{b}_selected") == F.col(f"target_{b}"))
    status = first_match(
        [
            (~F.col("eligible"), "ineligible"),
            (~F.col("batch_completed"), "not_scheduled"),
            ((F.col("total_collected") == 0) & (F.coalesce("listed_reviews", F.lit(0)) == 0), "no_google_reviews"),
            (F.col("total_collected") == 0, "failed_scrape"),
            (sum((F.col(f"{b}_selected") for b in BUCKETS), F.lit(0)) == 0, "reviews_without_text"),
            (filled, "complete_bucket_coverage"),
        ],
        "partial_bucket_coverage",
    )
    return df.withColumn("coverage_status", status)


def share(n: Column, total: Column) -> Column:
    """n / total, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(n.cast("double"), total), F.lit(0.0))


def run_metrics(raw: DataFrame, mode: str, modes: list[str], is_duplicate: Column, is_empty: Column, is_selected: Column) -> DataFrame:
    """Counts and guarded rates of a whole run in one aggregation."""
    base = raw.agg(
        F.count("*").alias("raw"), *[F.count_if(F.col(mode) == m).alias(f"raw_{m}") for m in modes],
        F.count_if(is_duplicate).alias("duplicates"), F.count_if(is_empty).alias("empty"), F.count_if(is_selected).alias("selected"))
    return base.withColumns({
        "duplicate_rate": F.round(share(F.col("duplicates"), F.col("raw")), 6),
        "empty_rate": F.round(share(F.col("empty"), F.col("raw")), 6),
        "yield_rate": F.round(share(F.col("selected"), F.col("raw")), 6),
    })


def batch_gate(per_batch: DataFrame) -> DataFrame:
    """Rates and gate decision per batch.

    per_batch: attempted, covered, raw, duplicates, empty, unmapped, selected, target (total of all buckets).
    """
    rate = share(F.col("covered"), F.col("attempted"))
    dup, emp = share(F.col("duplicates"), F.col("raw")), share(F.col("empty"), F.col("raw"))
    gain = share(F.col("selected"), F.col("raw"))
    decision = first_match(
        [((F.col("unmapped") > 0) | (rate < 0.60), "FAIL"), ((dup < 0.45) & (emp < 0.40) & (gain > 0.25), "PASS")],
        "CONDITIONAL PASS")
    return per_batch.withColumns({
        "coverage_rate": F.round(rate, 6), "duplicate_rate": F.round(dup, 6), "empty_rate": F.round(emp, 6),
        "yield_rate": F.round(gain, 6), "fill_rate": F.round(share(F.col("selected"), F.col("target")), 6), "decision": decision})


def batch_costs(runs: DataFrame, batch: str, modes: list[str], per_run: float = 0.50, per_review: float = 0.003,
                digits: int = 2) -> DataFrame:
    """Cost per batch; unknown as a whole when a mode is missing or has no known count.

    runs: one row per batch and mode with raw_review_count.
    """
    cost = F.lit(per_run) * F.count("raw_review_count") + F.sum("raw_review_count") * F.lit(per_review)
    known = F.count_distinct(F.when(F.col("raw_review_count").isNotNull() & F.col("mode").isin(modes), F.col("mode")))
    return runs.groupBy(batch).agg(
        F.when(known == len(modes), F.round(cost, digits)).alias("total_cost"), known.alias("modes_known")
    ).withColumn("cost_status", F.when(F.col("total_cost").isNull(), F.lit("unavailable")).otherwise(F.lit("available")))
