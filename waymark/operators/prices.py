"""Prices: candidate evidence, observations, conflicts, selection, comparison and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions.rules import any_word_in, contains_any, first_match, flag_names, weighted_flags, word_in, yes
from waymark.functions.text import is_filled
from waymark.operators.quality import expectations
from waymark.operators.ranking import keep_first
from waymark.operators.skew import join_one_per_key

DAY_WILDCARD, AUDIENCE_WILDCARD = "all_days", "general"


def entrance_range(places: DataFrame, prices: DataFrame, entry_type: str = "entrance_fee") -> DataFrame:
    """Lowest, highest and number of entry prices per place, also for places without any."""
    summary = prices.filter(F.col("price_type") == entry_type).groupBy("place_id").agg(
        F.min("amount").alias("price_min"), F.max("amount").alias("price_max"), F.count("amount").alias("n_prices"))
    return places.join(summary, "place_id", "left").fillna(0, ["n_prices"])


# ---- candidates ----------------------------------------------------------


def free_phrase(name: Column, description: Column, rules: dict = config.EVIDENCE) -> Column:
    """First free-entry phrase in the name or the description, else NULL."""
    n, d = F.lower(name), F.lower(F.coalesce(description, F.lit("")))
    return first_match([(word_in(n, p) | word_in(d, p), p) for p in rules["free_phrases"]])


def non_attraction(name: Column, category: Column, rules: dict = config.EVIDENCE) -> Column:
    """Why a name does not denote an attraction, else NULL."""
    n = F.lower(name)
    named = [(word_in(n, w), w) for w in rules["non_attraction_words"]]
    # the post rule stands before the office words in the fixed order
    at = rules["non_attraction_words"].index("kantor") if "kantor" in rules["non_attraction_words"] else len(named)
    named.insert(at, (yes(n.rlike(rules["post_pattern"])), r"pos\s"))
    return first_match(named + [
        (any_word_in(n, rules["dock_words"]) & ~yes(category.isin(rules["dock_categories"])) & ~contains_any(n, rules["dock_pass_words"]),
         rules["dock_words"][0]),
        (any_word_in(n, rules["gate_words"]), rules["gate_words"][0]),
        (any_word_in(n, rules["parking_words"]) & ~contains_any(n, rules["parking_pass_words"]), rules["parking_words"][0]),
    ])


def paid_facilities(facilities: DataFrame, rules: dict = config.EVIDENCE) -> DataFrame:
    """Places with an available paid facility; plain payment methods do not count."""
    n = F.lower(F.trim("facility_name"))
    cash_only = n.contains(rules["cash_word"]) & ~contains_any(n, rules["cash_pass_words"])
    hit = (F.col("availability") == "available") & contains_any(n, rules["paid_facility_words"]) & ~cash_only & ~contains_any(n, rules["card_words"])
    return facilities.groupBy("place_id").agg(F.bool_or(yes(hit)).alias("paid_facility"))


def score_candidates(candidates: DataFrame, rules: dict = config.EVIDENCE) -> DataFrame:
    """Evidence score, decision, strength and priority of each price candidate in one projection.

    candidates: place_id, name, category, tags, website, description, operational_status, price_hint, price_raw,
    original_priority, in_scope, mapped, paid_facility. Rows out of scope keep a NULL decision.
    """
    c = F.col
    name, cat, tags, web = F.lower(F.trim("name")), F.lower(F.trim("category")), F.lower(F.coalesce("tags", F.lit(""))), F.lower(F.trim(F.coalesce("website", F.lit(""))))
    raw, hint = is_filled(c("price_raw")), is_filled(c("price_hint"))
    commercial = yes(cat.isin(rules["commercial_categories"]) | contains_any(tags, rules["commercial_terms"]) | contains_any(cat, rules["commercial_terms"]))
    paid = yes(c("paid_facility"))
    site = (web != "") & ~contains_any(web, rules["map_sites"])
    managed_name = contains_any(name, rules["managed_name_words"])
    managed_text = contains_any(F.lower(F.coalesce("description", F.lit(""))), rules["managed_description_words"])
    not_place, free = non_attraction(c("name"), cat, rules), free_phrase(c("name"), c("description"), rules)
    unmapped = ~yes(c("mapped"))
    other = raw | hint | paid | managed_name | managed_text | site
    category_only = ~other & (commercial | yes(cat.isin(rules["category_only"])))
    df = candidates.select(
        "*", weighted_flags([
            (raw | hint, 5), (commercial, 4), (paid, 3), (site, 2), (managed_name, 2), (managed_text, 2), (site, 1),
            (not_place.isNotNull(), -5), (free.isNotNull(), -4), (unmapped, -2)]).alias("_sum"),
        category_only.alias("_only"), not_place.alias("_not_place"), free.alias("_free"), unmapped.alias("_unmapped"),
        F.array_sort(F.array_distinct(flag_names([
            (raw, "existing_price_raw_value"), (~raw & hint, "existing_price_hint"), (commercial, "primary_category"), (paid, "facilities"),
            (site, "website"), (managed_name, "name"), (managed_text, "description"), (not_place.isNotNull(), "name_non_attraction"),
            (free.isNotNull(), "name_public_free"), (unmapped, "metadata_availability")]))).alias("_fields"))
    scope = yes(c("in_scope"))
    score = F.when(~scope, F.lit(0)).when(c("_only"), F.least(c("_sum"), F.lit(1))).otherwise(c("_sum"))
    status = c("operational_status")

    def out(decision, validation, rule, strength):
        return F.struct(F.lit(decision).alias("final_decision"), F.lit(validation).alias("validation_status"), F.lit(rule).alias("decision_rule"),
                        (strength if isinstance(strength, Column) else F.lit(strength)).alias("evidence_strength"))

    verdict = first_match(
        [
            (~scope & (c("original_priority") == "not_applicable"), out("not_applicable", "force_closed", "original_not_applicable", "weak")),
            (~scope, out(None, "not_evaluated", "out_of_scope", "weak")),
            (status == "permanently_closed", out("not_applicable", "force_closed", "permanently_closed", "strong")),
            (status == "temporarily_closed", out("manual_review", "force_closed", "temporarily_closed", "strong")),
            (c("_not_place").isNotNull(), out("excluded_non_attraction", "validated", "non_attraction_filter", "strong")),
            (c("_free").isNotNull(), out("excluded_free", "validated", "public_free_space", "strong")),
            (c("_unmapped"), out("manual_review", "validated", "unmapped_metadata", "weak")),
            (c("_only"), out("manual_review", "validated", "weak_category_evidence", "weak")),
            (score >= 3, out("research", "validated", "strong_paid_evidence", F.when(score >= 5, F.lit("strong")).otherwise(F.lit("moderate")))),
        ],
        out("manual_review", "validated", "insufficient_evidence", "weak"),
    )
    df = df.withColumns({"paid_evidence_score": score, "_v": verdict}).select("*", "_v.*")
    closed = status.isin("temporarily_closed", "permanently_closed")
    priority = first_match(
        [
            (~scope & (c("original_priority") == "not_applicable"), F.lit("not_applicable")),
            (~scope, F.lit("low")),
            (c("final_decision") == "research", c("original_priority")),
            (c("final_decision") == "not_applicable", F.lit("not_applicable")),
        ],
        F.lit("low"),
    )
    fields = F.when(~scope, F.lit("")).when(c("_only"), F.lit("primary_category")).otherwise(F.array_join("_fields", ", "))
    return df.withColumns({
        "free_evidence_score": F.when(scope & c("_free").isNotNull(), 4).otherwise(0),
        "non_attraction_score": F.when(scope & c("_not_place").isNotNull(), 5).otherwise(0),
        "final_research_priority": priority, "evidence_fields": fields,
        "likely_paid_entry": yes(c("final_decision") == "research"),
        "requires_manual_review": yes(c("final_decision") == "manual_review") | (~scope & yes(closed)),
        "operational_review_flag": ~scope & yes(closed),
    }).drop("_sum", "_only", "_not_place", "_free", "_unmapped", "_fields", "_v")


def decision_provenance(scored: DataFrame, version: str) -> DataFrame:
    """One row per decision taken in scope."""
    return scored.filter(yes(F.col("in_scope"))).select(
        "place_id", F.lit("final_decision").alias("field_name"), F.col("final_decision").alias("field_value"), "decision_rule", "evidence_fields",
        F.lit(version).alias("validation_version"))


def decision_changes(previous: DataFrame, current: DataFrame, key: str = "place_id", decision: str = "final_decision") -> DataFrame:
    """Keys whose decision differs between two runs, appeared or disappeared."""
    a = previous.select(key, F.col(decision).alias("previous_decision"), F.lit(True).alias("_a"))
    b = current.select(key, F.col(decision).alias("new_decision"), F.lit(True).alias("_b"))
    kind = first_match([(F.col("_a").isNull(), "added"), (F.col("_b").isNull(), "removed")], "changed")
    return a.join(b, key, "full").filter(
        F.col("_a").isNull() | F.col("_b").isNull() | ~F.col("previous_decision").eqNullSafe(F.col("new_decision"))
    ).select(key, "previous_decision", "new_decision", kind.alias("change_type"))


# ---- observations --------------------------------------------------------


def extract_observations(places: DataFrame, reviews: DataFrame, rules: DataFrame) -> DataFrame:
    """Price observations by phrase: in the description, else in the first review that holds the phrase.

    rules: place_id, rule_id, phrase, price_type, amount; places: place_id, description;
    reviews: place_id, review_id, text. The rules of a place travel as one array, so a place
    with very many reviews is never gathered anywhere.
    """
    packed = rules.groupBy("place_id").agg(F.array_sort(F.collect_list(F.struct("rule_id", F.lower("phrase").alias("phrase")))).alias("rules"))
    in_text = places.join(packed, "place_id").select("place_id", F.lower(F.coalesce("description", F.lit(""))).alias("t"), F.explode("rules").alias("r")).filter(
        F.col("t").contains(F.col("r.phrase"))).select(F.col("r.rule_id").alias("rule_id"), F.lit(0).alias("in_review"), F.lit(None).cast("bigint").alias("review_id"))
    in_review = join_one_per_key(reviews, packed, "place_id", "inner").select(
        F.col("review_id").cast("bigint"), F.lower(F.coalesce("text", F.lit(""))).alias("t"), F.explode("rules").alias("r")).filter(
        F.col("t").contains(F.col("r.phrase"))).groupBy(F.col("r.rule_id").alias("rule_id")).agg(F.min("review_id").alias("review_id")).select(
        "rule_id", F.lit(1).alias("in_review"), "review_id")
    found = in_text.unionByName(in_review).groupBy("rule_id").agg(F.min(F.struct("in_review", "review_id")).alias("f"))
    return rules.join(found, "rule_id").select(
        "rule_id", "place_id", "price_type", "amount", "phrase",
        F.when(F.col("f.in_review") == 0, F.lit("description")).otherwise(F.lit("review")).alias("found_in"), F.col("f.review_id").alias("review_id"))


def number_contexts(df: DataFrame, key: str, text: Column) -> DataFrame:
    """Every number of a text with its false-positive class, read before dots are touched."""
    from waymark.functions.money import false_positive_class

    numbers = F.regexp_extract_all(text, F.lit(r"(\b[0-9]+(?:\.[0-9]+)?\b)"), F.lit(1))
    value = F.col("raw").cast("double")
    return df.select(key, F.explode(numbers).alias("raw")).select(key, "raw", value.alias("value"), false_positive_class(value).alias("false_positive_type"))


def price_conflicts(observations: DataFrame, key: list[str], amount: str = "amount", row_id: str = "obs_id") -> DataFrame:
    """Conflicting amounts per semantic key, one row per distinct amount.

    Conflicts are between observations of different amounts under one key. They are kept in
    factored form: each amount with its number of observations and the number of conflicting
    pairs it takes part in, next to the selected (largest) amount. That holds everything a
    list of pairs holds, without its quadratic size.
    """
    per_amount = observations.groupBy(*key, amount).agg(F.count("*").alias("observations"), F.min(row_id).alias("first_observation"))
    per_key = per_amount.groupBy(*key).agg(
        F.sum("observations").alias("_all"), F.count("*").alias("distinct_amounts"), F.max(amount).alias("selected_amount")).filter("distinct_amounts > 1")
    return per_amount.join(per_key, key).select(
        *key, amount, "observations", "first_observation", "distinct_amounts", "selected_amount",
        (F.col(amount) == F.col("selected_amount")).alias("is_selected"), (F.col("observations") * (F.col("_all") - F.col("observations"))).alias("conflicting_pairs"))


def select_final(observations: DataFrame, key: list[str], entry_type: str, winner: str = "max", row_id: str = "obs_id") -> DataFrame:
    """One price per key. Entry prices take the largest or smallest amount, all others the first observation."""
    sign = -1.0 if winner == "max" else 1.0
    rank = F.when(F.col("price_type") == entry_type, F.col("amount") * sign)
    return keep_first(observations, key, [rank.asc_nulls_last(), F.col(row_id).asc(), F.col("amount").asc()])


def research_status(population: DataFrame, observations: DataFrame, types: list[str]) -> DataFrame:
    """Research status and flags per price type for every place."""
    per = observations.groupBy("place_id").agg(
        F.count("*").alias("observations_found"), *[F.bool_or(F.col("price_type") == x).alias(f"has_{x}_price") for x in types])
    df = population.join(per, "place_id", "left").fillna(0, ["observations_found"]).fillna(False, [f"has_{x}_price" for x in types])
    found = F.col("observations_found") > 0
    return df.withColumns({
        "research_status": F.when(found, F.lit("completed_with_price")).otherwise(F.lit("completed_no_current_price")),
        "research_confidence": F.when(found, F.lit(0.9)).otherwise(F.lit(0.0)), "unresolved": ~found})


def verification_queue(population: DataFrame, prices: DataFrame) -> DataFrame:
    """Places to verify, with a priority from the best evidence at hand.

    prices: place_id, price_data_status (rejected ones are ignored).
    """
    ok = F.col("price_data_status") != "rejected"
    per = prices.groupBy("place_id").agg(
        F.count("*").alias("observation_count"), F.count_if(ok).alias("usable_price_count"),
        F.bool_or(F.col("price_data_status") == "provisional_recent").alias("_recent"), F.bool_or(F.col("price_data_status") == "historical_reference").alias("_old"))
    df = population.join(per, "place_id", "left").fillna(0, ["observation_count", "usable_price_count"])
    priority = first_match([(F.col("observation_count") == 0, "low"), (yes(F.col("_recent")), "high"), (yes(F.col("_old")), "medium")], "medium")
    reason = first_match(
        [
            (F.col("observation_count") == 0, "No local price evidence found. Needs thorough external search."),
            (yes(F.col("_recent")), "Provisional price exists from recent reviews. Needs official confirmation."),
            (yes(F.col("_old")), "Only historical review prices exist. Needs current validation."),
        ],
        "Unknown date observations present. Needs verification.")
    return df.withColumns({"verification_priority": priority, "reason": reason}).drop("_recent", "_old")


# ---- outside sources -----------------------------------------------------


def check_sources(claims: DataFrame, pages: DataFrame) -> DataFrame:
    """Whether a stored page really holds what is claimed from it: excerpt, every number of it, and the name.

    claims: claim_id, url, excerpt, name; pages: url (unique), body.
    """
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    df = join_one_per_key(claims, pages.select("url", "body"), "url", "left")
    body, excerpt = squeeze(F.coalesce("body", F.lit(""))), squeeze(F.col("excerpt"))
    numbers = F.regexp_extract_all(F.replace(F.col("excerpt"), F.lit("."), F.lit("")), F.lit(r"(\b[0-9]+\b)"), F.lit(1))
    df = df.select("claim_id", "url", F.col("body").isNotNull().alias("retrieved"),
                   F.lower(body).contains(F.lower(excerpt)).alias("excerpt_found"), F.forall(numbers, lambda n: body.contains(n)).alias("price_text_found"),
                   F.lower(body).contains(F.lower("name")).alias("identity_found"))
    reasons = flag_names([(~F.col("excerpt_found"), "excerpt not found"), (~F.col("price_text_found"), "price text not found"), (~F.col("identity_found"), "identity text not found")])
    return df.withColumn("failed_checks", F.array_join(reasons, ", ")).withColumn(
        "audit_status", F.when(F.col("retrieved") & (F.col("failed_checks") == ""), F.lit("passed")).otherwise(F.lit("failed")))


def compare_with_local(external: DataFrame, local: DataFrame) -> DataFrame:
    """Each outside price against the local prices of the same place and type.

    Day and audience must agree unless either side carries the wildcard. A row with local prices of
    its type but none compatible is left out; one without any local price of its type is 'external_only'.

    The local side is reduced to one row per (place, type): a list of its semantic groups, whose
    length is bounded by the number of day, audience and status values. Each outside row therefore
    meets one row, and counts of matching and differing local prices stand for the single pairs.

    external: ext_id, place_id, price_type, day_type, audience, amount; local: the same plus verification.
    """
    pair = lambda: F.concat_ws("|", F.col("place_id").cast("string"), "price_type")
    groups = local.groupBy(pair().alias("_key"), "day_type", "audience", "verification").agg(
        F.count("*").alias("n"), F.min("amount").alias("low"), F.max("amount").alias("high"))
    by_type = groups.groupBy("_key").agg(F.collect_list(F.struct("day_type", "audience", "verification", "n", "low", "high")).alias("_local"))
    exact = local.groupBy(F.concat_ws("|", F.col("place_id").cast("string"), "price_type", F.col("amount").cast("string")).alias("_akey"), "day_type", "audience").agg(F.count("*").alias("n"))
    by_amount = exact.groupBy("_akey").agg(F.collect_list(F.struct("day_type", "audience", "n")).alias("_same"))
    df = external.withColumns({"_key": pair(), "_akey": F.concat_ws("|", F.col("place_id").cast("string"), "price_type", F.col("amount").cast("string"))})
    df = join_one_per_key(df, by_type, "_key", "left")
    df = join_one_per_key(df, by_amount, "_akey", "left")

    def compatible(g):
        day = (g["day_type"] == F.col("day_type")) | (g["day_type"] == DAY_WILDCARD) | (F.col("day_type") == DAY_WILDCARD)
        who = (g["audience"] == F.col("audience")) | (g["audience"] == AUDIENCE_WILDCARD) | (F.col("audience") == AUDIENCE_WILDCARD)
        return day & who

    total = lambda arr: F.coalesce(F.aggregate(arr, F.lit(0).cast("bigint"), lambda acc, g: acc + g["n"]), F.lit(0))
    fit = F.filter("_local", compatible)
    df = df.select("*", fit.alias("_fit")).withColumns({
        "n_compatible": total(F.col("_fit")), "n_match": total(F.filter("_same", compatible)),
        "local_low": F.array_min(F.transform("_fit", lambda g: g["low"])), "local_high": F.array_max(F.transform("_fit", lambda g: g["high"])),
    })
    all_current = F.forall(F.col("_fit"), lambda g: g["verification"] != "historical")
    all_old = F.forall(F.col("_fit"), lambda g: g["verification"] == "historical")
    differs = F.col("n_compatible") > F.col("n_match")
    status = first_match(
        [
            (F.col("_local").isNull(), "external_only"), (~differs, "match"), (all_old, "historical_difference"), (all_current, "different_current_price"),
        ],
        "mixed_difference")
    gap = F.greatest(F.abs(F.col("amount") - F.col("local_low")), F.abs(F.col("amount") - F.col("local_high")))
    return df.filter(F.col("_local").isNull() | (F.size("_fit") > 0)).select(
        "ext_id", "place_id", "price_type", F.when(F.col("_local").isNotNull(), F.col("n_compatible")).alias("n_compatible"),
        F.when(F.col("_local").isNotNull(), F.col("n_match")).alias("n_match"), "local_low", "local_high", gap.alias("largest_difference"),
        F.round(F.coalesce(F.try_divide(F.abs(F.col("amount") - F.col("local_low")) * 100, "local_low"), F.when(F.col("local_low").isNotNull(), F.lit(0.0))), 4).alias("difference_percent"),
        status.alias("comparison_status"))


def verified_prices(external: DataFrame, local: DataFrame) -> DataFrame:
    """Outside prices with a verified identity, their state, confidence and local support.

    Support is a count plus the key (place, price type) under which the supporting local
    observations are found; no list is gathered.
    """
    key = lambda: F.concat_ws("|", F.col("place_id").cast("string"), "price_type")
    support = local.groupBy(key().alias("support_key")).agg(F.count("*").alias("supporting_local_count"), F.min("obs_id").alias("first_local_observation"))
    ok = external.filter("identity_status = 'verified'").withColumn("support_key", key())
    df = join_one_per_key(ok, support, "support_key", "left").fillna(0, ["supporting_local_count"])
    state = F.when(F.col("temporal_status").isin("verified_current", "official_live_unbounded"), F.col("temporal_status")).otherwise(F.lit("externally_supported_recent"))
    return df.withColumns({"price_data_status": state, "confidence": F.when(state == "verified_current", F.lit(0.9)).otherwise(F.lit(0.8))})


def verification_coverage(queue: DataFrame, sources: DataFrame, observations: DataFrame, verified: DataFrame, conflicts: DataFrame,
                          previous: DataFrame | None = None) -> DataFrame:
    """Counts per place and the status they lead to; places outside this run keep their previous row."""
    s = sources.groupBy("place_id").agg(
        F.count("*").alias("sources_checked"), F.count_if(F.col("research_status") == "accepted").alias("accepted_sources"),
        F.count_if(F.col("source_type").isin("official_website", "official_social_media")).alias("official_sources"),
        F.count_if(F.col("source_type") == "government").alias("government_sources"))
    o = observations.groupBy("place_id").agg(F.count("*").alias("external_observations"))
    p = F.col("price_data_status")
    v = verified.groupBy("place_id").agg(
        F.count_if(p == "verified_current").alias("verified_current_prices"), F.count_if(p == "official_live_unbounded").alias("official_live_unbounded_prices"),
        F.count_if(p == "externally_supported_recent").alias("provisional_external_prices"))
    k = conflicts.groupBy("place_id").agg(F.count("*").alias("conflicts"))
    counts = ["sources_checked", "accepted_sources", "official_sources", "government_sources", "external_observations", "verified_current_prices",
              "official_live_unbounded_prices", "provisional_external_prices", "conflicts"]
    df = queue
    for part in (s, o, v, k):
        df = df.join(part, "place_id", "left")
    df = df.fillna(0, counts)
    status = first_match(
        [
            (F.col("external_observations") == 0, "completed_no_price"), (F.col("verified_current_prices") > 0, "completed_verified"),
            (F.col("official_live_unbounded_prices") > 0, "completed_official_unbounded"),
        ],
        "completed_provisional")
    df = df.withColumn("verification_status", status)
    df = df.withColumn("research_confidence", first_match(
        [(F.col("verification_status").isin("completed_verified", "completed_official_unbounded"), 0.9), (F.col("verification_status") == "completed_provisional", 0.5)], 0.0))
    if previous is not None:
        kept = previous.join(queue.select("place_id"), "place_id", "left_anti")
        df = df.unionByName(kept, allowMissingColumns=True)
    return df


def unresolved(coverage: DataFrame) -> DataFrame:
    return coverage.filter(F.col("verification_status").isin("completed_no_price", "completed_unresolved"))


def input_audit(candidates: DataFrame, population: DataFrame, priorities: list[str]) -> DataFrame:
    """Uniqueness, allowed priorities, membership in the population and no closed places."""
    open_only = candidates.withColumn("is_closed", F.col("operational_status") == "permanently_closed")
    return expectations(open_only, {"original_priority": priorities, "is_closed": [False]}, ["place_id"], {"place_id": population.select("place_id")})


def run_manifest(parts: dict[str, DataFrame]) -> DataFrame:
    """Per place and kind of record: how many, and an order-free fingerprint of their ids.

    The id lists themselves are the long tables; they are not packed into one row.
    parts: kind -> (place_id, id).
    """
    out = None
    for kind, df in parts.items():
        part = df.groupBy("place_id").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                                          F.bit_xor(F.xxhash64(F.col("id").cast("string"))).alias("fingerprint")).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out
