"""Metadata survivorship: which record supplies which value, with conflicts and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import geo, hours, urls
from waymark.functions.rules import first_match, flag_names, tiers, weighted_flags, yes
from waymark.functions.text import is_filled
from waymark.operators.ranking import newest
from waymark.operators.skew import join_one_per_key

# Completeness weights of the two runs and class limits.
PILOT_WEIGHTS = {"address": 15, "coordinates": 15, "website": 10, "phone": 10, "hours": 15, "status": 10, "facilities": 15, "description": 5, "tags": 5}
FULL_WEIGHTS = {"mapped": 20, "address": 15, "website": 15, "phone": 10, "hours": 10, "status": 15, "facilities": 10, "description": 5}
CLASS_LIMITS = [(90, "complete"), (75, "strong"), (50, "moderate")]

TRUE_TEXTS = ["true", "1"]


def is_true(c: Column) -> Column:
    """Flags arrive as booleans, 'true' or '1'."""
    return yes(F.lower(c.cast("string")).isin(TRUE_TEXTS))


def status_of(permanent: Column, temporary: Column) -> Column:
    return first_match([(yes(permanent), "permanently_closed"), (yes(temporary), "temporarily_closed")], "open")


def operational_status(records: DataFrame, population: DataFrame) -> DataFrame:
    """Status per place: any permanent closure, then any temporary one, then open; unknown without records."""
    per = records.groupBy("place_id").agg(
        F.bool_or(is_true(F.col("perm_closed"))).alias("p"), F.bool_or(is_true(F.col("temp_closed"))).alias("t"), F.count("*").alias("n"))
    return population.join(per, "place_id", "left").select(
        "place_id", F.when(F.col("n").isNull(), F.lit("unknown")).otherwise(status_of(F.col("p"), F.col("t"))).alias("operational_status"),
        F.coalesce("n", F.lit(0)).alias("source_count"))


def survivors(records: DataFrame, population: DataFrame, blank_website: bool = True) -> DataFrame:
    """Selected values per place: the newest record supplies them, the population fills gaps.

    `blank_website`: a newest record without website blanks the value (else the default stays).
    A website counts only when it is an official one.

    records: place_id, record_id, collected_at, phone, website, address, rating.
    population: place_id, default_phone, default_website, default_rating.
    """
    new = newest(records, ["place_id"], "collected_at", "record_id").select(
        "place_id", F.col("record_id").alias("newest_record"), "collected_at", "phone", "website", "address", "rating")
    default_site = F.when(urls.website_class(F.col("default_website")) == "official", F.col("default_website")).otherwise(F.lit(""))
    has_site = is_filled(F.col("website"))
    new_site = F.when(urls.website_class(F.col("website")) == "official", F.trim("website")).otherwise(F.lit(""))
    mapped = F.col("newest_record").isNotNull()
    kept_site = F.lit("") if blank_website else default_site
    return population.join(new, "place_id", "left").select(
        "place_id", "newest_record", "collected_at", F.coalesce("address", F.lit("")).alias("address"),
        F.when(~mapped, default_site).when(has_site, new_site).otherwise(kept_site).alias("website"),
        F.when(is_filled(F.col("phone")), urls.mobile_phone(F.col("phone"))).otherwise(
            F.when(is_filled(F.col("default_phone")), urls.mobile_phone(F.col("default_phone"))).otherwise(F.lit(""))).alias("phone"),
        F.coalesce("rating", "default_rating").alias("rating"),
        F.when(mapped, F.lit("mapped")).otherwise(F.lit("unmapped")).alias("mapping_status"))


def conflicts(records: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows where an older record disagrees with a selected value.

    One pass over the records: each joins the one selected row of its place and
    the differing fields are exploded.

    selected: place_id, newest_record, website, phone, address, operational_status, lat, lon, categories,
    opening_hours (of the newest record). records: the same fields as delivered.
    """
    chosen = selected.select(
        "place_id", "newest_record", *[F.col(c).alias(f"sel_{c}") for c in
                                       ("website", "phone", "address", "operational_status", "lat", "lon", "categories", "opening_hours")])
    both = join_one_per_key(records, chosen, "place_id", "inner").filter("record_id <> newest_record")
    col, sel = F.col, lambda c: F.col(f"sel_{c}")
    site, phone, address = col("website"), col("phone"), col("address")
    state = status_of(is_true(col("perm_closed")), is_true(col("temp_closed")))
    point = lambda a, b: F.concat_ws(",", a.cast("string"), b.cast("string"))
    both_filled = lambda a, b: is_filled(a) & is_filled(b)

    def entry(differs, field, a, b, rule):
        return F.when(yes(differs), F.struct(
            F.lit(field).alias("field_name"), a.cast("string").alias("value_a"), b.cast("string").alias("value_b"),
            F.lit(rule).alias("resolution")))

    newest_rule = "newest_source_priority"
    found = F.array(
        entry(both_filled(site, sel("website")) & (urls.website_class(site) == "official") & (urls.url_key(site) != urls.url_key(sel("website"))),
              "website", sel("website"), F.trim(site), newest_rule),
        entry(both_filled(phone, sel("phone")) & (urls.mobile_phone(phone) != urls.mobile_phone(sel("phone"))),
              "phone", sel("phone"), F.trim(phone), newest_rule),
        entry(both_filled(address, sel("address")) & (F.lower(F.trim(address)) != F.lower(sel("address"))),
              "address", sel("address"), F.trim(address), newest_rule),
        entry(col("lat").isNotNull() & col("lon").isNotNull() & sel("lat").isNotNull() & sel("lon").isNotNull()
              & (geo.haversine_m(sel("lat"), sel("lon"), col("lat"), col("lon")) > 100.0),
              "coordinates", point(sel("lat"), sel("lon")), point(col("lat"), col("lon")), newest_rule),
        entry(state != sel("operational_status"), "operational_status", sel("operational_status"), state, "operational_status_priority"),
        entry((F.size("categories") > 0) & (F.size("sel_categories") > 0) & ~F.arrays_overlap("categories", "sel_categories"),
              "category", F.to_json("sel_categories"), F.to_json("categories"), newest_rule),
        entry(both_filled(col("opening_hours"), sel("opening_hours"))
              & (F.lower(F.trim("opening_hours")) != F.lower(F.trim("sel_opening_hours"))),
              "opening_hours", F.trim("sel_opening_hours"), F.trim("opening_hours"), newest_rule),
    )
    return both.select("place_id", "newest_record", "record_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("c")).select(
        "place_id", F.col("newest_record").alias("source_a"), F.col("record_id").alias("source_b"), "c.*")


def provenance(selected: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row per filled selected field."""
    long = selected.select(key, *[F.col(c).cast("string").alias(c) for c in fields]).unpivot([key], fields, "field_name", "field_value")
    return long.filter(is_filled(F.col("field_value")))


def opening_hours_rows(places: DataFrame, key: str, entries: str) -> DataFrame:
    """One row per recognised day with readable hours."""
    rows = places.select(key, F.explode(entries).alias("e")).select(
        key, hours.lookup(F.lower(F.trim("e.day")), hours.DAY_NAMES).alias("day_of_week"), F.col("e.hours").alias("raw_value"),
        hours.parse_hours(F.col("e.hours")).alias("h")).select(key, "day_of_week", "raw_value", "h.*")
    return rows.filter(F.col("day_of_week").isNotNull() & ((F.col("open_time") != "") | (F.col("close_time") != "") | F.col("is_24_hours") | F.col("is_closed")))


def facility_rows(places: DataFrame, key: str, groups: str) -> DataFrame:
    """One row per facility item with its group and availability."""
    per_group = places.select(key, F.explode(F.map_entries(groups)).alias("g"))
    per_item = per_group.select(key, F.col("g.key").alias("grp"), F.explode("g.value").alias("m")).select(
        key, "grp", F.explode(F.map_entries("m")).alias("i"))
    return per_item.select(
        key, hours.facility_group(F.col("grp"), F.col("i.key")).alias("facility_group"), F.col("i.key").alias("facility_name"),
        hours.availability(F.col("i.value")).alias("availability"))


def contact_rows(selected: DataFrame, key: str) -> DataFrame:
    """Contacts of a place: website, phone and map link where filled."""
    kinds = [("website", "website"), ("phone", "phone"), ("source_url", "map_url")]
    rows = F.array(*[F.struct(F.lit(kind).alias("contact_type"), F.col(c).alias("value")) for c, kind in kinds])
    return selected.select(key, F.explode(rows).alias("r")).select(key, "r.*").filter(is_filled(F.col("value")))


def record_relations(records: DataFrame, selected: DataFrame) -> DataFrame:
    """Every delivered address and phone with whether it is the selected one and whether it conflicts."""
    chosen = selected.select("place_id", "newest_record", F.col("address").alias("sel_address"))
    both = join_one_per_key(records, chosen, "place_id", "inner")
    first = F.col("record_id") == F.col("newest_record")
    norm = urls.mobile_phone(F.col("phone"))
    rows = F.array(
        F.when(is_filled(F.col("address")), F.struct(
            F.lit("address").alias("relation"), F.col("address").alias("value"), F.lit("").alias("kind"),
            (~first & (F.col("address") != F.col("sel_address"))).alias("conflict"))),
        F.when(is_filled(F.col("phone")), F.struct(
            F.lit("phone").alias("relation"), norm.alias("value"), urls.phone_type(norm).alias("kind"), F.lit(False).alias("conflict"))),
    )
    return both.select("place_id", "record_id", first.alias("is_selected"), F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select(
        "place_id", "record_id", "is_selected", "r.*")


def website_relations(records: DataFrame, name: Column) -> DataFrame:
    """Every delivered website with its detailed class."""
    sites = records.filter(is_filled(F.col("website")))
    return sites.select("place_id", "record_id", "website", urls.website_detail(F.col("website"), name).alias("d")).select(
        "place_id", "record_id", "website", "d.*")


def field_states(df: DataFrame) -> DataFrame:
    """Why a field is empty: observed, missing, unknown or not applicable.

    df: place_id, website, phone, address, description, has_hours, has_facilities, operational_status, mapped, has_place_id.
    """
    seen = lambda c: F.when(is_filled(F.col(c)), F.lit("observed")).otherwise(F.lit("missing"))
    gone = F.col("operational_status") == "permanently_closed"
    layer = lambda c: first_match([(yes(F.col(c)), "observed"), (gone, "not_applicable")], "missing")
    site = first_match([(is_filled(F.col("website")), "observed"), (~yes(F.col("has_place_id")), "not_applicable")], "missing")
    return df.select(
        "place_id", site.alias("website_status"), seen("phone").alias("phone_status"), seen("address").alias("address_status"),
        seen("description").alias("description_status"), layer("has_hours").alias("hours_status"), layer("has_facilities").alias("facility_status"),
        F.when(yes(F.col("mapped")), F.lit("observed")).otherwise(F.lit("unknown")).alias("operational_state"))


def completeness(weights: dict[str, int]) -> Column:
    """Weighted sum of the flag columns named in `weights`."""
    return weighted_flags([(F.col(c), w) for c, w in weights.items()])


def completeness_class(score: Column, limits=CLASS_LIMITS) -> Column:
    return tiers(score, limits, "sparse")


def warnings(flags: dict[str, Column]) -> Column:
    """Sorted warning names as JSON text."""
    return F.to_json(F.array_sort(flag_names([(c, n) for n, c in flags.items()])))


def status_audit(records: DataFrame) -> DataFrame:
    """Sources behind a status: count, sorted source types, and whether any record disagrees with the newest one."""
    new = newest(records, ["place_id"], "collected_at", "record_id").select(
        "place_id", F.col("record_id").alias("selected_source"), is_true(F.col("perm_closed")).alias("newest_closed"))
    per = records.groupBy("place_id").agg(
        F.count("*").alias("source_count"), F.array_join(F.array_sort(F.collect_set("source")), "/").alias("source_types"),
        F.bool_or(is_true(F.col("perm_closed"))).alias("_any"), F.bool_and(is_true(F.col("perm_closed"))).alias("_all"))
    return per.join(new, "place_id").select(
        "place_id", "source_count", "source_types", "selected_source",
        F.when(F.col("newest_closed"), ~F.col("_all")).otherwise(F.col("_any")).alias("conflict_present"))
