"""Normalisation and classification of place records: one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions import geo, hours, text, urls
from waymark.functions.rules import any_word_in, contains_any, first_match, flag_names, word_in, yes


def category_tags(categories: Column, name: Column, rules=config.TAG_RULES, priority=config.TAG_PRIORITY) -> Column:
    """Struct (primary, tags) from words in the categories and the name; tags come sorted."""
    low_name = F.lower(name)
    blob = F.concat(F.lower(F.array_join(categories, " ")), F.lit(" "), low_name)
    hits = [
        F.when(contains_any(blob, words), F.array(*[F.lit(t) for t in tags])).otherwise(F.array().cast("array<string>"))
        for words, tags in rules
    ]
    found = F.array_sort(F.array_distinct(F.concat(*hits)))
    fallback = F.when(yes(low_name.contains("wisata") | blob.contains("attraction")), F.array(F.lit("recreation")))
    tags = F.when(F.size(found) > 0, found).otherwise(F.coalesce(fallback, F.array(F.lit("other"))))
    primary = first_match([(F.array_contains(tags, p), p) for p in priority], "other")
    return F.struct(primary.alias("primary"), tags.alias("tags"))


def classify(
    name: Column, categories: Column, lat: Column, lon: Column,
    description: Column, review_count: Column, search: Column,
    vocab: dict = config.CLASSIFY, box=config.TARGET_BOX,
) -> Column:
    """Struct (decision, reason, confidence, signals) of a place record.

    The rules form one ordered cascade, so the whole decision is a single CASE.
    """
    first = F.initcap(F.trim(F.get(categories, F.lit(0))))
    primary = F.lower(first)
    low = F.lower(name)
    rest = F.slice(categories, F.lit(2), F.greatest(F.size(categories), F.lit(0)))
    none = F.array().cast("array<string>")

    def out(decision, reason, confidence, signals):
        sig = signals if isinstance(signals, Column) else (F.array(*[F.lit(s) for s in signals]) if signals else none)
        why = reason if isinstance(reason, Column) else F.lit(reason)
        return F.struct(
            F.lit(decision).alias("decision"), why.alias("reason"),
            F.lit(confidence).alias("confidence"), sig.alias("signals"),
        )

    def with_name(fmt, value):
        return F.format_string(fmt, value)

    secondary_park = F.transform(
        F.filter(rest, lambda c: contains_any(F.lower(c), vocab["park_secondary"])),
        lambda c: F.concat(F.lit("secondary_category:"), c),
    )
    park_signals = F.concat(
        flag_names([(word_in(low, w), f"name_keyword:{w}") for w in vocab["park_name_words"]]),
        flag_names([(word_in(F.lower(description), w), f"desc_keyword:{w}") for w in vocab["park_name_words"]]),
        F.coalesce(secondary_park, none),
        flag_names([(review_count >= vocab["park_min_reviews"], F.concat(F.lit("high_reviews:"), review_count.cast("string")))]),
        flag_names([(F.lower(search).contains(w), f"search_keyword:{w}") for w in vocab["park_search"]]),
    )
    is_park = primary.isin(vocab["park_categories"])
    accepted = contains_any(primary, [w.lower() for w in vocab["accepted"]])
    blocked_name = yes(
        contains_any(F.concat(F.lit(" "), low, F.lit(" ")), [f" {w} " for w in vocab["accepted_name_block"]])
        | F.lit(False)
    )
    for w in vocab["accepted_name_block"]:
        blocked_name = blocked_name | yes(low.startswith(w))
    extra = F.get(
        F.filter(
            F.transform(rest, lambda c: F.initcap(F.trim(c))),
            lambda c: contains_any(F.lower(c), [w.lower() for w in vocab["accepted"]]),
        ),
        F.lit(0),
    )
    bad_word = first_match([(word_in(low, w), w) for w in vocab["rejected_name_words"]])
    good_word = first_match([(word_in(low, w), w) for w in vocab["accepted_name_words"]])

    return first_match(
        [
            (lat.isNotNull() & lon.isNotNull() & ~geo.in_box(lat, lon, box),
             out("manual_review", F.format_string("Koordinat (%s, %s) di luar target Lampung", lat.cast("string"), lon.cast("string")),
                 0.5, ["outside_bounds"])),
            (categories.isNull() | (F.size(categories) == 0),
             out("manual_review", "Lokasi tanpa kategori", 0.5, ["missing_categories"])),
            (is_park & (F.size(park_signals) > 0),
             out("accepted", F.concat(F.lit("Kategori 'Taman' disetujui dengan sinyal: "), F.array_join(park_signals, ", ")),
                 0.9, park_signals)),
            (is_park & contains_any(low, vocab["local_park_words"]),
             out("manual_review", with_name("Taman lingkungan/perumahan lokal: '%s'", name), 0.5, ["local_park_keyword"])),
            (is_park, out("manual_review", "Kategori 'Taman' tanpa sinyal wisata khusus", 0.5, [])),
            (primary.isin(vocab["lodging_categories"]) & ~contains_any(low, vocab["lodging_pass_words"]),
             out("rejected", "Kategori utama 'Rumah wisata' teridentifikasi sebagai penginapan/akomodasi", 1.0, ["category_rejected"])),
            (accepted & blocked_name,
             out("rejected", with_name("Nama mengandung unsur bisnis/non-wisata: '%s'", name), 0.8, ["name_rejected_keyword"])),
            (accepted, out("accepted", with_name("Kategori utama '%s' disetujui", first), 1.0, ["category_accepted"])),
            (contains_any(primary, [w.lower() for w in vocab["rejected"]]),
             out("rejected", with_name("Kategori utama '%s' ditolak", first), 1.0, ["category_rejected"])),
            (contains_any(primary, [w.lower() for w in vocab["manual"]]),
             out("manual_review", with_name("Kategori utama '%s' memerlukan review manual", first), 0.5, ["category_manual"])),
            (extra.isNotNull(),
             out("accepted", with_name("Kategori tambahan '%s' disetujui", extra), 0.9, ["secondary_category_accepted"])),
            (bad_word.isNotNull(),
             out("rejected", with_name("Nama mengandung keyword bisnis '%s'", bad_word), 0.9, ["name_rejected_keyword"])),
            (good_word.isNotNull(),
             out("accepted", with_name("Nama mengandung keyword wisata '%s'", good_word), 0.8, ["name_accepted_keyword"])),
        ],
        out("manual_review", with_name("Kategori '%s' tidak terklasifikasi secara otomatis", first), 0.5, []),
    )


def business_status(permanently: Column, temporarily: Column) -> Column:
    return first_match(
        [(yes(permanently), "CLOSED_PERMANENTLY"), (yes(temporarily), "CLOSED_TEMPORARILY")], "OPERATIONAL"
    )


def rating_bucket(rating: Column) -> Column:
    return first_match([(rating >= 4.0, "positive"), (rating >= 3.0, "neutral")], "negative")


def whole_stars(raw: Column, default: int = 5) -> Column:
    """Star rating cut to a whole number; unreadable values count as the default."""
    return F.coalesce(raw.cast("string").try_cast("double").cast("int"), F.lit(default))


def rating_segment(rating: Column) -> Column:
    return first_match([(rating.isNull(), "empty"), (rating >= 4.5, "high"), (rating >= 4.0, "medium")], "low")


def review_segment(count: Column) -> Column:
    return first_match([(count >= 1000, "popular"), (count >= 100, "medium"), (count >= 1, "low")], "no_review")


def has_real_website(url: Column) -> Column:
    u = F.lower(F.trim(url))
    return yes((u != "") & ~contains_any(u, ["google.com/maps", "openstreetmap.org", "google.co.id/maps"]))


def research_priority(category: Column, tags: Column, status: Column, levels=config.PRIORITY_TIERS) -> Column:
    """Struct (priority, reason): closed states first, then the first keyword of the first tier that hits."""
    blob = F.concat(F.lower(F.array_join(tags, " ")), F.lit(" "), F.lower(category))

    def out(p, why):
        return F.struct(F.lit(p).alias("priority"), F.lit(why).alias("reason"))

    rules = [
        (status == "permanently_closed", out("not_applicable", "Place is permanently closed")),
        (status == "temporarily_closed", out("low", "Place is temporarily closed")),
    ]
    for level, words in levels:
        rules += [(yes(blob.contains(w)), out(level, f"Matches {level} priority keyword '{w}'")) for w in words]
    return first_match(rules, out("low", "Default priority for other categories"))


def category_group(category: Column, groups: dict[str, list[str]] = config.CATEGORY_GROUPS) -> Column:
    return first_match([(F.lower(category).isin(members), g) for g, members in groups.items()], "other")


def query_texts(df: DataFrame, templates: list[tuple[str, str]], key: str, name: str, region: str | None = None) -> DataFrame:
    """One row per record and template; the id is the record key plus the template position."""
    def fill(body: str) -> Column:
        filled = F.replace(F.lit(body), F.lit("{name}"), F.col(name))
        return F.replace(filled, F.lit("{region}"), F.col(region)) if region else filled

    options = F.array(*[
        F.struct(F.lit(i + 1).alias("seq"), F.lit(kind).alias("query_type"), fill(body).alias("query_text"))
        for i, (kind, body) in enumerate(templates)
    ])
    return df.select(key, name, F.explode(options).alias("q")).select(
        key, name, F.col("q.seq").alias("query_seq"), "q.query_type", "q.query_text"
    )


def normalize_places(raw: DataFrame, regions=config.REGIONS, slugs=config.REGION_SLUGS, default_region=config.DEFAULT_REGION,
                     stop_phrases=config.NAME_STOP_PHRASES, vocab=config.CLASSIFY, box=config.TARGET_BOX) -> DataFrame:
    """Raw place rows to normalised place rows in one projection."""
    lat, lon = geo.coordinate(F.col("latitude")), geo.coordinate(F.col("longitude"))
    name = F.coalesce(text.collapse_whitespace(F.col("raw_name")), F.lit(""))
    cats = F.filter(
        F.transform(
            F.coalesce(F.col("raw_categories"), F.array().cast("array<string>")),
            lambda c: text.collapse_whitespace(F.lower(F.replace(c, F.lit("_"), F.lit(" ")))),
        ),
        lambda c: c.isNotNull(),
    )
    base = raw.select(
        "*", lat.alias("_lat"), lon.alias("_lon"), name.alias("name"), cats.alias("categories")
    )
    # used many times below, so it is a column of its own
    base = base.withColumn("_region", geo.region_of(F.col("raw_address"), F.col("_lat"), F.col("_lon"), regions, F.col("query_region")))
    verdict = classify(
        F.col("name"), F.col("categories"), F.col("_lat"), F.col("_lon"),
        F.col("description"), F.col("review_count"), F.col("query_keyword"), vocab, box,
    )
    return base.select(
        "source_record_id", "source", "source_place_id", "name",
        text.matching_name(F.col("name"), stop_phrases).alias("normalized_name"),
        text.collapse_whitespace(F.col("raw_address")).alias("address"),
        F.coalesce(geo.canonical_region(F.col("_region"), slugs), F.lit(default_region)).alias("city_regency"),
        "district",
        F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"),
        "categories", "rating", "review_count",
        urls.phone(F.col("phone")).alias("phone"),
        F.coalesce(urls.website(text.blank_to_null(F.col("website"))), urls.website(F.col("source_url"))).alias("website"),
        hours.hours_text(F.col("opening_hours")).alias("opening_hours"),
        business_status(F.col("permanently_closed"), F.col("temporarily_closed")).alias("business_status"),
        hours.facility_labels(F.col("facilities")).alias("facilities"),
        "source_url", "collected_at", "raw_payload_path", "query_region",
        verdict.alias("_v"),
    ).select(
        "*",
        F.col("_v.decision").alias("classification"),
        F.col("_v.confidence").alias("classification_confidence"),
        F.col("_v.signals").alias("classification_signals"),
        F.col("_v.reason").alias("classification_reason"),
    ).drop("_v")
