"""Prices in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from waymark.functions.rules import contains_any, first_match, yes

# Zero-price texts, free-entry words and the two mention patterns.
ZERO_TEXTS = ["0", "rp 0", "rp. 0", "rp0"]
FREE_WORDS = ["free", "gratis", "cuma-cuma"]
MENTION_AFTER_LABEL = (
    r"(?:tiket masuk|htm|harga tiket|tiket|masuk|parkir|retribusi)\s*(?:rp\.?\s*)?"
    r"([0-9]+(?:\.[0-9]+)?)\s*(?:ribu|k)?\b"
)
MENTION_BEFORE_UNIT = (
    r"(?:rp\.?\s*)?([0-9]+(?:\.[0-9]+)?)\s*(?:ribu|k)?\s*(?:per orang|/orang|orang|dewasa|anak)"
)
MENTION_PATTERNS = [MENTION_AFTER_LABEL, MENTION_BEFORE_UNIT]


def price_value(c: Column) -> Column:
    """Number meant by a price text such as `Rp 15.000`, `15k` or `Gratis`."""
    p = F.trim(F.lower(c))
    thousands = F.regexp_extract(p, r"([0-9]+(?:\.[0-9]+)?)\s*k\b", 1)
    runs = F.regexp_extract_all(p, F.lit(r"([0-9.,]+)"), F.lit(1))
    # longest run, the first one when several are equally long
    ranked = F.transform(runs, lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x")))
    run = F.array_max(ranked)["x"]
    by_comma = F.split(run, ",")
    by_dot = F.split(run, r"\.")
    no_dots = F.replace(F.get(by_comma, F.lit(0)), F.lit("."), F.lit(""))
    decimal_comma = F.concat(no_dots, F.lit("."), F.get(by_comma, F.lit(1)))
    number = first_match(
        [
            (run.contains(".") & run.contains(","), decimal_comma),
            (run.contains(",") & (F.size(by_comma) == 2) & (F.length(F.get(by_comma, F.lit(1))) == 2), decimal_comma),
            (run.contains(","), F.replace(run, F.lit(","), F.lit(""))),
            (run.contains(".") & (F.length(F.element_at(by_dot, -1)) == 3), F.replace(run, F.lit("."), F.lit(""))),
        ],
        run,
    )
    return first_match(
        [
            (c.isNull() | (c == ""), F.lit(None).cast("double")),
            (p.isin(ZERO_TEXTS) | contains_any(p, FREE_WORDS), F.lit(0.0)),
            (thousands != "", thousands.try_cast("double") * 1000),
        ],
        number.try_cast("double"),
    )


def price_mentions(text: Column, patterns: list[str] = MENTION_PATTERNS) -> Column:
    """Array of structs, one per price mention; a span may match both patterns."""
    low = F.lower(text)

    def reader(pattern):
        return lambda whole: mention(whole, pattern)

    def mention(whole, pattern):
        # the number is read again from the short match, so the text itself is scanned once per pattern
        raw = F.regexp_extract(whole, pattern, 1)
        value = F.replace(raw, F.lit("."), F.lit("")).cast("double")
        scaled = F.when((whole.contains("ribu") | whole.contains("k")) & (value < 1000), value * 1000).otherwise(value)
        return F.struct(
            whole.alias("matched"),
            scaled.alias("amount"),
            F.when(whole.contains("parkir"), F.lit("parking_fee")).otherwise(F.lit("entrance_fee")).alias("price_type"),
            first_match([(whole.contains("dewasa"), "adult"), (whole.contains("anak"), "child")], "general").alias(
                "applies_to"
            ),
            F.lit(0.8).alias("confidence"),
        )

    found = [
        F.transform(F.regexp_extract_all(low, F.lit(p), F.lit(0)), reader(p)) for p in patterns
    ]
    return F.concat(*found)


def false_positive_class(value: Column, ratings=(4.5, 4.8), years=(2024, 2025, 2026), phone_floor=1_000_000_000) -> Column:
    """Why a number in a price context is not a price; 'none' when it may be one."""
    return first_match(
        [
            (value.isin(*[float(r) for r in ratings]), "rating"),
            (value.isin(*[float(y) for y in years]), "year"),
            (value > phone_floor, "phone_number"),
        ],
        "none",
    )


def temporal_quality(text: Column, unknown_years: list[str], recent_years: list[str]) -> Column:
    """Struct (quality, status, confidence) from the years named in a text."""
    def out(quality, status, confidence):
        return F.struct(F.lit(quality).alias("quality"), F.lit(status).alias("status"), F.lit(confidence).alias("confidence"))

    return first_match(
        [
            (contains_any(text, unknown_years), out("unknown", "unknown_date", 0.3)),
            (contains_any(text, recent_years), out("recent", "recent_unverified", 0.9)),
        ],
        out("historical", "historical", 0.5),
    )


def price_data_status(rejected: Column, verification: Column) -> Column:
    return first_match(
        [
            (yes(rejected), "rejected"),
            (verification == "recent_unverified", "provisional_recent"),
            (verification == "historical", "historical_reference"),
        ],
        "unresolved",
    )
