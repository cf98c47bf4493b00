"""Web addresses and phone numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from waymark.functions.rules import contains_any, first_match, yes

# Address fragments per website class, in rule order.
MAP_SITES = ["google.com/maps", "maps.google.com", "maps.app.goo.gl", "google.co.id/maps"]
SOCIAL_SITES = ["instagram.com", "facebook.com", "twitter.com", "x.com", "tiktok.com", "youtube.com"]
INVALID_SITES = ["openstreetmap.org", "example.com", "apify.com", "placeholder"]
MARKET_SITES = ["trip.com", "traveloka.com", "tiket.com", "booking.com", "agoda.com", "airbnb.com"]
GOVERNMENT_SITES = ["go.id", "kemlu.go.id", "indonesia.go.id"]
NEWS_SITES = ["detik.com", "kompas.com", "liputan6.com", "tribunnews.com", "tempo.co"]
BLOG_SITES = ["blogspot.com", "wordpress.com", "medium.com", "tumblr.com"]


def website(c: Column) -> Column:
    """Trimmed, lower case, with a scheme and without one trailing slash."""
    u = F.lower(F.trim(c))
    u = F.when(u.startswith("http://") | u.startswith("https://"), u).otherwise(F.concat(F.lit("https://"), u))
    return F.when(F.length(c) > 0, F.regexp_replace(u, "/$", ""))


def url_key(c: Column) -> Column:
    """Join key of an address; map links reduce to the place id they carry."""
    u = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"^https?://(www\.)?", "")
    u = F.regexp_replace(u, r"/+$", "")
    place = F.regexp_extract(u, r"query_place_id=([^&]+)", 1)
    return F.when(
        u.contains("google.com/maps") & (place != ""), F.concat(F.lit("google_maps_place_id:"), place)
    ).otherwise(u)


def host(c: Column) -> Column:
    """Host of an address, without scheme and leading www."""
    return F.regexp_extract(F.lower(F.trim(c)), r"^(?:https?://)?(?:www\.)?([^/]*)", 1)


def authority(c: Column) -> Column:
    """Network location exactly as written after the scheme; empty without a scheme."""
    return F.regexp_extract(c, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)


def website_class(c: Column, maps=MAP_SITES, social=SOCIAL_SITES, invalid=INVALID_SITES) -> Column:
    u = F.lower(F.trim(c))
    return first_match(
        [
            (u.isNull() | (u == ""), "missing"),
            (contains_any(u, maps), "google_maps"),
            (contains_any(u, social), "social_media"),
            (contains_any(u, invalid), "invalid"),
        ],
        "official",
    )


def website_detail(c: Column, name: Column) -> Column:
    """Struct with type, status, identity match, domain, official flag and reason."""
    u = F.lower(F.trim(c))
    squeezed_url = F.regexp_replace(u, r"(?U)\W+", "")
    squeezed_name = F.regexp_replace(F.lower(name), r"(?U)\W+", "")
    long_words = F.filter(F.split(F.trim(F.lower(name)), r"(?U)\s+"), lambda w: F.length(w) > 3)
    own_profile = yes(
        squeezed_url.contains(squeezed_name) | F.exists(long_words, lambda w: squeezed_url.contains(w))
    )

    def out(kind, status, identity, official, reason):
        return F.struct(
            F.lit(kind).alias("website_type"),
            F.lit(status).alias("website_status"),
            F.lit(identity).alias("identity_match_status"),
            F.when(F.coalesce(u, F.lit("")) == "", F.lit("")).otherwise(host(c)).alias("domain"),
            F.lit(official).alias("is_official"),
            F.lit(reason).alias("classification_reason"),
        )

    social = contains_any(u, SOCIAL_SITES)
    return first_match(
        [
            (u.isNull() | (u == ""), out("unknown", "missing", "none", False, "URL is empty")),
            (contains_any(u, MAP_SITES), out("map_profile", "google_maps_only", "none", False, "Google Maps profile URL")),
            (u.contains("openstreetmap.org"),
             out("map_profile", "openstreetmap_only", "none", False, "OpenStreetMap profile URL")),
            (contains_any(u, MARKET_SITES),
             out("travel_marketplace", "aggregator", "none", False, "Booking or travel marketplace site")),
            (u.contains("wikipedia.org"), out("directory", "reference", "none", False, "Wikipedia reference article")),
            (contains_any(u, GOVERNMENT_SITES),
             out("government", "official", "strong", True, "Official government domain")),
            (contains_any(u, NEWS_SITES), out("news_media", "news", "none", False, "News media listing or article")),
            (contains_any(u, BLOG_SITES), out("blog", "blog", "none", False, "Personal or travel blog")),
            (social & own_profile,
             out("official_social_media", "social_media", "strong", True,
                 "Official social media channel (name matches profile)")),
            (social,
             out("official_social_media", "social_media", "weak", False,
                 "Social media channel with weak name matching")),
        ],
        out("official_website", "official", "strong", True, "Custom independent domain matching identity"),
    )


def source_profile(url: Column, title: Column, name: Column) -> Column:
    """Class and identity of an outside source, with confidence and authority."""
    u = F.lower(url)
    named = F.when(yes(F.lower(title).contains(F.lower(name))), F.lit("verified")).otherwise(F.lit("probable"))
    kind = first_match(
        [
            (u.contains("wikipedia.org"), "reference"),
            (u.contains("detik.com"), "news_media"),
            (u.contains("trip.com"), "travel_marketplace"),
            (u.contains("go.id"), "government"),
            (u.contains("facebook.com") | u.contains("instagram.com"), "official_social_media"),
        ],
        "official_website",
    )
    identity = F.when(kind.isin("reference", "travel_marketplace"), F.lit("probable")).otherwise(named)
    official = kind.isin("official_social_media", "official_website")
    return F.struct(
        kind.alias("source_type"),
        identity.alias("identity_status"),
        official.alias("is_official"),
        (kind == "government").alias("is_government"),
        first_match([(identity == "verified", 1.0), (identity == "probable", 0.7)], 0.3).alias("confidence"),
        F.when(official | (kind == "government"), F.lit("high")).otherwise(F.lit("medium")).alias("authority"),
    )


def source_freshness(kind: Column, body: Column, current_year: str) -> Column:
    undated = kind.isin("reference", "news_media", "travel_marketplace", "blog", "general")
    return F.when(~undated & yes(body.contains(current_year)), F.lit("verified_current")).otherwise(
        F.lit("recent_external_unverified")
    )


def _from(c: Column, place: int) -> Column:
    """The rest of a text from a place on."""
    return F.substring(c, F.lit(place), F.length(c))


def phone(c: Column, country: str = "62") -> Column:
    """Digits and plus only; a national 0 or bare country code becomes +country."""
    p = F.regexp_replace(c, r"[^0-9+]", "")
    return F.when(
        F.length(c) > 0,
        first_match(
            [
                (p.startswith("0"), F.concat(F.lit("+" + country), _from(p, 2))),
                (p.startswith(country), F.concat(F.lit("+"), p)),
            ],
            p,
        ),
    )


def mobile_phone(c: Column, country: str = "62") -> Column:
    """Stricter variant: digits only, 08… and bare 8… are mobile numbers; '' when nothing is left."""
    t = F.trim(F.coalesce(c, F.lit("")))
    d = F.regexp_replace(t, r"[^0-9]", "")
    mobile = country + "8"
    d = first_match(
        [
            (d.startswith("08"), F.concat(F.lit(mobile), _from(d, 3))),
            (d.startswith("8") & ~t.startswith("+"), F.concat(F.lit(mobile), _from(d, 2))),
        ],
        d,
    )
    return F.when(d == "", F.lit("")).otherwise(F.concat(F.lit("+"), d))


def phone_type(normalized: Column, country: str = "62") -> Column:
    return F.when(normalized.startswith("+" + country + "8"), F.lit("mobile")).otherwise(F.lit("fixed_line"))
