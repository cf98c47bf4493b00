"""Declared schemas of inputs and products."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


HOURS = T.ArrayType(struct(day=S, hours=S))
FACILITIES = T.MapType(S, T.ArrayType(T.MapType(S, B)))

PLACE_EXPORT = struct(
    title=S, placeId=S, cid=S, categoryName=S, categories=T.ArrayType(S), location=struct(lat=D, lng=D), address=S, neighborhood=S, city=S,
    postalCode=S, phone=S, phoneUnformatted=S, website=S, url=S, description=S, imageUrl=S, searchString=S, scrapedAt=S, totalScore=D, reviewsCount=I,
    openingHours=HOURS, additionalInfo=FACILITIES, permanentlyClosed=B, temporarilyClosed=B)

MAP_ELEMENTS = struct(elements=T.ArrayType(struct(type=S, id=L, lat=D, lon=D, center=struct(lat=D, lon=D), tags=T.MapType(S, S))))

PLACES_RESPONSE = struct(places=T.ArrayType(struct(
    id=S, displayName=struct(text=S), formattedAddress=S, location=struct(latitude=D, longitude=D), types=T.ArrayType(S), websiteUri=S, internationalPhoneNumber=S)))

RAW_PLACE = struct(
    source_record_id=S, source=S, source_place_id=S, source_url=S, query_region=S, query_keyword=S, raw_name=S, raw_address=S,
    raw_categories=T.ArrayType(S), raw_payload_path=S, latitude=D, longitude=D, collected_at=S, rating=D, review_count=I, phone=S, website=S,
    opening_hours=HOURS, facilities=FACILITIES, permanently_closed=B, temporarily_closed=B, description=S, district=S, postal_code=S, image_url=S)

PRICE = struct(
    price_id=S, canonical_id=S, price_type=S, amount_min=D, amount_max=D, currency=S, applies_to=S, unit=S, valid_day_type=S, source_name=S, source_url=S,
    observed_at=S, effective_date=S, confidence=D, verification_status=S, notes=S)
REVIEW = struct(
    review_id=S, canonical_id=S, source=S, source_place_id=S, rating=I, review_text=S, review_date=S, language=S, sentiment_bucket=S, sentiment_method=S,
    review_url=S, collected_at=S, is_duplicate=B, content_hash=S)
FACILITY = struct(
    facility_id=S, canonical_id=S, facility_type=S, facility_name=S, availability=S, source_name=S, source_url=S, observed_at=S, confidence=D, notes=S)
OPENING_HOURS = struct(
    opening_hours_id=S, canonical_id=S, day_of_week=S, open_time=S, close_time=S, is_24_hours=B, is_closed=B, source_name=S, source_url=S, observed_at=S, notes=S)
PROVENANCE = struct(
    provenance_id=S, canonical_id=S, field_name=S, field_value=S, source_name=S, source_url=S, collected_at=S, observed_at=S, confidence=D, verification_status=S)
FAILED = struct(canonical_id=S, stage=S, reason=S, attempts=I, failed_at=S)

TEMPLATES = {"price": PRICE, "review": REVIEW, "facility": FACILITY, "opening_hours": OPENING_HOURS, "provenance": PROVENANCE, "failed": FAILED}


def conform(df, schema: T.StructType, aliases: dict[str, str] | None = None):
    """Columns of a schema in order: aliases renamed, absent ones NULL, all cast."""
    from pyspark.sql import functions as F

    df = df.withColumnsRenamed(aliases or {})
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
