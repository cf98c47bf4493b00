"""Opening hours and facility maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from waymark.functions.rules import contains_any, first_match

# Closed and all-day texts, day names, facility groups and overrides.
CLOSED_TEXTS = ["closed", "tutup", "closed today", "tutup hari ini"]
ALL_DAY_TEXTS = ["open 24 hours", "buka 24 jam", "24 jam", "24 hours", "buka 24jam"]
DAY_NAMES = {
    "senin": "monday", "selasa": "tuesday", "rabu": "wednesday", "kamis": "thursday",
    "jumat": "friday", "sabtu": "saturday", "minggu": "sunday", "monday": "monday",
    "tuesday": "tuesday", "wednesday": "wednesday", "thursday": "thursday", "friday": "friday",
    "saturday": "saturday", "sunday": "sunday",
}
FACILITY_GROUPS = {
    "opsi layanan": "service_options", "service options": "service_options",
    "aksesibilitas": "accessibility", "accessibility": "accessibility",
    "fasilitas": "amenities", "amenities": "amenities",
    "pembayaran": "payments", "payments": "payments",
    "anak-anak": "children", "children": "children",
    "hewan peliharaan": "pets", "pets": "pets",
    "parkir": "parking", "parking": "parking",
}
FACILITY_OVERRIDES = [
    (["toilet", "restroom", "kamar kecil"], "restroom"),
    (["makanan", "minuman", "food", "drink", "kuliner", "restoran", "cafe"], "food_and_drink"),
    (["luar ruangan", "outdoor", "taman"], "outdoor"),
]


def lookup(c: Column, mapping: dict[str, str], default=None) -> Column:
    """Value of a small fixed mapping."""
    return first_match([(c == k, v) for k, v in mapping.items()], default)


def parse_hours(c: Column) -> Column:
    """Struct (open_time, close_time, is_24_hours, is_closed); 24:00 is text, not a time."""
    h = F.lower(F.trim(c))
    hh = F.regexp_extract_all(h, F.lit(r"([0-9]{1,2})[.:]([0-9]{2})"), F.lit(1))
    mm = F.regexp_extract_all(h, F.lit(r"([0-9]{1,2})[.:]([0-9]{2})"), F.lit(2))

    def clock(i):
        return F.concat(F.lpad(F.get(hh, F.lit(i)), 2, "0"), F.lit(":"), F.get(mm, F.lit(i)))

    def out(open_time, close_time, all_day, closed):
        lit = lambda v: v if isinstance(v, Column) else F.lit(v)
        return F.struct(
            lit(open_time).alias("open_time"), lit(close_time).alias("close_time"),
            F.lit(all_day).alias("is_24_hours"), F.lit(closed).alias("is_closed"),
        )

    return first_match(
        [
            (h.isin(CLOSED_TEXTS), out("", "", False, True)),
            (h.isin(ALL_DAY_TEXTS), out("00:00", "24:00", True, False)),
            (F.size(hh) == 2, out(clock(0), clock(1), False, False)),
        ],
        out("", "", False, False),
    )


def hours_text(entries: Column) -> Column:
    """`day: hours` parts of an array<struct<day,hours>>, joined by '; '; NULL for an empty list."""
    kept = F.filter(
        entries,
        lambda e: (F.coalesce(e["day"], F.lit("")) != "") | (F.coalesce(e["hours"], F.lit("")) != ""),
    )
    parts = F.transform(
        kept,
        lambda e: F.concat(F.coalesce(e["day"], F.lit("")), F.lit(": "), F.coalesce(e["hours"], F.lit(""))),
    )
    return F.when(F.size(entries) > 0, F.array_join(parts, "; "))


def facility_labels(groups: Column) -> Column:
    """`group: item` labels of the true items in map<string, array<map<string, boolean>>>."""
    def of_group(entry):
        items = F.flatten(F.transform(entry["value"], lambda m: F.map_entries(m)))
        return F.transform(
            F.filter(items, lambda i: i["value"]), lambda i: F.concat(entry["key"], F.lit(": "), i["key"])
        )

    return F.coalesce(
        F.flatten(F.transform(F.map_entries(groups), of_group)), F.array().cast("array<string>")
    )


def availability(c: Column) -> Column:
    v = F.lower(c.cast("string"))
    return first_match([(v.isin("true", "1"), "available"), (v.isin("false", "0"), "unavailable")], "unknown")


def facility_group(group: Column, item: Column) -> Column:
    low = F.lower(item)
    return first_match(
        [(contains_any(low, words), name) for words, name in FACILITY_OVERRIDES],
        lookup(F.lower(F.trim(group)), FACILITY_GROUPS, "other"),
    )
