"""Distances, boxes and grid cells."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from waymark.functions.rules import first_match, yes

EARTH_M = 6371000.0
METRES_PER_DEGREE = 111194.9


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; infinite when a coordinate is missing."""
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlam / 2), 2
    )
    dist = F.lit(2 * EARTH_M) * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return F.coalesce(dist, F.lit(float("inf")))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlam / 2), 2
    )
    return F.lit(2 * EARTH_M / 1000) * F.asin(F.sqrt(a))


def coordinate(c: Column) -> Column:
    """Numeric coordinate or NULL; only the wider +-180 bound can reject a value."""
    v = c.cast("string").try_cast("double")
    return F.when(v.between(-180.0, 180.0), v)


def in_box(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    """Point inside (min_lon, min_lat, max_lon, max_lat); missing coordinates are outside."""
    x0, y0, x1, y1 = box
    return yes(lat.between(y0, y1) & lon.between(x0, x1))


def region_of(address: Column, lat: Column, lon: Column, regions: list[dict], default: Column) -> Column:
    """Longest region named in the address, else the first box holding the point, else the default.

    `regions` rows have name, query and box; their order decides between overlapping boxes.
    """
    low = F.lower(address)
    by_length = sorted(regions, key=lambda r: max(len(r["name"]), len(r["query"])), reverse=True)
    named = first_match(
        [(yes(low.contains(r["query"].lower()) | low.contains(r["name"].lower())), r["name"]) for r in by_length]
    )
    boxed = first_match([(in_box(lat, lon, r["box"]), r["name"]) for r in regions])
    return F.coalesce(named, boxed, default)


def canonical_region(c: Column, slugs: dict[str, str]) -> Column:
    """Canonical region name: slug, then same text, then substring either way, else unchanged."""
    t = F.trim(c)
    low = F.lower(t)
    slug = F.regexp_replace(low, r"[- ]", "_")
    names = list(slugs.values())
    return F.when(F.length(c) > 0, F.coalesce(
        first_match([(slug == k, v) for k, v in slugs.items()]),
        first_match([(low == v.lower(), v) for v in names]),
        first_match([(F.lit(v.lower()).contains(low) | low.contains(v.lower()), v) for v in names]),
        t,
    ))


def own_cell(lat: Column, lon: Column, radius_m: float, cells: int = 1) -> list[Column]:
    """Grid cell of a point, cells so many radiuses high."""
    size = cells * radius_m / METRES_PER_DEGREE
    return [F.floor(lat / size).alias("cell_y"), F.floor(lon / size).alias("cell_x")]


def cells_within(lat: Column, lon: Column, radius_m: float, cells: int = 1) -> Column:
    """All cells, so many radiuses high, that can hold a point within the radius.

    The longitude span widens with latitude, so the cover is complete at any
    latitude short of the poles (the date line is not wrapped).
    """
    size = cells * radius_m / METRES_PER_DEGREE
    pad = radius_m / METRES_PER_DEGREE * 1.0001
    widest = F.least(F.abs(lat) + pad, F.lit(89.9))
    span = pad / F.cos(F.radians(widest))
    ys = F.sequence(F.floor((lat - pad) / size), F.floor((lat + pad) / size))
    xs = F.sequence(F.floor((lon - span) / size), F.floor((lon + span) / size))
    return F.flatten(
        F.transform(ys, lambda y: F.transform(xs, lambda x: F.struct(y.alias("cell_y"), x.alias("cell_x"))))
    )
