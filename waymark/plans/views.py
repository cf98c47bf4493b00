"""Derived views over the given tables.

Each view is a list of (column, expression) pairs. The expressions are written
so that Spark and the oracle read them alike, so both sides start from the
same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from waymark.plans.registry import Tables


def columns(t: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return t.selectExpr(*[f"{e} AS {n}" for n, e in cols])


def sql(table: str, cols: list[tuple[str, str]]) -> str:
    return f"(SELECT {', '.join(f'{e} AS {n}' for n, e in cols)} FROM {table})"


def _point(step: str) -> list[tuple[str, str]]:
    b = "(c_custkey - c_custkey % 5)"
    return [
        ("lat", f"CAST(-6.5 AS double) + CAST(({b} * 7919) % 30000 AS double) / CAST(10000 AS double)"
                f" + CAST(c_custkey % 5 AS double) * CAST({step} AS double)"),
        ("lon", f"CAST(103 AS double) + CAST(({b} * 104729) % 35000 AS double) / CAST(10000 AS double)"),
    ]


def geo_columns(step: str = "0.0009") -> list[tuple[str, str]]:
    """Chains of five points, `step` degrees apart, spread over the target area."""
    return [
        ("place_id", "c_custkey"),
        ("name", "lower(concat(c_mktsegment, ' place ', CAST(c_custkey % 3 AS varchar(9))))"),
        ("region", "concat('R', CAST(c_nationkey AS varchar(9)))"),
        ("category", "lower(c_mktsegment)"),
        *_point(step),
    ]


GEO = geo_columns()

# Catalog items: category from p_type, region from p_brand, facilities from the bits of p_size.
CATALOG = [
    ("item_id", "p_partkey"),
    ("name", "p_name"),
    ("category", "lower(p_type)"),
    ("region", "p_brand"),
    ("has_parking", "(p_size % 2 = 1)"),
    ("has_toilet", "(p_size % 4 >= 2)"),
    ("has_food", "(p_size % 8 >= 4)"),
    ("has_guide", "(p_size % 16 >= 8)"),
    ("price", "p_retailprice"),
    ("rating", "CAST(p_size % 21 AS double) / CAST(10 AS double) + CAST(3 AS double)"),
    ("review_count", "CAST((p_partkey * 37) % 2000 AS bigint)"),
    ("status", "CASE p_partkey % 50 WHEN 0 THEN 'permanently_closed' WHEN 1 THEN 'unknown'"
               " WHEN 2 THEN 'temporarily_closed' ELSE 'open' END"),
    ("completeness", "CAST(40 + p_partkey % 61 AS double)"),
    ("warnings", "CAST(p_size % 5 AS int)"),
    ("confidence", "CAST((p_partkey * 13) % 100 AS double) / CAST(100 AS double)"),
]
CATALOG_FACILITIES = ["has_parking", "has_toilet", "has_food", "has_guide"]

# Reviews: place from user_id, star rating from value.
REVIEWS = [
    ("review_id", "event_id"),
    ("place_id", "user_id"),
    ("rating", "CAST(least(5, CAST(floor(value / 100) AS int) + 1) AS int)"),
    ("review_ts", "ts"),
    ("kind", "event_type"),
    ("text", "CASE WHEN event_id % 4 = 0 THEN '' ELSE props END"),
]

# Price observations: place from l_suppkey, semantic key from flags, amount in steps of 5000.
PRICES = [
    ("obs_id", "l_orderkey * 10 + l_linenumber"),
    ("place_id", "l_suppkey"),
    ("price_type", "CASE l_returnflag WHEN 'A' THEN 'entry' WHEN 'N' THEN 'parking' ELSE 'activity' END"),
    ("day_type", "CASE l_linenumber % 3 WHEN 0 THEN 'weekday' WHEN 1 THEN 'weekend' ELSE 'all_days' END"),
    ("audience", "CASE l_linestatus WHEN 'O' THEN 'adult' ELSE 'general' END"),
    ("unit", "CASE WHEN l_linenumber % 2 = 0 THEN 'per_person' ELSE 'per_vehicle' END"),
    ("vehicle", "CASE WHEN l_linenumber % 5 = 0 THEN 'car' ELSE 'none' END"),
    ("amount", "CAST(floor(l_extendedprice / 5000) * 5000 AS double)"),
    ("verification", "CASE WHEN l_quantity < 15 THEN 'recent_unverified' WHEN l_quantity < 35 THEN 'historical'"
                     " ELSE 'unknown_date' END"),
    ("accepted", "(l_discount < 0.08)"),
]

# Place records as delivered by a source: place from user_id, newest first by ts.
RECORDS = [
    ("record_id", "event_id"),
    ("place_id", "user_id"),
    ("collected_at", "ts"),
    ("source", "CASE WHEN event_id % 3 = 0 THEN 'maps' ELSE 'osm' END"),
    ("phone", "CASE WHEN event_type = 'error' THEN NULL ELSE concat('08', CAST(user_id % 7 AS varchar(9)),"
              " CAST(event_id % 3 AS varchar(9))) END"),
    ("website", "CASE WHEN event_type = 'view' THEN concat('https://site', CAST(event_id % 2 AS varchar(9)), '.id/')"
                " WHEN event_type = 'click' THEN 'https://instagram.com/x' END"),
    ("address", "concat('Street ', CAST(event_id % 4 AS varchar(9)))"),
    ("perm_closed", "(event_type = 'signup' AND value > 200)"),
    ("temp_closed", "(event_type = 'purchase' AND value > 150)"),
    ("rating", "CASE WHEN event_type <> 'error' THEN value END"),
]


def geo(t: Tables, step: str = "0.0009") -> DataFrame:
    return columns(t.customer, geo_columns(step))


def catalog(t: Tables) -> DataFrame:
    return columns(t.part, CATALOG)


def reviews(t: Tables) -> DataFrame:
    return columns(t.events, REVIEWS)


def prices(t: Tables) -> DataFrame:
    return columns(t.lineitem, PRICES)


def records(t: Tables) -> DataFrame:
    return columns(t.events, RECORDS)


GEO_SQL = sql("customer", GEO)
CATALOG_SQL = sql("part", CATALOG)
REVIEWS_SQL = sql("events", REVIEWS)
PRICES_SQL = sql("lineitem", PRICES)
RECORDS_SQL = sql("events", RECORDS)
