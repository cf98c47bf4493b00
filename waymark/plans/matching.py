"""Joins and entity resolution queries (JN, ER)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import config
from waymark.functions import geo
from waymark.functions.similarity import block_ratio, indel_ratio
from waymark.functions.text import is_filled, sorted_tokens
from waymark.operators import joins, nearby, normalize as nrm, resolve
from waymark.operators.skew import join_shuffled
from waymark.plans import views
from waymark.plans.registry import query

C = F.col
GEO, CAT = views.GEO_SQL, views.CATALOG_SQL
EARTH = "6371000.0"


def dist_sql(a: str, b: str) -> str:
    x = (f"(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))"
         f" * pow(sin(radians({b}.lon - {a}.lon) / 2), 2))")
    return f"(2 * {EARTH} * atan2(sqrt({x}), sqrt(1 - {x})))"


@query("jn01_attach_summaries", """
SELECT c_custkey, coalesce(n_orders, 0) AS n_orders, total, coalesce(n_open, 0) AS n_open FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) b ON b.o_custkey = c_custkey""")
def _(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    totals = o.groupBy("c_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    opened = o.filter("o_orderstatus = 'O'").groupBy("c_custkey").agg(F.count("*").alias("n_open"))
    return joins.attach(t.customer.select("c_custkey"), "c_custkey", [totals, opened], ["n_orders", "n_open"])


@query("jn02_members", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def _(t):
    wanted = t.lineitem.filter("l_returnflag = 'R'").select(C("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_totalprice").join(wanted, "o_orderkey", "left_semi")


@query("jn03_orphans", """
SELECT 'documents_without_label' AS relation, doc_id, count(*) AS orphan_rows, 'warning' AS severity FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY 2""")
def _(t):
    return joins.orphans(t.documents.select("doc_id"), "doc_id", t.labels, "documents_without_label", "warning")


# Source records and places: every customer is a record, those of two segments are places too.
_rec = [("record_id", "c_custkey"), ("segment", "c_mktsegment"), ("source_place_id", "CASE c_mktsegment WHEN 'MACHINERY' THEN c_custkey % 60 END"),
        ("url_key", "CASE c_mktsegment WHEN 'FURNITURE' THEN concat('u', CAST(c_custkey % 50 AS varchar(9))) END"),
        ("name", "concat('place ', CAST(c_custkey - c_custkey % 5 AS varchar(12)))"), ("region", "'R'"), *views._point("0.0004")]
_is_place = "segment IN ('BUILDING', 'HOUSEHOLD')"


@query("jn04_waterfall", f"""
WITH r AS {views.sql("customer", _rec)}, pop AS (SELECT record_id AS place_id, name, lat, lon FROM r WHERE {_is_place}),
h AS (SELECT r.*, CASE WHEN segment = 'AUTOMOBILE' THEN CAST(record_id % 100 AS bigint) END AS h1, CAST(source_place_id * 5 AS bigint) AS h2, CAST(substr(url_key, 2) AS bigint) * 10 AS h3 FROM r),
n AS (SELECT h.record_id, arg_min(p.place_id, ({dist_sql('h', 'p')}, p.place_id)) AS h4, min({dist_sql('h', 'p')}) AS d FROM h JOIN pop p ON p.name = h.name AND {dist_sql('h', 'p')} <= 100 WHERE h1 IS NULL AND h2 IS NULL AND h3 IS NULL GROUP BY 1),
m AS (SELECT h.record_id, coalesce(h1, h2, h3, h4) AS cid, CASE WHEN h1 IS NOT NULL THEN 'source_record_id' WHEN h2 IS NOT NULL THEN 'google_place_id' WHEN h3 IS NOT NULL THEN 'normalized_url'
  WHEN h4 IS NOT NULL THEN 'coordinates_name_fallback' END AS method, CASE WHEN h1 IS NOT NULL THEN 1.0 WHEN h2 IS NOT NULL THEN 1.0 WHEN h3 IS NOT NULL THEN 0.95
  WHEN h4 IS NOT NULL THEN round(1.0 * (1.0 - (d / 100.0) * 0.1), 2) END AS conf FROM h LEFT JOIN n USING (record_id))
SELECT record_id, CASE WHEN p.place_id IS NOT NULL THEN cid END AS canonical_id, CASE WHEN p.place_id IS NOT NULL THEN method END AS method,
  CAST(CASE WHEN p.place_id IS NOT NULL THEN conf END AS double) AS confidence, p.place_id IS NOT NULL AS mapped FROM m LEFT JOIN pop p ON p.place_id = cid""")
def _(t):
    return _waterfall(t)


def _waterfall(t):
    r = views.columns(t.customer, _rec)
    pop = r.filter(_is_place).select(C("record_id").alias("place_id"), "name", "lat", "lon", C("record_id").alias("ord"), "region")
    by_record = r.filter("segment = 'AUTOMOBILE'").select("record_id", (C("record_id") % 100).cast("bigint").alias("canonical_id"))
    by_place = r.filter("source_place_id IS NOT NULL").select("source_place_id", (C("source_place_id") * 5).cast("bigint").alias("canonical_id")).distinct()
    by_url = r.filter("url_key IS NOT NULL").select("url_key", F.expr("CAST(substr(url_key, 2) AS bigint) * 10").alias("canonical_id"), C("record_id").alias("seq"))
    return joins.map_records(r, by_record, by_place, joins.last_entry(by_url, "url_key", "seq"), pop)


@query("jn05_points_in_boxes", f"""
WITH b AS (SELECT n_nationkey AS box_id, CAST(103.0 + n_nationkey * 0.12 AS double) AS x0, CAST(-6.4 + (n_nationkey % 5) * 0.5 AS double) AS y0 FROM nation)
SELECT g.place_id, (SELECT min(box_id) FROM b WHERE g.lon BETWEEN x0 AND x0 + CAST(0.9 AS double) AND g.lat BETWEEN y0 AND y0 + CAST(0.8 AS double)) AS box_id FROM {GEO} g""")
def _(t):
    boxes = t.nation.selectExpr("n_nationkey AS box_id", "n_nationkey AS rank", "CAST(103.0 + n_nationkey * 0.12 AS double) AS min_lon",
                                "CAST(-6.4 + (n_nationkey % 5) * 0.5 AS double) AS min_lat").withColumns(
        {"max_lon": C("min_lon") + 0.9, "max_lat": C("min_lat") + 0.8})
    return nearby.points_in_boxes(views.geo(t).select("place_id", "lat", "lon"), boxes, "place_id").select("place_id", "box_id")


# Ratcliff-Obershelp: the longest common block, first in a and then in b, then both sides of it. 0.002 degrees are more than 100 m up to 60 degrees north or south.
@query("jn06_nearest_named", f"""
WITH RECURSIVE r AS {views.sql("customer", _rec)}, g AS (SELECT record_id, lower(trim(name)) AS t, lat, lon, {_is_place} AS place, CAST(floor(lat / 0.002) AS bigint) AS gy, CAST(floor(lon / 0.002) AS bigint) AS gx FROM r),
wide AS (SELECT g.*, gy + v.d AS hy, gx + w.d AS hx FROM g, (VALUES (-1), (0), (1)) v(d), (VALUES (-1), (0), (1)) w(d) WHERE NOT place),
n AS (SELECT a.record_id, b.record_id AS place_id, a.t AS x, b.t AS y, {dist_sql('a', 'b')} AS d FROM wide a JOIN g b ON b.gy = a.hy AND b.gx = a.hx AND b.place WHERE {dist_sql('a', 'b')} <= 100 AND a.t <> '' AND b.t <> ''),
walk AS (SELECT DISTINCT x, y, x AS a, y AS b, 0::BIGINT AS hit, 0 AS side FROM n UNION ALL
  SELECT x, y, CASE s WHEN 0 THEN substr(a, 1, m.i - 1) ELSE substr(a, m.i + m.k) END, CASE s WHEN 0 THEN substr(b, 1, strpos(b, substr(a, m.i, m.k)) - 1) ELSE substr(b, strpos(b, substr(a, m.i, m.k)) + m.k) END, CASE s WHEN 0 THEN m.k ELSE 0 END, s
  FROM (SELECT *, list_filter(flatten(list_transform(range(length(a), 0, -1), lambda k: list_transform(range(1, length(a) - k + 2), lambda i: {{'i': i, 'k': k}}))), lambda z: contains(b, substr(a, z.i, z.k)))[1] AS m FROM walk), (VALUES (0), (1)) t(s) WHERE m IS NOT NULL),
sim AS (SELECT x, y, 2.0::DOUBLE * sum(hit)::DOUBLE / (length(x) + length(y)) AS s FROM walk GROUP BY x, y),
c AS (SELECT record_id, place_id, round(s * (1.0::DOUBLE - (d / 100.0::DOUBLE) * 0.1::DOUBLE), 9) AS score FROM n JOIN sim USING (x, y) WHERE s >= 0.85::DOUBLE - 1e-12::DOUBLE)
SELECT record_id, arg_min(place_id, (-score, place_id)) AS place_id, round_even(max(score), 2) AS confidence FROM c GROUP BY 1""")
def _(t):
    r = views.columns(t.customer, _rec)
    places = r.filter(_is_place).select(C("record_id").alias("place_id"), "name", "lat", "lon", C("record_id").alias("ord"), "region")
    return nearby.nearest_named(r.filter(f"NOT {_is_place}"), places)


@query("jn07_preferred_source", """
SELECT l_partkey, CASE WHEN p.k IS NOT NULL THEN p.k ELSE f.k END AS obs, CASE WHEN p.k IS NOT NULL THEN p.s ELSE f.s END AS l_suppkey, p.k IS NOT NULL AS from_preferred FROM (SELECT DISTINCT l_partkey FROM lineitem) a
LEFT JOIN (SELECT l_partkey, min(l_orderkey * 10 + l_linenumber) AS k, arg_min(l_suppkey, (l_orderkey * 10 + l_linenumber, l_suppkey)) AS s FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) p USING (l_partkey)
LEFT JOIN (SELECT l_partkey, max(l_orderkey * 10 + l_linenumber) AS k, arg_max(l_suppkey, (l_orderkey * 10 + l_linenumber, l_suppkey)) AS s FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) f USING (l_partkey)""")
def _(t):
    rows = t.lineitem.select("l_partkey", "l_returnflag", "l_suppkey", (C("l_orderkey") * 10 + C("l_linenumber")).alias("obs"))
    return joins.preferred_source(rows, "l_partkey", C("l_returnflag"), "R", "A", "obs", ["obs", "l_suppkey"])


@query("jn09_image_lookup", f"""
SELECT item_id, coalesce(u, CASE category WHEN 'promo' THEN 'promo.jpg' WHEN 'large' THEN 'large.jpg' ELSE 'any.jpg' END) AS image_url
FROM {CAT} LEFT JOIN (SELECT p_name AS name, concat('img', max(p_partkey)) AS u FROM part WHERE p_size > 25 AND p_name LIKE '%ring' GROUP BY 1) USING (name)""")
def _(t):
    by_name = t.part.filter("p_size > 25 AND p_name LIKE '%ring'").groupBy(C("p_name").alias("name")).agg(F.concat(F.lit("img"), F.max("p_partkey")).alias("image_url"))
    return joins.image_for(views.catalog(t), by_name, "name", {"promo": "promo.jpg", "large": "large.jpg"}, "any.jpg").select("item_id", "image_url")


# ---- entity resolution ---------------------------------------------------


@query("er01_haversine", f"""
SELECT a.place_id, round({dist_sql('a', 'b')}, 4) AS metres, round({dist_sql('a', 'b')} / 1000, 6) AS km FROM {GEO} a JOIN {GEO} b ON b.place_id = a.place_id + 1""")
def _(t):
    g = views.geo(t)
    nxt = g.select((C("place_id") - 1).alias("place_id"), C("lat").alias("lat2"), C("lon").alias("lon2"))
    pair = [C(c) for c in ("lat", "lon", "lat2", "lon2")]
    return g.join(nxt, "place_id").select("place_id", F.round(geo.haversine_m(*pair), 4).alias("metres"), F.round(geo.haversine_km(*pair), 6).alias("km"))


@query("er02_similarity")
def _(t):
    """Similarity of each part name with the next one."""
    p = t.part.select("p_partkey", "p_name")
    nxt = p.select((C("p_partkey") - 1).alias("p_partkey"), C("p_name").alias("other"))
    return p.join(nxt, "p_partkey").select(
        "p_partkey", F.round(indel_ratio(sorted_tokens(C("p_name")), sorted_tokens(C("other"))), 6).alias("token_sort"),
        F.round(block_ratio(C("p_name"), C("other")), 6).alias("block"))


# Records of several sources with shared phones and sites, near addresses and near names, in chains of five points
_NEAR_NAMES = ["bukit melati", "lembah hijau indah", "lembah hijaw indah", "indah lembah hijaw", "curug kembar tujuh indah raya", "curug kembar tujuh indah rayo", "waterpark bukit melati", "bukit melati"]
_NEAR_ADDRESSES = {0: "Jl Raya Pantai 12 Metro", 1: "Jl Raya Pantai 13 Metro", 2: "", 3: "metro 12 raya pantai  jl", 4: "Dusun Tiga Way Kanan"}
_cases = lambda key, values: f"CASE {key} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in values.items()) + " END"


def _person(shift: int) -> list[tuple[str, str]]:
    k = f"(c_custkey + {shift})"
    point = {n: f"CASE WHEN {k} % 13 <> 0 THEN {e} END" for n, e in views._point("0.0009")}
    return [
        ("record_id", "c_custkey"), ("seq", f"({k} * 7919) % 100003"), ("name", _cases(f"{k} % 8", dict(enumerate(_NEAR_NAMES)))), ("address", _cases(f"{k} % 9", _NEAR_ADDRESSES)),
        ("phone", f"CASE WHEN {k} % 29 = 5 THEN '+440' WHEN {k} % 29 = 6 THEN '' WHEN {k} % 6 < 2 THEN concat('+62', CAST(floor({k} / 6) AS varchar(9))) END"),
        ("website", f"CASE {k} % 17 WHEN 0 THEN concat('https://s', CAST({k} % 60 AS varchar(9)), '.id/a') WHEN 1 THEN concat('https://s', CAST(({k} - 1) % 60 AS varchar(9)), '.id/a') WHEN 2 THEN 'https://instagram.com/p' WHEN 3 THEN 'https://instagram.com/p' END"),
        ("source", _cases(f"{k} % 10", {0: "google_places", 1: "apify_google_maps", 2: "official_sites", 3: "official_sites", 4: "blog", **{n: "osm" for n in range(5, 10)}})), ("lat", point["lat"]), ("lon", point["lon"])]


def _tokens_sql(c: str) -> str:
    return f"array_to_string(list_sort(string_split(trim(regexp_replace({c}, '\\s+', ' ', 'g')), ' ')), ' ')"


def _indel_sql(a: str, b: str) -> str:
    """Longest common subsequence as a fold over the characters of one text: rows of the usual table, made monotone by running maxima."""
    hits = f"list_transform(string_split({a}, ''), lambda c: list_concat([0], list_transform(string_split({b}, ''), lambda d: CASE WHEN c = d THEN 1 ELSE 0 END)))"
    zeros = f"list_transform(range(0, length({b}) + 1), lambda z: 0)"
    step = "lambda p, e: list_transform(range(1, len(p) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: CASE WHEN e[i] = 1 THEN p[i - 1] + 1 ELSE p[i] END)))"
    return f"200.0::DOUBLE * list_reduce({hits}, {step}, {zeros})[length({b}) + 1] / (length({a}) + length({b}))"


def _scores_sql(name: str, column: str, source: str) -> str:
    """CTEs name_t (text, its sorted tokens) and name (x, y, score) over the distinct token texts of a column."""
    return f"""{name}_t AS (SELECT DISTINCT {_tokens_sql(column)} AS t FROM {source} WHERE {column} <> ''),
{name} AS (SELECT a.t AS x, b.t AS y, {_indel_sql('a.t', 'b.t')} AS score FROM {name}_t a, {name}_t b)"""


_trusted = "source IN ('google_places', 'apify_google_maps')"


def _rules_sql(shift: int, pairs: str) -> str:
    """CTEs o (records in order) and p (pairs a before b with confidence and reason); `pairs` says which pairs."""
    return f"""o AS (SELECT *, {_trusted} AS trusted, regexp_extract(website, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS dom, {_tokens_sql('name')} AS nt, {_tokens_sql('lower(address)')} AS ta,
  row_number() OVER (ORDER BY CASE WHEN {_trusted} THEN 0 WHEN source = 'osm' THEN 1 WHEN source = 'official_sites' THEN 2 ELSE 9 END, seq, record_id) AS ord FROM {views.sql("customer", _person(shift))}),
low AS (SELECT lower(address) AS address FROM o), {_scores_sql('names', 'name', 'o')}, {_scores_sql('addrs', 'address', 'low')},
d AS (SELECT a.record_id AS ra, b.record_id AS rb, a.ord AS oa, b.ord AS ob, a.trusted AND b.trusted AS blocked, coalesce(a.phone <> '' AND a.phone = b.phone, false) AS ph,
  coalesce(a.website = b.website AND a.dom NOT IN ('instagram.com', 'facebook.com', 'maps.google.com', 'google.com', ''), false) AS we, {dist_sql('a', 'b')} AS m, a.name AS na, b.name AS nb, a.nt AS ta, b.nt AS tb, a.ta AS da, b.ta AS db
  FROM o a JOIN o b ON {pairs}),
p AS (SELECT ra, rb, oa, ob, CASE WHEN blocked THEN {{'c': 0.0::DOUBLE, 'r': 'different_trusted_ids'}} WHEN ph THEN {{'c': 0.95, 'r': 'same_phone'}} WHEN we THEN {{'c': 0.95, 'r': 'same_website'}}
  WHEN na = nb AND m <= 500 THEN {{'c': 1.0, 'r': 'exact_name_distance_500m'}}
  WHEN names.score >= 90 AND m <= 300 AND na <> nb AND (contains(na, nb) OR contains(nb, na) OR names.score < 95) THEN {{'c': 0.0, 'r': 'potential_parent_child'}}
  WHEN names.score >= 90 AND m <= 300 THEN {{'c': 0.9, 'r': 'fuzzy_name_distance_300m'}}
  WHEN addrs.score >= 85 AND m <= 500 THEN {{'c': 0.85, 'r': 'similar_address_distance_500m'}} ELSE {{'c': 0.0, 'r': 'no_match'}} END AS rule
  FROM d LEFT JOIN names ON names.x = ta AND names.y = tb LEFT JOIN addrs ON addrs.x = da AND addrs.y = db)"""


@query("er03_pair_rules", f"WITH {_rules_sql(0, 'b.record_id = a.record_id + 1')} SELECT rb AS record_id, rule.c AS confidence, rule.r AS reason FROM p")
def _(t):
    r = views.columns(t.customer, _person(0))
    tok = lambda side, f: F.when(is_filled(C(f"{side}.{f}")), sorted_tokens(F.lower(C(f"{side}.{f}"))))
    row = F.struct("record_id", "name", "address", "phone", "website", C("source").isin("google_places", "apify_google_maps").alias("trusted"), "lat", "lon")
    a = r.select((C("record_id") + 1).alias("record_id"), row.alias("anchor"))
    pairs = r.select("record_id", row.alias("row")).join(a, "record_id").withColumns({
        "distance_m": geo.haversine_m(C("row.lat"), C("row.lon"), C("anchor.lat"), C("anchor.lon")),
        "name_score": indel_ratio(tok("row", "name"), tok("anchor", "name")), "address_score": indel_ratio(tok("row", "address"), tok("anchor", "address"))})
    rule = resolve.pair_rule("row", "anchor", config.SHARED_DOMAINS)
    return pairs.select("record_id", rule.alias("r")).select("record_id", "r.confidence", "r.reason")


def _records(t, shift=0):
    return views.columns(t.customer, _person(shift)).withColumnsRenamed({"name": "normalized_name", "lat": "latitude", "lon": "longitude"})


def _resolve_sql(shift: int) -> str:
    """One ordered pass: a record becomes an anchor unless an earlier anchor matches it; then each other record takes its best anchor."""
    return f"""WITH RECURSIVE {_rules_sql(shift, 'a.ord < b.ord AND (a.phone = b.phone OR a.website = b.website OR abs(a.lat - b.lat) < 0.005 AND abs(a.lon - b.lon) < 0.006)')},
m AS (SELECT oa, ob, rule FROM p WHERE rule.c > 0), l AS (SELECT ob, list(oa) AS l FROM m GROUP BY 1),
walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS anchors UNION ALL
  SELECT n + 1, CASE WHEN l.l IS NOT NULL AND list_has_any(l.l, anchors) THEN anchors ELSE list_append(anchors, n + 1) END FROM walk LEFT JOIN l ON l.ob = n + 1 WHERE n < (SELECT count(*) FROM o)),
anchor AS (SELECT unnest(anchors) AS a FROM (SELECT anchors FROM walk ORDER BY n DESC LIMIT 1)),
best AS (SELECT ob, arg_min({{'a': oa, 'rule': rule}}, (-rule.c, oa)) AS b FROM m JOIN anchor ON oa = a WHERE ob NOT IN (SELECT a FROM anchor) GROUP BY 1),
mapping AS (SELECT o.record_id, coalesce(t.record_id, o.record_id) AS canonical_id, coalesce(b.rule.c, 1.0)::DOUBLE AS confidence, CASE WHEN b IS NULL THEN 'new' ELSE 'merged' END AS match_status, coalesce(b.rule.r, 'new_record') AS dedup_reason
  FROM o LEFT JOIN best ON best.ob = o.ord LEFT JOIN o t ON t.ord = b.a)"""


@query("er04_resolve", _resolve_sql(0) + " SELECT * FROM mapping")
def _(t):
    return resolve.resolve(_records(t))


@query("er05_merge_clusters", """
WITH r AS (SELECT o_custkey AS canonical_id, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'addr' || o_orderkey END AS address, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 100000.0 END AS rating,
  CAST(o_orderkey % 7 AS bigint) AS n, lower(o_orderstatus) AS cat, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'manual_review' ELSE 'other' END AS cls,
  o_orderkey <> min(o_orderkey) OVER (PARTITION BY o_custkey) AS late FROM orders)
SELECT canonical_id, arg_min(address, (late, o_orderkey)) FILTER (address IS NOT NULL) AS address, count(*) AS source_count,
  round(CASE WHEN sum(n) FILTER (rating IS NOT NULL) > 0 THEN sum(rating * n) / sum(n) FILTER (rating IS NOT NULL) ELSE avg(rating) END, 2) AS rating,
  CAST(sum(n) FILTER (rating IS NOT NULL) AS bigint) AS review_count, CASE WHEN bool_or(late) THEN 0.9::DOUBLE ELSE 1.0::DOUBLE END AS dedup_confidence,
  bool_or(cls = 'manual_review') AS needs_manual_review, arg_min(cls, (cls <> 'accepted', late, o_orderkey)) AS classification, array_to_string(list_sort(list_distinct(list(cat))), ',') AS tags
FROM r GROUP BY 1""")
def _(t):
    o = t.orders.selectExpr(
        "o_orderkey AS record_id", "o_custkey", "o_orderkey AS seq", "0 AS source_rank", "CAST(o_orderkey AS string) AS name",
        "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('addr', o_orderkey) END AS address", "CAST(NULL AS string) AS region", "CAST(NULL AS string) AS phone",
        "CAST(NULL AS string) AS website", "CAST(NULL AS double) AS latitude", "CAST(NULL AS double) AS longitude", "array(lower(o_orderstatus)) AS categories",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice / 100000.0 END AS rating", "o_orderkey % 7 AS review_count", "o_orderdate AS collected_at",
        "CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'manual_review' ELSE 'other' END AS classification")
    first = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))
    mapping = t.orders.select("o_orderkey", "o_custkey").join(first, "o_custkey").select(
        C("o_orderkey").alias("record_id"), C("o_custkey").alias("canonical_id"), F.when(C("o_orderkey") == C("first"), 1.0).otherwise(0.9).alias("confidence"),
        F.when(C("o_orderkey") == C("first"), "new").otherwise("merged").alias("match_status"))
    tags = lambda cats, name: F.struct(F.get(cats, F.lit(0)).alias("primary"), cats.alias("tags"))
    return resolve.merge_clusters(o.drop("o_custkey"), mapping, tags).select(
        "canonical_id", "address", "source_count", "rating", "review_count", "dedup_confidence", "needs_manual_review", "classification",
        F.array_join("category_tags", ",").alias("tags"))


@query("er06_mapping", _resolve_sql(3) + " SELECT * FROM mapping")
def _(t):
    """As er04 with other names, phones and sites at the points."""
    return resolve.resolve(_records(t, 3))


_annex = ("concat(lower(c_mktsegment), CASE c_custkey % 4 WHEN 0 THEN ' place' WHEN 1 THEN ' place annex' WHEN 2 THEN ' place parkir' ELSE ' plaza' END)")
_pc = [("place_id", "c_custkey"), ("nn", _annex), ("reg", "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat('R', CAST(c_nationkey % 2 AS varchar(9))) END"), *views._point("0.0009")]


@query("er07_parent_child", f"""
WITH p AS {views.sql("customer", _pc)}, {_scores_sql('names', 'nn', 'p')},
v AS (SELECT a.place_id AS i, b.place_id AS j, length(a.nn) < length(b.nn) AS shorter FROM p a JOIN p b ON a.place_id <> b.place_id AND abs(a.lat - b.lat) < 0.003 AND a.nn <> b.nn
  AND (a.reg = '' OR b.reg = '' OR a.reg = b.reg) AND {dist_sql('a', 'b')} <= 300 JOIN names ON x = {_tokens_sql('a.nn')} AND y = {_tokens_sql('b.nn')}
  WHERE contains(' ' || b.nn || ' ', ' ' || a.nn || ' ') OR contains(' ' || a.nn || ' ', ' ' || b.nn || ' ') OR score >= 80 AND score < 90),
f AS (SELECT child, arg_min(parent, (i, j)) AS parent FROM (SELECT i, j, CASE WHEN shorter THEN i ELSE j END AS parent, CASE WHEN shorter THEN j ELSE i END AS child FROM v) GROUP BY 1)
SELECT p.place_id, f.parent AS parent_id, CASE WHEN f.parent IS NOT NULL THEN CASE WHEN contains(nn, 'parkir') THEN 'supporting_facility' ELSE 'part_of' END
  WHEN p.place_id IN (SELECT parent FROM f) THEN 'same_place' END AS relationship, f.parent IS NOT NULL AS needs_review FROM p LEFT JOIN f ON f.child = p.place_id""")
def _(t):
    p = views.columns(t.customer, _pc).select("place_id", C("place_id").alias("ord"), C("nn").alias("name"), C("nn").alias("normalized_name"),
                                              C("reg").alias("region"), C("lat").alias("latitude"), C("lon").alias("longitude"))
    return resolve.parent_child(p)


_nd = views.geo_columns("0.0008")


@query("er08_near_duplicates", f"""
WITH p AS {views.sql("customer", _nd)}
SELECT a.place_id AS place_id_1, b.place_id AS place_id_2, round({dist_sql('a', 'b')}, 1) AS distance_m, round(CASE WHEN a.name = b.name THEN 100.0 ELSE (length(a.name) - 1) * 100.0 / length(a.name) END, 1) AS name_score
FROM p a JOIN p b ON b.place_id = a.place_id + 1 AND a.category = b.category AND b.place_id % 5 <> 0 AND {dist_sql('a', 'b')} <= 100""")
def _(t):
    p = views.geo(t, "0.0008").select("place_id", C("place_id").alias("ord"), C("name").alias("normalized_name"), "category",
                                      F.array(C("place_id").cast("string")).alias("trusted_ids"), C("lat").alias("latitude"), C("lon").alias("longitude"))
    return resolve.near_duplicates(p)


@query("er09_rekey", _resolve_sql(0) + " SELECT record_id AS place_id, canonical_id AS cluster_id FROM mapping")
def _(t):
    mapping = resolve.resolve(_records(t)).select(C("record_id").alias("place_id"), C("canonical_id").alias("cluster_id"))
    return join_shuffled(views.geo(t).select("place_id"), mapping, "place_id", "left")
