"""Normalisation queries (NRM)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import config
from waymark.functions import geo, hours, money, text, urls
from waymark.operators import normalize as nrm
from waymark.plans import views
from waymark.plans.registry import query

C = F.col


def cases(col: str, pairs, default: str = "NULL") -> str:
    """SQL CASE on equality or on given conditions."""
    body = " ".join(f"WHEN {c} THEN {v}" for c, v in pairs)
    return f"CASE {body} ELSE {default} END"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def has_any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, {quote(w)})" for w in words) + ")"


# RE2 classes that match what the Unicode white-space class matches.
WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query("nrm01_collapse_whitespace", f"""
SELECT doc_id, nullif(trim(regexp_replace(text, '{WS}', ' ', 'g')), '') AS clean_text FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.collapse_whitespace(C("text")).alias("clean_text"))


PART_STOP = ["red", "old", "cold", "gear box", "small", "red gear"]
_strip = "lower(p_name)"
for _p in sorted(PART_STOP, key=len, reverse=True):
    _strip = f"regexp_replace({_strip}, '\\b{_p}\\b', ' ', 'g')"


@query("nrm02_matching_name", f"""
SELECT p_partkey, coalesce(nullif(trim(regexp_replace({_strip}, '\\s+', ' ', 'g')), ''), trim(lower(p_name))) AS match_name
FROM part""")
def _(t):
    return t.part.select("p_partkey", text.matching_name(C("p_name"), PART_STOP).alias("match_name"))


@query("nrm03_coordinate", f"""
WITH g AS (SELECT place_id, CASE WHEN place_id % 7 = 0 THEN 'n/a' WHEN place_id % 11 = 0 THEN CAST(200.5 AS varchar)
  ELSE CAST(lat AS varchar) END AS raw FROM {views.GEO_SQL})
SELECT place_id, round(CASE WHEN try_cast(raw AS double) BETWEEN -180 AND 180 THEN try_cast(raw AS double) END, 6) AS coord FROM g""")
def _(t):
    raw = F.when(C("place_id") % 7 == 0, "n/a").when(C("place_id") % 11 == 0, "200.5").otherwise(C("lat").cast("string"))
    return views.geo(t).select("place_id", F.round(geo.coordinate(raw), 6).alias("coord"))


BOX = (104.0, -6.0, 105.5, -4.5)


@query("nrm04_in_box", f"""
SELECT place_id, coalesce(lat BETWEEN -6.0 AND -4.5 AND lon BETWEEN 104.0 AND 105.5, false) AS inside
FROM (SELECT place_id, CASE WHEN place_id % 9 = 0 THEN NULL ELSE lat END AS lat, lon FROM {views.GEO_SQL})""")
def _(t):
    lat = F.when(C("place_id") % 9 == 0, None).otherwise(C("lat"))
    return views.geo(t).select("place_id", geo.in_box(lat, C("lon"), BOX).alias("inside"))


_addr = "CASE WHEN place_id % 6 = 0 THEN 'Jl Raya Tulang Bawang Barat 5' WHEN place_id % 6 = 1 THEN 'kota METRO pusat' ELSE NULL END"
_by_len = sorted(config.REGIONS, key=lambda r: max(len(r["name"]), len(r["query"])), reverse=True)
_named = cases("", [(f"contains(lower(a), {quote(r['query'].lower())}) OR contains(lower(a), {quote(r['name'].lower())})",
                     quote(r["name"])) for r in _by_len])
_boxed = cases("", [(f"lon BETWEEN {r['box'][0]} AND {r['box'][2]} AND lat BETWEEN {r['box'][1]} AND {r['box'][3]}",
                     quote(r["name"])) for r in config.REGIONS])


@query("nrm05_region_of", f"""
SELECT place_id, coalesce({_named}, {_boxed}, region) AS resolved
FROM (SELECT *, {_addr} AS a FROM {views.GEO_SQL})""")
def _(t):
    g = views.geo(t).withColumn("a", F.expr(_addr))
    return g.select("place_id", geo.region_of(C("a"), C("lat"), C("lon"), config.REGIONS, C("region")).alias("resolved"))


SLUGS = {"nation_1": "Nation One", "nation_2": "Nation Two West", "far_east": "NATION_3"}


@query("nrm06_canonical_region", """
SELECT n_nationkey, CASE
  WHEN lower(replace(replace(trim(n_name), '-', '_'), ' ', '_')) = 'nation_1' THEN 'Nation One'
  WHEN lower(replace(replace(trim(n_name), '-', '_'), ' ', '_')) = 'nation_2' THEN 'Nation Two West'
  WHEN lower(trim(n_name)) = 'nation one' THEN 'Nation One'
  WHEN lower(trim(n_name)) = 'nation two west' THEN 'Nation Two West'
  WHEN lower(trim(n_name)) = 'nation_3' THEN 'NATION_3'
  WHEN contains('nation one', lower(trim(n_name))) OR contains(lower(trim(n_name)), 'nation one') THEN 'Nation One'
  WHEN contains('nation two west', lower(trim(n_name))) OR contains(lower(trim(n_name)), 'nation two west') THEN 'Nation Two West'
  WHEN contains('nation_3', lower(trim(n_name))) OR contains(lower(trim(n_name)), 'nation_3') THEN 'NATION_3'
  ELSE trim(n_name) END AS canonical
FROM nation""")
def _(t):
    return t.nation.select("n_nationkey", geo.canonical_region(C("n_name"), SLUGS).alias("canonical"))


_ph = ("CASE c_custkey % 5 WHEN 0 THEN concat('0812-', CAST(c_custkey AS varchar(12))) WHEN 1 THEN concat('62 811 ', CAST(c_custkey AS varchar(12)))"
       " WHEN 2 THEN concat('+62 (721) ', CAST(c_custkey AS varchar(12))) WHEN 3 THEN concat('8', CAST(c_custkey AS varchar(12))) ELSE '' END")


@query("nrm07_phone", f"""
WITH p AS (SELECT c_custkey, {_ph} AS raw FROM customer),
d AS (SELECT *, regexp_replace(raw, '[^0-9+]', '', 'g') AS plus, regexp_replace(raw, '[^0-9]', '', 'g') AS dig FROM p),
m AS (SELECT *, CASE WHEN dig LIKE '08%' THEN '628' || substr(dig, 3) WHEN dig LIKE '8%' AND raw NOT LIKE '+%' THEN '628' || substr(dig, 2) ELSE dig END AS mob FROM d)
SELECT c_custkey,
  CASE WHEN raw = '' THEN NULL WHEN plus LIKE '0%' THEN '+62' || substr(plus, 2) WHEN plus LIKE '62%' THEN '+' || plus ELSE plus END AS phone,
  CASE WHEN mob = '' THEN '' ELSE '+' || mob END AS strict_phone,
  CASE WHEN mob LIKE '628%' THEN 'mobile' ELSE 'fixed_line' END AS phone_kind
FROM m""")
def _(t):
    raw = F.expr(_ph)
    strict = urls.mobile_phone(raw)
    return t.customer.select(
        "c_custkey", urls.phone(raw).alias("phone"), strict.alias("strict_phone"), urls.phone_type(strict).alias("phone_kind"))


@query("nrm08_website", """
SELECT page_id,
  regexp_replace(CASE WHEN lower(trim(url)) LIKE 'http://%' OR lower(trim(url)) LIKE 'https://%' THEN lower(trim(url))
    ELSE 'https://' || lower(trim(url)) END, '/$', '') AS website,
  CASE WHEN contains(k, 'google.com/maps') AND regexp_extract(k, 'query_place_id=([^&]+)', 1) <> ''
    THEN 'google_maps_place_id:' || regexp_extract(k, 'query_place_id=([^&]+)', 1) ELSE k END AS url_key
FROM (SELECT page_id, u AS url, rtrim(regexp_replace(lower(trim(u)), '^https?://(www\\.)?', ''), '/') AS k
  FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN upper(regexp_replace(url, '^https?://', '')) || '/'
    WHEN 2 THEN 'https://www.google.com/maps/search/?api=1&query_place_id=ID' || page_id || '&hl=id' ELSE url || '/' END AS u FROM pages))""")
def _(t):
    u = F.expr("CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN concat(upper(regexp_replace(url, '^https?://', '')), '/') "
               "WHEN 2 THEN concat('https://www.google.com/maps/search/?api=1&query_place_id=ID', page_id, '&hl=id') ELSE concat(url, '/') END")
    return t.pages.select("page_id", urls.website(u).alias("website"), urls.url_key(u).alias("url_key"))


@query("nrm09_domain", r"""
SELECT page_id, regexp_extract(lower(trim(url)), '^(?:https?://)?(?:www\.)?([^/]*)', 1) AS host,
  regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1) AS authority FROM pages""")
def _(t):
    return t.pages.select("page_id", urls.host(C("url")).alias("host"), urls.authority(C("url")).alias("authority"))


_pt = ("CASE p_partkey % 9 WHEN 0 THEN 'Gratis' WHEN 1 THEN concat('Rp ', CAST(p_size AS varchar(9)), '.000') "
       "WHEN 2 THEN concat('rp', CAST(p_size AS varchar(9)), 'k') WHEN 3 THEN concat('Rp. ', CAST(p_size AS varchar(9)), '.500,75') "
       "WHEN 4 THEN concat('IDR ', CAST(p_size AS varchar(9)), ',25') WHEN 5 THEN concat(CAST(p_size AS varchar(9)), ',000 / 7') "
       "WHEN 6 THEN concat('about ', CAST(p_size AS varchar(9)), '.5') WHEN 7 THEN 'rp 0' ELSE 'ask' END")


@query("nrm10_price_value", f"""
WITH p AS (SELECT p_partkey, trim(lower({_pt})) AS p FROM part),
r AS (SELECT *, regexp_extract(p, '([0-9]+(?:\\.[0-9]+)?)\\s*k\\b', 1) AS k,
  regexp_extract_all(p, '[0-9.,]+') AS runs FROM p),
n AS (SELECT *, list_sort(list_transform(range(len(runs)), lambda i: {{'n': -length(runs[i + 1]), 'i': i, 'x': runs[i + 1]}}))[1].x AS run FROM r),
q AS (SELECT *, split(run, ',') AS bc, split(run, '.') AS bd FROM n)
SELECT p_partkey, CASE
  WHEN p IN ('0', 'rp 0', 'rp. 0', 'rp0') OR contains(p, 'free') OR contains(p, 'gratis') OR contains(p, 'cuma-cuma') THEN 0.0
  WHEN k <> '' THEN CAST(k AS double) * 1000
  WHEN contains(run, ',') AND contains(run, '.') THEN try_cast(replace(bc[1], '.', '') || '.' || bc[2] AS double)
  WHEN contains(run, ',') AND len(bc) = 2 AND length(bc[2]) = 2 THEN try_cast(bc[1] || '.' || bc[2] AS double)
  WHEN contains(run, ',') THEN try_cast(replace(run, ',', '') AS double)
  WHEN contains(run, '.') AND length(bd[-1]) = 3 THEN try_cast(replace(run, '.', '') AS double)
  ELSE try_cast(run AS double) END AS amount
FROM q""")
def _(t):
    return t.part.select("p_partkey", money.price_value(F.expr(_pt)).alias("amount"))


_inject = ("concat(text, CASE doc_id % 5 WHEN 0 THEN ' tiket masuk rp 15.000 per orang' WHEN 1 THEN ' Parkir 5 ribu, dewasa' "
           "WHEN 2 THEN ' htm: 20k' WHEN 3 THEN ' Rp. 7.500 anak dan 12 dewasa' ELSE '' END)")
_p1, _p2 = money.MENTION_PATTERNS


@query("nrm11_price_mentions", f"""
WITH d AS (SELECT doc_id, lower({_inject}) AS t FROM documents),
m AS (SELECT doc_id, unnest(regexp_extract_all(t, '{_p1}', 0)) AS f, unnest(regexp_extract_all(t, '{_p1}', 1)) AS n FROM d
  UNION ALL SELECT doc_id, unnest(regexp_extract_all(t, '{_p2}', 0)), unnest(regexp_extract_all(t, '{_p2}', 1)) FROM d),
v AS (SELECT *, CAST(replace(n, '.', '') AS double) AS v FROM m)
SELECT doc_id, f AS matched, CASE WHEN (contains(f, 'ribu') OR contains(f, 'k')) AND v < 1000 THEN v * 1000 ELSE v END AS amount,
  CASE WHEN contains(f, 'parkir') THEN 'parking_fee' ELSE 'entrance_fee' END AS price_type,
  CASE WHEN contains(f, 'dewasa') THEN 'adult' WHEN contains(f, 'anak') THEN 'child' ELSE 'general' END AS applies_to,
  0.8::DOUBLE AS confidence FROM v""")
def _(t):
    return t.documents.select("doc_id", F.explode(money.price_mentions(F.expr(_inject))).alias("m")).select("doc_id", "m.*")


_wc = "CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN 'https://maps.google.com/x' WHEN 2 THEN 'https://www.instagram.com/p' WHEN 3 THEN ' ' WHEN 4 THEN 'https://pantaisari.com' ELSE NULL END"


@query("nrm19_website_class", f"""
SELECT page_id, CASE WHEN u IS NULL OR u = '' THEN 'missing' WHEN {has_any('u', urls.MAP_SITES)} THEN 'google_maps'
  WHEN {has_any('u', urls.SOCIAL_SITES)} THEN 'social_media' WHEN {has_any('u', urls.INVALID_SITES)} THEN 'invalid' ELSE 'official' END AS website_class
FROM (SELECT page_id, lower(trim({_wc})) AS u FROM pages)""")
def _(t):
    return t.pages.select("page_id", urls.website_class(F.expr(_wc)).alias("website_class"))


_wd = ("CASE page_id % 12 WHEN 0 THEN url WHEN 1 THEN 'https://maps.google.com/x' WHEN 2 THEN 'https://www.instagram.com/pantai_sari' "
       "WHEN 3 THEN 'https://facebook.com/other' WHEN 4 THEN 'https://disbudpar.go.id/a' WHEN 5 THEN NULL WHEN 6 THEN 'https://id.wikipedia.org/wiki/A' "
       "WHEN 7 THEN 'http://detik.com/x' WHEN 8 THEN 'https://a.blogspot.com' WHEN 9 THEN 'https://www.traveloka.com/q' "
       "WHEN 10 THEN 'https://www.openstreetmap.org/node/1' ELSE '' END")
_social_own = "(contains(regexp_replace(u, '\\W+', '', 'g'), 'pantaisari') OR contains(regexp_replace(u, '\\W+', '', 'g'), 'pantai') OR contains(regexp_replace(u, '\\W+', '', 'g'), 'sari'))"


@query("nrm20_website_detail", f"""
SELECT page_id,
  CASE WHEN e THEN 'unknown' WHEN mp OR contains(u, 'openstreetmap.org') THEN 'map_profile' WHEN mk THEN 'travel_marketplace' WHEN wi THEN 'directory'
    WHEN gv THEN 'government' WHEN nw THEN 'news_media' WHEN bl THEN 'blog' WHEN so THEN 'official_social_media' ELSE 'official_website' END AS website_type,
  CASE WHEN e THEN 'missing' WHEN mp THEN 'google_maps_only' WHEN contains(u, 'openstreetmap.org') THEN 'openstreetmap_only' WHEN mk THEN 'aggregator' WHEN wi THEN 'reference'
    WHEN gv THEN 'official' WHEN nw THEN 'news' WHEN bl THEN 'blog' WHEN so THEN 'social_media' ELSE 'official' END AS website_status,
  CASE WHEN e OR mp OR contains(u, 'openstreetmap.org') OR mk OR wi THEN 'none' WHEN gv THEN 'strong' WHEN nw OR bl THEN 'none'
    WHEN so THEN CASE WHEN own THEN 'strong' ELSE 'weak' END ELSE 'strong' END AS identity_match_status,
  CASE WHEN e THEN '' ELSE regexp_extract(u, '^(?:https?://)?(?:www\\.)?([^/]*)', 1) END AS domain,
  CASE WHEN e OR mp OR contains(u, 'openstreetmap.org') OR mk OR wi THEN false WHEN gv THEN true WHEN nw OR bl THEN false WHEN so THEN own ELSE true END AS is_official
FROM (SELECT page_id, u, u IS NULL OR u = '' AS e, {has_any('u', urls.MAP_SITES)} AS mp, {has_any('u', urls.MARKET_SITES)} AS mk, contains(u, 'wikipedia.org') AS wi,
  {has_any('u', urls.GOVERNMENT_SITES)} AS gv, {has_any('u', urls.NEWS_SITES)} AS nw, {has_any('u', urls.BLOG_SITES)} AS bl, {has_any('u', urls.SOCIAL_SITES)} AS so, {_social_own} AS own
  FROM (SELECT page_id, lower(trim({_wd})) AS u FROM pages))""")
def _(t):
    d = urls.website_detail(F.expr(_wd), F.lit("Pantai Sari"))
    return t.pages.select("page_id", d.alias("d")).select("page_id", "d.*").drop("classification_reason")


_title = "regexp_extract(html, '<title>([^<]*)</title>', 1)"


@query("nrm21_source_profile", f"""
WITH p AS (SELECT page_id, lower(u) AS u, contains(lower(title), 'the') AS named, html FROM
  (SELECT page_id, {_wd} AS u0, coalesce({_wd}, url) AS u, {_title} AS title, html FROM pages)),
k AS (SELECT *, CASE WHEN contains(u, 'wikipedia.org') THEN 'reference' WHEN contains(u, 'detik.com') THEN 'news_media' WHEN contains(u, 'trip.com') THEN 'travel_marketplace'
  WHEN contains(u, 'go.id') THEN 'government' WHEN contains(u, 'facebook.com') OR contains(u, 'instagram.com') THEN 'official_social_media' ELSE 'official_website' END AS kind FROM p),
i AS (SELECT *, CASE WHEN kind IN ('reference', 'travel_marketplace') THEN 'probable' WHEN named THEN 'verified' ELSE 'probable' END AS ident FROM k)
SELECT page_id, kind AS source_type, ident AS identity_status, kind IN ('official_social_media', 'official_website') AS is_official, kind = 'government' AS is_government,
  CASE ident WHEN 'verified' THEN 1.0::DOUBLE ELSE 0.7::DOUBLE END AS confidence,
  CASE WHEN kind IN ('official_social_media', 'official_website', 'government') THEN 'high' ELSE 'medium' END AS authority,
  CASE WHEN kind NOT IN ('reference', 'news_media', 'travel_marketplace', 'blog', 'general') AND contains(html, '2024') THEN 'verified_current' ELSE 'recent_external_unverified' END AS freshness
FROM i""")
def _(t):
    u = F.coalesce(F.expr(_wd), C("url"))
    p = urls.source_profile(u, F.expr(_title), F.lit("the"))
    base = t.pages.select("page_id", p.alias("p"), "html")
    return base.select("page_id", "p.*", urls.source_freshness(C("p.source_type"), C("html"), "2024").alias("freshness"))


@query("nrm22_lexicon_text", r"""
SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(trim(lower(text)), 'http\S+|www\S+', '', 'g'), '[^a-z0-9\s]', ' ', 'g'), '[\s\x0B]+', ' ', 'g')) AS clean
FROM documents""")
def _(t):
    return t.documents.select("doc_id", text.lexicon_text(C("text")).alias("clean"))


@query("nrm23_text_keys", r"""
SELECT doc_id, sha256(regexp_replace(lower(text), '[^\p{L}\p{N}_]', '', 'g')) AS similarity_hash, sha256(trim(text)) AS content_hash FROM documents""")
def _(t):
    return t.documents.select("doc_id", F.sha2(text.similarity_text(C("text")), 256).alias("similarity_hash"),
                              text.content_hash(C("text")).alias("content_hash"))


@query("nrm24_parse_date", """
SELECT event_id, CAST(coalesce(try_strptime(raw, '%Y-%m-%d %H:%M:%S'), TIMESTAMP '0001-01-01 00:00:00') AS varchar) AS parsed
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'yesterday' WHEN event_id % 10 = 1 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw FROM events)""")
def _(t):
    from waymark.operators.reviews import review_time
    raw = F.when(C("event_id") % 10 == 0, "yesterday").when(C("event_id") % 10 == 1, None).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return t.events.select("event_id", F.date_format(review_time(raw), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("nrm25_rating_bucket", """
SELECT event_id, CASE WHEN r >= 4 THEN 'positive' WHEN r >= 3 THEN 'neutral' ELSE 'negative' END AS bucket,
  coalesce(CAST(trunc(try_cast(CASE WHEN event_id % 8 = 0 THEN 'five' ELSE CAST(r AS varchar) END AS double)) AS int), 5) AS stars
FROM (SELECT event_id, value / 100 AS r FROM events)""")
def _(t):
    r = C("value") / 100
    raw = F.when(C("event_id") % 8 == 0, "five").otherwise(r.cast("string"))
    return t.events.select("event_id", nrm.rating_bucket(r).alias("bucket"), nrm.whole_stars(raw).alias("stars"))


@query("nrm12_price_range", f"""
SELECT s_suppkey AS place_id, min(amount) AS price_min, max(amount) AS price_max, count(amount) AS n_prices
FROM supplier LEFT JOIN (SELECT * FROM {views.PRICES_SQL} WHERE price_type = 'entry') p ON p.place_id = s_suppkey GROUP BY 1""")
def _(t):
    from waymark.operators.prices import entrance_range
    return entrance_range(t.supplier.select(C("s_suppkey").alias("place_id")), views.prices(t), "entry")


_RULES = [(["red", "hot"], ["warm", "nature"]), (["cold", "blue"], ["cool"]), (["ring"], ["round", "nature"])]
_PRIO = ["round", "cool", "warm", "nature", "recreation", "other"]


@query("nrm17_category_tags", """
WITH b AS (SELECT p_partkey, lower(p_type) || ' ' || lower(p_name) AS b, lower(p_name) AS n FROM part),
f AS (SELECT p_partkey, list_sort(list_distinct((CASE WHEN contains(b, 'red') OR contains(b, 'hot') THEN ['warm', 'nature'] ELSE [] END)
  || (CASE WHEN contains(b, 'cold') OR contains(b, 'blue') THEN ['cool'] ELSE [] END)
  || (CASE WHEN contains(b, 'ring') THEN ['round', 'nature'] ELSE [] END))) AS t FROM b),
g AS (SELECT p_partkey, CASE WHEN len(t) = 0 THEN ['other'] ELSE t END AS t FROM f)
SELECT p_partkey, CASE WHEN list_contains(t, 'round') THEN 'round' WHEN list_contains(t, 'cool') THEN 'cool' WHEN list_contains(t, 'warm') THEN 'warm'
  WHEN list_contains(t, 'nature') THEN 'nature' ELSE 'other' END AS primary_category, array_to_string(t, ',') AS tags FROM g""")
def _(t):
    tags = nrm.category_tags(F.array(C("p_type")), C("p_name"), _RULES, _PRIO)
    return t.part.select("p_partkey", tags.alias("c")).select(
        "p_partkey", C("c.primary").alias("primary_category"), F.array_join("c.tags", ",").alias("tags"))


# A reduced vocabulary over p_type and p_name, so that every branch of the cascade is reached.
PART_CLASSIFY = dict(
    config.CLASSIFY, park_categories=["promo"], park_name_words=["red", "old"], park_secondary=["bolt"], park_min_reviews=45,
    park_search=["gear"], local_park_words=["hot"], lodging_categories=["large"], lodging_pass_words=["blue", "green", "gear"],
    accepted=["Economy", "Large"], accepted_name_block=["red", "ring"], rejected=["Small"], manual=["Medium"],
    rejected_name_words=["cold"], accepted_name_words=["anvil", "widget"])


@query("nrm18_classify", """
WITH b AS (SELECT p_partkey, p_name AS name, lower(p_name) AS n, lower(p_type) AS c, split_part(lower(p_name), ' ', 2) AS c2, p_size,
  CASE WHEN p_partkey % 13 = 0 THEN 10.0 ELSE -5.0 END AS lat, p_partkey % 17 = 0 AS nocat FROM part),
s AS (SELECT *, list_filter([CASE WHEN regexp_matches(n, '\\bred\\b') THEN 'name_keyword:red' END, CASE WHEN regexp_matches(n, '\\bold\\b') THEN 'name_keyword:old' END,
  CASE WHEN contains(c2, 'bolt') THEN 'secondary_category:' || c2 END, CASE WHEN p_size >= 45 THEN 'high_reviews:' || p_size END], lambda x: x IS NOT NULL) AS sig FROM b),
d AS (SELECT *, CASE WHEN lat > 0 THEN 'out' WHEN nocat THEN 'nocat' WHEN c = 'promo' AND len(sig) > 0 THEN 'park_ok' WHEN c = 'promo' AND contains(n, 'hot') THEN 'park_local'
  WHEN c = 'promo' THEN 'park_no' WHEN c = 'large' AND NOT (contains(n, 'blue') OR contains(n, 'green') OR contains(n, 'gear')) THEN 'lodging'
  WHEN c IN ('economy', 'large') AND (contains(' ' || n || ' ', ' red ') OR contains(' ' || n || ' ', ' ring ') OR starts_with(n, 'red') OR starts_with(n, 'ring')) THEN 'acc_block'
  WHEN c IN ('economy', 'large') THEN 'acc' WHEN c = 'small' THEN 'rej' WHEN c = 'medium' THEN 'man'
  WHEN regexp_matches(n, '\\bcold\\b') THEN 'bad' WHEN regexp_matches(n, '\\banvil\\b') THEN 'good_anvil' WHEN regexp_matches(n, '\\bwidget\\b') THEN 'good_widget' ELSE 'default' END AS k FROM s)
SELECT p_partkey, CASE WHEN k IN ('park_ok', 'acc', 'good_anvil', 'good_widget') THEN 'accepted' WHEN k IN ('lodging', 'acc_block', 'rej', 'bad') THEN 'rejected' ELSE 'manual_review' END AS decision,
  CAST(CASE WHEN k = 'park_ok' THEN 0.9 WHEN k IN ('lodging', 'acc', 'rej') THEN 1.0 WHEN k = 'acc_block' THEN 0.8 WHEN k = 'bad' THEN 0.9 WHEN k IN ('good_anvil', 'good_widget') THEN 0.8 ELSE 0.5 END AS double) AS confidence,
  CASE k WHEN 'out' THEN 'outside_bounds' WHEN 'nocat' THEN 'missing_categories' WHEN 'park_ok' THEN array_to_string(sig, ',') WHEN 'park_local' THEN 'local_park_keyword'
    WHEN 'lodging' THEN 'category_rejected' WHEN 'acc_block' THEN 'name_rejected_keyword' WHEN 'acc' THEN 'category_accepted' WHEN 'rej' THEN 'category_rejected' WHEN 'man' THEN 'category_manual'
    WHEN 'bad' THEN 'name_rejected_keyword' WHEN 'good_anvil' THEN 'name_accepted_keyword' WHEN 'good_widget' THEN 'name_accepted_keyword' ELSE '' END AS signals
FROM d""")
def _(t):
    cats = F.when(C("p_partkey") % 17 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.lower("p_type"), F.get(F.split(F.lower("p_name"), " "), F.lit(1))))
    lat = F.when(C("p_partkey") % 13 == 0, 10.0).otherwise(-5.0)
    v = nrm.classify(C("p_name"), cats, lat, F.lit(105.0), F.lit(None).cast("string"), C("p_size"),
                     F.lit(None).cast("string"), PART_CLASSIFY)
    return t.part.select("p_partkey", v.alias("v")).select(
        "p_partkey", "v.decision", "v.confidence", F.array_join("v.signals", ",").alias("signals"))


@query("nrm16_business_status", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'CLOSED_PERMANENTLY' WHEN o_orderpriority = '1-URGENT' THEN 'CLOSED_TEMPORARILY' ELSE 'OPERATIONAL' END AS business_status FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", nrm.business_status(C("o_orderstatus") == "F", C("o_orderpriority") == "1-URGENT").alias("business_status"))


@query("nrm13_hours_text", """
SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'day' || event_id % 7 || ': ' || user_id % 12 || '.00' END AS hours_text FROM events""")
def _(t):
    entry = F.struct(F.format_string("day%d", C("event_id") % 7).alias("day"), F.format_string("%d.00", C("user_id") % 12).alias("hours"))
    blank = F.struct(F.lit("").alias("day"), F.lit("").alias("hours"))
    entries = F.when(C("event_id") % 5 == 0, F.array().cast("array<struct<day:string,hours:string>>")).otherwise(F.array(entry, blank))
    return t.events.select("event_id", hours.hours_text(entries).alias("hours_text"))


_ht = ("CASE event_id % 6 WHEN 0 THEN ' Closed' WHEN 1 THEN 'Buka 24 Jam' WHEN 2 THEN concat(CAST(user_id % 12 AS varchar(9)), '.00 to 22.30') "
       "WHEN 3 THEN '08:30 - 17:00' WHEN 4 THEN '8.00' ELSE 'maybe' END")


@query("nrm14_parse_hours", f"""
SELECT event_id, CASE event_id % 6 WHEN 1 THEN '00:00' WHEN 2 THEN lpad(CAST(user_id % 12 AS varchar), 2, '0') || ':00' WHEN 3 THEN '08:30' ELSE '' END AS open_time,
  CASE event_id % 6 WHEN 1 THEN '24:00' WHEN 2 THEN '22:30' WHEN 3 THEN '17:00' ELSE '' END AS close_time,
  event_id % 6 = 1 AS is_24_hours, event_id % 6 = 0 AS is_closed FROM events""")
def _(t):
    return t.events.select("event_id", hours.parse_hours(F.expr(_ht)).alias("h")).select("event_id", "h.*")


@query("nrm15_facility_labels", """
SELECT p_partkey, concat_ws('|', CASE WHEN p_size % 2 = 1 THEN 'Parkir: lot' END, CASE WHEN p_size % 4 >= 2 THEN 'Parkir: toilet' END) AS labels FROM part""")
def _(t):
    groups = F.create_map(F.lit("Parkir"), F.array(
        F.create_map(F.lit("lot"), C("p_size") % 2 == 1), F.create_map(F.lit("toilet"), C("p_size") % 4 >= 2)))
    return t.part.select("p_partkey", F.array_join(hours.facility_labels(groups), "|").alias("labels"))


@query("nrm26_segments", f"""
SELECT item_id, CASE WHEN r IS NULL THEN 'empty' WHEN r >= 4.5 THEN 'high' WHEN r >= 4.0 THEN 'medium' ELSE 'low' END AS rating_segment,
  CASE WHEN review_count >= 1000 THEN 'popular' WHEN review_count >= 100 THEN 'medium' WHEN review_count >= 1 THEN 'low' ELSE 'no_review' END AS review_segment,
  item_id % 3 = 1 AS has_website
FROM (SELECT *, CASE WHEN item_id % 10 = 3 THEN NULL ELSE rating END AS r FROM {views.CATALOG_SQL})""")
def _(t):
    c = views.catalog(t).withColumn("r", F.when(C("item_id") % 10 != 3, C("rating")))
    site = F.when(C("item_id") % 3 == 0, "https://www.google.com/maps/x").when(C("item_id") % 3 == 1, "https://a.id")
    return c.select("item_id", nrm.rating_segment(C("r")).alias("rating_segment"),
                    nrm.review_segment(C("review_count")).alias("review_segment"), nrm.has_real_website(site).alias("has_website"))


_TIERS = [("high", ["promo", "ring"]), ("medium", ["large", "gear"]), ("low", ["small"])]


@query("nrm27_research_priority", f"""
WITH b AS (SELECT item_id, status, name || ' ' || category AS b FROM {views.CATALOG_SQL}),
k AS (SELECT item_id, CASE WHEN status = 'permanently_closed' THEN 'closed' WHEN status = 'temporarily_closed' THEN 'temp'
  WHEN contains(b, 'promo') THEN 'high:promo' WHEN contains(b, 'ring') THEN 'high:ring' WHEN contains(b, 'large') THEN 'medium:large' WHEN contains(b, 'gear') THEN 'medium:gear'
  WHEN contains(b, 'small') THEN 'low:small' ELSE 'none' END AS k FROM b)
SELECT item_id, CASE k WHEN 'closed' THEN 'not_applicable' WHEN 'temp' THEN 'low' WHEN 'none' THEN 'low' ELSE split_part(k, ':', 1) END AS priority,
  CASE k WHEN 'closed' THEN 'Place is permanently closed' WHEN 'temp' THEN 'Place is temporarily closed' WHEN 'none' THEN 'Default priority for other categories'
    ELSE 'Matches ' || split_part(k, ':', 1) || ' priority keyword ''' || split_part(k, ':', 2) || '''' END AS reason FROM k""")
def _(t):
    p = nrm.research_priority(C("category"), F.array(C("name")), C("status"), _TIERS)
    return views.catalog(t).select("item_id", p.alias("p")).select("item_id", "p.*")


@query("nrm28_category_group", """
SELECT p_partkey, CASE WHEN lower(p_type) IN ('promo', 'small') THEN 'nature' WHEN lower(p_type) IN ('large') THEN 'cultural' ELSE 'other' END AS category_group FROM part""")
def _(t):
    return t.part.select("p_partkey", nrm.category_group(C("p_type"), {"nature": ["promo", "small"], "cultural": ["large"]}).alias("category_group"))


_tpl = ", ".join(f"({i + 1}, {quote(k)}, {quote(b)})" for i, (k, b) in enumerate(config.RESEARCH_TEMPLATES))


@query("nrm29_query_texts", f"""
SELECT s_suppkey, s_name, seq AS query_seq, kind AS query_type, replace(body, '{{name}}', s_name) AS query_text
FROM supplier, (VALUES {_tpl}) q(seq, kind, body)""")
def _(t):
    return nrm.query_texts(t.supplier, config.RESEARCH_TEMPLATES, "s_suppkey", "s_name")


@query("nrm30_natural_key", """
SELECT event_id, sha256(concat_ws('|', event_id, user_id, event_type)) AS natural_id FROM events""")
def _(t):
    return t.events.select("event_id", text.natural_key(C("event_id"), C("user_id"), C("event_type")).alias("natural_id"))


@query("nrm31_normalize_places")
def _(t):
    g = views.geo(t)
    s = lambda e: F.expr(e).cast("string")
    raw = g.select(
        F.concat(F.lit("src_"), "place_id").alias("source_record_id"), F.lit("osm").alias("source"),
        s("place_id").alias("source_place_id"), F.lit(None).cast("string").alias("source_url"),
        F.lit("metro").alias("query_region"), F.lit("wisata").alias("query_keyword"),
        F.initcap(F.concat(F.lit("pantai  "), "name")).alias("raw_name"), F.expr(_addr).alias("raw_address"),
        F.array(F.lit("Tujuan_Wisata"), "category").alias("raw_categories"), F.lit(None).cast("string").alias("raw_payload_path"),
        C("lat").alias("latitude"), C("lon").alias("longitude"), F.lit("2026-01-01").alias("collected_at"),
        F.lit(4.5).alias("rating"), F.lit(10).alias("review_count"), s("concat('08', place_id)").alias("phone"),
        F.lit("site.id/").alias("website"),
        F.array(F.struct(F.lit("Senin").alias("day"), F.lit("8.00").alias("hours"))).alias("opening_hours"),
        F.create_map(F.lit("Parkir"), F.array(F.create_map(F.lit("lot"), F.lit(True)))).alias("facilities"),
        F.lit(False).alias("permanently_closed"), F.lit(None).cast("boolean").alias("temporarily_closed"),
        F.lit("tempat indah").alias("description"), F.lit(None).cast("string").alias("district"),
    )
    return nrm.normalize_places(raw)
