"""Sentiment, planning, sampling and source queries (SEN, PLN, SMP, SRC)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from waymark.operators import planner as pln, sampling as smp, sentiment as sen
from waymark.plans import views
from waymark.plans.matching import dist_sql
from waymark.plans.registry import query
from waymark.operators.durable import shared_folder
from waymark.sources import ingest, schemas, sinks

C = F.col
CAT, GEO, REV = views.CATALOG_SQL, views.GEO_SQL, views.REVIEWS_SQL
POS, NEG = ["the", "les", "with", "und"], ["and", "der", "que", "of"]

# ---- sentiment -----------------------------------------------------------

_in = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
LEX = f"""
WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(regexp_replace(regexp_replace(trim(lower(text)), 'http\\S+|www\\S+', '', 'g'), '[^a-z0-9\\s]', ' ', 'g'), '[\\s\\x0B]+', ' ', 'g')), ' ') AS w FROM documents),
c AS (SELECT doc_id, len(list_filter(w, lambda x: list_contains({_in(POS)}, x))) AS p, len(list_filter(w, lambda x: list_contains({_in(NEG)}, x))) AS n, len(list_filter(w, lambda x: x <> '')) AS k, 1 + doc_id % 5 AS r FROM w)"""


@query("sen01_lexicon", LEX + """
SELECT doc_id, CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END AS label, CASE WHEN p > n THEN 1.0::DOUBLE WHEN n > p THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END AS score FROM c""")
def _(t):
    return sen.lexicon_labels(t.documents.select("doc_id", "text"), "text", POS, NEG).drop("text")


_rule = """CASE WHEN r >= 4 AND n > p AND n >= 2 THEN 'negative' WHEN r >= 4 THEN 'positive' WHEN r <= 2 THEN 'negative' WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END"""


@query("sen02_rating_rule", LEX + f"""
SELECT doc_id, {_rule} AS label, round(greatest(-1.0, least(1.0, CASE WHEN r >= 4 AND n > p AND n >= 2 THEN -0.6 WHEN r >= 4 THEN 0.85 + 0.03 * p WHEN r <= 2 THEN -0.9 + 0.02 * p WHEN p > n THEN 0.5 WHEN n > p THEN -0.5 ELSE 0.0 END)), 6)::DOUBLE AS score, round(least(1.0, 0.7 + 0.05 * k), 6)::DOUBLE AS confidence FROM c""")
def _(t):
    s = sen.rating_labels(t.documents.select("doc_id", "text"), "text", (C("doc_id") % 5 + 1).cast("double"), POS, NEG)
    return s.select("doc_id", "label", F.round("score", 6).alias("score"), F.round("confidence", 6).alias("confidence"))


def _labelled(t):
    return t.documents.select("doc_id", "text", "lang").join(t.labels, "doc_id").select("doc_id", "text", F.when(C("quality") == 1, "good").otherwise("bad").alias("label"))


@query("sen03_classifier")
def _(t):
    return sen.fitted_quality(_labelled(t), "text", "label")


@query("sen04_pseudo_label", """SELECT event_id, CASE WHEN value / 100 >= 4 THEN 'positive' WHEN value / 100 <= 2 THEN 'negative' ELSE 'neutral' END AS label FROM events""")
def _(t):
    return t.events.select("event_id", sen.pseudo_label(C("value") / 100).alias("label"))


@query("sen05_quality", """
WITH d AS (SELECT CAST(quality AS varchar) AS a, CASE WHEN doc_id % 3 = 0 THEN '2' ELSE CAST(toxic AS varchar) END AS b FROM labels), l AS (SELECT a AS x FROM d UNION SELECT b FROM d),
f AS (SELECT x, coalesce(2.0 * (SELECT count(*) FROM d WHERE a = x AND b = x) / nullif((SELECT count(*) FROM d WHERE a = x) + (SELECT count(*) FROM d WHERE b = x), 0), 0) AS f1 FROM l)
SELECT (SELECT count(*) FROM d) AS n, round((SELECT count(*) FROM d WHERE a = b) / (SELECT count(*) FROM d), 4) AS accuracy, round(avg(f1), 4) AS macro_f1 FROM f""")
def _(t):
    d = t.labels.select(C("quality").cast("string").alias("a"), F.when(C("doc_id") % 3 == 0, "2").otherwise(C("toxic").cast("string")).alias("b"))
    return sen.quality(d, "a", "b")


@query("sen06_place_summary", """
WITH d AS (SELECT user_id, value, CASE WHEN value >= 150 THEN 'positive' WHEN value <= 50 THEN 'negative' ELSE 'neutral' END AS label FROM events)
SELECT user_id AS place_id, round(avg(value / 100), 4) AS sentiment_score_mean, round(avg(value / 1000), 4) AS sentiment_confidence_mean, count(*) FILTER (label = 'positive') AS positive_review_count, count(*) FILTER (label = 'neutral') AS neutral_review_count, count(*) FILTER (label = 'negative') AS negative_review_count, count(*) AS total_review_count FROM d GROUP BY 1""")
def _(t):
    d = t.events.select(C("user_id").alias("place_id"), (C("value") / 100).alias("score"), (C("value") / 1000).alias("confidence"),
                        F.when(C("value") >= 150, "positive").when(C("value") <= 50, "negative").otherwise("neutral").alias("label"))
    return sen.place_summary(d)


@query("sen07_folds")
def _(t):
    folds = sen.assign_folds(t.documents.select("doc_id", "lang"), "doc_id", "lang", 5)
    return folds.groupBy("lang", "fold").agg(F.count("*").alias("n"))


@query("sen07_cross_validation")
def _(t):
    return sen.cross_validate(_labelled(t), "doc_id", "text", "label")


# ---- planning ------------------------------------------------------------

_bud = """CASE WHEN tier IN ('Ekonomis', 'Backpacker') THEN CASE WHEN pr <= 20000 THEN 1.0 WHEN pr <= 35000 THEN 0.75 WHEN pr <= 50000 THEN 0.4 ELSE 0.1 END WHEN tier = 'Standar' THEN CASE WHEN pr BETWEEN 15000 AND 75000 THEN 1.0 WHEN pr <= 120000 THEN 0.7 ELSE 0.3 END
  ELSE CASE WHEN pr >= 50000 THEN 1.0 WHEN pr >= 25000 THEN 0.6 ELSE 0.3 END END"""


@query("pln01_relevance", f"""
WITH i AS (SELECT item_id, category, CASE item_id % 3 WHEN 0 THEN 'Ekonomis' WHEN 1 THEN 'Standar' ELSE 'Mewah' END AS tier, CASE WHEN item_id % 7 = 0 THEN NULL ELSE price * 40 END AS price, CASE WHEN item_id % 5 = 0 THEN NULL ELSE rating END AS rating, item_id % 2 = 0 AS food FROM {CAT}),
p AS (SELECT *, CASE WHEN price > 0 THEN price WHEN food THEN 25000.0 ELSE 15000.0 END AS pr FROM i)
SELECT item_id, round((CASE WHEN food THEN 0.3 WHEN contains(category, 'promo') OR contains(category, 'small') THEN 1.0 ELSE 0.3 END) * 0.4 + ({_bud}) * 0.4 + least(1.0, coalesce(rating, 4.5) / 5.0) * 0.2, 6)::DOUBLE AS relevance FROM p""")
def _(t):
    i = views.catalog(t)
    tier = F.when(C("item_id") % 3 == 0, "Ekonomis").when(C("item_id") % 3 == 1, "Standar").otherwise("Mewah")
    price, rating = F.when(C("item_id") % 7 != 0, C("price") * 40), F.when(C("item_id") % 5 != 0, C("rating"))
    return i.select("item_id", F.round(pln.relevance(C("category"), F.array(F.lit("Promo"), F.lit("small")), tier, price, rating, C("item_id") % 2 == 0), 6).alias("relevance"))


# every third place names another region in its address
_addressed = [*views.CATALOG, ("address", "CASE WHEN p_partkey % 3 = 0 THEN concat('Jl. ', CAST(p_partkey % 90 AS varchar(9)), ' dekat BRAND#', CAST(p_partkey % 40 AS varchar(9)), ' utara') END")]


def _plan_items(t):
    cat = F.when(C("category") == "medium", "Wisata Kuliner").otherwise(C("category"))
    return views.columns(t.part, _addressed).select("item_id", "region", "address", cat.alias("category"), (C("price") * 40).alias("price"), "rating")


def _plan_requests(t):
    seg = C("c_mktsegment")
    wanted = F.when(seg == "BUILDING", F.array(F.lit("Semua"), F.lit(" ECO"))).when(seg == "MACHINERY", F.array(F.lit("promo "), F.lit(""), F.lit(None).cast("string"))).otherwise(F.array().cast("array<string>"))
    primary = F.when(seg == "HOUSEHOLD", "Large, semua").when(seg == "FURNITURE", "Semua").when(seg == "BUILDING", "standard,,Sma")
    return t.customer.select(
        C("c_custkey").alias("request_id"), F.concat(F.lit("Kota Brand#"), C("c_nationkey") + 1).alias("region"), wanted.alias("wanted"), primary.alias("primary_category"),
        F.when(C("c_acctbal") < 2000, "Ekonomis").when(C("c_acctbal") < 6000, F.lit(None).cast("string")).otherwise("Mewah").alias("tier"),
        F.when(C("c_nationkey") % 2 == 0, "Padat").otherwise("Santai").alias("pace"), (C("c_custkey") % 7).cast("int").alias("days"))


def _plan(t):
    return pln.plan(_plan_requests(t), _plan_items(t))


_slot_sql = ", ".join(f"('{pace}', {k}, '{time}', {str(food).lower()})" for pace, slots in pln.PACED_SLOTS.items() for k, (time, food) in enumerate(slots))
_held = lambda cols, words: " OR ".join(f"contains({cols}, '{w}')" for w in words)


@query("pln02_itinerary", f"""
WITH RECURSIVE i AS (SELECT item_id, lower(region) AS reg, lower(coalesce(address, '')) AS addr, CASE WHEN category = 'medium' THEN 'wisata kuliner' ELSE category END AS cat, price * 40 AS price, rating FROM {views.sql("part", _addressed)}),
q AS (SELECT c_custkey AS request_id, 'brand#' || (c_nationkey + 1) AS reg, CASE c_mktsegment WHEN 'BUILDING' THEN [' ECO', 'standard', 'Sma'] WHEN 'MACHINERY' THEN ['promo '] WHEN 'HOUSEHOLD' THEN ['Large'] ELSE [] END AS w,
  CASE WHEN c_acctbal < 2000 THEN 'Ekonomis' WHEN c_acctbal < 6000 THEN 'Standar' ELSE 'Mewah' END AS tier, CASE WHEN c_nationkey % 2 = 0 THEN 'Padat' ELSE 'Santai' END AS pace, CAST(least(c_custkey % 7, 5) AS INTEGER) AS days FROM customer),
wish AS (SELECT * REPLACE (list_transform(w, lambda x: lower(trim(x))) AS w) FROM q),
hit AS (SELECT q.*, i.* EXCLUDE (reg, addr), {_held('cat', pln.FOOD_WORDS)} AS food FROM wish q JOIN i ON contains(i.reg, q.reg) OR contains(i.addr, q.reg) OR NOT EXISTS (SELECT 1 FROM i z WHERE contains(z.reg, q.reg) OR contains(z.addr, q.reg))),
has AS (SELECT request_id, bool_or(food) AS hf, bool_or(NOT food) AS hs FROM hit GROUP BY 1),
pool AS (SELECT *, u.p AS for_food, CASE WHEN price > 0 THEN price WHEN u.p THEN 25000.0 ELSE 15000.0 END AS pr FROM hit JOIN has USING (request_id), (VALUES (true), (false)) u(p) WHERE CASE WHEN u.p THEN food OR NOT hf ELSE NOT food OR NOT hs END),
sc AS (SELECT request_id, for_food, item_id, round((CASE WHEN for_food THEN CASE WHEN {_held('cat', pln.FOOD_SCORE_WORDS)} THEN 1.0 ELSE 0.3 END WHEN len(w) = 0 THEN 0.8 WHEN len(list_filter(w, lambda x: contains(cat, x))) > 0 THEN 1.0 ELSE 0.3 END)::DOUBLE * 0.4::DOUBLE
  + ({_bud})::DOUBLE * 0.4::DOUBLE + least(1.0::DOUBLE, coalesce(rating, 4.5::DOUBLE) / 5.0::DOUBLE) * 0.2::DOUBLE, 8) AS score FROM pool),
l AS (SELECT request_id, list({{'id': item_id, 's': score}} ORDER BY score DESC, item_id) FILTER (for_food) AS fl, list({{'id': item_id, 's': score}} ORDER BY score DESC, item_id) FILTER (NOT for_food) AS sl FROM sc GROUP BY 1),
t AS (SELECT * FROM (VALUES {_slot_sql}) v(pace, slot, time, is_food)),
s AS (SELECT request_id, CAST(d AS INTEGER) AS day, slot, time, is_food, row_number() OVER (PARTITION BY request_id ORDER BY d, slot) AS n FROM q JOIN t USING (pace), range(1, 6) AS r(d) WHERE d <= days),
walk AS (SELECT request_id, 0::BIGINT AS n, []::BIGINT[] AS used, NULL::STRUCT(id BIGINT, s DOUBLE) AS e FROM q
  UNION ALL
  SELECT request_id, n, list_append(used, e.id), e FROM (
    SELECT request_id, n, used, o[coalesce(list_filter(range(1, len(o) + 1), lambda k: list_sum(list_transform(o[1:k], lambda x: x.s)) >= draw * list_sum(list_transform(o, lambda x: x.s)))[1], 1)] AS e FROM (
      SELECT request_id, n, used, draw, CASE WHEN len(free) > 0 THEN free ELSE [list_sort(p)[slot % len(p) + 1]] END AS o FROM (
        SELECT request_id, n, used, slot, p, list_filter(p, lambda x: NOT list_contains(used, x.id))[1:5] AS free, ('0x' || md5(concat_ws('|', 42, request_id, day, slot))[1:13])::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS draw FROM (
          SELECT w.request_id, s.n, w.used, s.slot, s.day, CASE WHEN s.is_food THEN l.fl ELSE l.sl END AS p FROM walk w JOIN s ON s.request_id = w.request_id AND s.n = w.n + 1 JOIN l ON l.request_id = w.request_id)))))
SELECT request_id, day, slot, time, is_food, e.id AS item_id, e.s AS score FROM walk JOIN s USING (request_id, n)""")
def _(t):
    return _plan(t)


_leg = [("request_id", "c_custkey - c_custkey % 5"), ("day", "CAST(1 AS int)"), ("slot", "CAST(c_custkey % 5 AS int)"), ("is_food", "(c_custkey % 2 = 0)"), ("price", "CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE c_acctbal END"),
        ("tier", "CASE c_nationkey % 3 WHEN 0 THEN 'Standar' WHEN 1 THEN 'Mewah' ELSE 'Ekonomis' END"), *views._point("0.0131")]


@query("pln03_legs", f"""
WITH s AS {views.sql("customer", _leg)}, j AS (SELECT s.*, coalesce({dist_sql('p', 's')} / 1000, 0) AS km FROM s LEFT JOIN s p ON p.request_id = s.request_id AND p.slot = s.slot - 1),
c AS (SELECT *, CASE WHEN price > 0 THEN price WHEN tier = 'Standar' THEN CASE WHEN is_food THEN 45000.0 ELSE 35000.0 END WHEN tier = 'Mewah' THEN CASE WHEN is_food THEN 120000.0 ELSE 85000.0 END ELSE CASE WHEN is_food THEN 25000.0 ELSE 15000.0 END END AS cost FROM j)
SELECT request_id, slot, round(km, 4) AS leg_km, round(km * 3.2, 0) AS leg_minutes, cost::DOUBLE AS cost, round(sum(cost) OVER (PARTITION BY request_id), 0)::DOUBLE AS total_cost FROM c""")
def _(t):
    return pln.legs(views.columns(t.customer, _leg)).select("request_id", "slot", F.round("leg_km", 4).alias("leg_km"), "leg_minutes", C("cost").cast("double"), "total_cost")


@query("pln04_swap", f"""
WITH q AS (SELECT c_custkey AS request_id, 'brand#' || (c_nationkey + 3) AS reg, CASE c_mktsegment WHEN 'BUILDING' THEN 'eco' WHEN 'MACHINERY' THEN 'rom' WHEN 'FURNITURE' THEN 'nothing' WHEN 'HOUSEHOLD' THEN '' ELSE 'a' END AS cat FROM customer),
i AS (SELECT item_id, lower(region) AS reg, lower(coalesce(address, '')) AS addr, category, rating, review_count FROM {views.sql("part", _addressed)}), x AS (SELECT DISTINCT o_custkey AS request_id, o_orderkey % 2000 AS item_id FROM orders),
m AS (SELECT q.request_id, q.cat, i.* FROM q JOIN i ON contains(i.reg, q.reg) OR contains(i.addr, q.reg) OR NOT EXISTS (SELECT 1 FROM i z WHERE contains(z.reg, q.reg) OR contains(z.addr, q.reg)) WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.request_id = q.request_id AND x.item_id = i.item_id)),
h AS (SELECT request_id, bool_or(cat <> '' AND contains(category, cat)) AS hit FROM m GROUP BY 1), r AS (SELECT m.*, row_number() OVER (PARTITION BY request_id ORDER BY rating DESC, review_count DESC, item_id) AS rank FROM m JOIN h USING (request_id) WHERE contains(category, cat) OR NOT hit)
SELECT request_id, rank, item_id, rating, review_count FROM r WHERE rank <= 3""")
def _(t):
    cat = F.when(C("c_mktsegment") == "BUILDING", " Eco ").when(C("c_mktsegment") == "MACHINERY", "ROM").when(C("c_mktsegment") == "FURNITURE", "nothing").when(C("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string")).otherwise("a")
    q = t.customer.select(C("c_custkey").alias("request_id"), F.concat(F.lit("Kabupaten Brand#"), C("c_nationkey") + 3).alias("region"), cat.alias("category"))
    gone = t.orders.select(C("o_custkey").alias("request_id"), (C("o_orderkey") % 2000).alias("item_id"))
    return pln.swap_alternatives(q, views.columns(t.part, _addressed).select("item_id", "region", "address", "category", "rating", "review_count"), gone)


# ---- sampling ------------------------------------------------------------

_quota = """
WITH c AS (SELECT c_nationkey AS g, count(*) AS n FROM customer GROUP BY 1), p AS (SELECT *, 300 - (SELECT count(*) FROM c) * 4 AS rest, (SELECT sum(n) FROM c) AS total FROM c),
o AS (SELECT *, g = 7 AND floor(n / total * rest) + 4 > 12 AS cap FROM p), s AS (SELECT *, CASE WHEN cap THEN 0.0 ELSE n / (SELECT sum(n) FROM o WHERE NOT cap) * (rest - coalesce((SELECT 12 - 4 FROM o WHERE cap), 0)) END AS share FROM o),
w AS (SELECT *, floor(share) AS whole, rest - coalesce((SELECT 12 - 4 FROM o WHERE cap), 0) AS lft FROM s), r AS (SELECT *, lft - (SELECT sum(whole) FROM w) AS spare, row_number() OVER (PARTITION BY cap ORDER BY share - whole DESC, g) AS pos FROM w),
q AS (SELECT g, n, CAST(CASE WHEN cap THEN 12 ELSE 4 + whole + CASE WHEN pos <= spare THEN 1 ELSE 0 END END AS bigint) AS quota FROM r)"""


@query("smp01_quotas", _quota + " SELECT g AS c_nationkey, n, quota FROM q")
def _(t):
    return smp.quotas(t.customer, "c_nationkey", 300, 4, 7, 0.04)


def _pick(t):
    c = t.customer
    q = smp.quotas(c, "c_nationkey", 300, 4, 7, 0.04)
    pools = [("poor", smp.pool(c, "c_custkey", [C("c_acctbal").asc(), C("c_custkey").asc()])), ("rich", smp.pool(c, "c_custkey", [C("c_acctbal").desc(), C("c_custkey").asc()]))]
    return smp.stratified_pick(c, "c_custkey", "c_nationkey", "c_mktsegment", q, pools, ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"], 300)


@query("smp02_stratified_counts", _quota + " SELECT g AS c_nationkey, least(n, quota) AS n FROM q")
def _(t):
    return _pick(t).groupBy("c_nationkey").agg(F.count_distinct("c_custkey").alias("n"))


@query("smp02_stratified_pick")
def _(t):
    return _pick(t)


@query("smp03_audit_sample")
def _(t):
    return smp.audit_sample(views.catalog(t), "item_id", {"closed": C("status") == "permanently_closed", "popular": C("review_count") > 1950}, {"per_region": ("region", 2), "per_category": ("category", 3)}, ("confidence", 20))


# ---- sources -------------------------------------------------------------


def _export(t):
    """Place export records as JSON text, written from the customer and part tables' own values."""
    body = F.struct(
        F.when(C("c_nationkey") != 3, C("c_name")).alias("title"), F.when(C("c_mktsegment") == "BUILDING", F.concat(F.lit("P"), "c_custkey")).alias("placeId"), F.when(C("c_mktsegment") == "MACHINERY", F.concat(F.lit("C"), "c_custkey")).alias("cid"),
        F.lower("c_mktsegment").alias("categoryName"), F.array(F.lit("wisata"), F.when(C("c_nationkey") < 9, "building").otherwise("x")).alias("categories"), F.struct(C("c_acctbal").alias("lat"), F.lit(105.5).alias("lng")).alias("location"),
        F.concat(F.lit("08"), "c_custkey").alias("phone"), F.when(C("c_nationkey") < 12, F.concat(F.lit("628"), "c_custkey")).alias("phoneUnformatted"))
    text = t.customer.select("c_custkey", F.concat(F.lit("/raw/"), F.lower("c_mktsegment"), F.lit("/2026-07-13/places.json")).alias("file_path"), F.to_json(body).alias("j"))
    return text.select("c_custkey", "file_path", F.from_json("j", schemas.PLACE_EXPORT).alias("r")).select("c_custkey", "file_path", "r.*").withColumn("_corrupt", F.lit(None).cast("string"))


@query("src01_place_export", """
SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'P' || c_custkey WHEN 'MACHINERY' THEN 'C' || c_custkey END AS known_id, c_name AS raw_name, lower(c_mktsegment) AS query_region,
  CASE WHEN lower(c_mktsegment) = 'building' AND c_nationkey < 9 THEN 'wisata,building' ELSE lower(c_mktsegment) || ',wisata,' || CASE WHEN c_nationkey < 9 THEN 'building' ELSE 'x' END END AS categories, CASE WHEN c_nationkey < 12 THEN '628' || c_custkey ELSE '08' || c_custkey END AS phone FROM customer WHERE c_nationkey <> 3""")
def _(t):
    p = ingest.export_places(_export(t), "2026-07-13T00:00:00Z")
    return p.select(F.when(F.length("source_place_id") < 16, C("source_place_id")).alias("known_id"), "raw_name", "query_region", F.array_join("raw_categories", ",").alias("categories"), "phone")


@query("src01_export_rejects", "SELECT 'Missing title field' AS reason, count(*) AS n FROM customer WHERE c_nationkey = 3")
def _(t):
    return ingest.export_rejects(_export(t)).groupBy("reason").agg(F.count("*").alias("n"))


@query("src02_upsert", """
SELECT user_id, event_id, value FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_type = 'purchase' DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def _(t):
    e = t.events.select("user_id", "event_id", "value", "event_type")
    return ingest.upsert_last(e.filter("event_type <> 'purchase'"), e.filter("event_type = 'purchase'"), "user_id", "event_id").select("user_id", "event_id", "value")


@query("src02_new_files", """
WITH f AS (SELECT doc_id, sha256(text) AS checksum FROM documents) SELECT min('/d/' || lpad(CAST(doc_id AS varchar), 9, '0')) AS path, checksum FROM f WHERE checksum NOT IN (SELECT f.checksum FROM f JOIN labels USING (doc_id)) GROUP BY checksum""")
def _(t):
    files = t.documents.select("doc_id", F.concat(F.lit("/d/"), F.lpad(C("doc_id").cast("string"), 9, "0")).alias("path"), F.sha2("text", 256).alias("checksum"))
    manifest = files.join(t.labels.select("doc_id"), "doc_id", "left_semi").select("path", "checksum")
    return ingest.new_files(files.select("path", "checksum"), manifest).select("path", "checksum")


@query("src02_import", """
WITH f AS (SELECT doc_id, doc_id % 500 AS place, sha256(text) AS checksum, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents),
n AS (SELECT min(doc_id) AS doc_id FROM f WHERE checksum NOT IN (SELECT checksum FROM f WHERE known) GROUP BY checksum),
b AS (SELECT place, doc_id, 0 AS fresh FROM f WHERE known UNION ALL SELECT doc_id % 500, doc_id, 1 FROM n)
SELECT place, arg_max(doc_id, (fresh, doc_id)) AS doc_id, (SELECT count(*) FROM f WHERE known) + (SELECT count(*) FROM n) AS manifest_rows FROM b GROUP BY place""")
def _(t):
    files = t.documents.select("doc_id", (C("doc_id") % 500).alias("place"), F.concat(F.lit("/d/"), F.lpad(C("doc_id").cast("string"), 9, "0")).alias("path"), F.sha2("text", 256).alias("checksum"))
    known = files.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    table, manifest = ingest.import_incremental(
        files.select("path", "checksum"), lambda fresh: files.join(fresh.select("path"), "path", "left_semi").select("place", "doc_id"),
        known.select("path", "checksum"), known.select("place", "doc_id"), "place", "doc_id")
    return table.withColumn("manifest_rows", manifest.agg(F.count("*")).scalar())


@query("src03_path_parts", """
WITH p AS (SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS host FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 0 OR host = '' THEN 'unknown_region' ELSE lower(replace(replace(host, '-', '_'), ' ', '_')) END AS region, CASE WHEN page_id % 3 = 0 THEN '2026-01-01' ELSE '2026-07-1' || page_id % 9 END AS date FROM p""")
def _(t):
    host = F.regexp_extract("url", "//([^/]+)/", 1)
    path = F.when(C("page_id") % 3 == 0, F.concat(host, F.lit("/raw/x.json"))).otherwise(F.concat(F.lit("/data/"), host, F.lit("/2026-07-1"), C("page_id") % 9, F.lit("/p.json")))
    return t.pages.select("page_id", ingest.path_region(path).alias("region"), ingest.path_date(path, "2026-01-01").alias("date"))


@query("src04_map_elements", """
SELECT 'osm_' || CASE WHEN s_suppkey % 2 = 0 THEN 'node' ELSE 'way' END || '_' || s_suppkey AS source_record_id, s_name AS raw_name, CASE WHEN s_suppkey % 2 = 0 THEN -5.0 - s_suppkey / 1000.0 ELSE -6.0 END::DOUBLE AS latitude,
  'tourism=museum' || CASE WHEN s_suppkey % 3 = 0 THEN ',leisure=park' ELSE '' END AS categories, CASE WHEN s_suppkey % 4 = 0 THEN 'Jl A, Metro' ELSE 'full ' || s_suppkey END AS raw_address FROM supplier WHERE s_nationkey <> 2""")
def _(t):
    tags = F.map_filter(F.create_map(
        F.lit("name"), F.when(C("s_nationkey") != 2, C("s_name")), F.lit("tourism"), F.lit("museum"), F.lit("leisure"), F.when(C("s_suppkey") % 3 == 0, "park"),
        F.lit("addr:street"), F.when(C("s_suppkey") % 4 == 0, "Jl A"), F.lit("addr:city"), F.when(C("s_suppkey") % 4 == 0, "Metro"), F.lit("addr:full"), F.concat(F.lit("full "), "s_suppkey")), lambda k, v: v.isNotNull())
    el = F.struct(F.when(C("s_suppkey") % 2 == 0, "node").otherwise("way").alias("type"), C("s_suppkey").alias("id"), F.when(C("s_suppkey") % 2 == 0, F.lit(-5.0) - C("s_suppkey") / 1000.0).alias("lat"), F.when(C("s_suppkey") % 2 == 0, 105.0).alias("lon"),
                  F.struct(F.lit(-6.0).alias("lat"), F.lit(104.0).alias("lon")).alias("center"), tags.alias("tags"))
    p = ingest.flatten_map_elements(t.supplier.select(F.array(el).alias("elements")), F.lit("metro"), "2026-01-01")
    return p.select("source_record_id", "raw_name", "latitude", F.array_join("raw_categories", ",").alias("categories"), "raw_address")


@query("src05_places_response", """
SELECT event_id, 'p' || CAST(json_extract(props, '$.k') AS varchar) AS source_place_id, CASE WHEN event_type = 'view' THEN 'Unknown' ELSE event_type END AS raw_name, value AS latitude FROM events WHERE event_type <> 'error'""")
def _(t):
    k = F.get_json_object("props", "$.k")
    name = F.struct(F.when(C("event_type") != "view", C("event_type")).alias("text"))
    place = F.struct(F.when(C("event_type") != "error", F.concat(F.lit("p"), k)).alias("id"), name.alias("displayName"), F.struct(C("value").alias("latitude"), F.lit(1.0).alias("longitude")).alias("location"))
    body = F.to_json(F.struct(F.array(place).alias("places")))
    return ingest.flatten_places_response(t.events.select("event_id", body.alias("body")), "body").select("event_id", "source_place_id", "raw_name", "latitude")


@query("src06_listing_items")
def _(t):
    return ingest.extract_listing_items(t.pages, ["the", "der", "les", "und", "para"])


@query("src07_typed_rows", "SELECT event_id, user_id, value FROM events")
def _(t):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return ingest.read_table(t.spark, f"{t.root}/events.parquet", schema)


@query("src08_three_formats", """
WITH s AS (SELECT count(*) AS n, sum(s_suppkey) AS keys, count(DISTINCT s_name) AS names FROM supplier)
SELECT f AS format, n, keys::BIGINT AS keys, names, '["' || 'x' || '"]' AS tag FROM s, (VALUES ('csv'), ('jsonl'), ('parquet')) v(f)""")
def _(t):
    rows = t.supplier.select("s_suppkey", "s_name", F.array(F.lit("x")).alias("tags"))
    folder = shared_folder(t.spark)
    out = None
    for path in sinks.save_dataset(rows, folder, "suppliers"):
        kind = path.rsplit(".", 1)[1]
        tags = "array<string>" if kind == "jsonl" else "string"
        schema = T.StructType.fromDDL(f"s_suppkey long, s_name string, tags {tags}")
        back = ingest.read_table(t.spark, path, schema)
        tag = F.to_json("tags") if kind == "jsonl" else C("tags")
        part = back.agg(F.count("*").alias("n"), F.sum("s_suppkey").alias("keys"), F.count_distinct("s_name").alias("names"), F.max(tag).alias("tag")).withColumn("format", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("src09_reconcile", """
WITH r AS (SELECT o_orderkey AS k, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1), s AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_quantity > 1 GROUP BY 1), m AS (SELECT l_orderkey AS k, max(l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(r.k, s.k, m.k) AS file_id, coalesce(r.n, 0) AS raw_rows, coalesce(s.n, 0) AS staged_rows, CAST(coalesce(m.n, 0) AS bigint) AS expected, coalesce(r.n, 0) = coalesce(s.n, 0) AND coalesce(r.n, 0) = coalesce(m.n, 0) AS agrees FROM r FULL JOIN s ON r.k = s.k FULL JOIN m ON m.k = coalesce(r.k, s.k)""")
def _(t):
    li = t.lineitem.select(C("l_orderkey").alias("file_id"), "l_quantity", "l_linenumber")
    manifest = li.groupBy("file_id").agg(F.max("l_linenumber").cast("bigint").alias("expected"))
    return ingest.reconcile_counts(li, li.filter("l_quantity > 1"), manifest, "file_id")


@query("src10_union_first_wins", """
SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, event_id) AS rn FROM events) WHERE rn = 1""")
def _(t):
    e = t.events.select("user_id", "event_id", "event_type")
    return ingest.union_first_wins([e.filter("event_type = 'purchase'"), e.filter("event_type = 'click'"), e.filter("event_type NOT IN ('purchase', 'click')")], "user_id", "event_id").select("user_id", "event_id")


@query("src11_batch_states", """
SELECT conv_id, count(DISTINCT role) AS n_modes, bool_and(length(text) > 20 AND turn < 6) AS all_ok, count(*) AS n_entries, CASE WHEN count(DISTINCT role) = 3 AND bool_and(length(text) > 20 AND turn < 6) THEN 'completed' ELSE 'pending' END AS batch_status FROM conversations GROUP BY 1""")
def _(t):
    m = t.conversations.select("conv_id", C("role").alias("mode"), F.when(F.length("text") > 20, "completed").otherwise("failed").alias("status"), (C("turn") < 6).alias("file_exists"))
    return ingest.batch_states(m, "conv_id")


@query("src11_batch_members", "SELECT p_brand AS batch, p_type AS mode, unnest([p_partkey, CAST(p_size AS bigint)]) AS canonical_id FROM part")
def _(t):
    return ingest.batch_members(t.part.select(C("p_brand").alias("batch"), C("p_type").alias("mode"), F.array("p_partkey", C("p_size").cast("bigint")).alias("members")), "batch", "members")


@query("src11_resume_set", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4 + 1 ELSE o_orderkey % 4 END AS attempts, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 + 1 >= 3 THEN 'failed_terminal' WHEN o_orderstatus = 'F' THEN 'failed' WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'completed' END AS status,
  NOT (o_orderstatus = 'F' AND o_orderkey % 4 + 1 >= 3) AND o_orderstatus <> 'P' AS run_again FROM orders""")
def _(t):
    s = t.orders.select("o_orderkey", (C("o_orderkey") % 4).alias("attempts"), F.when(C("o_orderstatus") == "F", "failed").when(C("o_orderstatus") == "O", "pending").otherwise("completed").alias("status"))
    return ingest.resume_set(s)


@query("src12_assign_batches", """
SELECT c_custkey, 'batch_' || CASE WHEN b < 1000 THEN lpad(CAST(b AS varchar), 3, '0') ELSE CAST(b AS varchar) END AS batch_id, m AS mode, CASE WHEN b = 1 THEN 'review_strategy_v1' ELSE 'review_strategy_v2' END AS strategy_version, 5 AS target_positive, CASE WHEN b = 1 THEN 5 ELSE 3 END AS target_negative, CASE WHEN b = 1 THEN 3 ELSE 2 END AS target_neutral
FROM (SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 50) + 1 AS bigint) AS b FROM customer), (VALUES ('positive'), ('negative'), ('neutral')) v(m)""")
def _(t):
    return ingest.assign_batches(t.customer, "c_custkey", 50, ["positive", "negative", "neutral"])


@query("src13_conform", "SELECT CAST(o_orderkey AS varchar) AS price_id, CAST(o_custkey AS varchar) AS canonical_id, o_totalprice AS amount_min, CAST(NULL AS varchar) AS currency FROM orders")
def _(t):
    return schemas.conform(t.orders, schemas.PRICE, {"o_orderkey": "price_id", "o_custkey": "canonical_id", "o_totalprice": "amount_min"}).select("price_id", "canonical_id", "amount_min", "currency")
