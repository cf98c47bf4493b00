"""Review, metadata, consolidation and quality queries (REV, MET, CON, QA)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import urls
from waymark.functions.rules import weighted_flags
from waymark.operators import master, metadata as met, normalize as nrm, quality as qa, reviews as rev
from waymark.plans import views
from waymark.plans.matching import _waterfall
from waymark.plans.normalization import has_any, quote
from waymark.plans.registry import query

C = F.col
REV, REC, CAT, GEO, PRI = views.REVIEWS_SQL, views.RECORDS_SQL, views.CATALOG_SQL, views.GEO_SQL, views.PRICES_SQL

# ---- reviews -------------------------------------------------------------

_rm = [("row_id", "event_id"), ("place", "user_id"), ("value", "value"), ("source_place_id", "CASE WHEN event_type IN ('view', 'click') THEN concat('g', CAST(user_id AS varchar(9))) END"),
       ("url", "CASE WHEN event_type IN ('click', 'purchase') THEN concat('u', CAST(user_id AS varchar(9))) END"), ("batch_id", "event_type")]
_known = "(SELECT place FROM r WHERE value > {v})"


@query("rev01_map_reviews", f"""
WITH r AS {views.sql("events", _rm)}
SELECT row_id, CASE WHEN source_place_id IS NOT NULL AND place IN {_known.format(v=300)} THEN place WHEN url IS NOT NULL AND place IN {_known.format(v=200)} THEN place + 10000 WHEN batch_id = 'signup' THEN 1 END AS canonical_id FROM r""")
def _(t):
    r = views.columns(t.events, _rm)
    by_place = r.filter("value > 300").select(F.concat(F.lit("g"), "place").alias("source_place_id"), C("place").alias("canonical_id")).distinct()
    by_url = r.filter("value > 200").select(F.concat(F.lit("u"), "place").alias("url"), (C("place") + 10000).alias("canonical_id")).distinct()
    single = r.filter("batch_id = 'signup'").select("batch_id", F.lit(1).cast("bigint").alias("canonical_id")).distinct()
    return rev.map_reviews(r, by_place, by_url, single).select("row_id", "canonical_id")


@query("rev02_review_facts", """
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 'c' || conv_id || '-' || turn ELSE 'gen_' || md5(txt || '_' || role) END AS review_id, stars AS rating,
  CASE WHEN stars >= 4 THEN 'positive' WHEN stars = 3 THEN 'neutral' ELSE 'negative' END AS sentiment_bucket, sha256(trim(txt)) AS content_hash, trim(txt) = '' AS is_empty
FROM (SELECT *, CASE WHEN conv_id % 9 = 0 THEN '' ELSE text END AS txt, CASE WHEN turn % 4 = 3 THEN 5 ELSE CAST(conv_id % 5 + 1 AS int) END AS stars FROM conversations)""")
def _(t):
    c = t.conversations.select(
        "conv_id", "turn", F.when(C("turn") % 2 == 0, F.format_string("c%d-%d", "conv_id", "turn")).alias("raw_id"),
        F.when(C("conv_id") % 9 == 0, F.lit(None)).otherwise(C("text")).alias("text"), C("role").alias("author"),
        F.when(C("turn") % 4 == 3, "n/a").otherwise((C("conv_id") % 5 + 1).cast("string")).alias("raw_rating"), F.lit(None).cast("string").alias("collected"))
    return rev.review_facts(c, "2026-01-01T00:00:00Z").select("conv_id", "turn", "review_id", "rating", "sentiment_bucket", "content_hash", "is_empty")


@query("rev03_unique_reviews", r"""
SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id % 7, CASE WHEN s <> '' THEN s ELSE 'h:' || sha256(trim(text)) END ORDER BY doc_id) AS rn
FROM (SELECT *, regexp_replace(lower(text), '[^\p{L}\p{N}_]', '', 'g') AS s FROM documents)) WHERE rn = 1""")
def _(t):
    r = t.documents.select(C("doc_id").alias("row_id"), (C("doc_id") % 7).alias("canonical_id"), C("doc_id").alias("review_id"), C("text").alias("review_text"))
    return rev.unique_reviews(r).select(C("row_id").alias("doc_id"))


_bucket = "CASE WHEN rating >= 4 THEN 'positive' WHEN rating = 3 THEN 'neutral' ELSE 'negative' END"


@query("rev04_representative", f"""
WITH r AS (SELECT *, {_bucket} AS sentiment_bucket, place_id % 4 AS batch_id FROM {REV}),
k AS (SELECT *, row_number() OVER (PARTITION BY place_id, sentiment_bucket ORDER BY review_ts DESC, length(text) DESC, review_id) AS selection_rank FROM r WHERE trim(text) <> '')
SELECT place_id AS canonical_id, review_id, sentiment_bucket, selection_rank FROM k WHERE selection_rank <= CASE sentiment_bucket WHEN 'positive' THEN 5 WHEN 'negative' THEN CASE batch_id WHEN 0 THEN 5 ELSE 3 END ELSE CASE batch_id WHEN 0 THEN 3 ELSE 2 END END""")
def _(t):
    r = views.reviews(t).select(C("place_id").alias("canonical_id"), "review_id", rev.star_bucket(C("rating")).alias("sentiment_bucket"),
                                C("text").alias("review_text"), "review_ts", (C("place_id") % 4).alias("batch_id"))
    targets = r.select("batch_id").distinct().select("batch_id", F.explode(F.array(*[F.struct(
        F.lit(b).alias("bucket"), F.when(C("batch_id") == 0, first).otherwise(later).alias("target"))
        for b, first, later in (("positive", 5, 5), ("negative", 5, 3), ("neutral", 3, 2))])).alias("x")).select("batch_id", "x.*")
    return rev.representative(r, targets, 5).select("canonical_id", "review_id", "sentiment_bucket", "selection_rank")


@query("rev05_coverage", """
WITH o AS (SELECT o_custkey, o_totalprice > 150000 AS usable, CASE o_orderstatus WHEN 'F' THEN 'positive' WHEN 'O' THEN 'negative' ELSE 'neutral' END AS b FROM orders),
g AS (SELECT o_custkey, count(*) AS n, least(count(*) FILTER (b = 'positive' AND usable), 2) AS p, least(count(*) FILTER (b = 'negative' AND usable), 2) AS ng, least(count(*) FILTER (b = 'neutral' AND usable), 1) AS u FROM o GROUP BY 1),
s AS (SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey, coalesce(n, 0) AS n, coalesce(p, 0) AS p, coalesce(ng, 0) AS ng, coalesce(u, 0) AS u FROM customer LEFT JOIN g ON o_custkey = c_custkey)
SELECT c_custkey AS canonical_id, n AS total_collected, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'ineligible' WHEN c_acctbal < 0 THEN 'not_scheduled' WHEN n = 0 AND c_nationkey < 5 THEN 'no_google_reviews' WHEN n = 0 THEN 'failed_scrape'
  WHEN p + ng + u = 0 THEN 'reviews_without_text' WHEN p = 2 AND ng = 2 AND u = 1 THEN 'complete_bucket_coverage' ELSE 'partial_bucket_coverage' END AS coverage_status FROM s""")
def _(t):
    pop = t.customer.select(C("c_custkey").alias("canonical_id"), (C("c_mktsegment") != "HOUSEHOLD").alias("eligible"), (C("c_acctbal") >= 0).alias("batch_completed"),
                            F.when(C("c_nationkey") >= 5, 5).alias("listed_reviews"), F.lit(2).alias("target_positive"), F.lit(2).alias("target_negative"), F.lit(1).alias("target_neutral"))
    b = F.when(C("o_orderstatus") == "F", "positive").when(C("o_orderstatus") == "O", "negative").otherwise("neutral")
    got = t.orders.select(
        C("o_custkey").alias("canonical_id"), C("o_orderkey").alias("review_id"), b.alias("sentiment_bucket"), F.when(C("o_totalprice") > 150000, "x").otherwise(" ").alias("review_text"),
        C("o_orderdate").alias("review_ts"), F.lit(0).alias("batch_id"))
    targets = got.select("batch_id").distinct().select("batch_id", F.explode(F.array(*[F.struct(F.lit(n).alias("bucket"), F.lit(k).alias("target"))
                                                       for n, k in (("positive", 2), ("negative", 2), ("neutral", 1))])).alias("x")).select("batch_id", "x.*")
    return rev.coverage(pop, got, rev.representative(got, targets, 2)).select("canonical_id", "total_collected", "coverage_status")


@query("rev06_run_metrics", f"""
SELECT count(*) AS raw, count(*) FILTER (kind = 'click') AS raw_click, count(*) FILTER (kind = 'view') AS raw_view, count(*) FILTER (rating = 2) AS duplicates, count(*) FILTER (trim(text) = '') AS empty, count(*) FILTER (rating >= 4) AS selected,
  round(count(*) FILTER (rating = 2) / count(*), 6) AS duplicate_rate, round(count(*) FILTER (trim(text) = '') / count(*), 6) AS empty_rate, round(count(*) FILTER (rating >= 4) / count(*), 6) AS yield_rate FROM {REV}""")
def _(t):
    return rev.run_metrics(views.reviews(t), "kind", ["click", "view"], C("rating") == 2, F.trim("text") == "", C("rating") >= 4)


@query("rev07_batch_gate", """
WITH b AS (SELECT o_custkey % 16 AS batch, count(DISTINCT o_custkey) AS attempted, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS covered, count(*) AS raw, count(*) FILTER (o_orderpriority = '1-URGENT') AS duplicates,
  count(*) FILTER (o_orderpriority IN ('2-HIGH', '5-LOW')) AS empty, count(*) FILTER (o_custkey % 16 = 3 AND o_orderstatus = 'P') AS unmapped, count(*) FILTER (o_totalprice > 100000 + (o_custkey % 16) * 20000) AS selected, count(DISTINCT o_custkey) * 10 AS target FROM orders GROUP BY 1)
SELECT *, round(covered / attempted, 6) AS coverage_rate, round(duplicates / raw, 6) AS duplicate_rate, round(empty / raw, 6) AS empty_rate, round(selected / raw, 6) AS yield_rate, round(selected / target, 6) AS fill_rate,
  CASE WHEN unmapped > 0 OR covered / attempted < 0.6 THEN 'FAIL' WHEN duplicates / raw < 0.45 AND empty / raw < 0.4 AND selected / raw > 0.25 THEN 'PASS' ELSE 'CONDITIONAL PASS' END AS decision FROM b""")
def _(t):
    o = t.orders.withColumn("batch", C("o_custkey") % 16)
    # one row per customer first, so that distinct customers are plain counts
    per = o.groupBy("batch", "o_custkey").agg(
        F.count("*").alias("raw"), F.bool_or(C("o_orderstatus") == "F").alias("hit"), F.count_if(C("o_orderpriority") == "1-URGENT").alias("duplicates"),
        F.count_if(C("o_orderpriority").isin("2-HIGH", "5-LOW")).alias("empty"), F.count_if((C("batch") == 3) & (C("o_orderstatus") == "P")).alias("unmapped"),
        F.count_if(C("o_totalprice") > 100000 + C("batch") * 20000).alias("selected"))
    b = per.groupBy("batch").agg(F.count("*").alias("attempted"), F.count_if("hit").alias("covered"), *[F.sum(c).alias(c) for c in ("raw", "duplicates", "empty", "unmapped", "selected")],
                                 (F.count("*") * 10).alias("target"))
    return rev.batch_gate(b)


@query("rev08_batch_costs", """
WITH r AS (SELECT o_custkey % 50 AS batch, o_orderstatus AS mode, CASE WHEN o_custkey % 50 = 7 AND o_orderstatus = 'P' THEN NULL ELSE count(*) END AS n FROM orders GROUP BY 1, 2, (o_custkey % 50 = 7 AND o_orderstatus = 'P')),
c AS (SELECT batch, count(n) AS modes_known, 0.5::DOUBLE * count(n) + sum(n) * 0.003::DOUBLE AS s FROM r GROUP BY 1)
SELECT batch, CASE WHEN modes_known = 3 THEN round(s, 4) END AS total_cost, modes_known, CASE WHEN modes_known = 3 THEN 'available' ELSE 'unavailable' END AS cost_status FROM c""")
def _(t):
    runs = t.orders.groupBy((C("o_custkey") % 50).alias("batch"), C("o_orderstatus").alias("mode")).agg(F.count("*").alias("n"))
    runs = runs.withColumn("raw_review_count", F.when(~((C("batch") == 7) & (C("mode") == "P")), C("n")))
    return rev.batch_costs(runs, "batch", ["F", "O", "P"], digits=4)


# ---- metadata ------------------------------------------------------------

_pop = "(SELECT c_custkey AS place_id FROM customer)"


def _population(t):
    return t.customer.select(C("c_custkey").alias("place_id"))


@query("met01_mapping_report")
def _(t):
    mapped = _waterfall(t)
    return mapped.groupBy(F.coalesce("method", F.lit("unmapped")).alias("method")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("mean_confidence"))


_mob = ("CASE WHEN regexp_replace({c}, '[^0-9]', '', 'g') LIKE '08%' THEN '+628' || substr(regexp_replace({c}, '[^0-9]', '', 'g'), 3) "
        "WHEN regexp_replace({c}, '[^0-9]', '', 'g') LIKE '8%' THEN '+628' || substr(regexp_replace({c}, '[^0-9]', '', 'g'), 2) ELSE '+' || regexp_replace({c}, '[^0-9]', '', 'g') END")
_newest = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY collected_at DESC, record_id) AS rn FROM {REC}) WHERE rn = 1)"


@query("met02_survivors", f"""
SELECT p.place_id, n.record_id AS newest_record, coalesce(n.address, '') AS address, CASE WHEN n.record_id IS NULL THEN 'https://default.id' WHEN n.website IS NULL THEN '' WHEN contains(n.website, 'instagram') THEN '' ELSE n.website END AS website,
  CASE WHEN n.phone IS NOT NULL THEN {_mob.format(c='n.phone')} ELSE '+6281' || p.place_id END AS phone, coalesce(n.rating, 3.5) AS rating, CASE WHEN n.record_id IS NULL THEN 'unmapped' ELSE 'mapped' END AS mapping_status
FROM {_pop} p LEFT JOIN {_newest} n USING (place_id)""")
def _(t):
    pop = _population(t).withColumns({"default_phone": F.concat(F.lit("081"), "place_id"), "default_website": F.lit("https://default.id"), "default_rating": F.lit(3.5)})
    return met.survivors(views.records(t), pop).drop("collected_at")


@query("met03_operational_status", """
SELECT c_custkey AS place_id, CASE WHEN n IS NULL THEN 'unknown' WHEN p THEN 'permanently_closed' WHEN q THEN 'temporarily_closed' ELSE 'open' END AS operational_status, coalesce(n, 0) AS source_count
FROM customer LEFT JOIN (SELECT o_custkey, bool_or(o_orderstatus = 'P' AND o_totalprice > 300000) AS p, bool_or(o_orderpriority = '1-URGENT' AND o_totalprice > 250000) AS q, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def _(t):
    r = t.orders.select(C("o_custkey").alias("place_id"), F.when((C("o_orderstatus") == "P") & (C("o_totalprice") > 300000), "True").otherwise("no").alias("perm_closed"),
                                                       F.when((C("o_orderpriority") == "1-URGENT") & (C("o_totalprice") > 250000), "1").alias("temp_closed"))
    return met.operational_status(r, t.customer.select(C("c_custkey").alias("place_id")))


_state = "CASE WHEN {a}.perm_closed THEN 'permanently_closed' WHEN {a}.temp_closed THEN 'temporarily_closed' ELSE 'open' END"


@query("met04_conflicts", f"""
WITH st AS (SELECT place_id, CASE WHEN bool_or(perm_closed) THEN 'permanently_closed' WHEN bool_or(temp_closed) THEN 'temporarily_closed' ELSE 'open' END AS s FROM {REC} GROUP BY 1),
w AS (SELECT n.*, st.s, CASE WHEN n.website IS NULL OR contains(n.website, 'instagram') THEN '' ELSE n.website END AS site, CASE WHEN n.phone IS NULL THEN '' ELSE {_mob.format(c='n.phone')} END AS ph FROM {_newest} n JOIN st USING (place_id)),
j AS (SELECT o.place_id, w.record_id AS source_a, o.record_id AS source_b, w.site, w.ph, w.address AS addr, w.s, o.website, o.phone, o.address, {_state.format(a='o')} AS os FROM {REC} o JOIN w USING (place_id) WHERE o.record_id <> w.record_id)
SELECT place_id, source_a, source_b, 'website' AS field_name, site AS value_a, website AS value_b, 'newest_source_priority' AS resolution FROM j WHERE site <> '' AND website IS NOT NULL AND NOT contains(website, 'instagram') AND website <> site
UNION ALL SELECT place_id, source_a, source_b, 'phone', ph, phone, 'newest_source_priority' FROM j WHERE ph <> '' AND phone IS NOT NULL AND {_mob.format(c='phone')} <> ph
UNION ALL SELECT place_id, source_a, source_b, 'address', addr, address, 'newest_source_priority' FROM j WHERE lower(address) <> lower(addr)
UNION ALL SELECT place_id, source_a, source_b, 'operational_status', s, os, 'operational_status_priority' FROM j WHERE os <> s""")
def _(t):
    r = views.records(t)
    places = r.select("place_id").distinct()
    sel = met.survivors(r, places.withColumns({"default_phone": F.lit(None).cast("string"), "default_website": F.lit(None).cast("string"), "default_rating": F.lit(None).cast("double")}))
    sel = sel.join(met.operational_status(r, places), "place_id")
    extra = {"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double"), "categories": F.lit(None).cast("array<string>"), "opening_hours": F.lit(None).cast("string")}
    return met.conflicts(r.withColumns(extra), sel.withColumns(extra))


@query("met05_provenance", """
SELECT c_custkey, field_name, field_value FROM (SELECT c_custkey, CAST(c_name AS varchar) AS c_name, CAST(c_nationkey AS varchar) AS c_nationkey, CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_mktsegment END AS c_mktsegment FROM customer)
UNPIVOT (field_value FOR field_name IN (c_name, c_nationkey, c_mktsegment)) WHERE trim(field_value) <> ''""")
def _(t):
    c = t.customer.withColumn("c_mktsegment", F.when(C("c_custkey") % 4 == 0, " ").otherwise(C("c_mktsegment")))
    return met.provenance(c, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


@query("met06_opening_hours", """
WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'Senin' WHEN 1 THEN ' sunday' WHEN 2 THEN 'JUMAT' ELSE 'someday' END AS day, CASE event_id % 5 WHEN 0 THEN '8.00 - 17.30' WHEN 1 THEN 'Tutup' WHEN 2 THEN '24 jam' WHEN 3 THEN 'call' ELSE '10:00 to 22:00' END AS h FROM events)
SELECT event_id, CASE trim(lower(day)) WHEN 'senin' THEN 'monday' WHEN 'sunday' THEN 'sunday' ELSE 'friday' END AS day_of_week, h AS raw_value, CASE event_id % 5 WHEN 0 THEN '08:00' WHEN 2 THEN '00:00' WHEN 4 THEN '10:00' ELSE '' END AS open_time,
  CASE event_id % 5 WHEN 0 THEN '17:30' WHEN 2 THEN '24:00' WHEN 4 THEN '22:00' ELSE '' END AS close_time, event_id % 5 = 2 AS is_24_hours, event_id % 5 = 1 AS is_closed FROM e WHERE event_id % 4 <> 3 AND event_id % 5 <> 3""")
def _(t):
    day = F.expr("CASE event_id % 4 WHEN 0 THEN 'Senin' WHEN 1 THEN ' sunday' WHEN 2 THEN 'JUMAT' ELSE 'someday' END")
    text = F.expr("CASE event_id % 5 WHEN 0 THEN '8.00 - 17.30' WHEN 1 THEN 'Tutup' WHEN 2 THEN '24 jam' WHEN 3 THEN 'call' ELSE '10:00 to 22:00' END")
    p = t.events.select("event_id", F.array(F.struct(day.alias("day"), text.alias("hours"))).alias("entries"))
    return met.opening_hours_rows(p, "event_id", "entries")


@query("met07_facilities", """
SELECT p_partkey, g AS facility_group, n AS facility_name, CASE v WHEN 'true' THEN 'available' ELSE 'unavailable' END AS availability FROM
(SELECT p_partkey, 'parking' AS g, 'Lahan' AS n, CAST(p_size % 2 = 1 AS varchar) AS v FROM part UNION ALL SELECT p_partkey, 'restroom', 'Toilet umum', CAST(p_size % 4 >= 2 AS varchar) FROM part
 UNION ALL SELECT p_partkey, 'food_and_drink', 'Cafe ' || p_brand, CAST(p_size > 25 AS varchar) FROM part UNION ALL SELECT p_partkey, 'other', p_name, 'true' FROM part)""")
def _(t):
    item = lambda k, v: F.create_map(k, v)
    groups = F.create_map(F.lit(" Parkir "), F.array(item(F.lit("Lahan"), C("p_size") % 2 == 1), item(F.lit("Toilet umum"), C("p_size") % 4 >= 2)),
                          F.lit("Lainnya"), F.array(item(F.concat(F.lit("Cafe "), "p_brand"), C("p_size") > 25), item(C("p_name"), F.lit(True))))
    return met.facility_rows(t.part.select("p_partkey", groups.alias("groups")), "p_partkey", "groups")


@query("met08_contacts", """
SELECT c_custkey, 'website' AS contact_type, 'https://s' || c_custkey || '.id' AS value FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'phone', '+62' || c_custkey FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT c_custkey, 'map_url', 'https://maps/' || c_custkey FROM customer""")
def _(t):
    c = t.customer.select("c_custkey", F.when(C("c_custkey") % 3 == 0, F.concat(F.lit("https://s"), "c_custkey", F.lit(".id"))).alias("website"),
                          F.when(C("c_custkey") % 2 == 0, F.concat(F.lit("+62"), "c_custkey")).otherwise(" ").alias("phone"), F.concat(F.lit("https://maps/"), "c_custkey").alias("source_url"))
    return met.contact_rows(c, "c_custkey")


@query("met08_record_relations", f"""
WITH j AS (SELECT o.place_id, o.record_id, o.record_id = n.record_id AS is_selected, o.address, o.phone, n.address AS sel FROM {REC} o JOIN {_newest} n USING (place_id))
SELECT place_id, record_id, is_selected, 'address' AS relation, address AS value, '' AS kind, NOT is_selected AND address <> sel AS conflict FROM j WHERE address IS NOT NULL
UNION ALL SELECT place_id, record_id, is_selected, 'phone', {_mob.format(c='phone')}, CASE WHEN {_mob.format(c='phone')} LIKE '+628%' THEN 'mobile' ELSE 'fixed_line' END, false FROM j WHERE phone IS NOT NULL""")
def _(t):
    r = views.records(t)
    sel = met.newest(r, ["place_id"], "collected_at", "record_id").select("place_id", C("record_id").alias("newest_record"), "address")
    return met.record_relations(r, sel)


@query("met08_website_relations", f"""
SELECT place_id, record_id, website, CASE WHEN contains(website, 'instagram') THEN 'official_social_media' ELSE 'official_website' END AS website_type, NOT contains(website, 'instagram') AS is_official FROM {REC} WHERE website IS NOT NULL""")
def _(t):
    return met.website_relations(views.records(t), F.lit("Taman Kota")).select("place_id", "record_id", "website", "website_type", "is_official")


_fs = [("place_id", "c_custkey"), ("website", "CASE WHEN c_custkey % 3 = 0 THEN 'a' END"), ("phone", "CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'b' END"), ("address", "c_name"),
       ("description", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'd' END"), ("has_hours", "(c_custkey % 4 = 0)"), ("has_facilities", "(c_custkey % 7 = 0)"),
       ("operational_status", "CASE WHEN c_custkey % 6 = 0 THEN 'permanently_closed' ELSE 'open' END"), ("mapped", "(c_custkey % 9 <> 0)"), ("has_place_id", "(c_custkey % 8 <> 1)")]


@query("met09_field_states", f"""
SELECT place_id, CASE WHEN website IS NOT NULL THEN 'observed' WHEN NOT has_place_id THEN 'not_applicable' ELSE 'missing' END AS website_status, CASE WHEN phone <> '' THEN 'observed' ELSE 'missing' END AS phone_status, 'observed' AS address_status,
  CASE WHEN description IS NOT NULL THEN 'observed' ELSE 'missing' END AS description_status, CASE WHEN has_hours THEN 'observed' WHEN operational_status = 'permanently_closed' THEN 'not_applicable' ELSE 'missing' END AS hours_status,
  CASE WHEN has_facilities THEN 'observed' WHEN operational_status = 'permanently_closed' THEN 'not_applicable' ELSE 'missing' END AS facility_status, CASE WHEN mapped THEN 'observed' ELSE 'unknown' END AS operational_state FROM {views.sql("customer", _fs)}""")
def _(t):
    return met.field_states(views.columns(t.customer, _fs))


_full = {"mapped": "status <> 'unknown'", "address": "item_id % 2 = 0", "website": "item_id % 3 = 0", "phone": "item_id % 5 <> 0", "hours": "has_parking", "status": "status <> 'unknown'", "facilities": "has_food", "description": "has_toilet"}
_score = " + ".join(f"CASE WHEN {_full[k]} THEN {w} ELSE 0 END" for k, w in met.FULL_WEIGHTS.items())


@query("met10_completeness", f"""
SELECT item_id, s AS score, CASE WHEN s >= 90 THEN 'complete' WHEN s >= 75 THEN 'strong' WHEN s >= 50 THEN 'moderate' ELSE 'sparse' END AS class FROM (SELECT item_id, {_score} AS s FROM {CAT})""")
def _(t):
    flags = views.catalog(t).select("item_id", *[F.expr(e).alias(k) for k, e in _full.items()])
    return flags.select("item_id", met.completeness(met.FULL_WEIGHTS).alias("score")).withColumn("class", met.completeness_class(C("score")))


@query("met11_warnings", """
SELECT c_custkey, '[' || concat_ws(',', CASE WHEN c_acctbal < 1000 THEN '"address_missing"' END, CASE WHEN c_custkey % 3 = 0 THEN '"metadata_unmapped"' END, CASE WHEN c_custkey % 2 = 0 THEN '"phone_missing"' END) || ']' AS warnings FROM customer""")
def _(t):
    return t.customer.select("c_custkey", met.warnings({"phone_missing": C("c_custkey") % 2 == 0, "address_missing": C("c_acctbal") < 1000, "metadata_unmapped": C("c_custkey") % 3 == 0}).alias("warnings"))


@query("met12_status_audit", f"""
SELECT r.place_id, count(*) AS source_count, string_agg(DISTINCT r.source, '/' ORDER BY r.source) AS source_types, any_value(n.record_id) AS selected_source, bool_or(r.perm_closed <> n.perm_closed) AS conflict_present FROM {REC} r JOIN {_newest} n USING (place_id) GROUP BY 1""")
def _(t):
    return met.status_audit(views.records(t))


@query("met13_price_candidates")
def _(t):
    c = views.catalog(t)
    p = nrm.research_priority(C("category"), F.array("name"), C("status"), [("high", ["promo"]), ("medium", ["large"]), ("low", ["small"])])
    return c.select("item_id", "name", "region", "category", "status", p.alias("p")).select("item_id", "name", "region", "category", "status", "p.priority", "p.reason")


# ---- consolidation -------------------------------------------------------


@query("con01_review_summary", f"""
SELECT p.place_id, p.place_id % 3 = 0 AS review_eligible, count(r.review_id) AS review_count, round(avg(rating), 6) AS review_rating_mean, median(rating) AS review_rating_median, min(rating) AS review_rating_min, max(rating) AS review_rating_max,
  count(*) FILTER (trim(text) <> '') AS review_text_count, CAST(max(review_ts) AS varchar) = CAST(min(review_ts) AS varchar) AS single_date, CASE WHEN count(r.review_id) > 0 THEN 'scraped' WHEN p.place_id % 3 = 0 THEN 'no_reviews' ELSE 'ineligible' END AS review_coverage_status, count(r.review_id) > 0 AS has_reviews
FROM {_pop} p LEFT JOIN {REV} r USING (place_id) GROUP BY 1""")
def _(t):
    pop = _population(t).withColumn("review_eligible", C("place_id") % 3 == 0)
    s = master.review_summary(pop, views.reviews(t))
    return s.withColumns({"review_rating_mean": F.round("review_rating_mean", 6), "single_date": C("review_latest_at") == C("review_oldest_at")}).drop("review_latest_at", "review_oldest_at")


_oh = [("place_id", "user_id"), ("day_of_week", "concat('d', CAST(event_id % 7 AS varchar(9)))"), ("is_24_hours", "(event_id % 7 < 6 OR user_id % 2 = 0)"),
       ("raw_value", "CASE WHEN event_id % 5 = 0 THEN ' ' ELSE concat('h', CAST(event_id % 4 AS varchar(9))) END"), ("source_id", "event_id % 11")]


@query("con02_hours_summary", f"""
WITH h AS {views.sql("events", _oh)}, d AS (SELECT place_id, day_of_week, bool_or(is_24_hours) AS a FROM h GROUP BY 1, 2), e AS (SELECT place_id, count(*) AS n, bool_and(a) AS a FROM d GROUP BY 1),
x AS (SELECT place_id, string_agg(DISTINCT trim(raw_value), '; ' ORDER BY trim(raw_value)) FILTER (trim(raw_value) <> '') AS s, count(DISTINCT source_id) AS c FROM h GROUP BY 1)
SELECT place_id, n AS opening_days_count, a AS open_24_hours, coalesce(s, 'Observed schedules') AS opening_hours_summary, c AS opening_hours_source_count, CASE WHEN a AND n = 7 THEN 'open_24_7' ELSE 'observed' END AS opening_hours_status FROM e JOIN x USING (place_id)""")
def _(t):
    return master.hours_summary(views.columns(t.events, _oh))


_fac = [("place_id", "l_orderkey"), ("facility_name", "CASE l_returnflag WHEN 'A' THEN 'Parkir luas' WHEN 'N' THEN 'Toilet khusus pengguna kursi roda' ELSE 'Cafe' END"), ("availability", "CASE WHEN l_linestatus = 'O' THEN 'available' ELSE 'unavailable' END")]


@query("con03_facility_summary", f"""
SELECT place_id, count(*) AS facility_count, '[' || coalesce(string_agg(DISTINCT '"' || facility_name || '"', ',' ORDER BY '"' || facility_name || '"') FILTER (availability = 'available'), '') || ']' AS facilities,
  bool_or(availability = 'available' AND facility_name LIKE 'Parkir%') AS has_parking, bool_or(availability = 'available' AND facility_name LIKE 'Toilet%') AS has_toilet, bool_or(availability = 'available' AND facility_name = 'Cafe') AS has_food, false AS has_prayer_room,
  bool_or(availability = 'available' AND facility_name LIKE 'Toilet%') AS has_wheelchair_access, CASE WHEN bool_or(availability = 'available' AND facility_name LIKE 'Toilet%') THEN 'observed_accessible' WHEN bool_or(facility_name LIKE 'Toilet%') THEN 'observed_inaccessible' ELSE 'missing' END AS accessibility_status,
  CASE WHEN count(*) >= 5 THEN 'complete' ELSE 'partial' END AS facility_data_status FROM {views.sql("lineitem", _fac)} GROUP BY 1""")
def _(t):
    return master.facility_summary(views.columns(t.lineitem, _fac))


_lp = [("place_id", "l_partkey"), ("price_type", "l_returnflag"), ("amount", "l_extendedprice"), ("amount_min", "CASE WHEN l_linenumber = 2 THEN l_extendedprice / 2 END"), ("amount_max", "CASE WHEN l_linenumber = 3 THEN l_extendedprice * 2 END"),
       ("confidence", "l_discount"), ("audit_decision", "CASE WHEN l_linenumber = 1 OR l_partkey % 17 = 0 THEN 'reject' ELSE 'accept' END"), ("price_data_status", "CASE l_linestatus WHEN 'F' THEN 'historical_reference' ELSE CASE WHEN l_partkey % 3 = 0 THEN 'current' ELSE 'unresolved' END END")]


@query("con04_local_prices", f"""
WITH o AS (SELECT *, audit_decision = 'accept' AS ok, CASE price_data_status WHEN 'historical_reference' THEN 'historical' ELSE price_data_status END AS st FROM {views.sql("lineitem", _lp)})
SELECT place_id, bool_or(ok) AS has_local_price_evidence, count(*) AS local_price_observation_count, count(*) FILTER (ok) AS local_valid_price_observation_count, count(DISTINCT price_type) FILTER (ok) AS local_price_type_count,
  '[' || coalesce(string_agg(DISTINCT '"' || price_type || '"', ',' ORDER BY '"' || price_type || '"') FILTER (ok), '') || ']' AS local_price_types, min(least(amount, amount_min, amount_max)) FILTER (ok) AS local_price_min, max(greatest(amount, amount_min, amount_max)) FILTER (ok) AS local_price_max,
  max(confidence) FILTER (ok) AS local_price_best_confidence, '[' || string_agg(DISTINCT '"' || st || '"', ',' ORDER BY '"' || st || '"') || ']' AS local_price_temporal_statuses,
  CASE WHEN NOT bool_or(ok) THEN 'no_evidence' WHEN bool_or(st = 'current') THEN 'current_present' ELSE 'historical_only' END AS local_price_data_status FROM o GROUP BY 1""")
def _(t):
    return master.local_price_summary(views.columns(t.lineitem, _lp))


@query("con05_external_prices", """
WITH p AS (SELECT o_custkey AS place_id, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi, bool_or(o_orderstatus = 'F') AS cur, bool_or(o_orderpriority = '5-LOW') AS unb FROM orders GROUP BY 1)
SELECT c_custkey AS place_id, coalesce(n, 0) AS external_selected_price_count, lo AS external_price_min, hi AS external_price_max, coalesce(cur, false) AS has_verified_current_price, coalesce(unb, false) AS has_official_live_unbounded_price,
  CASE WHEN c_acctbal < 0 THEN 'not_verified' ELSE 'completed_no_price' END AS external_verification_status, CASE WHEN n > 0 THEN 'verified_present' WHEN c_acctbal < 0 THEN 'not_verified' ELSE 'completed_no_price' END AS external_price_data_status FROM customer LEFT JOIN p ON place_id = c_custkey""")
def _(t):
    pop = t.customer.select(C("c_custkey").alias("place_id"))
    cov = t.customer.filter("c_acctbal >= 0").select(C("c_custkey").alias("place_id")).withColumn("verification_status", F.lit("completed_no_price"))
    prices = t.orders.select(C("o_custkey").alias("place_id"), C("o_totalprice").alias("amount"),
        F.when(C("o_orderstatus") == "F", "Current").otherwise("old").alias("temporal_status"), (C("o_orderpriority") == "5-LOW").alias("is_unbounded"))
    return master.external_price_summary(pop, cov, prices)


@query("con06_source_flags", """
SELECT l_suppkey AS place_id, bool_or(l_returnflag IN ('A', 'N')) AS has_maps, bool_or(l_returnflag = 'R') AS has_osm, '[' || string_agg(DISTINCT '"' || l_returnflag || '"', ',' ORDER BY '"' || l_returnflag || '"') || ']' AS source_types FROM lineitem GROUP BY 1""")
def _(t):
    m = t.lineitem.select(C("l_suppkey").alias("place_id"), C("l_returnflag").alias("source"))
    return master.source_flags(m, {"has_maps": ["A", "N"], "has_osm": ["R"]})


def _star(t):
    """Customer star in the shape of a wide master: orders as reviews and prices."""
    g = views.geo(t)
    pop = g.join(t.customer.select(C("c_custkey").alias("place_id"), "c_acctbal"), "place_id").select(
        "place_id", F.when(C("place_id") % 12 != 0, C("lat")).alias("latitude"), F.when(C("place_id") % 12 != 0, C("lon")).alias("longitude"), "name",
        F.when(C("place_id") % 2 == 0, "addr").alias("address"), F.when(C("place_id") % 3 == 0, "+62").alias("phone"), F.when(C("place_id") % 5 == 0, "https://a.id").alias("official_website"),
        F.when(C("place_id") % 7 == 0, "google_maps_only").otherwise("missing").alias("website_status"), F.when(C("place_id") % 4 == 1, "text").alias("description"),
        F.when(C("place_id") % 6 != 0, "mapped").alias("metadata_mapping_status"), F.when(C("place_id") % 8 != 0, "open").alias("operational_status"),
        (C("place_id") % 3 == 1).alias("review_eligible"), (C("place_id") % 10 / 10.0).alias("classification_confidence"), (C("place_id") % 5 == 2).cast("int").alias("source_conflict_count"))
    o = t.orders.select(C("o_custkey").alias("place_id"), "o_orderstatus", "o_totalprice")
    rv = o.filter("o_orderstatus = 'P'").groupBy("place_id").agg(F.count("*").alias("review_count")).withColumns({"has_reviews": F.lit(True), "review_coverage_status": F.lit("scraped")})
    fac = o.filter("o_orderstatus = 'F'").groupBy("place_id").agg(F.count("*").alias("facility_count"), (F.count("*") > 4).alias("has_opening_hours"))
    price = o.filter("o_orderstatus = 'O'").groupBy("place_id").agg(F.lit(True).alias("has_local_price_evidence"), F.lit("historical_only").alias("local_price_data_status"), F.count("*").alias("external_selected_price_count"))
    scope = o.filter("o_totalprice > 400000").groupBy("place_id").agg(F.lit("in_scope").alias("price_validation_scope"), F.lit("completed_unresolved").alias("external_verification_status"))
    return master.consolidate(pop, [rv, fac, price, scope])


_star_sql = f"""
WITH b AS (SELECT g.place_id, CASE WHEN g.place_id % 12 <> 0 THEN lat END AS lat, g.place_id % 2 = 0 AS addr, g.place_id % 3 = 0 AS ph, g.place_id % 5 = 0 AS site, g.place_id % 7 = 0 AS gm, g.place_id % 4 = 1 AS descr, g.place_id % 6 <> 0 AS mapped,
  g.place_id % 8 <> 0 AS op, g.place_id % 3 = 1 AS elig, (g.place_id % 10) / 10.0 AS conf, g.place_id % 5 = 2 AS conflict, coalesce(rv, 0) AS rv, coalesce(fc, 0) AS fc, coalesce(pr, 0) AS pr, coalesce(mx > 400000, false) AS scope
  FROM {GEO} g LEFT JOIN (SELECT o_custkey AS k, count(*) FILTER (o_orderstatus = 'P') AS rv, count(*) FILTER (o_orderstatus = 'F') AS fc, count(*) FILTER (o_orderstatus = 'O') AS pr, max(o_totalprice) AS mx FROM orders GROUP BY 1) o ON o.k = g.place_id),
w AS (SELECT *, list_sort(list_filter([CASE WHEN lat IS NULL THEN 'missing_coordinates' END, CASE WHEN NOT op THEN 'unknown_operational_status' END, CASE WHEN rv = 0 THEN 'no_review_data' END, CASE WHEN NOT mapped THEN 'metadata_unmapped' END, CASE WHEN fc <= 4 THEN 'opening_hours_missing' END,
  CASE WHEN fc = 0 THEN 'facility_data_unknown' END, CASE WHEN pr > 0 THEN 'local_price_historical_only' END, CASE WHEN NOT scope THEN 'external_price_not_verified' END, CASE WHEN scope THEN 'external_price_unresolved' END, CASE WHEN conflict THEN 'source_conflict' END, CASE WHEN conf < 0.6 THEN 'low_identity_confidence' END], lambda x: x IS NOT NULL)) AS ws FROM b),
s AS (SELECT *, CAST(CASE WHEN lat IS NOT NULL THEN 20 ELSE 0 END + CASE WHEN NOT elig OR rv > 0 THEN 15 ELSE 0 END + CASE WHEN addr THEN 5 ELSE 0 END + CASE WHEN ph THEN 5 ELSE 0 END + CASE WHEN site THEN 5 WHEN gm THEN 2 ELSE 0 END + CASE WHEN descr THEN 5 ELSE 0 END
  + CASE WHEN fc > 0 THEN 10 ELSE 0 END + CASE WHEN fc > 4 THEN 10 ELSE 0 END + CASE WHEN op THEN 10 ELSE 0 END + CASE WHEN NOT scope OR pr > 0 THEN 5 ELSE 0 END + 5 + CASE len(ws) WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END AS double) AS score,
  CAST(rv > 0 AS int) + CAST(mapped AS int) + CAST(fc > 0 AS int) + CAST(fc > 4 AS int) + CAST(pr > 0 AS int) + CAST(pr > 0 AS int) + CAST(op AS int) AS layers FROM w)"""


@query("con07_master", _star_sql + """
SELECT place_id, rv AS review_count, fc AS facility_count, fc > 4 AS has_opening_hours, pr AS external_selected_price_count, CASE WHEN mapped THEN 'mapped' ELSE 'unmapped' END AS metadata_mapping_status, CASE WHEN op THEN 'open' ELSE 'unknown' END AS operational_status,
  CASE WHEN scope THEN 'in_scope' ELSE 'out_of_scope' END AS price_validation_scope, score AS overall_completeness_score FROM s""")
def _(t):
    return _star(t).select("place_id", "review_count", "facility_count", "has_opening_hours", "external_selected_price_count", "metadata_mapping_status", "operational_status", "price_validation_scope", "overall_completeness_score")


@query("con08_quality_warnings", _star_sql + """
SELECT place_id, '[' || array_to_string(list_transform(ws, lambda x: '"' || x || '"'), ',') || ']' AS quality_warnings, len(ws) AS quality_warning_count FROM s""")
def _(t):
    return _star(t).select("place_id", "quality_warnings", "quality_warning_count")


@query("con09_completeness", _star_sql + """
SELECT place_id, score AS overall_completeness_score, CASE WHEN score >= 90 THEN 'complete' WHEN score >= 75 THEN 'strong' WHEN score >= 50 THEN 'moderate' ELSE 'sparse' END AS overall_completeness_class FROM s""")
def _(t):
    return _star(t).select("place_id", "overall_completeness_score", "overall_completeness_class")


@query("con10_layers", _star_sql + """
SELECT place_id, rv > 0 AS has_review_data, mapped AS has_metadata_data, fc > 0 AS has_facility_data, fc > 4 AS has_opening_hours_data, pr > 0 AS has_local_price_data, layers AS enrichment_layer_count FROM s""")
def _(t):
    return _star(t).select("place_id", "has_review_data", "has_metadata_data", "has_facility_data", "has_opening_hours_data", "has_local_price_data", "enrichment_layer_count")


@query("con11_layer_coverage", _star_sql + """, c AS (SELECT count(*) AS total, count(*) FILTER (rv > 0) AS a, count(*) FILTER (mapped) AS b, count(*) FILTER (fc > 0) AS d FROM s)
SELECT l AS layer, n AS covered, total, round(n * 100.0 / total, 2) AS pct FROM c, LATERAL (VALUES ('has_review_data', a), ('has_metadata_data', b), ('has_facility_data', d)) v(l, n)""")
def _(t):
    return master.layer_coverage(_star(t), ["has_review_data", "has_metadata_data", "has_facility_data"])


@query("con12_source_manifest", """
SELECT 'orders' AS source, count(*) AS row_count, count(DISTINCT o_custkey) AS distinct_keys, count(DISTINCT o_custkey) FILTER (o_custkey IN (SELECT c_custkey FROM customer)) AS matched_keys FROM orders
UNION ALL SELECT 'events', count(*), count(DISTINCT user_id), count(DISTINCT user_id) FILTER (user_id IN (SELECT c_custkey FROM customer)) FROM events""")
def _(t):
    return master.source_manifest({"orders": t.orders.select(C("o_custkey").alias("k")), "events": t.events.select(C("user_id").alias("k"))}, "k", t.customer.select(C("c_custkey").alias("k")))


# ---- quality -------------------------------------------------------------


@query("qa01_check_rules", """
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN -1 ELSE o_totalprice END AS p, CASE WHEN o_orderkey % 700 = 2 THEN 95.0 ELSE 5.0 END AS lat FROM orders)
SELECT 'unique_key' AS rule, count(*) - count(DISTINCT o_orderkey) AS violations, CAST(NULL AS varchar) AS example, count(*) = count(DISTINCT o_orderkey) AS passed FROM f
UNION ALL SELECT 'negative_price', count(*) FILTER (p < 0), CAST(min(o_orderkey) FILTER (p < 0) AS varchar), count(*) FILTER (p < 0) = 0 FROM f
UNION ALL SELECT 'latitude_bounds', count(*) FILTER (lat > 90), CAST(min(o_orderkey) FILTER (lat > 90) AS varchar), count(*) FILTER (lat > 90) = 0 FROM f
UNION ALL SELECT 'row_count', abs(count(*) - 100), NULL, count(*) = 100 FROM f""")
def _(t):
    f = t.orders.select("o_orderkey", F.when(C("o_orderkey") % 1000 == 1, -1.0).otherwise(C("o_totalprice")).alias("p"), F.when(C("o_orderkey") % 700 == 2, 95.0).otherwise(5.0).alias("lat"))
    return qa.check_rules(f, "o_orderkey", {"negative_price": C("p") < 0, "latitude_bounds": ~C("lat").between(-90, 90)}, expected_rows=100)


@query("qa02_duplicates", """
SELECT 'order' AS key_name, count(*) AS row_count, count(DISTINCT l_orderkey) AS distinct_keys, count(*) - count(DISTINCT l_orderkey) AS surplus, (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)) AS largest_group FROM lineitem
UNION ALL SELECT 'order_line', count(*), count(DISTINCT (l_orderkey, l_linenumber)), count(*) - count(DISTINCT (l_orderkey, l_linenumber)), (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)) FROM lineitem""")
def _(t):
    return qa.duplicate_audit(t.lineitem, {"order": ["l_orderkey"], "order_line": ["l_orderkey", "l_linenumber"]})


@query("qa03_join_growth", """
WITH a AS (SELECT c_custkey AS k, count(*) AS l FROM customer GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS r FROM orders GROUP BY 1)
SELECT 'customer_orders' AS stage, CAST(sum(l) AS bigint) AS rows_in, CAST(sum(l * greatest(coalesce(r, 0), 1)) AS bigint) AS rows_out, count(*) AS keys_in, count(r) AS keys_matched, round(sum(l * greatest(coalesce(r, 0), 1)) / sum(l), 6) AS multiplier,
  CASE WHEN max(l) > 1 THEN 'N' ELSE '1' END || ':' || CASE WHEN max(r) > 1 THEN 'N' ELSE '1' END AS cardinality, sum(l * greatest(coalesce(r, 0), 1)) = sum(l) AS passed FROM a LEFT JOIN b USING (k)""")
def _(t):
    return qa.join_growth("customer_orders", t.customer.select(C("c_custkey").alias("k")), t.orders.select(C("o_custkey").alias("k")), "k")


_na = ("CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN ' ' WHEN 3 THEN 'not_applicable' WHEN 4 THEN 'false' ELSE '0' END AS a", "c_acctbal AS b")


@query("qa04_null_audit", f"""
WITH f AS (SELECT {', '.join(_na)} FROM customer)
SELECT 'a' AS field, count(a) AS non_null, count(*) - count(a) AS nulls, count(*) FILTER (a = 'unknown') AS unknown, count(*) FILTER (a = ' ') AS empty, count(*) FILTER (a = 'not_applicable') AS not_applicable, count(*) FILTER (a = 'false') AS "false", count(*) FILTER (a = '0') AS zero FROM f
UNION ALL SELECT 'b', count(b), count(*) - count(b), 0, 0, 0, 0, count(*) FILTER (b = 0) FROM f""")
def _(t):
    return qa.null_audit(t.customer.selectExpr(*_na), ["a", "b"])


@query("qa05_digest")
def _(t):
    return qa.digest(t.lineitem)


@query("qa05_difference", """
SELECT o_orderkey, o_orderstatus, 'removed' AS change FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '5-LOW') UNION ALL SELECT o_orderkey, 'X', 'added' FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW'""")
def _(t):
    cols = ["o_orderkey", "o_orderstatus"]
    new = t.orders.filter("NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')").withColumn(
        "o_orderstatus", F.when((C("o_orderstatus") == "P") & (C("o_orderpriority") == "5-LOW"), "X").otherwise(C("o_orderstatus")))
    return qa.difference(t.orders.select(cols), new.select(cols))


@query("qa06_expectations", """
SELECT 'o_orderstatus_allowed' AS expectation, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS violations, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 AS passed FROM orders
UNION ALL SELECT 'o_orderkey_unique', count(*) - count(DISTINCT o_orderkey), count(*) = count(DISTINCT o_orderkey) FROM orders
UNION ALL SELECT 'o_custkey_subset', count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)), count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)) = 0 FROM orders""")
def _(t):
    return qa.expectations(t.orders, {"o_orderstatus": ["F", "O"]}, ["o_orderkey"], {"o_custkey": t.customer.filter("c_acctbal > 0").select("c_custkey")})


@query("qa07_compare_versions", """
WITH n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 1 THEN NULL ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 50 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS p FROM orders WHERE o_totalprice < 480000)
SELECT 'o_orderstatus' AS field, count(*) AS compared, count(*) FILTER (s IS DISTINCT FROM o_orderstatus) AS changed FROM orders JOIN n USING (o_orderkey) UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (p IS DISTINCT FROM o_totalprice) FROM orders JOIN n USING (o_orderkey)
UNION ALL SELECT '_only_one_side', count(*), count(*) FILTER (n.o_orderkey IS NULL) FROM orders LEFT JOIN n USING (o_orderkey)""")
def _(t):
    new = t.orders.filter("o_totalprice < 480000").withColumns({
        "o_orderstatus": F.when(C("o_orderkey") % 100 != 1, C("o_orderstatus")), "o_totalprice": F.when(C("o_orderkey") % 50 == 3, C("o_totalprice") + 1).otherwise(C("o_totalprice"))})
    return qa.compare_versions(t.orders, new, "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("qa08_keyword_extract", f"""
SELECT item_id, name, concat_ws(',', CASE WHEN contains(name, 'red') THEN 'red' END, CASE WHEN contains(name, 'ring') THEN 'ring' END) AS matched FROM {CAT} WHERE contains(name, 'red') OR contains(name, 'ring')""")
def _(t):
    return qa.keyword_extract(views.catalog(t), C("name"), ["red", "ring"]).select("item_id", "name", F.array_join("matched", ",").alias("matched"))
