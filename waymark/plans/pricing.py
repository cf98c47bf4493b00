"""Price queries (PRC) and the compatibility join (JN-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark import config
from waymark.functions import money
from waymark.operators import prices as prc
from waymark.plans import views
from waymark.plans.registry import query

C = F.col
PRI, CAT = views.PRICES_SQL, views.CATALOG_SQL

RULES = dict(
    config.EVIDENCE, free_phrases=["old gizmo", "cold"], non_attraction_words=["bolt", "kantor"], post_pattern=r"(?U)\bhot\s", dock_words=["anvil"], dock_categories=["promo"],
    dock_pass_words=["red"], gate_words=["valve"], parking_words=["gear"], parking_pass_words=["blue", "small"], commercial_categories=["large"], commercial_terms=["economy"],
    managed_name_words=["ring"], managed_description_words=["brand#1"], category_only=["small", "medium"], map_sites=["google.com"])
_w = lambda c, w: f"regexp_matches({c}, '\\b{w}\\b')"
_np = (f"CASE WHEN {_w('name', 'bolt')} THEN 'bolt' WHEN regexp_matches(name, '\\bhot\\s') THEN 'pos\\s' WHEN {_w('name', 'anvil')} AND category <> 'promo' AND NOT contains(name, 'red') THEN 'anvil'"
       f" WHEN {_w('name', 'valve')} THEN 'valve' WHEN {_w('name', 'gear')} AND NOT (contains(name, 'blue') OR contains(name, 'small')) THEN 'gear' END")
_fr = f"CASE WHEN {_w('name', 'old gizmo')} OR {_w('descr', 'old gizmo')} THEN 'old gizmo' WHEN {_w('name', 'cold')} OR {_w('descr', 'cold')} THEN 'cold' END"


@query("prc01_name_rules", f"""
SELECT item_id, {_fr} AS free_phrase, {_np} AS non_attraction FROM (SELECT *, lower(region) AS descr FROM {CAT})""")
def _(t):
    return views.catalog(t).select("item_id", prc.free_phrase(C("name"), C("region"), RULES).alias("free_phrase"), prc.non_attraction(C("name"), C("category"), RULES).alias("non_attraction"))


_cand = [("place_id", "p_partkey"), ("name", "p_name"), ("category", "lower(p_type)"), ("tags", "''"), ("website", "CASE p_partkey % 5 WHEN 0 THEN 'https://a.id' WHEN 1 THEN 'https://google.com/maps' END"),
         ("description", "p_brand"), ("operational_status", "CASE p_partkey % 50 WHEN 0 THEN 'permanently_closed' WHEN 2 THEN 'temporarily_closed' ELSE 'open' END"),
         ("price_hint", "CASE WHEN p_partkey % 7 = 0 THEN 'x' END"), ("price_raw", "CASE WHEN p_partkey % 11 = 0 THEN 'y' ELSE ' ' END"),
         ("original_priority", "CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'not_applicable' END"), ("in_scope", "(p_partkey % 4 < 2)"), ("mapped", "(p_partkey % 9 <> 0)")]


def _scored(t):
    facs = t.lineitem.select(C("l_partkey").alias("place_id"), F.when(C("l_returnflag") == "A", "Tiket masuk").when(C("l_returnflag") == "N", "Bayar tunai").otherwise("Kartu tiket").alias("facility_name"),
                             F.when(C("l_discount") > 0.08, "available").otherwise("unavailable").alias("availability"))
    c = views.columns(t.part, _cand).join(prc.paid_facilities(facs), "place_id", "left")
    return prc.score_candidates(c, RULES)


_scored_sql = f"""
WITH f AS (SELECT l_partkey AS place_id, bool_or(l_returnflag = 'A' AND l_discount > 0.08) AS pf FROM lineitem GROUP BY 1),
a AS (SELECT c.*, coalesce(pf, false) AS pf, lower(description) AS descr, trim(coalesce(price_raw, '')) <> '' AS raw, price_hint IS NOT NULL AS hint, category = 'large' OR contains(category, 'economy') AS com,
  website IS NOT NULL AND NOT contains(website, 'google.com') AS site, contains(name, 'ring') AS mn, contains(lower(description), 'brand#1') AS md FROM {views.sql("part", _cand)} c LEFT JOIN f USING (place_id)),
b AS (SELECT *, {_np} AS np, {_fr} AS fr FROM a),
d AS (SELECT *, NOT (raw OR hint OR pf OR mn OR md OR site) AND (com OR category IN ('small', 'medium')) AS only_cat, CASE WHEN raw OR hint THEN 5 ELSE 0 END + CASE WHEN com THEN 4 ELSE 0 END + CASE WHEN pf THEN 3 ELSE 0 END + CASE WHEN site THEN 3 ELSE 0 END + CASE WHEN mn THEN 2 ELSE 0 END
  + CASE WHEN md THEN 2 ELSE 0 END - CASE WHEN np IS NOT NULL THEN 5 ELSE 0 END - CASE WHEN fr IS NOT NULL THEN 4 ELSE 0 END - CASE WHEN NOT mapped THEN 2 ELSE 0 END AS s FROM b),
e AS (SELECT *, CASE WHEN NOT in_scope THEN 0 WHEN only_cat THEN least(s, 1) ELSE s END AS score FROM d),
r AS (SELECT *, CASE WHEN NOT in_scope AND original_priority = 'not_applicable' THEN 'original_not_applicable' WHEN NOT in_scope THEN 'out_of_scope' WHEN operational_status = 'permanently_closed' THEN 'permanently_closed' WHEN operational_status = 'temporarily_closed' THEN 'temporarily_closed'
  WHEN np IS NOT NULL THEN 'non_attraction_filter' WHEN fr IS NOT NULL THEN 'public_free_space' WHEN NOT mapped THEN 'unmapped_metadata' WHEN only_cat THEN 'weak_category_evidence' WHEN score >= 3 THEN 'strong_paid_evidence' ELSE 'insufficient_evidence' END AS rule FROM e),
g AS (SELECT *, CASE rule WHEN 'original_not_applicable' THEN 'not_applicable' WHEN 'out_of_scope' THEN NULL WHEN 'permanently_closed' THEN 'not_applicable' WHEN 'non_attraction_filter' THEN 'excluded_non_attraction' WHEN 'public_free_space' THEN 'excluded_free'
  WHEN 'strong_paid_evidence' THEN 'research' ELSE 'manual_review' END AS decision, CASE WHEN NOT in_scope THEN '' WHEN only_cat THEN 'primary_category' ELSE array_to_string(list_sort(list_filter([CASE WHEN raw THEN 'existing_price_raw_value' END, CASE WHEN NOT raw AND hint THEN 'existing_price_hint' END, CASE WHEN com THEN 'primary_category' END,
  CASE WHEN pf THEN 'facilities' END, CASE WHEN site THEN 'website' END, CASE WHEN mn THEN 'name' END, CASE WHEN md THEN 'description' END, CASE WHEN np IS NOT NULL THEN 'name_non_attraction' END, CASE WHEN fr IS NOT NULL THEN 'name_public_free' END, CASE WHEN NOT mapped THEN 'metadata_availability' END], lambda x: x IS NOT NULL)), ', ') END AS fields FROM r)"""


@query("prc02_score_candidates", _scored_sql + """
SELECT place_id, score AS paid_evidence_score, CASE WHEN in_scope AND fr IS NOT NULL THEN 4 ELSE 0 END AS free_evidence_score, CASE WHEN in_scope AND np IS NOT NULL THEN 5 ELSE 0 END AS non_attraction_score, decision AS final_decision, rule AS decision_rule,
  CASE WHEN rule IN ('permanently_closed', 'temporarily_closed', 'non_attraction_filter', 'public_free_space') THEN 'strong' WHEN rule = 'strong_paid_evidence' THEN CASE WHEN score >= 5 THEN 'strong' ELSE 'moderate' END ELSE 'weak' END AS evidence_strength,
  CASE WHEN NOT in_scope THEN CASE WHEN original_priority = 'not_applicable' THEN 'not_applicable' ELSE 'low' END WHEN decision = 'research' THEN original_priority WHEN decision = 'not_applicable' THEN 'not_applicable' ELSE 'low' END AS final_research_priority,
  fields AS evidence_fields, coalesce(decision = 'manual_review', false) OR (NOT in_scope AND operational_status <> 'open') AS requires_manual_review FROM g""")
def _(t):
    return _scored(t).select("place_id", "paid_evidence_score", "free_evidence_score", "non_attraction_score", "final_decision", "decision_rule", "evidence_strength", "final_research_priority", "evidence_fields", "requires_manual_review")


@query("prc03_decision_provenance", _scored_sql + """
SELECT place_id, 'final_decision' AS field_name, decision AS field_value, rule AS decision_rule, fields AS evidence_fields, 'v1' AS validation_version FROM g WHERE in_scope""")
def _(t):
    return prc.decision_provenance(_scored(t), "v1")


@query("prc04_decision_changes", """
WITH n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 40 = 3 THEN 'X' ELSE o_orderstatus END AS s FROM orders WHERE o_totalprice < 450000), p AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_totalprice > 20000)
SELECT coalesce(p.k, n.k) AS place_id, p.s AS previous_decision, n.s AS new_decision, CASE WHEN p.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' ELSE 'changed' END AS change_type FROM p FULL JOIN n ON p.k = n.k WHERE p.k IS NULL OR n.k IS NULL OR p.s <> n.s""")
def _(t):
    o = t.orders.select(C("o_orderkey").alias("place_id"), C("o_orderstatus").alias("final_decision"), "o_totalprice")
    new = o.filter("o_totalprice < 450000").withColumn("final_decision", F.when(C("place_id") % 40 == 3, "X").otherwise(C("final_decision")))
    return prc.decision_changes(o.filter("o_totalprice > 20000"), new)


@query("prc05_extract_observations", """
WITH r AS (SELECT item_id AS rule_id, 'src' || item_id % 20 AS place_id, lower(list_extract(string_split(text, ' '), 3)) AS phrase FROM benchmark), p AS (SELECT source AS place_id, lower(arg_min(text, doc_id)) AS t FROM documents GROUP BY 1),
h AS (SELECT rule_id, r.place_id, bool_or(contains(p.t, phrase)) AS in_text, (SELECT min(doc_id) FROM documents d WHERE d.source = r.place_id AND contains(lower(d.text), phrase)) AS hit FROM r JOIN p USING (place_id) GROUP BY rule_id, r.place_id, phrase)
SELECT rule_id, place_id, CASE WHEN in_text THEN 'description' ELSE 'review' END AS found_in, CASE WHEN NOT in_text THEN hit END AS review_id FROM h WHERE in_text OR hit IS NOT NULL""")
def _(t):
    rules = t.benchmark.select(C("item_id").alias("rule_id"), F.concat(F.lit("src"), C("item_id") % 20).alias("place_id"), F.get(F.split("text", " "), F.lit(2)).alias("phrase"), F.lit("entry").alias("price_type"), F.lit(1.0).alias("amount"))
    places = t.documents.groupBy(C("source").alias("place_id")).agg(F.min_by("text", "doc_id").alias("description"))
    reviews = t.documents.select(C("source").alias("place_id"), C("doc_id").alias("review_id"), "text")
    return prc.extract_observations(places, reviews, rules).select("rule_id", "place_id", "found_in", "review_id")


def _conflict_sql(key):
    ks = ", ".join(key)
    on = " AND ".join(f"a.{k} = b.{k}" for k in key)
    return f"""
WITH o AS (SELECT * FROM {PRI}), p AS (SELECT {', '.join('a.' + k for k in key)}, a.amount, count(*) AS pairs FROM o a JOIN o b ON {on} AND a.amount <> b.amount GROUP BY {', '.join('a.' + k for k in key)}, a.amount),
g AS (SELECT {ks}, amount, count(*) AS observations, min(obs_id) AS first_observation FROM o GROUP BY {ks}, amount), m AS (SELECT {ks}, max(amount) AS mx, count(*) AS c FROM g GROUP BY {ks})
SELECT {', '.join('g.' + k for k in key)}, g.amount, observations, first_observation, m.c AS distinct_amounts, m.mx AS selected_amount, g.amount = m.mx AS is_selected, p.pairs AS conflicting_pairs
FROM p JOIN g ON {' AND '.join(f'p.{k} = g.{k}' for k in key)} AND p.amount = g.amount JOIN m ON {' AND '.join(f'p.{k} = m.{k}' for k in key)}"""


_k6 = ["place_id", "price_type", "unit", "day_type", "audience"]
_k7 = ["place_id", "price_type", "day_type", "audience", "vehicle"]


@query("prc06_conflicts", _conflict_sql(_k6))
def _(t):
    return prc.price_conflicts(views.prices(t), _k6)


@query("prc07_external_conflicts", _conflict_sql(_k7))
def _(t):
    return prc.price_conflicts(views.prices(t), _k7)


@query("prc08_final_prices", f"""
SELECT place_id, price_type, audience, day_type, unit, obs_id, amount FROM (SELECT *, row_number() OVER (PARTITION BY place_id, price_type, audience, day_type, unit ORDER BY CASE WHEN price_type = 'entry' THEN -amount END NULLS LAST, obs_id, amount) AS rn FROM {PRI}) WHERE rn = 1""")
def _(t):
    key = ["place_id", "price_type", "audience", "day_type", "unit"]
    return prc.select_final(views.prices(t), key, "entry").select(*key, "obs_id", "amount")


_obs9 = "(SELECT o_custkey AS place_id, CASE o_orderstatus WHEN 'F' THEN 'entry' WHEN 'O' THEN 'parking' ELSE 'activity' END AS price_type FROM orders)"


@query("prc09_research_status", f"""
SELECT c_custkey AS place_id, coalesce(n, 0) AS observations_found, coalesce(e, false) AS has_entry_price, coalesce(p, false) AS has_parking_price, CASE WHEN n > 0 THEN 'completed_with_price' ELSE 'completed_no_current_price' END AS research_status,
  CASE WHEN n > 0 THEN 0.9::DOUBLE ELSE 0.0::DOUBLE END AS research_confidence, n IS NULL AS unresolved FROM customer LEFT JOIN (SELECT place_id, count(*) AS n, bool_or(price_type = 'entry') AS e, bool_or(price_type = 'parking') AS p FROM {_obs9} GROUP BY 1) ON place_id = c_custkey""")
def _(t):
    obs = t.orders.select(C("o_custkey").alias("place_id"), F.when(C("o_orderstatus") == "F", "entry").when(C("o_orderstatus") == "O", "parking").otherwise("activity").alias("price_type"))
    return prc.research_status(t.customer.select(C("c_custkey").alias("place_id")), obs, ["entry", "parking"])


_num = "concat(p_name, ' rating 4.5 tahun ', CAST(2020 + p_size % 8 AS varchar(9)), ' rp ', CAST(p_partkey AS varchar(9)), '.000 telp 0812777', CAST(1000 + p_size AS varchar(9)), ' x9y')"


@query("prc10_number_contexts", f"""
SELECT p_partkey, raw, CAST(raw AS double) AS value, CASE WHEN CAST(raw AS double) IN (4.5, 4.8) THEN 'rating' WHEN CAST(raw AS double) IN (2024, 2025, 2026) THEN 'year' WHEN CAST(raw AS double) > 1000000000 THEN 'phone_number' ELSE 'none' END AS false_positive_type
FROM (SELECT p_partkey, unnest(regexp_extract_all({_num}, '\\b[0-9]+(?:\\.[0-9]+)?\\b')) AS raw FROM part)""")
def _(t):
    return prc.number_contexts(t.part, "p_partkey", F.expr(_num))


@query("prc11_temporal_quality", """
SELECT doc_id, CASE WHEN contains(x, '2026') THEN 'unknown' WHEN contains(x, '2024') OR contains(x, '2025') THEN 'recent' ELSE 'historical' END AS quality, CASE WHEN contains(x, '2026') THEN 'unknown_date' WHEN contains(x, '2024') OR contains(x, '2025') THEN 'recent_unverified' ELSE 'historical' END AS status,
  CASE WHEN contains(x, '2026') THEN 0.3::DOUBLE WHEN contains(x, '2024') OR contains(x, '2025') THEN 0.9::DOUBLE ELSE 0.5::DOUBLE END AS confidence FROM (SELECT doc_id, text || ' ' || CAST(2020 + doc_id % 9 AS varchar) AS x FROM documents)""")
def _(t):
    x = F.concat("text", F.lit(" "), (C("doc_id") % 9 + 2020).cast("string"))
    return t.documents.select("doc_id", money.temporal_quality(x, ["2026"], ["2024", "2025"]).alias("q")).select("doc_id", "q.*")


@query("prc12_price_status", f"""
SELECT obs_id, CASE WHEN NOT accepted THEN 'rejected' WHEN verification = 'recent_unverified' THEN 'provisional_recent' WHEN verification = 'historical' THEN 'historical_reference' ELSE 'unresolved' END AS price_data_status FROM {PRI}""")
def _(t):
    return views.prices(t).select("obs_id", money.price_data_status(~C("accepted"), C("verification")).alias("price_data_status"))


@query("prc13_verification_queue", f"""
WITH p AS (SELECT o_custkey AS place_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'rejected' WHEN o_totalprice > 400000 THEN 'provisional_recent' WHEN o_orderstatus = 'F' THEN 'historical_reference' ELSE 'unresolved' END AS s FROM orders),
a AS (SELECT place_id, count(*) AS n, count(*) FILTER (s <> 'rejected') AS u, bool_or(s = 'provisional_recent') AS r, bool_or(s = 'historical_reference') AS h FROM p GROUP BY 1)
SELECT c_custkey AS place_id, coalesce(n, 0) AS observation_count, coalesce(u, 0) AS usable_price_count, CASE WHEN n IS NULL THEN 'low' WHEN r THEN 'high' ELSE 'medium' END AS verification_priority, CASE WHEN n IS NULL THEN 1 WHEN r THEN 2 WHEN h THEN 3 ELSE 4 END AS reason_no FROM customer LEFT JOIN a ON place_id = c_custkey""")
def _(t):
    s = F.when(C("o_orderpriority") == "1-URGENT", "rejected").when(C("o_totalprice") > 400000, "provisional_recent").when(C("o_orderstatus") == "F", "historical_reference").otherwise("unresolved")
    p = t.orders.select(C("o_custkey").alias("place_id"), s.alias("price_data_status"))
    q = prc.verification_queue(t.customer.select(C("c_custkey").alias("place_id")), p)
    no = F.when(C("reason").startswith("No local"), 1).when(C("reason").startswith("Provisional"), 2).when(C("reason").startswith("Only"), 3).otherwise(4)
    return q.withColumn("reason_no", no).drop("reason")


_claim = [("claim_id", "page_id"), ("url", "CASE WHEN page_id % 10 = 9 THEN 'https://gone.example' ELSE url END"),
          ("excerpt", "CASE page_id % 4 WHEN 0 THEN substr(html, 30, 60) WHEN 1 THEN 'price 1.234.567 here' WHEN 2 THEN 'CHARSET=\"utf-8\"' ELSE concat(substr(html, 1, 20), ' 7') END"),
          ("name", "CASE WHEN page_id % 3 = 0 THEN 'no such place' ELSE 'HTML' END")]


@query("prc14_check_sources", f"""
WITH u AS (SELECT url, arg_min(html, page_id) AS html FROM pages GROUP BY 1), s AS (SELECT c.*, u.html, trim(regexp_replace(coalesce(u.html, ''), '\\s+', ' ', 'g')) AS b, trim(regexp_replace(excerpt, '\\s+', ' ', 'g')) AS x, regexp_extract_all(replace(excerpt, '.', ''), '\\b[0-9]+\\b') AS nums FROM {views.sql("pages", _claim)} c LEFT JOIN u USING (url)),
f AS (SELECT claim_id, url, html IS NOT NULL AS retrieved, contains(lower(b), lower(x)) AS excerpt_found, len(list_filter(nums, lambda n: NOT contains(b, n))) = 0 AS price_text_found, contains(lower(b), lower(name)) AS identity_found FROM s)
SELECT *, concat_ws(', ', CASE WHEN NOT excerpt_found THEN 'excerpt not found' END, CASE WHEN NOT price_text_found THEN 'price text not found' END, CASE WHEN NOT identity_found THEN 'identity text not found' END) AS failed_checks,
  CASE WHEN retrieved AND excerpt_found AND price_text_found AND identity_found THEN 'passed' ELSE 'failed' END AS audit_status FROM f""")
def _(t):
    pages = t.pages.groupBy("url").agg(F.min_by("html", "page_id").alias("body"))
    return prc.check_sources(views.columns(t.pages, _claim), pages)


_ext = [("ext_id", "o_orderkey"), ("place_id", "o_custkey % 60"), ("price_type", "CASE o_orderstatus WHEN 'F' THEN 'entry' WHEN 'O' THEN 'parking' ELSE 'other' END"), ("day_type", "CASE o_orderkey % 3 WHEN 0 THEN 'weekday' WHEN 1 THEN 'weekend' ELSE 'all_days' END"),
        ("audience", "CASE o_orderkey % 2 WHEN 0 THEN 'adult' ELSE 'child' END"), ("amount", "CAST(floor(o_totalprice / 50000) * 50000 AS double)")]
_loc = [("place_id", "l_suppkey % 70"), ("price_type", "CASE l_returnflag WHEN 'A' THEN 'entry' ELSE 'parking' END"), ("day_type", "CASE l_linenumber % 3 WHEN 0 THEN 'weekday' WHEN 1 THEN 'weekend' ELSE 'holiday' END"),
        ("audience", "CASE WHEN l_suppkey % 70 < 15 THEN 'senior' WHEN l_linestatus = 'O' THEN 'adult' ELSE 'child' END"), ("amount", "CASE WHEN l_suppkey % 70 < 40 THEN 50000.0 ELSE 100000.0 END"),
        ("verification", "CASE WHEN l_suppkey % 3 = 0 THEN 'historical' WHEN l_suppkey % 3 = 1 THEN 'recent_unverified' WHEN l_quantity > 25 THEN 'historical' ELSE 'recent_unverified' END")]
_cmp_sql = f"""
WITH e AS {views.sql("orders", _ext)}, l AS (SELECT place_id, price_type, day_type, audience, CAST(amount AS double) AS amount, verification, count(*) AS n FROM {views.sql("lineitem", _loc)} GROUP BY ALL),
j AS (SELECT e.*, l.amount AS la, l.verification AS lv, l.n FROM e JOIN l USING (place_id, price_type) WHERE (l.day_type = e.day_type OR l.day_type = 'all_days' OR e.day_type = 'all_days') AND (l.audience = e.audience OR l.audience = 'general' OR e.audience = 'general')),
r AS (SELECT ext_id, place_id, price_type, CAST(sum(n) AS bigint) AS n_compatible, CAST(coalesce(sum(n) FILTER (la = amount), 0) AS bigint) AS n_match, min(la) AS local_low, max(la) AS local_high, max(abs(amount - la)) AS largest_difference, round(any_value(abs(amount - la)) FILTER (true), 4) AS x,
  any_value(amount) AS amount, bool_and(lv = 'historical') AS old, bool_and(lv <> 'historical') AS cur FROM j GROUP BY 1, 2, 3)
SELECT ext_id, place_id, price_type, n_compatible, n_match, local_low, local_high, largest_difference, round(abs(amount - local_low) * 100 / local_low, 4) AS difference_percent,
  CASE WHEN n_match = n_compatible THEN 'match' WHEN old THEN 'historical_difference' WHEN cur THEN 'different_current_price' ELSE 'mixed_difference' END AS comparison_status FROM r
UNION ALL SELECT ext_id, place_id, price_type, NULL, NULL, NULL, NULL, NULL, NULL, 'external_only' FROM e WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.place_id = e.place_id AND l.price_type = e.price_type)"""


def _compare(t):
    local = views.columns(t.lineitem, _loc).withColumn("amount", C("amount").cast("double"))
    return prc.compare_with_local(views.columns(t.orders, _ext), local)


@query("jn08_compatible_join", f"SELECT ext_id, n_compatible, n_match, comparison_status FROM ({_cmp_sql})")
def _(t):
    return _compare(t).select("ext_id", "n_compatible", "n_match", "comparison_status")


@query("prc15_compare_prices", _cmp_sql)
def _(t):
    return _compare(t)


_ver = [("ext_id", "o_orderkey"), ("place_id", "o_custkey % 120"), ("price_type", "CASE o_orderstatus WHEN 'F' THEN 'entry' ELSE 'parking' END"), ("identity_status", "CASE WHEN o_orderkey % 4 = 0 THEN 'probable' ELSE 'verified' END"),
        ("temporal_status", "CASE o_orderkey % 5 WHEN 0 THEN 'verified_current' WHEN 1 THEN 'official_live_unbounded' ELSE 'old' END")]
_ver_sql = f"""SELECT e.ext_id, e.place_id, e.price_type, coalesce(n, 0) AS supporting_local_count, f AS first_local_observation, CASE WHEN temporal_status IN ('verified_current', 'official_live_unbounded') THEN temporal_status ELSE 'externally_supported_recent' END AS price_data_status,
  CASE WHEN temporal_status = 'verified_current' THEN 0.9::DOUBLE ELSE 0.8::DOUBLE END AS confidence FROM {views.sql("orders", _ver)} e LEFT JOIN (SELECT place_id, price_type, count(*) AS n, min(obs_id) AS f FROM {PRI} GROUP BY 1, 2) l USING (place_id, price_type) WHERE identity_status = 'verified'"""


def _verified(t):
    return prc.verified_prices(views.columns(t.orders, _ver), views.prices(t))


@query("prc16_verified_prices", _ver_sql)
def _(t):
    return _verified(t).select("ext_id", "place_id", "price_type", "supporting_local_count", "first_local_observation", "price_data_status", "confidence")


@query("prc17_verification_coverage", f"""
WITH q AS (SELECT c_custkey AS place_id FROM customer), s AS (SELECT user_id AS place_id, count(*) AS a, count(*) FILTER (event_type = 'click') AS b, count(*) FILTER (event_type IN ('view', 'signup')) AS c, count(*) FILTER (event_type = 'error') AS d FROM events GROUP BY 1),
o AS (SELECT place_id, count(*) AS e FROM {views.sql("orders", _ver)} GROUP BY 1), v AS (SELECT place_id, count(*) FILTER (price_data_status = 'verified_current') AS f, count(*) FILTER (price_data_status = 'official_live_unbounded') AS g, count(*) FILTER (price_data_status = 'externally_supported_recent') AS h FROM ({_ver_sql}) GROUP BY 1),
k AS (SELECT place_id, count(*) AS i FROM {PRI} GROUP BY 1),
r AS (SELECT q.place_id, coalesce(a, 0) AS sources_checked, coalesce(b, 0) AS accepted_sources, coalesce(c, 0) AS official_sources, coalesce(d, 0) AS government_sources, coalesce(e, 0) AS external_observations, coalesce(f, 0) AS verified_current_prices, coalesce(g, 0) AS official_live_unbounded_prices, coalesce(h, 0) AS provisional_external_prices, coalesce(i, 0) AS conflicts
  FROM q LEFT JOIN s USING (place_id) LEFT JOIN o USING (place_id) LEFT JOIN v USING (place_id) LEFT JOIN k USING (place_id)),
z AS (SELECT *, CASE WHEN external_observations = 0 THEN 'completed_no_price' WHEN verified_current_prices > 0 THEN 'completed_verified' WHEN official_live_unbounded_prices > 0 THEN 'completed_official_unbounded' ELSE 'completed_provisional' END AS verification_status FROM r)
SELECT *, CASE WHEN verification_status IN ('completed_verified', 'completed_official_unbounded') THEN 0.9::DOUBLE WHEN verification_status = 'completed_provisional' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS research_confidence FROM z
UNION ALL SELECT p_partkey, 1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'completed_verified', NULL FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)""")
def _(t):
    q = t.customer.select(C("c_custkey").alias("place_id"))
    kind = F.when(C("event_type") == "view", "official_website").when(C("event_type") == "signup", "official_social_media").when(C("event_type") == "error", "government").otherwise("blog")
    src = t.events.select(C("user_id").alias("place_id"), kind.alias("source_type"), F.when(C("event_type") == "click", "accepted").otherwise("no").alias("research_status"))
    prev = t.part.select(C("p_partkey").alias("place_id"), F.lit(1).cast("bigint").alias("sources_checked"), F.lit("completed_verified").alias("verification_status"))
    return prc.verification_coverage(q, src, views.columns(t.orders, _ver), _verified(t), views.prices(t), prev)


@query("prc18_input_audit", f"""
WITH c AS {views.sql("part", _cand)}
SELECT 'original_priority_allowed' AS expectation, count(*) FILTER (original_priority NOT IN ('high', 'medium')) AS violations, count(*) FILTER (original_priority NOT IN ('high', 'medium')) = 0 AS passed FROM c
UNION ALL SELECT 'is_closed_allowed', count(*) FILTER (operational_status = 'permanently_closed'), count(*) FILTER (operational_status = 'permanently_closed') = 0 FROM c
UNION ALL SELECT 'place_id_unique', count(*) - count(DISTINCT place_id), count(*) = count(DISTINCT place_id) FROM c
UNION ALL SELECT 'place_id_subset', count(*) FILTER (place_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)), count(*) FILTER (place_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)) = 0 FROM c""")
def _(t):
    pop = t.lineitem.filter("l_quantity > 49").select(C("l_partkey").alias("place_id")).distinct()
    return prc.input_audit(views.columns(t.part, _cand), pop, ["high", "medium"])


@query("prc19_run_manifest", f"""
SELECT place_id, 'observations' AS kind, count(*) AS n, min(obs_id) AS first_id, max(obs_id) AS last_id FROM {PRI} GROUP BY 1 UNION ALL SELECT place_id, 'external', count(*), min(ext_id), max(ext_id) FROM {views.sql("orders", _ver)} GROUP BY 1""")
def _(t):
    return prc.run_manifest({"observations": views.prices(t).select("place_id", C("obs_id").alias("id")), "external": views.columns(t.orders, _ver).select("place_id", C("ext_id").alias("id"))}).drop("fingerprint")
