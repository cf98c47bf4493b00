"""Feature and recommendation queries (FEA, REC, EVA)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import features as fea, recommend as rec
from waymark.plans import views
from waymark.plans.matching import dist_sql
from waymark.plans.registry import query

C = F.col
CAT = views.CATALOG_SQL
CATS = ["economy", "large", "medium", "promo", "small"]
REGS = [f"Brand#{i}" for i in range(1, 21)]
FACS = views.CATALOG_FACILITIES
PEN = "((100.0 - completeness) * 0.001 + warnings * 0.02 + CASE status WHEN 'unknown' THEN 0.1 WHEN 'permanently_closed' THEN 1.0 ELSE 0.0 END)"

# Requests from the customer table: segment to category, nation to region, key bits to facilities.
REQ = [("request_id", "c_custkey"),
       ("category", "CASE c_mktsegment WHEN 'BUILDING' THEN 'economy' WHEN 'MACHINERY' THEN 'promo' WHEN 'FURNITURE' THEN 'small' WHEN 'HOUSEHOLD' THEN 'standard' ELSE 'large' END"),
       ("region", "concat('Brand#', CAST(c_nationkey + 1 AS varchar(9)))"), ("f1", "(c_custkey % 2 = 1)"), ("f2", "(c_custkey % 4 >= 2)"), ("f3", "(c_custkey % 8 >= 4)"), ("f4", "(c_custkey % 16 >= 8)"),
       *[("user_" + n, e) for n, e in views._point("0.0009")]]


def _facs(flags):
    return F.filter(F.array(*[F.when(C(c), F.lit(f)) for c, f in zip(flags, FACS)]), lambda x: x.isNotNull())


def items(t):
    c = views.catalog(t)
    p = (C("item_id") - C("item_id") % 5)
    c = c.withColumns({
        "facilities": _facs(FACS), "penalty": fea.quality_penalty(C("completeness"), C("warnings"), C("status")), "eligible": C("status") != "permanently_closed",
        "lat": F.lit(-6.5) + ((p * 7919) % 30000).cast("double") / 10000.0, "lon": F.lit(103.0) + ((p * 104729) % 35000).cast("double") / 10000.0})
    return rec.with_signature(c, CATS, REGS, FACS)


def requests(t):
    r = views.columns(t.customer, REQ).withColumn("facilities", _facs(["f1", "f2", "f3", "f4"]))
    return rec.with_signature(r, CATS, REGS, FACS)


_in = lambda xs: "(" + ", ".join(f"'{x}'" for x in xs) + ")"
BASE_SQL = f"""
WITH i AS MATERIALIZED (SELECT item_id, CASE WHEN category IN {_in(CATS)} THEN category END AS cat, CASE WHEN region IN {_in(REGS)} THEN region END AS reg, CAST(has_parking AS int) AS a1, CAST(has_toilet AS int) AS a2, CAST(has_food AS int) AS a3, CAST(has_guide AS int) AS a4, status <> 'permanently_closed' AS eligible,
  completeness, {PEN}::DOUBLE AS penalty, name, price, rating, review_count, status, -6.5::DOUBLE + CAST(((item_id - item_id % 5) * 7919) % 30000 AS double) / 10000.0::DOUBLE AS lat, 103.0::DOUBLE + CAST(((item_id - item_id % 5) * 104729) % 35000 AS double) / 10000.0::DOUBLE AS lon FROM {CAT}),
q AS MATERIALIZED (SELECT request_id, CASE WHEN category IN {_in(CATS)} THEN category END AS cat, CASE WHEN region IN {_in(REGS)} THEN region END AS reg, CAST(f1 AS int) AS b1, CAST(f2 AS int) AS b2, CAST(f3 AS int) AS b3, CAST(f4 AS int) AS b4, user_lat AS lat, user_lon AS lon FROM {views.sql("customer", REQ)}),
p AS (SELECT request_id, item_id, eligible, penalty, completeness, q.cat AS q_cat, i.cat AS cat, CAST(coalesce(q.cat = i.cat, false) AS int)::DOUBLE AS sc, CAST(coalesce(q.reg = i.reg, false) AS int)::DOUBLE AS sr, (a1 * b1 + a2 * b2 + a3 * b3 + a4 * b4)::DOUBLE AS inter, (a1 + a2 + a3 + a4)::DOUBLE AS na, (b1 + b2 + b3 + b4)::DOUBLE AS nb,
  (CAST(q.cat IS NOT NULL AS int) + CAST(q.reg IS NOT NULL AS int))::DOUBLE AS qw, (CAST(i.cat IS NOT NULL AS int) + CAST(i.reg IS NOT NULL AS int))::DOUBLE AS iw, q.lat AS qlat, q.lon AS qlon, i.lat AS ilat, i.lon AS ilon, status FROM q CROSS JOIN i),
j AS (SELECT *, CASE WHEN na + nb - inter > 0 THEN inter / (na + nb - inter) ELSE 0.0::DOUBLE END AS jac FROM p)"""


def ranked_sql(score: str, extra: str = "", keep: str = "", k: int = 10) -> str:
    return f"""{BASE_SQL}, s AS (SELECT *, round(CASE WHEN eligible THEN {score} ELSE -1.0::DOUBLE END, 8) AS score FROM j {keep}),
r AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, item_id) AS rank FROM s)
SELECT request_id, item_id, rank, score{extra} FROM r WHERE rank <= {k}"""


COSINE = "CASE WHEN (qw + nb) * (iw + na) > 0 THEN (sc + sr + inter) / sqrt((qw + nb) * (iw + na)) ELSE 0.0::DOUBLE END"
WEIGHTED = "sc * 0.5::DOUBLE + sr * 0.3::DOUBLE + jac * 0.2::DOUBLE"
HYBRID = "sc * 0.4::DOUBLE + sr * 0.25::DOUBLE + jac * 0.15::DOUBLE + round(0.1::DOUBLE + (completeness / 100.0::DOUBLE - penalty) * 0.1::DOUBLE, 8)"
KM = "(2 * 6371.0 * asin(sqrt(pow(sin(radians(ilat - qlat) / 2), 2) + cos(radians(qlat)) * cos(radians(ilat)) * pow(sin(radians(ilon - qlon) / 2), 2))))"
NEAR = ("sc * 0.4::DOUBLE + sr * 0.25::DOUBLE + jac * 0.15::DOUBLE + round((completeness / 100.0::DOUBLE - penalty) * 0.1::DOUBLE, 8)"
        f" + exp(-0.015::DOUBLE * greatest(0.0::DOUBLE, {KM} - 5.0::DOUBLE)) * 0.1::DOUBLE")


def _out(df):
    return df.select("request_id", "item_id", "rank", "score")


@query("fea01_one_hot", """
SELECT p_partkey, CAST(lower(p_type) = 'promo' AS float) AS feat_cat_promo, CAST(lower(p_type) = 'small' AS float) AS feat_cat_small, CAST(lower(p_type) IN ('promo', 'small') AS int)::DOUBLE AS ones FROM part""")
def _(t):
    v = fea.one_hot(F.lower("p_type"), ["promo", "small"])
    return t.part.select("p_partkey", v.alias("v")).select("p_partkey", *fea.flat_columns(C("v"), ["promo", "small"], "feat_cat_"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).alias("ones"))


@query("fea02_label_flags", """
SELECT l_partkey, bool_or(l_returnflag = 'A') AS has_guide, bool_or(l_returnflag IN ('N', 'R')) AS has_wifi FROM lineitem GROUP BY 1""")
def _(t):
    label = F.when(C("l_returnflag") == "A", "Pemandu Wisata").when(C("l_returnflag") == "N", "WIFI").otherwise("Internet cafe")
    return fea.label_flags(t.lineitem.select("l_partkey", label.alias("label")), "l_partkey", "label", {"has_guide": ["guide", "pemandu"], "has_wifi": ["wifi", "internet"]})


@query("fea03_eligibility", f"""
SELECT item_id, status <> 'permanently_closed' AND item_id % 9 <> 0 AS eligible, CASE WHEN item_id % 3 = 0 THEN rating / 5.0 END AS rating_normalized, CASE WHEN status IN ('open', 'unknown') THEN status ELSE 'unavailable' END AS price_status FROM {CAT}""")
def _(t):
    lat = F.when(C("item_id") % 9 != 0, 1.0)
    return views.catalog(t).select("item_id", fea.eligible(C("status"), lat, F.lit(2.0)).alias("eligible"),
                                   fea.normalized_rating(F.when(C("item_id") % 3 == 0, "scraped").otherwise("no"), C("rating")).alias("rating_normalized"), fea.price_status(C("status"), ["open", "unknown"]).alias("price_status"))


@query("fea04_penalty", f"SELECT item_id, round({PEN}, 6)::DOUBLE AS penalty FROM {CAT}")
def _(t):
    return views.catalog(t).select("item_id", F.round(fea.quality_penalty(C("completeness"), C("warnings"), C("status")), 6).alias("penalty"))


@query("fea05_feature_table")
def _(t):
    c = views.catalog(t)
    master = c.select(C("item_id").alias("place_id"), "name", C("category").alias("primary_category"), C("region").alias("city_or_regency"), F.lit(-5.0).alias("latitude"), F.lit(105.0).alias("longitude"), C("status").alias("operational_status"),
                      "has_parking", "has_toilet", "has_food", F.lit(False).alias("has_prayer_room"), F.lit(None).cast("boolean").alias("has_wheelchair_access"), F.lit("scraped").alias("review_coverage_status"), C("rating").alias("review_rating_mean"),
                      F.lit("completed_verified").alias("external_verification_status"), C("price").alias("external_price_min"), C("price").alias("external_price_max"), C("completeness").alias("overall_completeness_score"), C("warnings").alias("quality_warning_count"))
    labels = t.lineitem.select(C("l_partkey").alias("place_id"), F.when(C("l_returnflag") == "A", "Pemandu").otherwise("Parkir").alias("raw_label"))
    sent = t.lineitem.groupBy(C("l_partkey").alias("place_id")).agg(F.round(F.avg("l_discount"), 6).alias("sentiment_score_mean"), F.round(F.avg("l_tax"), 6).alias("sentiment_confidence_mean"))
    return fea.build_features(master, labels, sent, CATS, REGS)


@query("rec01_cosine", ranked_sql(COSINE))
def _(t):
    return _out(rec.recommend_cosine(requests(t), items(t)))


@query("rec02_weighted", ranked_sql(WEIGHTED))
def _(t):
    return _out(rec.recommend_weighted(requests(t), items(t)))


_words = "regexp_extract_all(replace(lower({c}), '_', ' '), '[a-z0-9]{{2,}}')"


def _tfidf_sql():
    text = lambda p, f: f"concat_ws(' ', {p}.cat, {p}.reg, CASE WHEN {f}1 = 1 THEN 'parking' END, CASE WHEN {f}2 = 1 THEN 'toilet' END, CASE WHEN {f}3 = 1 THEN 'food' END, CASE WHEN {f}4 = 1 THEN 'guide' END)"
    return f"""{BASE_SQL}, iw1 AS (SELECT item_id, unnest({_words.format(c=text('i', 'a'))}) AS w FROM i), iw AS (SELECT item_id, w, count(*) AS tf FROM iw1 GROUP BY 1, 2), qw1 AS (SELECT request_id, unnest({_words.format(c=text('q', 'b'))}) AS w FROM q), qw2 AS (SELECT request_id, w, count(*) AS tf FROM qw1 GROUP BY 1, 2),
idf AS (SELECT w, ln((1.0 + (SELECT count(*) FROM i)) / (1.0 + count(*))) + 1.0 AS idf FROM iw GROUP BY 1), iv AS (SELECT item_id, w, tf * idf AS v FROM iw JOIN idf USING (w)), qv AS (SELECT request_id, w, tf * idf AS v FROM qw2 JOIN idf USING (w)),
il AS (SELECT item_id, sqrt(sum(v * v)) AS l FROM iv GROUP BY 1), ql AS (SELECT request_id, sqrt(sum(v * v)) AS l FROM qv GROUP BY 1), d AS (SELECT request_id, item_id, sum(iv.v * qv.v) AS dot FROM qv JOIN iv USING (w) GROUP BY 1, 2),
c AS (SELECT request_id, item_id, round(dot / (il.l * ql.l), 8) AS sim FROM d JOIN il USING (item_id) JOIN ql USING (request_id)),
s AS (SELECT j.request_id, j.item_id, round(CASE WHEN eligible THEN coalesce(sim, 0.0) + round(penalty * -0.5::DOUBLE, 8) ELSE -1.0 END, 8) AS score FROM j LEFT JOIN c ON c.request_id = j.request_id AND c.item_id = j.item_id),
r AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, item_id) AS rank FROM s) SELECT request_id, item_id, rank, score FROM r WHERE rank <= 10"""


@query("rec03_tfidf", _tfidf_sql())
def _(t):
    return _out(rec.recommend_tfidf(requests(t), items(t)))


_reasons = ("list_filter([CASE WHEN sc >= 0.8 THEN 'category_match' END, CASE WHEN sr = 1 THEN 'region_match' END, CASE WHEN jac >= 0.5 THEN 'facility_match' END, 'nearby_location', CASE WHEN status = 'open' THEN 'verified_open' END], lambda x: x IS NOT NULL)")


@query("rec04_hybrid", ranked_sql(HYBRID, f", array_to_string({_reasons}, ',') AS reasons"))
def _(t):
    r, i = requests(t), items(t)
    parts = rec.breakdown(rec.recommend_hybrid(r, i), r, i)
    codes = rec.reason_codes(C("sim_category"), C("sim_region"), C("sim_facility"), F.lit(1.0), F.lit(None).cast("double"), C("status"))
    return parts.select("request_id", "item_id", "rank", "score", F.array_join(codes, ",").alias("reasons"))


@query("rec04_hybrid_near", ranked_sql(NEAR))
def _(t):
    return _out(rec.recommend_hybrid_near(requests(t), items(t)))


@query("rec05_ineligible_last", f"""{BASE_SQL}, s AS (SELECT request_id, item_id, eligible, round(CASE WHEN eligible THEN {WEIGHTED} ELSE -1.0::DOUBLE END, 8) AS score FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, item_id) AS rank FROM s) SELECT request_id, count(*) FILTER (score = -1) AS n_ineligible, min(rank) FILTER (score = -1) AS first_ineligible FROM r WHERE rank <= 90 GROUP BY 1""")
def _(t):
    ranked = rec.recommend_weighted(requests(t), items(t), 90)
    return ranked.groupBy("request_id").agg(F.count_if(C("score") == -1).alias("n_ineligible"), F.min(F.when(C("score") == -1, C("rank"))).alias("first_ineligible"))


@query("rec06_top_k", ranked_sql(HYBRID, k=3))
def _(t):
    return _out(rec.recommend_hybrid(requests(t), items(t), 3))


@query("rec07_response_rows", f"""SELECT r.request_id, r.item_id, r.rank, name, round(coalesce(CASE WHEN i.item_id % 4 <> 0 THEN rating END, 4.7), 1) AS rating, review_count FROM ({ranked_sql(HYBRID)}) r JOIN {CAT} i USING (item_id) WHERE price <= 1000""")
def _(t):
    r, i = requests(t), items(t)
    shown = i.withColumn("rating", F.when(C("item_id") % 4 != 0, C("rating")))
    return rec.response_rows(rec.recommend_hybrid(r, i), shown, F.lit(1000.0)).select("request_id", "item_id", "rank", "name", "rating", "review_count")


@query("rec08_reason_codes", f"""SELECT item_id, concat_ws(',', CASE WHEN completeness / 100 >= 0.8 THEN 'category_match' END, CASE WHEN warnings = 1 THEN 'region_match' END, CASE WHEN confidence >= 0.5 THEN 'facility_match' END, CASE WHEN rating / 5 >= 0.7 THEN 'nearby_location' END, CASE WHEN confidence - 0.5 > 0.3 THEN 'positive_sentiment' END,
  CASE WHEN status = 'open' THEN 'verified_open' END, CASE WHEN NOT (completeness / 100 >= 0.8 OR warnings = 1 OR confidence >= 0.5 OR rating / 5 >= 0.7 OR confidence - 0.5 > 0.3 OR status = 'open') THEN 'general_recommendation' END) AS reasons FROM {CAT}""")
def _(t):
    codes = rec.reason_codes(C("completeness") / 100, C("warnings").cast("double"), C("confidence"), C("rating") / 5, C("confidence") - 0.5, C("status"))
    return views.catalog(t).select("item_id", F.array_join(codes, ",").alias("reasons"))


@query("rec09_request_vectors", f"""{BASE_SQL} SELECT request_id, {', '.join(f"CAST(coalesce(cat = '{c}', false) AS int)::DOUBLE AS c{n}" for n, c in enumerate(CATS))}, (b1 + b2 + b3 + b4)::DOUBLE AS n_facilities FROM q""")
def _(t):
    r = requests(t).withColumns({"cv": fea.one_hot(C("cat"), CATS), "fv": fea.multi_hot(C("facs"), FACS)})
    return r.select("request_id", *[F.get("cv", F.lit(n)).cast("double").alias(f"c{n}") for n in range(len(CATS))], F.aggregate("fv", F.lit(0.0), lambda a, x: a + x).alias("n_facilities"))


def _eval_part(name, score):
    return f"""{name} AS (SELECT request_id, item_id, rank, CAST(coalesce(q_cat = cat, false) AS int) AS rel, q_cat FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY round(CASE WHEN eligible THEN {score} ELSE -1.0::DOUBLE END, 8) DESC, item_id) AS rank FROM j) WHERE rank <= 10),
{name}u AS (SELECT request_id, any_value(q_cat) AS q_cat, sum(rel) AS h, sum(rel / log2(rank + 1)) AS dcg FROM {name} GROUP BY 1),
{name}v AS (SELECT *, CASE WHEN h > 0 THEN dcg / list_sum(list_transform(range(1, CAST(h AS bigint) + 1), lambda r: 1.0 / log2(r + 1))) ELSE 0 END AS ndcg, coalesce(h / (SELECT count(*) FROM i WHERE i.cat = q_cat), 0) AS rc FROM {name}u)"""


_eval_row = "SELECT '{n}' AS algorithm, count(*) AS n_requests, round(avg(h / 10.0), 4) AS precision_at_k, round(avg(ndcg), 4) AS ndcg_at_k, round(avg(CASE WHEN h = 0 THEN 0 ELSE rc END), 6) AS recall_at_k, (SELECT count(DISTINCT item_id) FROM {n}) AS distinct_items, round((SELECT count(DISTINCT item_id) FROM {n}) * 100.0 / (SELECT count(*) FROM i), 2) AS coverage_pct FROM {n}v"


@query("eva01_ranking_quality", f"""{BASE_SQL}, {_eval_part('cosine', COSINE)}, {_eval_part('weighted', WEIGHTED)}, {_eval_part('hybrid', HYBRID)} {' UNION ALL '.join(_eval_row.format(n=n) for n in ('cosine', 'weighted', 'hybrid'))}""")
def _(t):
    r, i = requests(t), items(t)
    runs = {"cosine": rec.recommend_cosine, "weighted": rec.recommend_weighted, "hybrid": rec.recommend_hybrid}
    out = None
    for name, fn in runs.items():
        row = rec.evaluate(fn(r, i), r, i).withColumn("algorithm", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


@query("eva02_diversity", f"""WITH r AS ({ranked_sql(WEIGHTED)}), i AS (SELECT item_id, CASE WHEN category IN {_in(CATS)} THEN category END AS cat, CASE WHEN region IN {_in(REGS)} THEN region END AS reg FROM {CAT}),
u AS (SELECT request_id, count(DISTINCT cat) AS c, count(DISTINCT reg) AS g FROM r JOIN i USING (item_id) GROUP BY 1)
SELECT count(*) AS n_requests, round(avg(c / 10.0), 4)::DOUBLE AS category_diversity, round(avg(g / 10.0), 4)::DOUBLE AS region_diversity FROM u""")
def _(t):
    i = items(t)
    return rec.diversity(rec.recommend_weighted(requests(t), i), i)
