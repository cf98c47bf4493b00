"""Filters, aggregations, rankings and set operations (FLT, AGG, WIN, SET)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import aggregates as agg, filters as flt, normalize as nrm, ranking
from waymark.plans import views
from waymark.plans.registry import query

C = F.col
CAT = views.CATALOG_SQL

# ---- filters -------------------------------------------------------------

_addr = "concat('Jl ', CASE item_id % 3 WHEN 0 THEN 'brand#1' ELSE 'x' END)"


@query("flt01_search_page", f"""
WITH m AS (SELECT * FROM (SELECT *, {_addr} AS address FROM {CAT}) WHERE contains(category, 'promo')
  AND (contains(lower(region), 'brand#1') OR contains(lower(address), 'brand#1'))
  AND (contains(lower(name), 'ring') OR contains(lower(region), 'ring') OR contains(lower(address), 'ring')))
SELECT item_id, name, round(coalesce(CASE WHEN item_id % 4 <> 0 THEN rating END, 4.6), 1) AS rating, coalesce(CASE WHEN item_id % 4 <> 0 THEN review_count END, 120) AS review_count,
  (SELECT count(*) FROM m) AS total_items, greatest(1, CAST(ceil((SELECT count(*) FROM m) / 5.0) AS bigint)) AS total_pages
FROM m ORDER BY item_id LIMIT 5 OFFSET 5""")
def _(t):
    items = views.catalog(t).withColumn("address", F.expr(_addr)).withColumns({
        "rating": F.when(C("item_id") % 4 != 0, C("rating")), "review_count": F.when(C("item_id") % 4 != 0, C("review_count"))})
    hits = flt.search(items, "Promo", "Kota Brand#1", "ring")
    return flt.page(hits, "item_id", 2, 5).select("item_id", "name", "rating", "review_count", "total_items", "total_pages")


@query("flt02_narrow_or_keep", f"""
WITH e AS (SELECT * FROM {CAT} WHERE item_id NOT IN (SELECT s_suppkey FROM supplier)),
a AS (SELECT * FROM e WHERE contains(category, 'promo') OR NOT EXISTS (SELECT 1 FROM e WHERE contains(category, 'promo'))),
b AS (SELECT * FROM a WHERE region = 'nowhere' OR NOT EXISTS (SELECT 1 FROM a WHERE region = 'nowhere'))
SELECT item_id, category, region FROM b""")
def _(t):
    gone = t.supplier.select(C("s_suppkey").alias("item_id"))
    kept = flt.exclude(views.catalog(t), gone, "item_id")
    kept = flt.narrow_or_keep(kept, C("category").contains("promo"))
    return flt.narrow_or_keep(kept, C("region") == "nowhere").select("item_id", "category", "region")


@query("flt03_budget_after_rank", f"""
SELECT region, item_id, rank, price FROM (SELECT region, item_id, price, row_number() OVER (PARTITION BY region ORDER BY rating DESC, item_id) AS rank FROM {CAT})
WHERE rank <= 5 AND price <= 1000""")
def _(t):
    ranked = ranking.top_n(views.catalog(t), ["region"], [C("rating").desc(), C("item_id")], 5, "rank")
    return flt.within_budget(ranked, "price", F.lit(1000.0)).select("region", "item_id", "rank", "price")


@query("flt04_route", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'P' THEN 'rejected' ELSE 'manual_review' END AS destination FROM orders""")
def _(t):
    d = F.when(C("o_orderstatus") == "F", "accepted").when(C("o_orderstatus") == "P", "rejected").otherwise("other")
    return t.orders.select("o_orderkey", flt.route(d).alias("destination"))


@query("flt05_verified", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'verified' ELSE 'candidate' END AS layer FROM orders""")
def _(t):
    cls = F.when(C("o_orderstatus") == "F", "accepted")
    return t.orders.select("o_orderkey", flt.verified_or_candidate(cls, C("o_orderpriority"), ["1-URGENT", "2-HIGH"]).alias("layer"))


@query("flt06_scope_queue", """
SELECT o_orderkey, batch, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'in_scope' ELSE 'out_of_scope' END AS scope_status
FROM (SELECT *, CAST(o_orderkey % 32 AS int) AS batch FROM orders) WHERE batch BETWEEN 3 AND 20 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def _(t):
    o = t.orders.withColumn("batch", (C("o_orderkey") % 32).cast("int"))
    done = t.lineitem.filter("l_returnflag = 'R'").select(C("l_orderkey").alias("o_orderkey"))
    scoped = flt.in_scope(o, C("o_orderpriority"), ["1-URGENT", "2-HIGH"])
    return flt.queue(scoped, "o_orderkey", done, first_batch=3, last_batch=20).select("o_orderkey", "batch", "scope_status")


# ---- aggregations --------------------------------------------------------


@query("agg01_decision_counts", """
SELECT o_orderpriority, count(*) AS raw, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t):
    return agg.decision_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("agg02_coverage", """
SELECT n_nationkey AS nation, n_name, coalesce(a, 0) AS raw_rows, coalesce(b, 0) AS rich, coalesce(d, 0) AS machinery FROM nation
LEFT JOIN (SELECT c_nationkey AS k, count(*) AS a, count(*) FILTER (c_acctbal > 9500) AS b, count(*) FILTER (c_mktsegment = 'MACHINERY') AS d FROM customer GROUP BY 1) ON k = n_nationkey""")
def _(t):
    c = t.customer.withColumnRenamed("c_nationkey", "nation")
    dim = t.nation.select(C("n_nationkey").alias("nation"), "n_name")
    return agg.coverage(dim, "nation", {
        "raw_rows": c, "rich": c.filter("c_acctbal > 9500"), "machinery": c.filter("c_mktsegment = 'MACHINERY'")})


@query("agg03_reconciliation", """
WITH c AS (SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders)
SELECT m AS metric, n, round(n / total * 100, 2) AS pct, f + o + p = total AS balanced
FROM c, LATERAL (VALUES ('total', total), ('accepted', f), ('open', o), ('rejected', p)) v(m, n)""")
def _(t):
    s = C("o_orderstatus")
    return agg.reconciliation(t.orders, {"accepted": s == "F", "open": s == "O", "rejected": s == "P"})


@query("agg04_source_overlap", """
SELECT CASE WHEN a AND b THEN 'both' WHEN a THEN 'only_a' WHEN b THEN 'only_b' ELSE 'neither' END AS overlap, count(*) AS n_keys, max(size) AS largest
FROM (SELECT l_orderkey, bool_or(l_returnflag = 'A') AS a, bool_or(l_returnflag = 'R') AS b, count(*) AS size FROM lineitem GROUP BY 1) GROUP BY 1""")
def _(t):
    return agg.source_overlap(t.lineitem, "l_orderkey", C("l_returnflag") == "A", C("l_returnflag") == "R")


@query("agg05_flag_summary", f"""
SELECT category, count(*) AS n, CAST(sum(CAST(has_parking AS int)) AS bigint) AS has_parking, CAST(sum(CAST(has_food AS int)) AS bigint) AS has_food, round(avg(completeness), 6) AS mean_score FROM {CAT} GROUP BY 1""")
def _(t):
    return agg.flag_summary(views.catalog(t), "category", ["has_parking", "has_food"], "completeness")


@query("agg06_rates", """
SELECT c_nationkey, count(*) AS n, round(avg(CASE WHEN c_acctbal > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive_rate, round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1.0 ELSE 0.0 END), 6) AS building_rate FROM customer GROUP BY 1""")
def _(t):
    return agg.rates(t.customer, "c_nationkey", {"positive_rate": C("c_acctbal") > 0, "building_rate": C("c_mktsegment") == "BUILDING"})


@query("agg07_element_counts", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g')), ' ')) AS word FROM documents) GROUP BY 1""")
def _(t):
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), "[^a-z0-9]", " "), " +", " ")), " ")
    return agg.element_counts(t.documents, words, "word")


@query("agg08_crosstab", """
SELECT coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, 'unknown') AS label, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(t):
    label = F.when(C("o_orderpriority") != "5-LOW", C("o_orderpriority"))
    return agg.crosstab(t.orders, label, "o_orderstatus", ["F", "O", "P"])


@query("agg09_stacked_counts", """
SELECT 'o_orderstatus' AS dimension, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY o_orderstatus
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY o_orderpriority UNION ALL SELECT 'total', 'total', count(*) FROM orders""")
def _(t):
    return agg.stacked_counts(t.orders, ["o_orderstatus", "o_orderpriority"])


_missing = ("CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS name", "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_mktsegment END AS segment",
            "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance")


@query("agg10_missing_counts", f"""
WITH m AS (SELECT {', '.join(_missing)} FROM customer), c AS (SELECT count(*) AS total, count(*) FILTER (name IS NULL) AS a, count(*) FILTER (trim(segment) = '') AS b, count(*) FILTER (balance IS NULL) AS d FROM m)
SELECT f AS field, n AS missing, round(n / total * 100, 2) AS pct FROM c, LATERAL (VALUES ('name', a), ('segment', b), ('balance', d)) v(f, n)""")
def _(t):
    return agg.missing_counts(t.customer.selectExpr(*_missing), ["name", "segment", "balance"])


@query("agg10_missing_list", f"""
SELECT c_custkey, concat_ws(', ', CASE WHEN name IS NULL THEN 'name' END, CASE WHEN trim(segment) = '' THEN 'segment' END, CASE WHEN balance IS NULL THEN 'balance' END) AS missing
FROM (SELECT c_custkey, {', '.join(_missing)} FROM customer)""")
def _(t):
    return t.customer.selectExpr("c_custkey", *_missing).select("c_custkey", agg.missing_list(["name", "segment", "balance"]).alias("missing"))


@query("agg11_distribution", f"""
SELECT seg AS segment, count(*) AS n, round(count(*) / (SELECT count(*) FROM part) * 100, 2) AS pct
FROM (SELECT CASE WHEN rating >= 4.5 THEN 'high' WHEN rating >= 4.0 THEN 'medium' ELSE 'low' END AS seg FROM {CAT}) GROUP BY 1""")
def _(t):
    return agg.distribution(views.catalog(t), nrm.rating_segment(C("rating")), "segment")


@query("agg12_group_stats", """
SELECT n_nationkey AS nation, coalesce(n, 0) AS n, mean, low, high FROM nation LEFT JOIN
(SELECT s_nationkey AS k, count(*) AS n, round(avg(s_acctbal), 6) AS mean, min(s_acctbal) AS low, max(s_acctbal) AS high FROM supplier GROUP BY 1) ON k = n_nationkey""")
def _(t):
    facts = t.supplier.select(C("s_nationkey").alias("nation"), "s_acctbal")
    return agg.group_stats(t.nation.select(C("n_nationkey").alias("nation")), "nation", facts, "s_acctbal")


# ---- rankings ------------------------------------------------------------


@query("win01_newest", """
SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def _(t):
    return ranking.newest(t.events, ["user_id"], "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("win02_keep_first_last", """
SELECT f.user_id, f.event_type, f.event_id AS first_id, l.event_id AS last_id FROM
(SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2) f JOIN (SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2) l USING (user_id, event_type)""")
def _(t):
    keys = ["user_id", "event_type"]
    first = ranking.keep_first(t.events, keys, [C("event_id").asc()]).select(*keys, C("event_id").alias("first_id"))
    last = ranking.keep_first(t.events, keys, [C("event_id").desc()]).select(*keys, C("event_id").alias("last_id"))
    return first.join(last, keys)


@query("win03_top_n_rank", f"""
SELECT place_id, review_id, bucket, rank, 'top_representative_' || bucket || '_rank_' || rank AS reason FROM
(SELECT *, row_number() OVER (PARTITION BY place_id, bucket ORDER BY review_ts DESC, length(text) DESC, review_id) AS rank FROM
  (SELECT *, CASE WHEN rating >= 4 THEN 'positive' WHEN rating >= 3 THEN 'neutral' ELSE 'negative' END AS bucket FROM {views.REVIEWS_SQL}))
WHERE rank <= CASE bucket WHEN 'positive' THEN 5 WHEN 'negative' THEN 3 ELSE 2 END""")
def _(t):
    r = views.reviews(t).withColumn("bucket", nrm.rating_bucket(C("rating")))
    target = F.when(C("bucket") == "positive", 5).when(C("bucket") == "negative", 3).otherwise(2)
    top = ranking.top_n_by_target(r, ["place_id", "bucket"], [C("review_ts").desc(), F.length("text").desc(), C("review_id")], target, 5, "rank")
    return top.select("place_id", "review_id", "bucket", "rank", F.format_string("top_representative_%s_rank_%d", "bucket", "rank").alias("reason"))


@query("win04_arrival_quota", """
SELECT role, conv_id, turn, quota_rank FROM (SELECT *, row_number() OVER (PARTITION BY conv_id % 20, role ORDER BY conv_id * 1000 + turn) AS quota_rank,
  CASE WHEN turn % 3 = 1 THEN '' ELSE text END AS txt FROM conversations) WHERE quota_rank <= CASE role WHEN 'user' THEN 5 WHEN 'assistant' THEN 5 ELSE 3 END AND txt <> ''""")
def _(t):
    c = t.conversations.select("role", "conv_id", "turn", (C("conv_id") % 20).alias("place"), (C("conv_id") * 1000 + C("turn")).alias("arrival"),
                               F.when(C("turn") % 3 == 1, "").otherwise(C("text")).alias("txt"))
    return ranking.arrival_quota(c, "place", "role", "arrival", "txt", {"user": 5, "assistant": 5, "system": 3}).select("role", "conv_id", "turn", "quota_rank")


@query("win05_pools", f"""
SELECT 'low_confidence' AS pool, item_id FROM (SELECT item_id FROM {CAT} ORDER BY confidence, item_id LIMIT 20)
UNION ALL SELECT 'popular', item_id FROM (SELECT item_id FROM {CAT} ORDER BY review_count DESC, item_id LIMIT 20)
UNION ALL SELECT 'closed', item_id FROM (SELECT item_id FROM {CAT} WHERE status = 'permanently_closed' ORDER BY item_id LIMIT 20)""")
def _(t):
    c = views.catalog(t)
    low = c.orderBy("confidence", "item_id").limit(20)
    popular = c.orderBy(C("review_count").desc(), C("item_id")).limit(20)
    closed = c.filter("status = 'permanently_closed'").orderBy("item_id").limit(20)
    named = lambda df, n: df.select(F.lit(n).alias("pool"), "item_id")
    return named(low, "low_confidence").unionByName(named(popular, "popular")).unionByName(named(closed, "closed"))


@query("win06_alternatives", f"""
SELECT category, item_id, rank FROM (SELECT category, item_id, row_number() OVER (PARTITION BY category ORDER BY rating DESC, review_count DESC, item_id) AS rank FROM {CAT}) WHERE rank <= 3""")
def _(t):
    order = [C("rating").desc_nulls_last(), C("review_count").desc_nulls_last(), C("item_id").asc()]
    return ranking.top_n(views.catalog(t), ["category"], order, 3, "rank").select("category", "item_id", "rank")


# ---- set operations ------------------------------------------------------


@query("set01_union_all", """
SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 100000""")
def _(t):
    pick = lambda cond: t.orders.filter(cond).select(C("o_orderkey").alias("k"), C("o_orderstatus").alias("s"))
    return pick("o_orderstatus = 'F'").unionByName(pick("o_totalprice > 100000"))


@query("set02_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("set03_difference_intersection", """
SELECT 'only_customers' AS part, k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'both', k FROM (SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders)""")
def _(t):
    a, b = t.customer.select(C("c_custkey").alias("k")), t.orders.select(C("o_custkey").alias("k"))
    return a.subtract(b).select(F.lit("only_customers").alias("part"), "k").unionByName(
        a.intersect(b).select(F.lit("both").alias("part"), "k"))


@query("set04_array_sets", """
WITH w AS (SELECT doc_id, list_distinct(string_split(lang || ' ' || source || ' a', ' ')) AS x, [lang, 'src3', 'zz'] AS y FROM documents)
SELECT doc_id, NOT list_has_any(x, y) AS disjoint, len(list_distinct(x || y)) AS union_size, list_contains(x, 'src3') AS has_src3 FROM w""")
def _(t):
    x = F.array_distinct(F.split(F.concat_ws(" ", "lang", "source", F.lit("a")), " "))
    y = F.array(C("lang"), F.lit("src3"), F.lit("zz"))
    return t.documents.select("doc_id", (~F.arrays_overlap(x, y)).alias("disjoint"),
                              F.size(F.array_union(x, y)).cast("bigint").alias("union_size"), F.array_contains(x, "src3").alias("has_src3"))
