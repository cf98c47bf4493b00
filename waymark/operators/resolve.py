"""Entity resolution: ordered greedy clustering without pairwise comparison of groups.

The result is that of one ordered pass over the records: a record joins the
best earlier anchor it matches, or becomes an anchor itself. The pass is run as
rounds. In each round the records that are first in every group they could
conflict in become anchors; the records that match a new anchor become members;
the rest wait for the next round. Groups (equal phone, equal website, equal
name or address in a neighbourhood) are only ever reduced to their first
record, never paired with themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions import geo, urls
from waymark.functions.rules import first_match, yes
from waymark.functions.similarity import indel_ratio
from waymark.functions.text import is_filled, sorted_tokens
from waymark.operators.durable import durable
from waymark.operators.nearby import contained_names, similar_within
from waymark.operators.skew import join_shuffled

NAME_RADIUS = 500.0
FUZZY_RADIUS = 300.0


def pair_rule(a: str, b: str, shared_domains: list[str]) -> Column:
    """Struct (confidence, reason) of a pair, the two sides given as struct columns; confidence 0 means no match.

    Needs `distance_m`, `name_score` and `address_score` (0-100) beside the two sides.
    """
    p = lambda f: (F.col(f"{a}.{f}"), F.col(f"{b}.{f}"))
    (phone_a, phone_b), (web_a, web_b), (name_a, name_b) = p("phone"), p("website"), p("name")
    same_phone = yes(is_filled(phone_a) & (phone_a == phone_b))
    same_web = yes(is_filled(web_a) & (web_a == web_b) & ~urls.authority(web_a).isin(shared_domains))
    dist, score = F.col("distance_m"), F.col("name_score")
    part_of_other = name_a.contains(name_b) | name_b.contains(name_a)

    def out(conf, reason):
        return F.struct(F.lit(conf).alias("confidence"), F.lit(reason).alias("reason"))

    return first_match(
        [
            (yes(p("trusted")[0] & p("trusted")[1]), out(0.0, "different_trusted_ids")),
            (same_phone, out(0.95, "same_phone")),
            (same_web, out(0.95, "same_website")),
            (yes((name_a == name_b) & (dist <= NAME_RADIUS)), out(1.0, "exact_name_distance_500m")),
            (yes((score >= 90) & (dist <= FUZZY_RADIUS) & (name_a != name_b) & (part_of_other | (score < 95))),
             out(0.0, "potential_parent_child")),
            (yes((score >= 90) & (dist <= FUZZY_RADIUS)), out(0.9, "fuzzy_name_distance_300m")),
            (yes((F.col("address_score") >= 85) & (dist <= NAME_RADIUS)), out(0.85, "similar_address_distance_500m")),
        ],
        out(0.0, "no_match"),
    )


def _scored(pairs: DataFrame, shared_domains: list[str]) -> DataFrame:
    """Pairs (row, anchor) with their rule outcome, matches only, anchor earlier than the row."""
    tok = lambda c: F.coalesce(sorted_tokens(c), F.lit(""))
    pairs = pairs.filter(F.col("anchor.ord") < F.col("row.ord")).withColumn(
        "distance_m", geo.haversine_m(F.col("row.lat"), F.col("row.lon"), F.col("anchor.lat"), F.col("anchor.lon")))
    # only pairs the scores can decide reach the UDF with text; NULL passes through it
    open_pair = (F.col("distance_m") <= NAME_RADIUS) & (F.col("row.name") != F.col("anchor.name"))
    addressed = open_pair & is_filled(F.col("row.address")) & is_filled(F.col("anchor.address"))
    pairs = pairs.withColumns({
        "name_score": indel_ratio(F.when(open_pair, tok(F.col("row.name"))), F.when(open_pair, tok(F.col("anchor.name")))),
        "address_score": indel_ratio(F.when(addressed, tok(F.lower("row.address"))), F.when(addressed, tok(F.lower("anchor.address")))),
    })
    return pairs.withColumn("rule", pair_rule("row", "anchor", shared_domains)).filter(F.col("rule.confidence") > 0)


def _nodes(records: DataFrame, order: str, rank: dict[str, int], trusted: list[str], shared_domains: list[str]) -> DataFrame:
    place = first_match([(F.col("source") == s, r) for s, r in rank.items()], 9)
    has_point = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    web = F.when(is_filled(F.col("website")) & ~urls.authority(F.col("website")).isin(shared_domains), F.col("website"))
    y, x = geo.own_cell(F.col("latitude"), F.col("longitude"), NAME_RADIUS)
    address = F.lower(F.when(is_filled(F.col("address")), F.col("address")))
    return records.select(
        F.col("record_id").alias("id"),
        F.struct(place.cast("int").alias("rank"), F.col(order).alias("seq"), F.col("record_id").alias("id")).alias("ord"),
        F.col("source").isin(trusted).alias("trusted"),
        F.col("normalized_name").alias("name"), "address", "phone", "website",
        F.when(has_point, F.col("latitude")).alias("lat"), F.when(has_point, F.col("longitude")).alias("lon"),
        F.filter(F.array(
            F.when(is_filled(F.col("phone")), F.concat(F.lit("p:"), "phone")), F.concat(F.lit("w:"), web),
        ), lambda k: k.isNotNull()).alias("keys"),
        F.when(has_point, F.filter(F.array(
            F.concat(F.lit("n:"), "normalized_name"),
            F.concat(F.lit("a:"), sorted_tokens(address)),
        ), lambda k: k.isNotNull())).otherwise(F.array().cast("array<string>")).alias("zones"),
        F.when(has_point, y).alias("cell_y"), F.when(has_point, x).alias("cell_x"),
        F.when(has_point, F.xxhash64("normalized_name", address, "latitude", "longitude")).alias("spot"),
    )


ROW = ["id", "ord", "trusted", "name", "address", "phone", "website", "lat", "lon"]


def _as(df: DataFrame, name: str, *extra: str) -> DataFrame:
    return df.select(F.struct(*ROW).alias(name), *extra)


def _reach(lat: Column) -> Column:
    """How many longitude cells a radius can span at a latitude."""
    widest = F.least(F.abs(lat) + F.lit(0.01), F.lit(89.9))
    return F.ceil(F.lit(1.001) / F.cos(F.radians(widest))).cast("bigint")


def _around(cell_y: Column, cell_x: Column, lat: Column) -> Column:
    return F.flatten(F.transform(
        F.sequence(cell_y - 1, cell_y + 1),
        lambda y: F.transform(F.sequence(cell_x - _reach(lat), cell_x + _reach(lat)),
                              lambda x: F.struct(y.alias("cell_y"), x.alias("cell_x")))))


def _similar_spots(nodes: DataFrame) -> DataFrame:
    """Pairs of spots (name, address, point) whose different names or addresses are similar enough to match."""
    spots = nodes.filter(F.col("spot").isNotNull()).groupBy("spot").agg(
        F.first("name").alias("name"), F.first("address").alias("address"), F.first("lat").alias("lat"), F.first("lon").alias("lon"))
    names = spots.select(F.col("spot").alias("id"), sorted_tokens(F.col("name")).alias("text"), F.col("name").alias("label"), "lat", "lon")
    addresses = spots.filter(is_filled(F.col("address"))).select(
        F.col("spot").alias("id"), sorted_tokens(F.lower("address")).alias("text"), "lat", "lon")
    by_name = similar_within(names, names, FUZZY_RADIUS, 0.95, equal_texts=False)
    by_address = similar_within(addresses, addresses, NAME_RADIUS, 0.85, equal_texts=False)
    # equal names and equal addresses are zone groups already
    both = by_name.unionByName(by_address).filter("left_id <> right_id").select(
        F.col("left_id").alias("spot"), F.col("right_id").alias("other")).distinct()
    equal = spots.select(F.col("spot"), F.col("name"), F.lower("address").alias("addr"))
    other = equal.select(F.col("spot").alias("other"), F.col("name").alias("name_o"), F.col("addr").alias("addr_o"))
    return join_shuffled(join_shuffled(both, equal, "spot"), other, "other").filter((F.col("name") != F.col("name_o")) & ~F.coalesce(sorted_tokens(F.col("addr")) == sorted_tokens(F.col("addr_o")), F.lit(False))
             ).select("spot", "other")


def _pairs_with(rows: DataFrame, anchors: DataFrame, spots: DataFrame, first_per_key: bool) -> DataFrame:
    """Candidate (row, anchor) pairs from keys, zones and similar spots.

    Per key only the first anchor can be chosen, so the anchors are reduced to
    one per key before the join.
    """
    keyed = anchors.select("*", F.explode("keys").alias("key"))
    if first_per_key:
        keyed = keyed.groupBy("key").agg(F.min_by(F.struct(*ROW), "ord").alias("anchor"))
        keyed = durable(keyed)
    else:
        keyed = _as(keyed, "anchor", "key")
    by_key = join_shuffled(_as(rows.select("*", F.explode("keys").alias("key")), "row", "key"), keyed, "key").select("row", "anchor")

    zoned = _as(anchors.select("*", F.explode("zones").alias("zone"),
                               F.col("lat").alias("_lat")).select("*", F.explode(_around(F.col("cell_y"), F.col("cell_x"), F.col("_lat"))).alias("c"))
                .drop("cell_y", "cell_x").select("*", "c.cell_y", "c.cell_x"), "anchor", "zone", "cell_y", "cell_x")
    by_zone = join_shuffled(_as(rows.select("*", F.explode("zones").alias("zone")), "row", "zone", "cell_y", "cell_x"), zoned, ["zone", "cell_y", "cell_x"]).filter(
        geo.haversine_m(F.col("row.lat"), F.col("row.lon"), F.col("anchor.lat"), F.col("anchor.lon")) <= NAME_RADIUS
    ).select("row", "anchor")

    near = join_shuffled(_as(anchors.withColumnRenamed("spot", "other"), "anchor", "other"), spots, "other").select("anchor", "spot")
    by_spot = join_shuffled(_as(rows, "row", "spot"), near, "spot").select("row", "anchor")
    return by_key.unionByName(by_zone).unionByName(by_spot)


def _round_winners(open_rows: DataFrame, spots: DataFrame) -> DataFrame:
    """Rows that come first in all of their keys, zones (with neighbouring cells) and similar spots."""
    me = F.struct("ord", "id")
    key_wins = open_rows.select("id", "ord", F.explode("keys").alias("key")).groupBy("key").agg(
        F.min(me).alias("m")).groupBy(F.col("m.id").alias("id")).agg(F.count("*").alias("key_wins"))
    cells = open_rows.select("id", "ord", "lat", "cell_y", "cell_x", F.explode("zones").alias("zone")).groupBy(
        "zone", "cell_y", "cell_x").agg(F.min(me).alias("m"), F.first("lat").alias("lat"))
    seen = cells.select("zone", "m", F.col("cell_y").alias("y0"), F.col("cell_x").alias("x0"),
                        F.explode(_around(F.col("cell_y"), F.col("cell_x"), F.col("lat"))).alias("c"))
    own = (F.col("c.cell_y") == F.col("y0")) & (F.col("c.cell_x") == F.col("x0"))
    zone_wins = seen.groupBy("zone", "c.cell_y", "c.cell_x").agg(
        F.min("m").alias("lowest"), F.min(F.when(own, F.col("m"))).alias("mine")
    ).filter(F.col("lowest") == F.col("mine")).groupBy(F.col("mine.id").alias("id")).agg(F.count("*").alias("zone_wins"))
    spot_min = open_rows.filter(F.col("spot").isNotNull()).groupBy("spot").agg(F.min("ord").alias("o"))
    rival = join_shuffled(spots, spot_min.withColumnRenamed("spot", "other"), "other").groupBy("spot").agg(F.min("o").alias("rival"))
    first = join_shuffled(join_shuffled(open_rows, key_wins, "id", "left"), zone_wins, "id", "left").filter(
        (F.size("keys") == F.coalesce("key_wins", F.lit(0))) & (F.size("zones") == F.coalesce("zone_wins", F.lit(0)))
    ).drop("key_wins", "zone_wins")
    return join_shuffled(first, rival, "spot", "left").filter(F.col("rival").isNull() | (F.col("ord") < F.col("rival"))).drop("rival")


def resolve(records: DataFrame, order: str = "seq", rank: dict[str, int] = config.SOURCE_RANK,
            trusted: list[str] = config.TRUSTED_SOURCES, shared_domains: list[str] = config.SHARED_DOMAINS) -> DataFrame:
    """Mapping record_id -> canonical_id (record id of the anchor), confidence, match_status, dedup_reason.

    records: record_id, source, normalized_name, address, phone, website, latitude, longitude and an order column.
    Anchors are matched on their own fields; what members would add to an anchor is not followed.
    """
    nodes = durable(_nodes(records, order, rank, trusted, shared_domains))
    spots = durable(_similar_spots(nodes))

    # Two trusted records never match and trusted ones come first, so all of them are anchors,
    # and so is every record that shares nothing with anything.
    fixed = nodes.filter("trusted OR (size(keys) = 0 AND size(zones) = 0)")
    rest = nodes.filter("NOT (trusted OR (size(keys) = 0 AND size(zones) = 0))")
    anchors = durable(fixed)
    matched = _scored(_pairs_with(rest, anchors.filter("trusted"), spots, True), shared_domains).select(F.col("row.id").alias("id")).distinct()
    open_rows = durable(join_shuffled(rest, matched, "id", "left_anti"))
    while not open_rows.isEmpty():
        won = durable(_round_winners(open_rows, spots).select(*nodes.columns))
        anchors = anchors.unionByName(won)
        left = join_shuffled(open_rows, won.select("id"), "id", "left_anti")
        matched = _scored(_pairs_with(left, won, spots, False), shared_domains).select(F.col("row.id").alias("id")).distinct()
        open_rows = durable(join_shuffled(left, matched, "id", "left_anti"))

    followers = join_shuffled(nodes, anchors.select("id"), "id", "left_anti")
    best = _scored(_pairs_with(followers, anchors, spots, True), shared_domains).groupBy(F.col("row.id").alias("record_id")).agg(
        F.min(F.struct((-F.col("rule.confidence")).alias("neg"), F.col("anchor.ord").alias("ord"),
                       F.col("rule.reason").alias("reason"), F.col("anchor.id").alias("id"))).alias("b"))
    merged = best.select("record_id", F.col("b.id").alias("canonical_id"), (-F.col("b.neg")).alias("confidence"),
                         F.lit("merged").alias("match_status"), F.col("b.reason").alias("dedup_reason"))
    fresh = anchors.select(F.col("id").alias("record_id"), F.col("id").alias("canonical_id"), F.lit(1.0).alias("confidence"),
                           F.lit("new").alias("match_status"), F.lit("new_record").alias("dedup_reason"))
    return fresh.unionByName(merged)


def keep_first_of_groups(rows: DataFrame, row_id: str, order: list[str], keys: list[Column]) -> DataFrame:
    """Ids kept by one ordered pass that drops a row as soon as one of its keys was seen on a kept row.

    The same rounds as above with exact keys only: exact even when keys overlap in chains.
    """
    nodes = durable(rows.select(
        F.col(row_id).alias("id"), F.struct(*order, row_id).alias("ord"),
        F.filter(F.array(*keys), lambda k: k.isNotNull()).alias("keys")))
    me = F.struct("ord", "id")
    kept, open_rows = None, nodes
    while not open_rows.isEmpty():
        wins = open_rows.select("id", "ord", F.explode("keys").alias("key")).groupBy("key").agg(F.min(me).alias("m")).groupBy(
            F.col("m.id").alias("id")).agg(F.count("*").alias("wins"))
        won = durable(join_shuffled(open_rows, wins, "id", "left").filter(F.size("keys") == F.coalesce("wins", F.lit(0))).drop("wins"))
        kept = won.select("id") if kept is None else kept.unionByName(won.select("id"))
        left = join_shuffled(open_rows, won.select("id"), "id", "left_anti")
        seen = won.select(F.explode("keys").alias("key"))
        dropped = join_shuffled(left.select("id", F.explode("keys").alias("key")), seen, "key", "left_semi").select("id").distinct()
        open_rows = durable(join_shuffled(left, dropped, "id", "left_anti"))
    ids = nodes.select("id").limit(0) if kept is None else kept
    return ids.withColumnRenamed("id", row_id)


def merge_clusters(records: DataFrame, mapping: DataFrame, tag_rule) -> DataFrame:
    """One row per cluster with surviving values.

    Text fields: first filled value in match order. Rating: review-weighted mean,
    rounded once at the end (plain mean when no reviews are counted).
    """
    r = join_shuffled(records, mapping.select("record_id", "canonical_id", "confidence", "match_status"), "record_id")
    pos = F.struct((F.col("match_status") != "new").alias("late"), F.col("source_rank"), F.col("seq"), F.col("record_id"))

    def first_filled(c: str) -> Column:
        return F.min_by(c, F.when(is_filled(F.col(c)), pos)).alias(c)

    point = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    n = F.coalesce(F.col("review_count"), F.lit(0))
    rated = F.col("rating").isNotNull()
    accepted = F.struct((F.col("classification") != "accepted").alias("late"), pos.alias("pos"))
    out = r.groupBy("canonical_id").agg(
        F.min_by("name", pos).alias("name"),
        first_filled("address"), first_filled("region"), first_filled("phone"), first_filled("website"),
        F.min_by("latitude", F.when(point, pos)).alias("latitude"), F.min_by("longitude", F.when(point, pos)).alias("longitude"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("categories")))).alias("_cats"),
        F.sum(F.when(rated, F.col("rating") * n)).alias("_weighted"), F.sum(F.when(rated, n)).alias("_reviews"),
        F.avg("rating").alias("_mean"),
        F.count("*").alias("source_count"), F.min("confidence").alias("dedup_confidence"),
        F.bool_or((F.col("confidence") < 0.85) | (F.col("classification") == "manual_review")).alias("needs_manual_review"),
        F.min("collected_at").alias("first_collected_at"), F.max("collected_at").alias("last_collected_at"),
        F.min_by("classification", F.when(F.col("classification").isNotNull(), accepted)).alias("classification"),
    )
    tagged = out.withColumn("_t", tag_rule(F.col("_cats"), F.col("name")))
    return tagged.withColumns({
        "rating": F.bround(F.when(F.col("_reviews") > 0, F.col("_weighted") / F.col("_reviews")).otherwise(F.col("_mean")), 2),
        "review_count": F.col("_reviews"),
        "category": F.col("_t.primary"), "category_tags": F.col("_t.tags"),
    }).drop("_t", "_cats", "_weighted", "_reviews", "_mean")


def parent_child(places: DataFrame, blocked_words: list[str] = config.NO_PARENT_WORDS,
                 facility_words: list[str] = config.FACILITY_WORDS, radius_m: float = FUZZY_RADIUS, fuzzy: bool = True) -> DataFrame:
    """Parent and relationship per place.

    places: place_id, ord, name, normalized_name, region, latitude, longitude. A place is the child of
    another one close by whose name is inside its own (or 80-90 similar): the shorter name is the parent.
    Among several parents the pair visited first counts: lowest (smaller, larger) order.
    """
    from waymark.functions.rules import contains_any

    usable = places.filter(~contains_any(F.lower("name"), blocked_words) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    nodes = usable.select(F.col("place_id").alias("id"), F.col("normalized_name").alias("text"),
                          F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    pairs = contained_names(nodes, radius_m).select(F.col("part_id").alias("a"), F.col("whole_id").alias("b"))
    if fuzzy:
        tokens = nodes.withColumn("text", sorted_tokens(F.col("text")))
        close = similar_within(tokens, tokens, radius_m, 0.80, equal_texts=False).filter("similarity < 0.90 AND left_id <> right_id")
        pairs = pairs.unionByName(close.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))
    ends = places.select("place_id", "ord", "name", F.col("normalized_name").alias("nn"),
                         F.lower(F.trim(F.coalesce("region", F.lit("")))).alias("reg"))
    side = lambda s: ends.select(F.col("place_id").alias(s), F.struct("ord", "place_id", "name", "nn", "reg").alias(f"{s}_"))
    both = join_shuffled(join_shuffled(pairs, side("a"), "a"), side("b"), "b").filter(
        (F.col("a_.nn") != F.col("b_.nn"))
        & ((F.col("a_.reg") == "") | (F.col("b_.reg") == "") | (F.col("a_.reg") == F.col("b_.reg"))))
    lo = F.when(F.col("a_.ord") < F.col("b_.ord"), F.col("a_")).otherwise(F.col("b_"))
    hi = F.when(F.col("a_.ord") < F.col("b_.ord"), F.col("b_")).otherwise(F.col("a_"))
    both = both.select(lo.alias("lo"), hi.alias("hi"))
    # equal lengths: the pair is first visited as (lo, hi), which makes hi the parent, then as
    # (hi, lo), which makes lo the parent of hi
    n_lo, n_hi = F.length("lo.nn"), F.length("hi.nn")
    visit = lambda p, c, turn: F.struct(
        F.when(F.lit(turn == 0), F.col("lo.ord")).otherwise(F.col("hi.ord")).alias("i"),
        F.when(F.lit(turn == 0), F.col("hi.ord")).otherwise(F.col("lo.ord")).alias("j"),
        F.col(f"{p}.place_id").alias("parent"), F.col(f"{c}.place_id").alias("child"))
    visits = F.when(n_lo < n_hi, F.array(visit("lo", "hi", 0))).when(n_lo > n_hi, F.array(visit("hi", "lo", 0))).otherwise(
        F.array(visit("hi", "lo", 0), visit("lo", "hi", 1)))
    links = both.select(F.explode(visits).alias("v")).groupBy(F.col("v.child").alias("place_id")).agg(
        F.min(F.struct("v.i", "v.j", "v.parent")).alias("m")).select("place_id", F.col("m.parent").alias("parent_id"))
    is_parent = links.select(F.col("parent_id").alias("place_id")).distinct().withColumn("is_parent", F.lit(True))
    relation = F.when(F.col("parent_id").isNotNull(), F.when(
        contains_any(F.lower("name"), facility_words), F.lit("supporting_facility")).otherwise(F.lit("part_of"))
    ).when(F.col("is_parent"), F.lit("same_place"))
    return join_shuffled(join_shuffled(places, links, "place_id", "left"), is_parent, "place_id", "left").select(
        "place_id", "parent_id", relation.alias("relationship"), F.col("parent_id").isNotNull().alias("needs_review"))


def near_duplicates(places: DataFrame, radius_m: float = 100.0, cut: float = 0.85) -> DataFrame:
    """Pairs of places with similar names, close together, backed by different trusted ids.

    places: place_id, ord, normalized_name, category, trusted_ids array, latitude, longitude.
    """
    src = places.filter(F.size("trusted_ids") > 0)
    nodes = src.select(F.col("place_id").alias("id"), sorted_tokens(F.col("normalized_name")).alias("text"),
                       F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    pairs = similar_within(nodes, nodes, radius_m, cut)
    side = lambda s: src.select(F.col("place_id").alias(f"{s}_id"), F.col("ord").alias(f"{s}_ord"),
                                F.col("category").alias(f"{s}_cat"), F.col("trusted_ids").alias(f"{s}_ids"))
    either_other = F.lit(False)
    for s in ("left", "right"):
        either_other = either_other | F.col(f"{s}_cat").isNull() | (F.col(f"{s}_cat") == "other")
    return join_shuffled(join_shuffled(pairs, side("left"), "left_id"), side("right"), "right_id").filter(
        (F.col("left_ord") < F.col("right_ord")) & ~F.arrays_overlap("left_ids", "right_ids")
        & (either_other | (F.col("left_cat") == F.col("right_cat")))
    ).select(F.col("left_id").alias("place_id_1"), F.col("right_id").alias("place_id_2"),
             F.bround("distance_m", 1).alias("distance_m"), F.bround(F.col("similarity") * 100, 1).alias("name_score"))
