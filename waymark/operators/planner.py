"""Itinerary planning as a batch job over a table of requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymark.functions import geo
from waymark.functions.rules import contains_any, first_match, yes
from waymark.operators.containment import holders
from waymark.operators.durable import durable
from waymark.operators.filters import bare_region
from waymark.operators.ranking import top_n
from waymark.operators.skew import join_one_per_key

# Food words, slot templates per pace, price and cost defaults, travel pace.
FOOD_WORDS = ["kuliner", "culinary", "resto", "makanan"]
FOOD_SCORE_WORDS = ["kuliner", "culinary", "resto", "makanan", "café", "cafe"]
PACED_SLOTS = {
    "Padat": [("07:00 - 08:30 WIB", True), ("09:00 - 11:30 WIB", False), ("12:00 - 13:30 WIB", True), ("14:00 - 17:30 WIB", False), ("18:30 - 21:00 WIB", True)],
    "Santai": [("08:30 - 11:30 WIB", False), ("12:00 - 14:00 WIB", True), ("15:30 - 18:30 WIB", False)],
}
LOW_BUDGETS = ["Ekonomis", "Backpacker"]
MINUTES_PER_KM = 3.2
CHOICES = 5


def budget_score(tier: Column, price: Column) -> Column:
    """Step function of the price per budget tier."""
    low = first_match([(price <= 20000, 1.0), (price <= 35000, 0.75), (price <= 50000, 0.4)], 0.1)
    mid = first_match([(price.between(15000, 75000), 1.0), (price <= 120000, 0.7)], 0.3)
    high = first_match([(price >= 50000, 1.0), (price >= 25000, 0.6)], 0.3)
    return F.when(tier.isin(LOW_BUDGETS), low).when(tier == "Standar", mid).otherwise(high)


def category_score(category: Column, wanted: Column, is_food: Column) -> Column:
    """Food slots want food places; other slots want one of the requested categories, if any."""
    cat = F.lower(category)
    food = F.when(contains_any(cat, FOOD_SCORE_WORDS), F.lit(1.0)).otherwise(F.lit(0.3))
    asked = F.when(yes(F.exists(wanted, lambda w: cat.contains(F.lower(w)))), F.lit(1.0)).otherwise(F.lit(0.3))
    return F.when(is_food, food).when(F.size(wanted) > 0, asked).otherwise(F.lit(0.8))


def relevance(category: Column, wanted: Column, tier: Column, price: Column, rating: Column, is_food: Column) -> Column:
    """0.4 category + 0.4 budget + 0.2 rating, with defaults for missing price and rating."""
    paid = F.when(price > 0, price).otherwise(F.when(is_food, F.lit(25000.0)).otherwise(F.lit(15000.0)))
    stars = F.least(F.lit(1.0), F.coalesce(rating, F.lit(4.5)) / 5.0)
    return category_score(category, wanted, is_food) * 0.40 + budget_score(tier, paid) * 0.40 + stars * 0.20


def default_cost(tier: Column, is_food: Column) -> Column:
    by = lambda food, other: F.when(is_food, F.lit(food)).otherwise(F.lit(other))
    return F.when(tier == "Standar", by(45000.0, 35000.0)).when(tier == "Mewah", by(120000.0, 85000.0)).otherwise(by(25000.0, 15000.0))


def wished(categories: Column, primary: Column | None = None, any_label: str = "semua") -> Column:
    """The categories asked for, lower-cased and trimmed: the array, then the parts of the comma-separated text; the label for any category is left out."""
    named = F.filter(F.coalesce(categories, F.array().cast("array<string>")), lambda c: yes((c != "") & (F.lower(c) != any_label)))
    if primary is not None:
        parts = F.when(yes(F.lower(primary) != any_label), F.filter(F.split(primary, ","), lambda c: (c != "") & (F.trim(F.lower(c)) != any_label)))
        named = F.concat(named, F.coalesce(parts, F.array().cast("array<string>")))
    return F.array_distinct(F.transform(named, lambda c: F.trim(F.lower(c))))


def placed_items(items: DataFrame, asked: DataFrame, region: str = "pool_region") -> tuple[DataFrame, DataFrame]:
    """Items once per asked region that their region or address text contains, and once for the empty region, which stands for
    the whole catalog; and the asked regions that any item lies in. Regions are bare_region texts in the column `region`."""
    address = F.lower(F.coalesce("address", F.lit(""))) if "address" in items.columns else F.lit("")
    texts = items.select("*", bare_region(F.col("region")).alias("_reg"), address.alias("_addr"))
    index = holders(asked, region, texts.select(F.explode(F.array("_reg", "_addr")).alias("text")), "text")
    by = lambda key: index.select(F.col("text").alias(key), F.col("terms").alias(f"{key}_terms"))
    both = join_one_per_key(join_one_per_key(texts, by("_reg"), "_reg"), by("_addr"), "_addr")
    none = F.array().cast("array<string>")
    pools = F.array_append(F.array_union(F.coalesce("_reg_terms", none), F.coalesce("_addr_terms", none)), F.lit(""))
    served = index.select(F.explode("terms").alias(region)).distinct()
    return both.select(*items.columns, F.explode(pools).alias(region)), served


def served_region(requests: DataFrame, served: DataFrame, region: str = "pool_region") -> DataFrame:
    """Requests with the empty region where no item lies in theirs."""
    known = requests.join(served.select(F.col(region).alias("_known")), F.col(region) == F.col("_known"), "left")
    return known.withColumn(region, F.coalesce("_known", F.lit(""))).drop("_known")


def region_pools(placed: DataFrame, need: int) -> DataFrame:
    """The places that can be needed per region and pool, from which every request is served.

    A place's score for a request depends on category, price and rating only, and within one category and price band on the
    rating alone; so the `need` best rated places per region, category and band hold every possible choice.
    """
    cat = F.lower("category")
    food = contains_any(cat, FOOD_WORDS)
    # price limits of all tiers cut the price axis into bands of equal budget score
    band = F.size(F.filter(F.array(*[F.lit(float(b)) for b in (0, 15000, 20000, 25000, 35000, 50000, 75000, 120000)]), lambda b: F.col("price") > b))
    exact = F.size(F.filter(F.array(*[F.lit(float(b)) for b in (15000, 20000, 25000, 35000, 50000, 75000, 120000)]), lambda b: F.col("price") == b))
    rated = placed.select("*", cat.alias("_cat"), food.alias("is_food"), F.coalesce(band, F.lit(0)).alias("_band"), F.coalesce(exact, F.lit(0)).alias("_edge"),
                          F.least(F.lit(1.0), F.coalesce("rating", F.lit(4.5)) / 5.0).alias("_stars"))
    return top_n(rated, ["pool_region", "is_food", "_cat", "_band", "_edge"], [F.col("_stars").desc(), F.col("item_id").asc()], need).drop("_stars", "_band", "_edge", "_cat")


def plan(requests: DataFrame, items: DataFrame, seed: int = 42, max_days: int = 5) -> DataFrame:
    """Itinerary slots per request: request_id, day, slot, time, is_food, item_id, score.

    requests: request_id, region, wanted array, tier, pace, days and, if it is there, primary_category (comma-separated).
    items: item_id, region, address, category, price, rating.

    A request is served from the places whose region or address contains its region, or from the whole catalog where there are
    none; its wishes are cleaned by wished(), a missing tier is the middle one. `max_days` is the longest itinerary; longer requests end there.

    Per request only as many places as it has slots (plus the size of the draw) are kept per pool. The short sequential pick
    (best five unused, drawn by score with a seeded hash) is a fold over the slots, on two short lists per request. A pool
    whose places are all used gives its places again, in id order by the number of the slot.
    """
    need = max(len(s) for s in PACED_SLOTS.values()) * max_days + CHOICES
    wish = wished(F.col("wanted"), F.col("primary_category") if "primary_category" in requests.columns else None)
    req = requests.select("request_id", F.coalesce(F.when(F.col("tier") != "", F.col("tier")), F.lit("Standar")).alias("tier"), "pace", "days", bare_region(F.col("region")).alias("pool_region"), F.array_sort(wish).alias("wanted"))
    placed, served = placed_items(items, req)
    pools = region_pools(placed, need)
    req = served_region(req, served)
    has_food = pools.groupBy("pool_region").agg(F.bool_or("is_food").alias("has_food"), F.bool_or(~F.col("is_food")).alias("has_sights"))
    req = req.join(has_food, "pool_region")
    # what a place is worth depends on region, wished categories and budget only: score once per profile
    profile = ["pool_region", "wanted", "tier"]
    profiles = req.groupBy(*profile).agg(F.first("has_food").alias("has_food"), F.first("has_sights").alias("has_sights"))
    cand = profiles.join(pools.drop("region"), "pool_region")
    # a region without food places serves food slots from its sights, and the other way round
    uses = F.filter(F.array(
        F.when(F.col("is_food") | ~F.col("has_food"), F.lit("food")), F.when(~F.col("is_food") | ~F.col("has_sights"), F.lit("sight"))), lambda x: x.isNotNull())
    cand = cand.withColumn("pool", F.explode(uses)).withColumn(
        "score", F.round(relevance(F.col("category"), F.col("wanted"), F.col("tier"), F.col("price"), F.col("rating"), F.col("pool") == "food"), 8))
    short = top_n(cand, [*profile, "pool"], [F.col("score").desc(), F.col("item_id").asc()], need)
    # at most `need` entries per pool, so the lists are short whatever the catalog holds
    entry = F.struct((-F.col("score")).alias("neg"), F.col("item_id"))
    lists = short.groupBy(*profile).agg(*[F.array_sort(F.collect_list(F.when(F.col("pool") == p, entry))).alias(p) for p in ("food", "sight")])
    lists = req.select("request_id", "pace", "days", *profile).join(lists, profile)
    drawn = lists.select("request_id", F.explode(_drawn(seed, max_days, dict(items.dtypes)["item_id"])).alias("s"))
    return drawn.select("request_id", "s.*")


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _template(pace: list[tuple[str, bool]]) -> Column:
    return F.array(*[F.struct(F.lit(time).alias("time"), F.lit(food).alias("is_food")) for time, food in pace])


def _drawn(seed: int, max_days: int, item_kind: str) -> Column:
    """The filled slots of a request, folded from its columns request_id, pace, days, food and sight (best entries first)."""
    template = F.coalesce(F.create_map(*[x for k, v in PACED_SLOTS.items() for x in (F.lit(k), _template(v))])[F.col("pace")], _template(PACED_SLOTS["Santai"]))
    days = F.when(F.col("days") >= 1, F.sequence(F.lit(1), F.least(F.col("days").cast("int"), F.lit(max_days)))).otherwise(F.array().cast("array<int>"))
    slots = F.flatten(F.transform(days, lambda d: F.transform(template, lambda t, i: F.struct(d.alias("day"), i.alias("slot"), t["time"].alias("time"), t["is_food"].alias("is_food")))))
    row = f"struct<day:int,slot:int,time:string,is_food:boolean,item_id:{item_kind},score:double>"
    start = F.struct(F.array().cast(f"array<{item_kind}>").alias("used"), F.array().cast(f"array<{row}>").alias("rows"))

    def unit(s):
        text = F.concat_ws("|", F.lit(str(seed)), F.col("request_id").cast("string"), s["day"].cast("string"), s["slot"].cast("string"))
        return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)

    def picked(options, s):
        """The first option at which the running sum of scores reaches the draw."""
        begun = F.struct(F.lit(0.0).alias("sum"), F.lit(-1).alias("at"), F.lit(0).alias("n"))
        walk = lambda draw: F.aggregate(options, begun, lambda a, e: F.struct(
            (a["sum"] - e["neg"]).alias("sum"), F.when((a["at"] < 0) & (a["sum"] - e["neg"] >= draw), a["n"]).otherwise(a["at"]).alias("at"), (a["n"] + 1).alias("n")))
        # the draw hashes a text: once per slot, not once per option
        at = _let(unit(s) * F.aggregate(options, F.lit(0.0), lambda a, e: a - e["neg"]), lambda draw: walk(draw)["at"])
        return F.get(options, F.greatest(at, F.lit(0)))

    def step(acc, s):
        def use(pool):
            # so many entries from the front hold CHOICES unused ones, if the pool does
            front = F.slice(pool, F.lit(1), F.size(acc["used"]) + CHOICES)
            unused = F.slice(F.filter(front, lambda e: ~F.array_contains(acc["used"], e["item_id"])), 1, CHOICES)
            again = F.filter(F.array(F.get(F.array_sort(pool, lambda a, b: F.when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0)),
                                           F.pmod(s["slot"], F.greatest(F.size(pool), F.lit(1))))), lambda e: e.isNotNull())
            options = _let(unused, lambda free: F.when(F.size(free) > 0, free).otherwise(again))
            return _let(options, lambda options: _let(picked(options, s), put))

        def put(e):
            made = F.struct(s["day"].alias("day"), s["slot"].alias("slot"), s["time"].alias("time"), s["is_food"].alias("is_food"), e["item_id"].alias("item_id"), (-e["neg"]).alias("score"))
            return F.when(e.isNull(), acc).otherwise(F.struct(F.array_append(acc["used"], e["item_id"]).alias("used"), F.array_append(acc["rows"], made).alias("rows")))

        return _let(F.when(s["is_food"], F.col("food")).otherwise(F.col("sight")), use)

    return F.aggregate(slots, start, step, lambda acc: acc["rows"])


def legs(slots: DataFrame, default_point: tuple[float, float] = (-5.4292, 105.2611)) -> DataFrame:
    """Distance and minutes from the previous slot of the day, cost per slot and total per request.

    slots: request_id, day, slot, is_food, lat, lon, price, tier.
    """
    lat, lon = F.coalesce("lat", F.lit(default_point[0])), F.coalesce("lon", F.lit(default_point[1]))
    day = W.partitionBy("request_id", "day").orderBy("slot")
    df = slots.withColumns({"lat": lat, "lon": lon}).withColumns({"_y": F.lag("lat").over(day), "_x": F.lag("lon").over(day)})
    km = F.coalesce(geo.haversine_km(F.col("_y"), F.col("_x"), F.col("lat"), F.col("lon")), F.lit(0.0))
    cost = F.when(F.col("price") > 0, F.col("price")).otherwise(default_cost(F.col("tier"), F.col("is_food")))
    df = df.withColumns({"leg_km": F.round(km, 6), "leg_minutes": F.bround(km * MINUTES_PER_KM, 0), "cost": cost}).drop("_y", "_x")
    # an itinerary has at most days x slots rows
    return df.withColumn("total_cost", F.round(F.sum("cost").over(W.partitionBy("request_id")), 0))


def swap_alternatives(requests: DataFrame, items: DataFrame, exclusions: DataFrame, k: int = 3) -> DataFrame:
    """Best rated alternatives per swap request: request_id, rank, item_id, rating, review_count.

    A place fits whose region or address contains the request's region (the whole catalog where none does), that the request
    does not exclude and whose category contains the request's category; where no such place is left, any category fits.

    requests: request_id, region, category; exclusions: request_id, item_id; items may have an address.

    Lists are made per region and category asked for, best first, as deep as the most exclusions of their own requests plus k.
    They are cut into segments that double in length, and a request meets the segments down to its own exclusions plus k: never
    more than twice that many rows, however long another request's list is.
    """
    order = [F.col("rating").desc_nulls_last(), F.col("review_count").desc_nulls_last(), F.col("item_id").asc()]
    gone = exclusions.select("request_id", "item_id").distinct()
    own = gone.groupBy("request_id").agg(F.count("*").alias("_n"))
    asked = requests.select("request_id", bare_region(F.col("region")).alias("pool_region"), F.lower(F.trim(F.coalesce("category", F.lit("")))).alias("term"))
    placed, served = placed_items(items, asked)
    asked = join_one_per_key(served_region(asked, served), own, "request_id").withColumn("depth", F.coalesce("_n", F.lit(0)) + k).drop("_n")
    # each request asks for its category and, in case nothing is left of it, for any
    asked = durable(asked.select("request_id", "pool_region", "depth", F.explode(F.array_distinct(F.array("term", F.lit("")))).alias("term")))
    most = asked.agg(F.max("depth")).first()[0] or 0

    regions = asked.groupBy("pool_region").agg(F.max("depth").alias("_depth"))
    rated = placed.select("pool_region", F.lower(F.coalesce("category", F.lit(""))).alias("cat"), "item_id", "rating", "review_count")
    rated = rated.join(asked.select("pool_region").distinct(), "pool_region", "left_semi")
    best = top_n(rated, ["pool_region", "cat"], order, most, "rank").join(regions, "pool_region").filter(F.col("rank") <= F.col("_depth")).drop("rank", "_depth")
    named = holders(asked, "term", rated, "cat").withColumnRenamed("text", "cat")
    offered = join_one_per_key(best, named, "cat")
    offered = offered.select("pool_region", "item_id", "rating", "review_count", F.explode(F.array_append(F.coalesce("terms", F.array().cast("array<string>")), F.lit(""))).alias("term"))
    profiles = asked.groupBy("pool_region", "term").agg(F.max("depth").alias("_depth"))
    lists = top_n(offered.join(profiles, ["pool_region", "term"]), ["pool_region", "term"], order, most, "rank").filter(F.col("rank") <= F.col("_depth"))
    segment = lambda n: F.length(F.bin(n)) - 1
    lists = lists.select("pool_region", "term", segment(F.col("rank")).alias("segment"), "rank", "item_id", "rating", "review_count")
    meets = asked.select("*", F.explode(F.sequence(F.lit(0), segment(F.col("depth")))).alias("segment"))
    options = meets.join(lists, ["pool_region", "term", "segment"]).filter(F.col("rank") <= F.col("depth")).join(gone, ["request_id", "item_id"], "left_anti")
    options = top_n(options.select("request_id", F.col("term") == "", "item_id", "rating", "review_count").toDF("request_id", "wide", "item_id", "rating", "review_count"),
                    ["request_id", "wide"], order, k, "rank")
    narrow = W.partitionBy("request_id")
    use = options.withColumn("_narrow", F.bool_or(~F.col("wide")).over(narrow)).filter(F.col("wide") != F.col("_narrow"))
    return use.select("request_id", F.col("rank"), "item_id", "rating", "review_count")
