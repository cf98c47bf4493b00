"""Joins on distance and text similarity without comparing everything to everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from waymark.functions import geo
from waymark.functions.similarity import block_ratio, gram_keys, indel_ratio, most_edits
from waymark.operators.skew import join_shuffled


def points_in_boxes(points: DataFrame, boxes: DataFrame, key: str, cell_deg: float = 0.25) -> DataFrame:
    """Range join of points to boxes (box_id, rank, min_lon, min_lat, max_lon, max_lat): the lowest rank wins.

    Boxes are cut into grid cells, so the join is an equi-join on the cell.
    Points come back with box_id, NULL when no box holds them.
    """
    cut = lambda c: F.floor(c / F.lit(cell_deg))
    cells = boxes.withColumn("gy", F.explode(F.sequence(cut(F.col("min_lat")), cut(F.col("max_lat"))))).withColumn(
        "gx", F.explode(F.sequence(cut(F.col("min_lon")), cut(F.col("max_lon")))))
    placed = points.withColumns({"gy": cut(F.col("lat")), "gx": cut(F.col("lon"))})
    hits = placed.join(cells, ["gy", "gx"]).filter(
        F.col("lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("lon").between(F.col("min_lon"), F.col("max_lon")))
    best = hits.groupBy(key).agg(F.min_by("box_id", "rank").alias("box_id"))
    return points.join(best, key, "left")


#: Height of a grid cell in radiuses: a point lies in reach of (1 + 2 / CELLS) ** 2 cells, 9, 4 or 2.25 for 1, 2 or 4.
CELLS = 4


def similar_within(left: DataFrame, right: DataFrame, radius_m: float, cut: float, measure: str = "indel", equal_texts: bool = True) -> DataFrame:
    """Pairs of left and right rows (id, text, lat, lon) at most `radius_m` apart with similarity >= cut.

    Rows of equal text and point are one spot. Spots meet on grid cell and text key (`gram_keys`), which is exact: a pair above
    the cut always shares a key, and keys grow with the length of a text. Distance, length and edit distance bounds follow
    before the score is computed once per surviving pair. With `equal_texts` off, pairs of equal texts (of equal `label`, where the
    rows have one) are left out in the join itself. Output: left_id, right_id, distance_m, similarity (0-1).

    The Ratcliff-Obershelp ratio never exceeds the indel ratio, so the same blocking holds for it.
    """
    usable = F.col("text").isNotNull() & (F.col("text") != "") & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    # a label only travels where it decides
    kind = "text" if equal_texts or "label" not in left.columns else "label"
    shape = list(dict.fromkeys(["text", kind, "lat", "lon"]))
    own = lambda side: [f"{side}{c}" for c in shape]
    left, right = left.filter(usable), right.filter(usable)
    spots = lambda df, side: df.select(*[F.col(c).alias(f"{side}{c}") for c in shape]).distinct()
    key = F.xxhash64("cell_y", "cell_x", "gram").alias("key")
    l = spots(left, "l").select("*", F.explode(geo.cells_within(F.col("llat"), F.col("llon"), radius_m, CELLS)).alias("c")).select(
        *own("l"), "c.cell_y", "c.cell_x", F.explode(gram_keys(F.col("ltext"), cut)).alias("gram")).select(*own("l"), key)
    y, x = geo.own_cell(F.col("rlat"), F.col("rlon"), radius_m, CELLS)
    r = spots(right, "r").select(*own("r"), y, x, F.explode(gram_keys(F.col("rtext"), cut)).alias("gram")).select(*own("r"), key)
    n, m = F.length("ltext"), F.length("rtext")
    edits = most_edits(n, m, cut)
    met = join_shuffled(l, r, "key").filter(F.abs(n - m) <= edits)
    if not equal_texts:
        met = met.filter(F.col(f"l{kind}") != F.col(f"r{kind}"))
    met = met.withColumn("distance_m", geo.haversine_m(F.col("llat"), F.col("llon"), F.col("rlat"), F.col("rlon"))).filter(F.col("distance_m") <= radius_m)
    spot = own("l") + own("r")
    pairs = met.select(*spot, "distance_m").dropDuplicates(spot).filter(F.levenshtein("ltext", "rtext") <= edits)
    score = indel_ratio(F.col("ltext"), F.col("rtext")) / 100.0 if measure == "indel" else block_ratio(F.col("ltext"), F.col("rtext"))
    good = pairs.withColumn("similarity", score).filter(F.col("similarity") >= F.lit(cut) - F.lit(1e-12))
    named = lambda df, side: df.select(F.col("id").alias(f"{side}_id"), *[F.col(c).alias(f"{side[0]}{c}") for c in shape])
    return join_shuffled(join_shuffled(good, named(left, "left"), own("l")), named(right, "right"), own("r")).select(
        "left_id", "right_id", "distance_m", "similarity")


def contained_names(nodes: DataFrame, radius_m: float) -> DataFrame:
    """Pairs where the whole words of one name appear in a row inside the other, within the radius.

    The shorter name equals one of the word runs of the longer one, so this is an equi-join.
    Output: part_id (shorter name), whole_id (longer name), distance_m.
    """
    words = F.split(F.col("text"), " ")
    n = F.size(words)
    runs = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(words, i, k), " ")))))
    y, x = geo.own_cell(F.col("lat"), F.col("lon"), radius_m)
    whole = nodes.select(
        F.col("id").alias("whole_id"), F.col("text").alias("wtext"), F.col("lat").alias("wlat"), F.col("lon").alias("wlon"),
        y, x, F.explode(runs).alias("part"))
    part = nodes.select(
        F.col("id").alias("part_id"), F.col("text").alias("part"), F.col("lat").alias("plat"), F.col("lon").alias("plon"),
        F.explode(geo.cells_within(F.col("lat"), F.col("lon"), radius_m)).alias("c")
    ).select("part_id", "part", "plat", "plon", "c.cell_y", "c.cell_x")
    d = geo.haversine_m(F.col("plat"), F.col("plon"), F.col("wlat"), F.col("wlon"))
    return join_shuffled(whole.filter("part <> wtext"), part, ["cell_y", "cell_x", "part"]).withColumn("distance_m", d).filter(
        F.col("distance_m") <= radius_m).select("part_id", "whole_id", "distance_m")


def nearest_named(records: DataFrame, places: DataFrame, region_ok: Column | None = None, radius_m: float = 100.0,
                  cut: float = 0.85) -> DataFrame:
    """Best place per record by name and distance: sim * (1 - 0.1 * d / radius), first place on ties.

    records: record_id, name, lat, lon (+ region); places: place_id, name, lat, lon, ord (+ region).
    """
    r = records.select(F.col("record_id").alias("id"), F.lower(F.trim("name")).alias("text"), "lat", "lon")
    p = places.select(F.col("place_id").alias("id"), F.lower(F.trim("name")).alias("text"), "lat", "lon")
    pairs = similar_within(r, p, radius_m, cut, "block").withColumnsRenamed({"left_id": "record_id", "right_id": "place_id"})
    pairs = join_shuffled(pairs, places.select("place_id", F.col("ord"), F.col("region").alias("place_region")), "place_id")
    pairs = join_shuffled(pairs, records.select("record_id", F.col("region").alias("record_region")), "record_id")
    if region_ok is not None:
        pairs = pairs.filter(region_ok)
    # rounded, so that places equally far away tie whatever the last digit of their distance is
    score = F.round(F.col("similarity") * (1.0 - (F.col("distance_m") / F.lit(radius_m)) * 0.1), 9)
    best = F.min(F.struct((-score).alias("neg"), F.col("ord"), F.col("place_id")))
    return pairs.groupBy("record_id").agg(best.alias("b")).select(
        "record_id", F.col("b.place_id").alias("place_id"), F.bround(-F.col("b.neg"), 2).alias("confidence"))
