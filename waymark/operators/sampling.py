"""Stratified samples: quotas, special pools, rare categories and seeded fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymark.operators.ranking import top_n


def quotas(df: DataFrame, group: str, size: int, floor: int, capped: object | None = None, max_share: float = 0.15) -> DataFrame:
    """Exact quotas per group: a floor each, the rest by largest remainder, one group optionally capped.

    Only group counts enter; the ranking of remainders runs over one row per group.
    """
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    one = W.partitionBy(F.lit(1))
    rest = F.lit(size) - F.count("*").over(one) * floor
    base = counts.withColumns({"_rest": rest, "_total": F.sum("n").over(one)})
    cap = int(size * max_share)
    hit = F.col(group) == F.lit(capped) if capped is not None else F.lit(False)
    over = hit & (F.floor(F.col("n") / F.col("_total") * F.col("_rest")) + floor > cap)
    base = base.withColumn("_capped", F.coalesce(over, F.lit(False)))
    # the capped group leaves the proportional part, the others share what it does not take
    taken = F.max(F.when(F.col("_capped"), F.lit(cap - floor)).otherwise(F.lit(0))).over(one)
    weight = F.sum(F.when(F.col("_capped"), F.lit(0)).otherwise(F.col("n"))).over(one)
    share = F.when(F.col("_capped"), F.lit(0.0)).otherwise(F.col("n") / F.col("_w") * F.col("_left"))
    base = base.withColumns({"_left": F.col("_rest") - taken, "_w": weight}).withColumn("_share", share)
    base = base.withColumn("_whole", F.floor("_share"))
    spare = F.col("_left") - F.sum("_whole").over(one)
    order = W.partitionBy("_capped").orderBy((F.col("_share") - F.col("_whole")).desc(), F.col(group).asc())
    base = base.withColumns({"_spare": spare, "_pos": F.row_number().over(order)})
    extra = F.when(~F.col("_capped") & (F.col("_pos") <= F.col("_spare")), 1).otherwise(0)
    quota = F.when(F.col("_capped"), F.lit(cap)).otherwise(F.lit(floor) + F.col("_whole") + extra)
    return base.select(group, "n", quota.cast("bigint").alias("quota"))


def stratified_pick(df: DataFrame, key: str, group: str, category: str, quota: DataFrame, pools: list[tuple[str, DataFrame]], categories: list[str],
                    size: int, seed: int = 42) -> DataFrame:
    """Sample that fills every quota: special pools first, then categories not yet present, then seeded fill.

    `pools` are (reason, rows in order with their position `pos`) and small by construction. The random
    part takes the lowest hash values per group.
    """
    special = None
    for i, (reason, rows) in enumerate(pools):
        part = rows.select(key, F.lit(i).alias("_pool"), F.col("pos").cast("bigint").alias("pos"), F.lit(reason).alias("reason"))
        special = part if special is None else special.unionByName(part)
    first = special.groupBy(key).agg(F.min(F.struct("_pool", "pos", "reason")).alias("s"))
    base = df.select(key, group, category)
    ranked = first.join(base, key).withColumn("_rn", F.row_number().over(W.partitionBy(group).orderBy("s._pool", "s.pos", key)))
    chosen_a = ranked.join(quota, group).filter("_rn <= quota").select(key, group, category, F.col("s.reason").alias("selection_reason")).persist()
    try:
        # Categories still missing: the lowest id per (category, group) is all the pick can use,
        # so the table handled here is as small as categories x groups.
        absent = [c for c in categories if c not in {r[0] for r in chosen_a.select(category).distinct().collect()}]
        left = base.join(chosen_a.select(key), key, "left_anti")
        lowest = left.filter(F.col(category).isin(absent)).groupBy(category, group).agg(F.min(key).alias(key)).collect() if absent else []
        room = {r[group]: r["quota"] for r in quota.select(group, "quota").collect()}
        for r in chosen_a.groupBy(group).count().collect():
            room[r[group]] -= r["count"]
        rare = []
        for c in absent:
            for r in sorted((r for r in lowest if r[category] == c), key=lambda r: r[key]):
                if room.get(r[group], 0) > 0:
                    room[r[group]] -= 1
                    rare.append((r[key], r[group], c, f"rare_category_{c}"))
                    break
    finally:
        chosen_a.unpersist()
    picked = chosen_a
    if rare:
        picked = picked.unionByName(df.sparkSession.createDataFrame(rare, chosen_a.schema))
    used = picked.groupBy(group).agg(F.count("*").alias("_used"))
    open_rows = base.join(picked.select(key), key, "left_anti").withColumn("_h", F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    need = quota.join(used, group, "left").select(group, (F.col("quota") - F.coalesce("_used", F.lit(0))).alias("_need"))
    fill = top_n(open_rows, [group], [F.col("_h").asc(), F.col(key).asc()], size, "_rn").join(need, group).filter(F.col("_rn") <= F.col("_need"))
    return picked.unionByName(fill.select(key, group, category, F.lit("random_geographic_representation").alias("selection_reason")))


def pool(df: DataFrame, key: str, order: list[Column], n: int = 20) -> DataFrame:
    """First n rows in a total order, with their position."""
    top = df.orderBy(*order).limit(n)
    return top.withColumn("pos", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)))


def audit_sample(df: DataFrame, key: str, rules: dict[str, Column], ranked: dict[str, tuple[str, int]], lowest: tuple[str, int], seed: int = 7) -> DataFrame:
    """Union of sampling rules, each row once with the rules that chose it.

    rules: name -> condition; ranked: name -> (group column, n per group in hash order);
    lowest: (score column, n) for the rows of least confidence.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    score, n = lowest
    parts = [df.orderBy(F.col(score).asc_nulls_last(), F.col(key)).limit(n).select(key, F.lit("lowest_confidence").alias("rule"))]
    parts += [top_n(hashed, [g], [F.col("_h").asc(), F.col(key).asc()], m).select(key, F.lit(name).alias("rule")) for name, (g, m) in ranked.items()]
    parts += [df.filter(F.coalesce(cond, F.lit(False))).select(key, F.lit(name).alias("rule")) for name, cond in rules.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("rules"))
