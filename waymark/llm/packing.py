"""Packing into fixed-length sequences as a cutting-stock problem, solved by column generation.

Documents are cut into full sequences and a remainder. The histogram of remainder lengths (exact where short) is the demand; the
linear program over patterns starts from greedily filled patterns, a knapsack dynamic program prices new ones, and the solution
rounded down plus a first-fit for the few lengths left gives whole patterns with multiplicities. Only the histogram
reaches the driver: its size follows from capacity and grain (384 sizes at most here), whatever the corpus. Pieces are ranked within their length
and rank ranges map to pattern copies.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymark.llm import text as T
from waymark.llm.store import saved
from waymark.llm.tokens import encoder

CAPACITY = 4096


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, with_ids: bool = True,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens[, ids]): every document's ids with `end_id` at the end, cut at multiples of the capacity.

    A null or empty text is the end id alone. Repeated rows give repeated pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch):
        rows, at = [], []
        for i, raw in enumerate(encoder(tokenizer_path).encode(batch.column(1).to_pylist())):
            raw += end_id.to_bytes(4, "little")
            for k in range(0, len(raw), 4 * capacity):
                part = raw[k:k + 4 * capacity]
                rows.append((k // 4, len(part) // 4, zlib.crc32(part), len(raw) // 4, part))
                at.append(i)
        cols = list(zip(*rows))
        arrays = [batch.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[:4])]
        names = [id_col, "start", "length", "ids_crc32", "doc_tokens"]
        if with_ids:
            arrays, names = [*arrays, pa.array(cols[4], pa.binary())], [*names, "ids"]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"{id_col} {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return T.mapped(docs.select(id_col, text_col), run, schema, text_col)


def knapsack(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best value and counts of an unbounded knapsack; sizes ascending, items of no value stay out.

    Item by item: with k copies of a size, cells that lie k sizes apart are compared, so one running maximum over the rows
    of a table as wide as the size covers every number of copies. An item that smaller ones match is left out.
    """
    best, steps = np.zeros(capacity + 1), []
    for j, (s, v) in enumerate(zip(sizes.tolist(), values.tolist())):
        if v <= best[s] + 1e-12:
            continue
        rows = capacity // s + 1
        grid = np.full(rows * s, -np.inf)
        grid[:capacity + 1] = best
        bonus = (np.arange(rows) * v)[:, None]
        steps.append((j, s, v, best))
        best = (np.maximum.accumulate(grid.reshape(rows, s) - bonus, 0) + bonus).ravel()[:capacity + 1]
    counts, c = np.zeros(len(sizes), np.int64), capacity
    for j, s, v, before in reversed(steps):
        copies = np.arange(c // s + 1)
        counts[j] = int((before[c - copies * s] + copies * v).argmax())
        c -= int(counts[j]) * s
    return float(values @ counts), counts


def greedy_start(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible basis: pattern columns and how often each is used (fractions allowed).

    Each pattern is filled largest size first from the sizes still wanted and used until one of them is met. That size is its
    column, and no later pattern holds it, so the columns are triangular.
    """
    columns, used = np.diag(capacity // sizes).astype(float), np.zeros(len(sizes))
    rest = demand.copy()
    while (rest > 0).any():
        a, left = np.zeros(len(sizes)), capacity
        for j in np.flatnonzero(rest > 0)[::-1]:
            a[j], left = left // sizes[j], left % sizes[j]
        held = np.flatnonzero(a)
        r = held[(rest[held] / a[held]).argmin()]
        used[r], columns[:, r] = rest[r] / a[r], a
        rest = np.maximum(rest - used[r] * a, 0.0)
        rest[r] = 0.0
    return columns, used


def column_generation(demand: dict[int, int], capacity: int, rounds: int = 4000, gap: float = 1e-5) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: pieces} with their number of copies that meet the demand {size: pieces} exactly.

    The linear program is solved by the revised simplex method on the pattern columns. It ends when no column prices in, or
    when the Lagrangian bound of a round shows that `gap` of the sequences at most could be saved. `rounds` bounds the pricing
    steps; reaching it leaves a feasible, less tight solution.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    d = np.array([demand[int(s)] for s in sizes], float)
    columns, x = greedy_start(sizes, d, capacity)
    inverse = np.linalg.inv(columns)
    for step in range(rounds):
        duals = np.maximum(inverse.sum(0), 0.0)
        value, a = knapsack(sizes, duals, capacity)
        if value <= 1 + 1e-7 or x.sum() - d @ duals / value <= gap * x.sum():
            break
        y = inverse @ a
        ok = y > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, x / np.where(ok, y, 1), np.inf)
        r = int(ratio.argmin())
        step_to = max(ratio[r], 0.0)
        x = np.maximum(x - step_to * y, 0.0)
        x[r] = step_to
        columns[:, r] = a
        row = inverse[r] / y[r]
        inverse -= np.outer(y, row)
        inverse[r] = row
        if step % 200 == 199:
            inverse = np.linalg.inv(columns)
            x = np.maximum(inverse @ d, 0.0)
    left = d.astype(np.int64)
    out = []
    for j in np.argsort(-x, kind="stable"):
        a = columns[:, j].astype(np.int64)
        used = a > 0
        n = int(min(np.floor(x[j] + 1e-6), (left[used] // a[used]).min())) if used.any() else 0
        if n > 0:
            left -= n * a
            out.append(({int(s): int(k) for s, k in zip(sizes[used], a[used])}, n))
    return out + first_fit({int(s): int(n) for s, n in zip(sizes, left) if n}, capacity)


def first_fit(rest: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """What rounding left over, largest first into the fullest pattern that holds it."""
    open_: list[list] = []
    for s in sorted(rest, reverse=True):
        n = rest[s]
        while n:
            b = min((b for b in open_ if b[0] >= s), key=lambda b: b[0], default=None)
            if b is None:
                open_.append(b := [capacity, {}])
            k = min(n, b[0] // s)
            b[0] -= k * s
            b[1][s] = b[1].get(s, 0) + k
            n -= k
    return [(b[1], 1) for b in open_]


def ranked(df: DataFrame, group: str, order: list[str], name: str, rows: int) -> DataFrame:
    """Number rows 0, 1, .. within groups: by hash buckets within the group, so that no group is one task's work."""
    buckets = min(4096, max(16, rows // 2048))
    cut = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = cut.groupBy(group, "_b").agg(F.count("*").alias("_n"))
    before = sizes.select(group, "_b", (F.sum("_n").over(W.partitionBy(group).orderBy("_b")) - F.col("_n")).alias("_before"))
    local = cut.withColumn("_r", F.row_number().over(W.partitionBy(group, "_b").orderBy(*order)) - 1)
    return local.join(before, [group, "_b"]).withColumn(name, F.col("_r") + F.col("_before")).drop("_b", "_r", "_before")


def counted_length(length: Column, capacity: int, grain: int) -> Column:
    """The size a length counts as: the next multiple of its step, never above the capacity."""
    steps = [2**k for k in range(1, grain.bit_length()) if 2**k < grain] + [grain]
    step = F.greatest(F.lit(1), F.lit(1), *[F.when(length > 32 * s, s).otherwise(1) for s in steps])
    return F.least(F.ceil(length / step) * step, F.lit(capacity)).cast("int")


def pack(cut: DataFrame, capacity: int = CAPACITY, grain: int = 16, id_col: str = "doc_id") -> DataFrame:
    """The pieces with sequence_id and offset: no sequence is longer than the capacity, offsets have no gaps.

    `cut` has a row per piece (id, start, length 1 to capacity, ..); it is read several times, so it should be a table.
    While patterns are made a length counts as the next multiple of a step of at most a 32nd of it (1 up to 64 tokens, then
    2, 4, ..) and at most the grain, so short pieces have exact sizes and padding stays within a few per cent. No pieces
    give no rows. The capacity must be a multiple of the grain.
    """
    if capacity % grain:
        raise ValueError(f"a capacity of {capacity} is no multiple of {grain}")
    sized = cut.withColumn("_size", counted_length(F.col("length"), capacity, grain))
    demand = {r["_size"]: r["n"] for r in sized.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    plan = [({capacity: 1}, demand.pop(capacity))] if capacity in demand else []
    plan += column_generation(demand, capacity)
    total = sum(n * k for p, n in plan for k in p.values())
    # per size: rank ranges [.., end) with the first sequence and the pieces per sequence of the pattern that takes them
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for pattern, n in plan:
        for s, k in pattern.items():
            known = ranges.setdefault(s, [])
            begin = known[-1][1] if known else 0
            known.append((begin, begin + n * k, sequence, k))
        sequence += n
    table = cut.sparkSession.createDataFrame(
        [(s, [dict(zip(("begin", "end", "sequence", "per"), r)) for r in known]) for s, known in ranges.items()],
        "_size int, _ranges array<struct<begin:long,end:long,sequence:long,per:long>>")
    order = [id_col, "start", "length", "ids_crc32"]
    placed = ranked(sized, "_size", order, "_rank", total).join(F.broadcast(table), "_size")
    at = F.get("_ranges", F.size(F.filter("_ranges", lambda r: r["end"] <= F.col("_rank"))))
    placed = placed.withColumn("_at", at).withColumn(
        "sequence_id", F.col("_at.sequence") + F.floor((F.col("_rank") - F.col("_at.begin")) / F.col("_at.per")))
    within = W.partitionBy("sequence_id").orderBy(F.col("_size").desc(), "_rank").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0))).drop("_size", "_rank", "_ranges", "_at")


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY, grain: int = 16, with_ids: bool = False) -> DataFrame:
    """Documents to packed pieces: encoded once, the pieces kept as a table. Ids stay out of the ranking and meet their pieces once, at the end."""
    cut = pieces(docs, tokenizer_path, end_id, capacity, with_ids)
    if not with_ids:
        return pack(saved(cut), capacity, grain)
    cut = saved(cut.withColumn("_piece", F.monotonically_increasing_id()))
    placed = pack(cut.drop("ids"), capacity, grain)
    return placed.join(cut.select("_piece", "ids"), "_piece").select(*[c for c in cut.columns if c != "_piece"], "sequence_id", "offset")
