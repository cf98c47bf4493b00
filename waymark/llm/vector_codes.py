"""Vector code compression: product quantisation trained by an active-entry Lloyd iteration in whole numbers.

Every component x becomes floor(256 x), a vector is cut into equal parts, and each part position has its own codebook. A
Lloyd round assigns all parts, then moves every used entry to the floored mean of its parts. A part keeps the exact squared
distance to its entry. In the next round, if that entry has not moved, nothing but the moved entries can have come nearer,
so only these are compared with the stored distance; a part whose own entry moved is compared with all. Ties go to the
lower index in both cases, so the codes equal those of a full search.

The state (whole-number parts, codes, distances) is a Parquet table in the shared folder per round; what reaches the driver
is the codebook and its sums, whose size the arguments fix.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from waymark.llm.store import checkpointed, saved

#: Largest |floor(256 x)|: squared distances summed over a vector then fit 64 bits.
LARGEST = 1 << 26
#: Labels up to which their sums are broadcast (the rows are counted); beyond, rows meet them on label and salt.
BROADCAST_LABELS = 50_000
SALTS = 32
BLOCK = 4096

_STATE = "vec_id bigint, label bigint, v binary, code binary, dist binary, error bigint, compared bigint"


def usable(vector: Column, scale: int) -> Column:
    """Not null, all components there, finite and within the range of whole-number arithmetic."""
    most = F.lit(float(LARGEST) / scale)
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce((x >= -most) & (x < most), F.lit(False)))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry for every row, the lower index on ties."""
    d = np.zeros((len(x), len(book)), np.int64)
    for k in range(x.shape[1]):
        d += np.square(x[:, k, None] - book[None, :, k])
    at = d.argmin(1)
    return at, d[np.arange(len(x)), at]


def reassign(x: np.ndarray, code: np.ndarray, dist: np.ndarray, book: np.ndarray, moved: np.ndarray) -> int:
    """Update code and dist in place against a book some of whose entries moved; returns the comparisons made."""
    entries = np.flatnonzero(moved)
    own = moved[code]
    stale, still = np.flatnonzero(own), np.flatnonzero(~own)
    if len(stale):
        code[stale], dist[stale] = nearest(x[stale], book)
    if len(still) and len(entries):
        at, d = nearest(x[still], book[entries])
        at = entries[at]
        won = (d < dist[still]) | ((d == dist[still]) & (at < code[still]))
        code[still[won]], dist[still[won]] = at[won], d[won]
    return len(stale) * len(book) + len(still) * len(entries)


def _first(batch, dim: int, parts: int, scale: int) -> np.ndarray:
    """Whole-number parts of a batch of vectors."""
    flat = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(flat * scale).astype(np.int64).reshape(-1, parts, dim // parts)


def _assigner(books: np.ndarray, moved: np.ndarray | None, dim: int, scale: int):
    """Arrow function of one round: rows of (vec_id, label, embedding) at first, of the state afterwards."""
    parts = len(books)

    def block(b):
        n = b.num_rows
        if moved is None:
            x = _first(b, dim, parts, scale)
            code, dist = np.zeros((n, parts), np.int64), np.zeros((n, parts), np.int64)
            compared = np.full(n, parts * books.shape[1], np.int64)
            for p in range(parts):
                code[:, p], dist[:, p] = nearest(x[:, p], books[p])
        else:
            joined = lambda k, kind: np.frombuffer(b"".join(b.column(k).to_pylist()), kind)
            x = joined(2, "<i4").astype(np.int64).reshape(n, parts, -1)
            code, dist = joined(3, np.uint8).astype(np.int64).reshape(n, parts), joined(4, "<i8").reshape(n, parts).copy()
            compared = b.column(6).to_numpy().copy()
            for p in range(parts):
                c, d = code[:, p].copy(), dist[:, p].copy()
                own = moved[p][c]
                compared += np.where(own, books.shape[1], moved[p].sum())
                reassign(x[:, p], c, d, books[p], moved[p])
                code[:, p], dist[:, p] = c, d
        bytes_of = lambda a, kind: pa.array([r.tobytes() for r in a.astype(kind)], pa.binary())
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), bytes_of(x, "<i4"), bytes_of(code, np.uint8), bytes_of(dist, "<i8"), pa.array(dist.sum(1)), pa.array(compared)],
                                          ["vec_id", "label", "v", "code", "dist", "error", "compared"])

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, BLOCK):
                yield block(b.slice(k, BLOCK))

    return run


def _sums(state: DataFrame, parts: int, entries: int) -> tuple[dict, dict]:
    """Componentwise sums and counts of the parts of every entry, added up in each task before they meet."""
    def partial(batches):
        total, count = None, np.zeros(parts * entries, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4").astype(np.int64).reshape(b.num_rows * parts, -1)
            slot = (np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).astype(np.int64).reshape(-1, parts) + np.arange(parts) * entries).ravel()
            if total is None:
                total = np.zeros((parts * entries, x.shape[1]), np.int64)
            np.add.at(total, slot, x)
            count += np.bincount(slot, minlength=parts * entries)
        if total is not None:
            used = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used].tolist(), pa.list_(pa.int64())), pa.array(count[used])], ["slot", "total", "n"])

    rows = state.select("v", "code").mapInArrow(partial, "slot bigint, total array<bigint>, n bigint")
    rows = rows.select("slot", "n", F.posexplode("total").alias("at", "s")).groupBy("slot", "at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    return {(r.slot, r.at): int(r.s) for r in rows}, {r.slot: r.n for r in rows}


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error, compared) of every usable row, and the final codebooks (parts x entries x width).

    Rows are dropped whose vector is null or empty, holds null or non-finite components or ones from 2^26 / scale on, or has
    another length than the usable vector of the smallest id whose length is a multiple of `parts`. The codebooks start as
    the parts of the vectors with the smallest ids; a null id counts as the largest, equal ids are taken in the order of
    their vectors, so repeated rows may give equal entries, of which the first is used. Fewer rows than entries give smaller
    codebooks. `compared` counts the entries a row's parts were compared with in all rounds. An empty table gives no rows.
    """
    if entries > 256:
        raise ValueError("a code is one byte: at most 256 entries")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("v"))
    rows = rows.filter(usable(F.col("v"), scale) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    head = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).collect()
    dim = len(head[0].v) if head else parts
    rows = rows.filter(F.size("v") == dim)
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    books = np.floor(np.array([r.v for r in start], np.float64).reshape(len(start), dim) * scale).astype(np.int64).reshape(-1, parts, dim // parts).transpose(1, 0, 2).copy()
    moved, state = None, rows
    if not start:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, label bigint, code string, error bigint, compared bigint"), books
    for k in range(rounds + 1):
        state = saved(state.mapInArrow(_assigner(books, moved, dim, scale), _STATE))
        if k < rounds:
            total, count = _sums(state, parts, books.shape[1])
            new = books.copy()
            for slot, n in count.items():
                p, e = divmod(slot, books.shape[1])
                new[p, e] = [total[slot, i] // n for i in range(dim // parts)]
            moved, books = (new != books).any(2), new
    return state.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), "error", "compared"), books


def books_sha256(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over the rows of the same label, null labels together.

    The sums are broadcast while their rows are few (counted); beyond, rows meet them on label and one of SALTS salts, so a
    label with a third of all rows is spread.
    """
    sums = checkpointed(coded.groupBy("label").agg(F.sum("error").alias("label_error")))
    # the label as an array: equal nulls match in an equi-join
    side = sums.select(F.array("label").alias("_l"), "label_error")
    if sums.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(side), F.array("label") == F.col("_l")).drop("_l")
    salted = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("_own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, (F.array("label") == F.col("_l")) & (F.col("_own") == F.col("_salt"))).drop("_l", "_salt", "_own")
