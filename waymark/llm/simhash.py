"""SimHash near-duplicates with pigeonring filtering.

A fingerprint is cut into tau + 1 segments in a ring. If two fingerprints differ in at most tau bits, some segment starts a
chain whose first l segments differ in at most floor(l * tau / (tau + 1)) bits for every l: the first is equal, the first
two differ in at most one bit, and so on. The first two conditions are the join key (one side spells out the one-bit
variants), the rest of the chain prunes the joined pairs, and only what is left gets the full Hamming check.

Equal fingerprints are one row before any join, so copies are never paired with each other.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from waymark.llm import text as T
from waymark.llm.components import components
from waymark.llm.store import checkpointed, saved

SEED = 42
#: Orders in which a bucket names a first fingerprint, to which the others are compared before all pairs are searched.
STAR_ORDERS = 8
#: Segments up to which the join's condition spells out all chains. With more, it is too long for the JVM to compile, and each of
#: the pairs that meet took thirteen microseconds; the few pairs within the bits then come from every chain that they share.
CHAIN_SEGMENTS = 4
_EIGHTHS = np.uint64(0x0101010101010101)


def simhashes(texts: list[str | None], width: int = 3) -> np.ndarray:
    """The fingerprint of each text: bit is 1 if set in over half the XXH64 hashes of its shingles; without words 0."""
    buf, start, stop, first = T.spelled_shingles(texts, width)
    h, n = T.xxh64(buf, start, stop, SEED), np.diff(first)
    some = np.flatnonzero(n)
    out = np.zeros(len(n), np.uint64)
    if len(some):
        # every eighth bit of a hash is a counter of one byte, so runs of at most 255 hashes are added as they are
        parts = -(-n[some] // 255)
        of = np.cumsum(parts) - parts
        cut = np.repeat(first[some] - 255 * of, parts) + 255 * np.arange(parts.sum())
        ones = np.stack([np.add.reduceat((h >> np.uint64(j)) & _EIGHTHS, cut).view(np.uint8).reshape(-1, 8) for j in range(8)], 2)
        bits = np.add.reduceat(ones.astype(np.int64), of) * 2 > n[some, None, None]
        out[some] = np.packbits(bits.reshape(len(some), 64), axis=1, bitorder="little").view("<u8").ravel()
    return out


def simhash(text: str | None, width: int = 3) -> int:
    """The fingerprint of one text."""
    return int(simhashes([text], width)[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of every row, as a signed number."""

    def run(batch):
        fp = simhashes(batch.column(1).to_pylist(), width).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=[id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return T.mapped(docs.select(id_col, text_col), run, f"{id_col} {kind}, fp long", text_col)


def _segments(tau: int) -> list[tuple[int, int]]:
    """(first bit, bits) of tau + 1 segments of nearly equal size."""
    m = tau + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: Column, seg: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, seg[0]).bitwiseAND(F.lit((1 << seg[1]) - 1).cast("bigint"))


def _ring(segs: list[tuple[int, int]], i: int, n: int) -> int:
    """The bits of n segments from segment i on, as a signed mask."""
    mask = 0
    for k in range(n):
        first, bits = segs[(i + k) % len(segs)]
        mask |= ((1 << bits) - 1) << first
    return mask - (1 << 64) if mask >> 63 else mask


def _size_step(least_size: float | None) -> Column:
    return F.lit(0) if least_size is None else F.floor(F.log(F.col("size") + 1.0) / math.log(1 / least_size)).cast("int")


def starred(distinct: DataFrame, tau: int, least_size: float | None = None) -> DataFrame:
    """Some of the pairs that `linked` gives, a few per fingerprint: each with the first, in several orders, of those that share
    two segments in a row with it.

    A dense group of n fingerprints meets here in a multiple of n pairs, after which its own pairs need not be made.
    """
    segs = _segments(tau)
    m = len(segs)
    fp = F.col("fp")
    keys = F.array(*[F.xxhash64(F.lit(i), _segment(fp, segs[i]), _segment(fp, segs[(i + 1) % m]), _size_step(least_size)) for i in range(m)])
    keyed = distinct.select("fp", F.explode(keys).alias("key"))
    firsts = F.array(*[F.min_by("fp", F.xxhash64("fp", F.lit(order))) for order in range(STAR_ORDERS)])
    least = keyed.groupBy("key").agg(F.array_distinct(firsts).alias("firsts"), F.count("*").alias("n")).filter("n > 1").select("key", F.explode("firsts").alias("a"))
    met = keyed.withColumnRenamed("fp", "b").join(least, "key").filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau))
    return met.select("a", "b").distinct()


def linked(distinct: DataFrame, tau: int = 2, least_size: float | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of a table of distinct fingerprints `fp` that differ in at most `tau` bits (1 to 15).

    With `least_size` the table also has `size`, and pairs whose sizes have a smaller ratio than that may be left out: sizes
    are part of the join key in steps of that ratio. If the table has `group`, pairs of one group (not null) are left out in the join.
    """
    if not 1 <= tau <= 15:
        raise ValueError("tau must be 1 to 15")
    segs = _segments(tau)
    m = len(segs)
    fp = F.col("fp")
    step = _size_step(least_size)
    sizes = [step] if least_size is None else [step, step - 1]

    def key(i: int, second: Column, size: Column) -> Column:
        """Ring position, first segment and second segment of a chain, and the size step; side by side where they fit, which keeps rows short."""
        if tau == 1:
            return F.xxhash64(F.lit(i), _segment(fp, segs[i]), second, size)
        head = F.shiftleft((size * 16 + i).cast("bigint"), 44)
        return head.bitwiseOR(F.shiftleft(_segment(fp, segs[i]), 22)).bitwiseOR(second)

    def variants(i: int) -> Column:
        masks = F.array(*[F.lit(mask).cast("bigint") for mask in (0, *(1 << j for j in range(segs[(i + 1) % m][1])))])
        return F.transform(masks, lambda mask: F.struct(F.lit(i).cast("tinyint").alias("i"), key(i, _segment(fp, segs[(i + 1) % m]).bitwiseXOR(mask), step).alias("key")))

    known = F.col("group") if "group" in distinct.columns else F.lit(None).cast("bigint")
    index = distinct.select(fp.alias("b"), known.alias("group_b"), step.alias("step_b"), F.explode(F.array(*[key(i, _segment(fp, segs[(i + 1) % m]), size) for size in sizes for i in range(m)])).alias("key"))
    probe = distinct.select(fp.alias("a"), known.alias("group_a"), step.alias("step_a"), F.explode(F.flatten(F.array(*[variants(i) for i in range(m)]))).alias("p")).select(
        "a", "group_a", "step_a", "p.i", "p.key")
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # the Hamming check comes first: nearly all that meet fail there
    near = F.bit_count(diff) <= tau
    if m <= CHAIN_SEGMENTS:
        # every prefix of the chain within its share of the budget; a pair is made once: at its first viable chain
        masks = F.array(*[F.lit(_ring(segs, i, n)).cast("bigint") for i in range(m) for n in range(1, m + 1)])

        def chain(i: Column) -> Column:
            return reduce(and_, [F.bit_count(diff.bitwiseAND(F.get(masks, i * m + (n - 1)))) <= n * tau // m for n in range(1, m + 1)])

        at = F.col("i").cast("int")
        near = reduce(and_, [near, chain(at), *[(at <= i) | ~chain(F.lit(i)) for i in range(m - 1)]])
    # and by the smaller fingerprint where both could ask for the other
    once = (F.col("step_a") != F.col("step_b")) | (F.col("a") < F.col("b"))
    pairs = probe.join(index, "key").filter((F.col("a") != F.col("b")) & F.coalesce(F.col("group_a") != F.col("group_b"), F.lit(True)) & once & near)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, tau: int = 2, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) of every row: 16 hex digits and the smallest id reachable over links of at most `tau` bits.

    A null or empty text has the fingerprint zero and is linked like any other. Rows with a null id take part in linking
    and get the smallest known id of their component, null if there is none. Repeated rows come back as often as they are given.
    """
    prints = checkpointed(fingerprints(docs, width, id_col, text_col))
    heads = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("head")))
    groups = components(linked(heads.select("fp"), tau))
    named = heads.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("head").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp", "left").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


#: Rows of a key table up to which it is broadcast (16 bytes each); beyond, the join shuffles.
BROADCAST_KEYS = 1_000_000


def _small(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _least_common(n: int, least: float) -> int:
    """Fewest common members of a set of `n` and any set that is at least `least` alike."""
    return math.ceil(least * n - 1e-9)


def _low_common(n: int, least: float) -> int:
    """Of the members of a set of `n` that `_low` gives, so many are common with the low members of any alike set that is not smaller."""
    return min(max(1, -(-n // 8)), _least_common(n, least))


def _low(n: int, least: float) -> int:
    """Lowest members of a set of `n`, as many as it can lose in an alike set and `_low_common` more."""
    return n - _least_common(n, least) + _low_common(n, least)


def _jaccard(pairs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b, set_a, set_b) whose sets have at least this Jaccard similarity."""

    def run(batches):
        for batch in batches:
            ends = [(c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (batch.column("set_a"), batch.column("set_b"))]
            keep = []
            for k in range(batch.num_rows):
                left, right = (v[o[k]:o[k + 1]] for o, v in ends)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(both >= least * (len(left) + len(right) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def _met(keys: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of every node with the first, in several orders, of those that share a key (x, node, size, place) with it.

    The keys of a set are its rarest members, one more than it can lose in a set that is `least` alike: alike sets share one.
    """
    firsts = F.array(*[F.min_by(F.struct("node", "size"), F.xxhash64("node", F.lit(order))) for order in range(STAR_ORDERS)])
    first = keys.groupBy("x").agg(F.array_distinct(firsts).alias("firsts"), F.count("*").alias("n")).filter("n > 1").select("x", F.explode("firsts").alias("f"))
    near = (F.col("size") >= least * F.col("f.size") - 1e-9) & (F.col("f.size") >= least * F.col("size") - 1e-9)
    stars = keys.join(first, "x").filter(near & (F.col("node") != F.col("f.node")))
    return stars.select(F.least("node", "f.node").alias("a"), F.greatest("node", "f.node").alias("b")).distinct()


def _rest(keys: DataFrame, groups: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of nodes of different groups that share a key and may be alike by their sizes and the places of the key."""
    known = keys.join(groups, "node", "left").withColumn("group", F.coalesce("root", "node")).drop("root")
    several = known.groupBy("x").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).filter("lo < hi").select("x")
    known = checkpointed(known.join(several, "x", "left_semi"))
    a, b = (known.select("x", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "size", "alone", "place", "group")]) for s in "ab")
    size_a, size_b = F.col("size_a"), F.col("size_b")
    # what both can have up to the key, of what other texts have too, and after it
    most = F.least(F.col("place_a") - F.col("alone_a"), F.col("place_b") - F.col("alone_b")) + F.least(size_a - F.col("place_a"), size_b - F.col("place_b"))
    may = (size_a >= least * size_b - 1e-9) & (size_b >= least * size_a - 1e-9) & (most >= least / (1 + least) * (size_a + size_b) - 1e-6)
    met = a.join(b, "x").filter((F.col("node_a") < F.col("node_b")) & (F.col("group_a") != F.col("group_b")) & may)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _rarest(sets: DataFrame, least: float) -> DataFrame:
    """Keys (x, node, size, alone, place) of sets (node, size, members): the rarest members, one more than a set can lose in one that is `least` alike."""
    member = sets.select("node", "size", F.explode("members").alias("x"))
    shared = member.groupBy("x").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = member.join(shared, "x").groupBy("node", "size").agg(F.array_sort(F.collect_list(F.struct("n", "x"))).alias("r"))
    # members that no other text has come first in the order and meet nothing
    alone = (F.col("size") - F.size("r")).cast("int")
    keys = (F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1 - alone).cast("int")
    return checkpointed(ranked.withColumns({"alone": alone, "keys": keys}).filter("keys > 0").select(
        "node", "size", "alone", F.posexplode(F.slice("r", F.lit(1), F.col("keys"))).alias("i", "r")).select("r.x", "node", "size", "alone", (F.col("alone") + F.col("i") + 1).alias("place")))


def _exact_groups(rows: DataFrame, tau: int, width: int, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As _banded_groups, by a search that misses no pair.

    Which texts can have a partner at all is read from their lowest shingle hashes: alike texts share many of them. Of those
    texts the rarest shingles are the keys of an equi-join, one more than a text can lose in an alike text. About a third of
    all shingle hashes is shuffled.
    """
    def sets(texts):
        x, first = T.WordBlock(texts).shingle_block(width)
        return [np.unique(x[a:b]) for a, b in zip(first[:-1], first[1:])]

    def run(batch):
        texts = batch.column(1).to_pylist()
        found = sets(texts)
        nodes = np.array([xxhash.xxh64_intdigest(u.tobytes(), SEED) for u in found], np.uint64).view(np.int64)
        low = [(u[:_low(len(u), least)] >> np.uint64(24)).astype(np.int64) for u in found]
        wanted = [_low_common(_least_common(len(u), least), least) for u in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes), pa.array(wanted, pa.int64()), pa.array(low, pa.list_(pa.int64()))], names=["key", "node", "wanted", "low"])

    prints = saved(T.mapped(rows.select("_key", "_text"), run, "key long, node long, wanted long, low array<long>", "_text"))
    heads = checkpointed(prints.groupBy("node").agg(F.min("key").alias("key")))
    # texts of which enough low shingles stand in other texts too; the cut hashes only let a few more through
    low = prints.join(heads, ["node", "key"]).select("node", "wanted", F.explode(F.array_distinct("low")).alias("x"))
    again = low.groupBy("x").agg(F.count("*").alias("n")).filter("n > 1").select("x")
    paired = low.join(again, "x").groupBy("node").agg(F.count("*").alias("n"), F.min("wanted").alias("wanted")).filter("n >= wanted").select("node")
    wanted = checkpointed(paired.join(heads, "node").select(F.col("key").alias("_key"), F.col("node").alias("_node")))

    def full(batch):
        texts = batch.column(1).to_pylist()
        found = sets(texts)
        nodes, fp = np.array([xxhash.xxh64_intdigest(u.tobytes(), SEED) for u in found], np.uint64).view(np.int64), simhashes(texts).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(fp), pa.array([len(u) for u in found], pa.int64()), pa.array([u.view(np.int64) for u in found], pa.list_(pa.int64()))],
                                         names=["node", "fp", "size", "members"])

    read = rows.select("_key", "_text").join(_small(wanted.select("_key").distinct()), "_key", "left_semi")
    alike = T.mapped(read, full, "node long, fp long, size long, members array<long>", "_text")
    alike = saved(alike.join(_small(wanted.select(F.col("_node").alias("node"))), "node", "left_semi").dropDuplicates(["node"]))

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda s: alike.select(F.col("node").alias(s), F.col("members").alias(f"set_{s}"))
        return checkpointed(_jaccard(checkpointed(pairs).join(side("b"), "b").join(side("a"), "a"), least))

    keys = _rarest(alike, least)

    # dense groups are joined by stars first; then only pairs between what is still apart are made
    of_print = checkpointed(alike.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("m")).select("fp", "m.node", "m.size"))
    bits = starred(of_print.select("fp", "size"), tau, least)
    bits = bits.join(of_print.select(F.col("fp").alias("a"), F.col("node").alias("x")), "a").join(of_print.select(F.col("fp").alias("b"), F.col("node").alias("y")), "b")
    same = alike.select("fp", F.col("node").alias("y")).join(of_print.select("fp", F.col("node").alias("x")), "fp").filter("x <> y")
    close = bits.select("x", "y").unionByName(same.select("x", "y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    first = verified(close.unionByName(_met(keys, least)).distinct())
    groups = components(first.unionByName(verified(_rest(keys, components(first), least))))
    return prints.select("key", "node"), heads, groups


#: MinHash values of a text for the candidates: bands of so many rows each.
BANDS, BAND_ROWS = 20, 5
#: An estimate from all values that lies so far below the bound is five standard deviations away.
SLACK = 0.2
#: Texts of a band up to which all its pairs are made; those of larger bands meet on their rarest shingles, which loses none.
BAND_PAIRS = 16
_RNG = np.random.default_rng(20)
_MULTIPLIERS = _RNG.integers(0, 1 << 63, BANDS * BAND_ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(members: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (rows: texts) of the shingle hashes that lie in one run; texts without shingles have zeros."""
    out = np.zeros((len(first) - 1, len(_MULTIPLIERS)), np.uint32)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        for k, m in enumerate(_MULTIPLIERS):
            out[some, k] = np.minimum.reduceat(members * m, first[some]) >> np.uint64(32)
    return out


def _estimated(pairs: DataFrame, heads: DataFrame, least: float) -> DataFrame:
    """(a, b, est) of the pairs whose share of equal MinHash values is at least `least`."""
    side = lambda s: heads.select(F.col("node").alias(s), F.col("sig").alias(f"sig_{s}"))

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b"))
            est = (x == y).mean(1) if batch.num_rows else np.zeros(0)
            keep = est >= least
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)), pa.array(est[keep])], names=["a", "b", "est"])

    return pairs.select("a", "b").join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long, est double")


def _texts_of(nodes: DataFrame, rows: DataFrame, heads: DataFrame) -> DataFrame:
    """(node, _text) of distinct nodes."""
    wanted = checkpointed(heads.join(nodes, "node").select("node", F.col("key").alias("_k"), F.col("t").alias("_u")))
    return rows.join(_small(wanted), (F.col("_key") == F.col("_k")) & (F.xxhash64(F.coalesce("_text", F.lit(""))) == F.col("_u"))).select("node", "_text").dropDuplicates(["node"])


def _verified(pairs: DataFrame, rows: DataFrame, heads: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts have a Jaccard similarity of at least `least`; the texts are read and shuffled, not stored."""
    pairs = checkpointed(pairs.select("a", "b").distinct())
    texts = _texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), rows, heads)
    side = lambda s: texts.select(F.col("node").alias(s), F.col("_text").alias(f"text_{s}"))

    def run(batch):
        (left, lf), (right, rf) = (T.WordBlock(batch.column(c).to_pylist()).shingle_block(width) for c in ("text_a", "text_b"))
        keep = []
        for k in range(batch.num_rows):
            x, y = np.unique(left[lf[k]:lf[k + 1]]), np.unique(right[rf[k]:rf[k + 1]])
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= least * (len(x) + len(y) - both) - 1e-9)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return checkpointed(T.mapped(pairs.join(side("b"), "b").join(side("a"), "a"), run, "a long, b long", "text_b"))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, size, members) of (node, _text): the distinct shingle hashes."""

    def run(batch):
        x, first = T.WordBlock(batch.column(1).to_pylist()).shingle_block(width)
        found = [np.unique(x[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(u) for u in found], pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["node", "size", "members"])

    return T.mapped(texts, run, "node long, size long, members array<long>", "_text")


def _of_prints(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of fingerprints as pairs of the texts that stand for them."""
    side = lambda s: prints.select(F.col("fp").alias(f"_{s}"), F.col("node").alias(s))
    return pairs.withColumnsRenamed({"a": "_a", "b": "_b"}).join(side("a"), "_a").join(side("b"), "_b").select("a", "b")


def _banded_groups(rows: DataFrame, tau: int, width: int, least: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(key, node) of every row, (node, key) of each distinct text's first row, and (node, root) of the linked nodes.

    Candidates are all pairs of fingerprints within `tau` bits, by `linked`, and the pairs that share one of BANDS bands of
    BAND_ROWS MinHash values, whatever their fingerprints; a pair of Jaccard 0.8 does with probability 0.9996. A dense group is
    joined by stars first: every text with the middle one and the first ones of its bands. The likeliest of each text are
    checked by the whole texts, then those that are still apart. Both searches then make only pairs between different groups;
    in bands of more than BAND_PAIRS texts, which one long passage can fill, alike texts are found by their rarest shingles.
    """
    def run(batch):
        texts = batch.column(1).to_pylist()
        x, first = T.WordBlock(texts).shingle_block(width)
        found = [np.unique(x[a:b]) for a, b in zip(first[:-1], first[1:])]
        nodes, fp = np.array([xxhash.xxh64_intdigest(u.tobytes(), SEED) for u in found], np.uint64).view(np.int64), simhashes(texts).view(np.int64)
        sig = [s.tobytes() for s in signatures(x, first)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes), pa.array(fp), pa.array([len(u) for u in found], pa.int64()), batch.column(2), pa.array(sig, pa.binary())],
                                         names=["key", "node", "fp", "size", "t", "sig"])

    given = rows.select("_key", "_text", F.xxhash64(F.coalesce("_text", F.lit(""))).alias("_t"))
    prints = saved(T.mapped(given, run, "key long, node long, fp long, size long, t long, sig binary", "_text"))
    least_row = F.min(F.struct("key", "t", "fp", "size", "sig"))
    heads = saved(prints.groupBy("node").agg(least_row.alias("m")).select("node", "m.*"))

    width_of = 4 * BAND_ROWS
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring(F.col("sig"), 1 + i * width_of, width_of)) for i in range(BANDS)])
    keys = heads.select("node", "size", F.explode(bands).alias("x"))
    shared = keys.groupBy("x").agg(F.count("*").alias("n")).filter("n > 1")
    keys = checkpointed(keys.join(shared, "x"))
    # the text in the middle of a dense group shares the most bands with others: all near it meet it
    middle = keys.groupBy("node").agg(F.sum("n").alias("met"))
    near = (F.col("size") >= least * F.col("f.size") - 1e-9) & (F.col("f.size") >= least * F.col("size") - 1e-9)
    entry = F.struct("node", "size")
    firsts = F.array(F.max_by(entry, F.struct("met", "node")), *[F.min_by(entry, F.xxhash64("node", F.lit(order))) for order in range(2)])
    first = keys.join(middle, "node").groupBy("x").agg(F.array_distinct(firsts).alias("firsts")).select("x", F.explode("firsts").alias("f"))
    stars = keys.join(first, "x").filter(near & (F.col("node") != F.col("f.node"))).select(F.col("node").alias("a"), F.col("f.node").alias("b"))
    of_print = checkpointed(heads.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("m")).select("fp", "m.node", "m.size"))
    same = heads.select("fp", F.col("node").alias("a")).join(of_print.select("fp", F.col("node").alias("b")), "fp").filter("a <> b")
    stars = stars.unionByName(same.select("a", "b")).distinct()
    stars = checkpointed(_estimated(stars, heads, least - SLACK))

    grouped = lambda df, s, groups: df.join(groups.select(F.col("node").alias(s), F.col("root").alias(f"_{s}")), s, "left").withColumn(f"_{s}", F.coalesce(f"_{s}", s))
    ordered = lambda df: df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    best = stars.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b"))
    links = _verified(best, rows, heads, width, least)
    groups = components(links)
    apart = grouped(grouped(stars.select("a", "b").join(best, ["a", "b"], "left_anti"), "a", groups), "b", groups).filter("_a <> _b")
    links = links.unionByName(_verified(ordered(apart), rows, heads, width, least))

    groups = components(links)
    known = keys.join(groups, "node", "left").withColumn("group", F.coalesce("root", "node"))
    several = known.groupBy("x").agg(F.min("group").alias("lo"), F.max("group").alias("hi"), F.count("*").alias("here")).filter("lo < hi").select("x", "here")
    known = checkpointed(known.select("x", "node", "size", "group").join(several, "x"))
    one, two = (known.filter(F.col("here") <= BAND_PAIRS).select("x", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "size", "group")]) for s in "ab")
    may = (F.col("size_a") >= least * F.col("size_b") - 1e-9) & (F.col("size_b") >= least * F.col("size_a") - 1e-9)
    met = one.join(two, "x").filter((F.col("node_a") < F.col("node_b")) & (F.col("group_a") != F.col("group_b")) & may).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    wide = checkpointed(known.filter(F.col("here") > BAND_PAIRS).select("node").distinct())
    if not wide.isEmpty():
        met = met.unionByName(_rest(_rarest(_sets(_texts_of(wide, rows, heads), width), least), groups, least))
    # the rarest shingles have already given all alike pairs of texts of large bands: to the bits these are one group
    in_groups = of_print.join(groups.unionByName(wide.select("node", F.lit(0).cast("bigint").alias("root"))).groupBy("node").agg(F.min(F.struct(F.col("root") != 0, "root")).alias("g")), "node", "left")
    in_groups = in_groups.select("fp", "size", F.col("g.root").alias("group"))
    # each search is a plan of its own: planned together they filled the driver
    met = checkpointed(met.distinct())
    bits = _of_prints(checkpointed(linked(checkpointed(in_groups), tau, least)), of_print)
    rest = ordered(met.unionByName(bits)).join(ordered(stars), ["a", "b"], "left_anti")
    rest = _estimated(rest, heads, least - SLACK)
    return prints.select("key", "node"), heads.select("node", "key"), components(links.unionByName(_verified(rest, rows, heads, width, least)))


def one_of_each_group(docs: DataFrame, tau: int = 8, width: int = 5, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """The rows that stay when one document of each group of near duplicates is kept, the one with the smallest id.

    Documents are linked when the sets of `width`-word shingles of their texts have a Jaccard similarity of at least `least`;
    equal sets are one node, and equal SimHashes (of three-word shingles) link nothing by themselves. Candidates come from
    MinHash bands and, within `tau` bits, from SimHash chains, and every link is checked on the whole texts, so no document
    goes without a near copy; of the pairs at the bound about 4 in 10,000 are not found, of likelier ones fewer. `exact`
    searches by the rarest shingles instead and finds all, at several times the shuffle.

    Rows without an id count as larger than any id; repeated rows, and all null, empty and blank texts, are one group each.
    All columns are kept.
    """
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(1 << 62).cast("bigint") + F.pmod(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.lit(1 << 61).cast("bigint")))
    rows = docs.select(key.alias("_key"), F.col(text_col).alias("_text"), F.struct(*docs.columns).alias("_row"))
    prints, heads, groups = (_exact_groups if exact else _banded_groups)(rows, tau, width, least)
    label = heads.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    stays = label.groupBy("root").agg(F.min("key").alias("first"))
    kept = label.join(stays, "root").select("node", "first")
    gone = checkpointed(prints.join(kept, "node").filter(F.col("key") != F.col("first")).select(F.col("key").alias("_key")).distinct())
    left = rows.join(_small(gone), "_key", "left_anti")
    # rows that repeat an id: only those are few enough to be numbered
    twice = checkpointed(prints.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("_key")))
    if twice.isEmpty():
        return left.select("_row.*")
    again = left.join(_small(twice), "_key", "left_semi").withColumn("_n", F.row_number().over(W.partitionBy("_key").orderBy(F.col("_text").asc_nulls_first())))
    return left.join(_small(twice), "_key", "left_anti").unionByName(again.filter("_n = 1").drop("_n")).select("_row.*")
