"""Hidden Markov language model.

Every word of the training texts has emission counts of its own and the end of a text is a symbol too; a word that training
has not seen is one more symbol. A start state is drawn, then every token is a transition and an emission.

Baum-Welch runs all its rounds over all training texts. The texts are cut once into parts of whole texts, written as
numbers of the part's own distinct words. A round is an E-step per part (expected counts of the part's words), a sum over
parts per range of word hashes, each word once, and a table of sums laid out by part, from which the parts read their words'
emissions in the next round. The layout of the round before and the shuffle of the E-step are gone before the next layout is
made, so only one of them takes disk at a time. So the emission table is as long as the vocabulary, no task or driver holds it whole, and nothing but the
transition matrix and totals travels with the tasks. Exact likelihoods come from the scaled forward recursion; only texts
longer than a segment need transfer matrices, which are multiplied up side by side and chained per text.
"""

from __future__ import annotations

import gc
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from waymark.llm import text as T
from waymark.llm.store import opened, remove, saved, shared_folder

SEGMENT = 1024
RESCALE = 8
SMOOTH = 4.0
STATS = -1  # the part of rows that hold totals


@dataclass
class Model:
    """Start, transition and emission probabilities; `emit` has a row per symbol."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Lattice:
    """Texts as segments of at most SEGMENT tokens, longest first, with their places in each text."""

    def __init__(self, sym: np.ndarray, first: np.ndarray, model: Model):
        self.model, self.sym = model, sym
        length = np.diff(first)
        count = -(-length // SEGMENT)
        doc = np.repeat(np.arange(len(length)), count)
        place = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        begin = first[:-1][doc] + place * SEGMENT
        size = np.minimum(SEGMENT, first[1:][doc] - begin)
        order = np.argsort(-size, kind="stable")
        self.doc, self.place, self.begin, self.size = doc[order], place[order], begin[order], size[order]
        self.steps = int(size.max()) if len(size) else 0
        self.active = np.searchsorted(-self.size, -np.arange(self.steps), "left")  # segments longer than t
        self.n_docs = len(length)
        # segments of texts that have several, and those by place: one of each text at most
        self.chained = np.flatnonzero(count[self.doc] > 1)
        by_place = self.chained[np.argsort(self.place[self.chained], kind="stable")]
        self.rounds = np.split(by_place, np.flatnonzero(np.diff(self.place[by_place])) + 1) if len(by_place) else []

    def seen(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.begin[:self.active[t]] + t
        return at, self.model.emit[self.sym[at]]

    def transfer(self) -> np.ndarray:
        """Products of transition and emission matrices of the chained segments, each up to a factor."""
        k, segs = len(self.model.start), self.chained
        m = np.tile(np.eye(k), (len(segs), 1, 1))
        active = np.searchsorted(-self.size[segs], -np.arange(self.steps), "left")
        for t, a in enumerate(active):
            if not a:
                break
            b = self.model.emit[self.sym[self.begin[segs[:a]] + t]]
            m[:a] = (m[:a].reshape(-1, k) @ self.model.move).reshape(a, k, k) * b[:, None, :]
            if t % RESCALE == RESCALE - 1:
                m[:a] /= m[:a].max((1, 2))[:, None, None]
        out = np.zeros((len(self.doc), k, k)) if len(segs) else np.zeros((0, k, k))
        if len(segs):
            out[segs] = m
        return out

    def forward(self, keep: list | None = None) -> np.ndarray:
        """Natural log-likelihood of every text; the state distributions before every step go to `keep`."""
        k = len(self.model.start)
        self.matrix = self.transfer()
        state = np.tile(self.model.start, (self.n_docs, 1))
        alpha = np.tile(self.model.start, (len(self.doc), 1))
        for segs in self.rounds:
            d = self.doc[segs]
            alpha[segs] = state[d]
            a = np.einsum("ns,nst->nt", state[d], self.matrix[segs])
            state[d] = a / a.sum(1)[:, None]
        logs = np.zeros(len(self.doc))
        if keep is not None:
            keep.append(alpha)
        for t in range(self.steps):
            _, b = self.seen(t)
            x = (alpha[:len(b)] @ self.model.move) * b
            s = x @ np.ones(k)
            alpha = x / s[:, None]
            logs[:len(b)] += np.log(s)
            if keep is not None:
                keep.append(alpha)
        return np.bincount(self.doc, logs, minlength=self.n_docs)

    def expected(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected emission, transition and start counts and the log-likelihood of all texts."""
        model, k = self.model, len(self.model.start)
        alphas: list[np.ndarray] = []
        total = self.forward(alphas)
        beta = np.ones((len(self.doc), k))
        state = np.ones((self.n_docs, k))
        for segs in reversed(self.rounds):
            d = self.doc[segs]
            beta[segs] = state[d]
            b = np.einsum("nst,nt->ns", self.matrix[segs], state[d])
            state[d] = b / b.sum(1)[:, None]
        emitted = np.zeros((len(self.sym), k))
        moved = np.zeros((k, k))
        one = np.ones(k)
        for t in range(self.steps - 1, -1, -1):
            at, b = self.seen(t)
            a = len(at)
            g = alphas[t + 1] * beta[:a]
            emitted[at] = g / (g @ one)[:, None]
            w = b * beta[:a]
            back = w @ model.move.T
            past = alphas[t][:a]
            moved += past.T @ (w / ((past * back) @ one)[:, None])
            beta[:a] = back / (back @ one)[:, None]
        begin = model.start * beta[self.place == 0]
        counts = np.stack([np.bincount(self.sym, emitted[:, s], minlength=len(model.emit)) for s in range(k)], 1)
        return counts, moved * model.move, (begin / begin.sum(1)[:, None]).sum(0), float(total.sum())


@dataclass
class Totals:
    """What tasks need beside the counts of their own words."""

    states: int
    words: float  # training words
    types: float  # distinct training words
    ends: int
    start: np.ndarray
    move: np.ndarray
    shares: np.ndarray  # of the states
    end_counts: np.ndarray
    norm: np.ndarray  # sum of all symbols' weights, by state

    @property
    def mass(self) -> float:
        """All smoothed training counts: 0.5 more for every word, the end and an unknown word."""
        return self.words + self.ends + 0.5 * (self.types + (self.ends > 0) + 1)


def noise(words: np.ndarray, states: int) -> np.ndarray:
    """Exponential draws by word and state, from the word's hash: where Baum-Welch starts."""
    seeds = np.arange(1, states + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    u = (T.mixed(words[:, None] ^ seeds[None, :]) >> np.uint64(11)).astype(float) / 2.0**53
    return 0.1 - np.log1p(-u)


def emissions(words: np.ndarray, n: np.ndarray, sums: np.ndarray | None, of: Totals) -> np.ndarray:
    """Emission rows of words with training counts `n` and expected counts `sums`, then the end's.

    A word's posterior over the states is smoothed with SMOOTH counts towards the overall shares of the states, and its
    emissions are its smoothed share times that posterior over the state's share: a rare word stays near the unigram
    model and an unknown one is there.
    """
    weight = np.append(n + 0.5, of.ends + 0.5)[:, None] / of.mass
    if sums is None:
        lean = np.vstack((np.where(n[:, None] > 0, noise(words, of.states), 1.0), np.ones(of.states)))
    else:
        c = np.vstack((sums, of.end_counts))
        lean = (c + SMOOTH * of.shares) / (np.append(n, of.ends)[:, None] + SMOOTH) / of.shares
    return weight * lean / of.norm


def parted(rows: DataFrame, id_col: str, text_col: str, part_chars: int) -> DataFrame:
    """Parts of whole texts (about `part_chars` characters): ids, marks, the sorted hashes of the part's words, and the
    texts in a row as places among them, with an end (the number of words) after each text."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        task, made, held, chars = TaskContext.get().partitionId(), 0, [], 0

        def part():
            ids, marks, hashes, lengths = zip(*held)
            words, at = np.unique(np.concatenate(hashes), return_inverse=True)
            lengths = np.concatenate(lengths)
            first = np.concatenate(([0], np.cumsum(lengths + 1)))
            sym = np.full(first[-1], len(words), np.int32)
            inside = np.ones(first[-1], bool)
            inside[first[1:] - 1] = False
            sym[inside] = at
            whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), pa.concat_arrays(x))
            return pa.RecordBatch.from_arrays(
                [pa.array([task << 24 | made]), whole(ids), whole(marks), pa.array([len(words)], pa.int64()), pa.array([words.tobytes()]), pa.array([first.astype(np.int64).tobytes()]),
                 pa.array([sym.tobytes()])], names=["part", "ids", "marks", "n_words", "words", "first", "sym"])

        for b in batches:
            sizes = [len(t or "") for t in b.column(1).to_pylist()]
            for lo, hi in T.blocks(sizes, min(part_chars, 1 << 20)):
                block = T.WordBlock(b.column(1).slice(lo, hi - lo).to_pylist())
                held.append((b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo), block.hashes, np.diff(block.first)))
                chars += sum(sizes[lo:hi])
                if chars >= part_chars:
                    yield part()
                    made, held, chars = made + 1, [], 0
        if held:
            yield part()

    return saved(rows.select(id_col, text_col, "held_out").mapInArrow(
        run, f"part long, ids array<{kind}>, marks array<boolean>, n_words long, words binary, first binary, sym binary"))


def _piece(folder: str, part: int, dtype, width: int) -> np.ndarray:
    """A part's sums in the order of its words."""
    fs, path = opened(folder)
    t = pq.read_table(f"{path}/part={part}", filesystem=fs, partitioning=None).sort_by("bucket")
    return np.frombuffer(b"".join(t.column("data").to_pylist()), dtype).reshape(-1, width)


def _loaded(batch, i: int, counts: str | None = None, sums: str | None = None, of: Totals | None = None):
    """Number, words, places of texts, symbols, training counts and expected counts of a part."""
    part = batch.column("part")[i].as_py()
    array = lambda c, d: np.frombuffer(batch.column(c)[i].as_buffer() or b"", d)
    words, first, sym = array("words", np.uint64), array("first", np.int64), array("sym", np.int32)
    read = lambda folder, dtype, width: _piece(folder, part, dtype, width) if len(words) else np.zeros((0, width), dtype)
    n = read(counts, np.float64, 1)[:, 0] if counts else None
    return part, words, first, sym, n, read(sums, np.float32, of.states) if sums else None


def _texts(first: np.ndarray, sym: np.ndarray, chosen: np.ndarray, limit: int = 1 << 18):
    """The chosen texts in runs of about `limit` tokens, of like length (few steps do for a run): (numbers, places, firsts)."""
    size = np.diff(first)[chosen]
    order = np.argsort(size, kind="stable")
    for lo, hi in T.blocks(size[order].tolist(), limit):
        docs = chosen[order[lo:hi]]
        n = size[order[lo:hi]]
        begin = np.concatenate(([0], np.cumsum(n)))
        yield docs, sym[np.arange(begin[-1]) + np.repeat(first[docs] - begin[:-1], n)], begin


def _lattices(words: np.ndarray, n: np.ndarray, sums: np.ndarray | None, of: Totals, first: np.ndarray, sym: np.ndarray, chosen: np.ndarray):
    """(numbers of the texts, their symbols, lattice) of the chosen texts, each run with the emissions of its own symbols only."""
    for docs, s, begin in _texts(first, sym, chosen):
        own, at = np.unique(s, return_inverse=True)
        w = own[:-1]  # the end is the last
        yield docs, own, Lattice(at, begin, Model(of.start, of.move, emissions(words[w], n[w], None if sums is None else sums[w].astype(float), of)))


def _training(batch, i: int) -> np.ndarray:
    return np.flatnonzero(~np.asarray(batch.column("marks")[i].values.to_numpy(zero_copy_only=False), bool))


def _cut(part: int, words: np.ndarray, data: np.ndarray | None, stats: np.ndarray | None, buckets: int):
    """One row per range of word hashes, and one with totals if there are any; without `data` the words alone."""
    bucket = ((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    edges = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1, [len(words)])) if len(words) else np.zeros(1, int)
    spans = list(zip(edges[:-1], edges[1:]))
    end = [] if stats is None else [stats.tobytes()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[a]) for a, _ in spans] + [-1 - part % 64] * len(end), pa.int64()), pa.array([part] * (len(spans) + len(end)), pa.int64()),
         pa.array([words[a:b].tobytes() for a, b in spans] + [b""] * len(end), pa.binary()),
         pa.array([None if data is None else data[a:b].tobytes() for a, b in spans] + end, pa.binary())],
        names=["bucket", "part", "words", "data"])


_BLOCKS = "bucket long, part long, words binary, data binary"
_SUMS = "bucket long, words binary, data binary, of_words array<double>, of_parts array<double>"


def _summed(blocks: DataFrame, folder: str, dtype, width: int, totals, n_words: int, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Adds the blocks of each range over parts, writes the sums of its words below `folder` and returns the totals of words and of parts.

    `totals(words, sums)` gives `n_words` numbers of a range; the `n_parts` numbers of the parts are added up beside them.
    """

    def run(key, table):
        data, bucket = table.column("data").to_pylist(), key[0].as_py()
        if bucket < 0:
            row = None, None, None, np.sum([np.frombuffer(d) for d in data], 0).tolist()
        else:
            uniq, at = np.unique(np.frombuffer(b"".join(table.column("words").to_pylist()), np.uint64), return_inverse=True)
            rows = np.frombuffer(b"".join(data), dtype).reshape(-1, width)
            sums = np.stack([np.bincount(at, rows[:, s], minlength=len(uniq)) for s in range(width)], 1)
            row = uniq.tobytes(), sums.astype(dtype).tobytes(), totals(uniq, sums).tolist(), None
        kinds = pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())
        return pa.table([pa.array([bucket], pa.int64()), *[pa.array([x], t) for x, t in zip(row, kinds)]], names=["bucket", "words", "data", "of_words", "of_parts"])

    blocks.groupBy("bucket").applyInArrow(run, _SUMS).write.parquet(folder)
    stats = blocks.sparkSession.read.schema(_SUMS).parquet(folder)
    got = stats.agg(*[F.sum(F.col("of_words")[i]) for i in range(n_words)], *[F.sum(F.col("of_parts")[i]) for i in range(n_parts)]).first()
    got = np.array([x or 0.0 for x in got])
    return got[:n_words], got[n_words:]


def _laid_out(parts: DataFrame, summed: str, folder: str, dtype, width: int, buckets: int) -> str:
    """Writes the sums of every part's words below `folder`, by part; the table `summed` is removed after."""

    def words_of(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield from _cut(b.column("part")[i].as_py(), np.frombuffer(b.column("words")[i].as_buffer() or b"", np.uint64), None, None, buckets)

    def run(key, table):
        part, words, data = (table.column(c).to_pylist() for c in ("part", "words", "data"))
        at = part.index(STATS)
        known, sums = np.frombuffer(words[at], np.uint64), np.frombuffer(data[at], dtype).reshape(-1, width)
        del words[at], part[at]
        out = [sums[np.searchsorted(known, np.frombuffer(w, np.uint64))].tobytes() for w in words]
        return pa.table([pa.array(part, pa.int64()), pa.array([key[0].as_py()] * len(part), pa.int64()), pa.array(out, pa.binary())], names=["part", "bucket", "data"])

    sums = parts.sparkSession.read.schema(_SUMS).parquet(summed).filter("bucket >= 0").select("bucket", F.lit(STATS).cast("long").alias("part"), "words", "data")
    both = parts.select("part", "words").mapInArrow(words_of, _BLOCKS).unionByName(sums)
    both.groupBy("bucket").applyInArrow(run, "part long, bucket long, data binary").repartition("part").write.partitionBy("part").parquet(folder)
    remove(summed)
    return folder


@dataclass
class Trained:
    """A fitted model: its totals, the folders of training counts and expected counts by part, and the log-likelihood before each round."""

    of: Totals
    counts: str
    sums: str | None
    log_likelihoods: list[float]


def baum_welch(parts: DataFrame, states: int = 8, rounds: int = 6, tolerance: float = 1e-3, range_words: int = 500_000) -> Trained:
    """Rounds over all training texts until the log-likelihood rises by less than `tolerance` of itself, `rounds` at most.

    Word ranges are made so that the parts bring about `range_words` rows to each. Every round's sums are a table of their
    own in the shared folder, so a lost executor costs its tasks only; the table before is removed first.
    """
    k = states
    one = parts.agg(F.sum("n_words").alias("pairs"), F.sum(F.size(F.filter("marks", lambda m: ~m))).alias("ends")).first()
    buckets, ends = max(1, -(-(one.pairs or 0) // range_words)), one.ends or 0
    base = shared_folder(parts.sparkSession)

    def counted(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, words, first, sym, *_ = _loaded(b, i)
                n = np.zeros(len(words) + 1)
                for _, s, _ in _texts(first, sym, _training(b, i)):
                    n += np.bincount(s, minlength=len(n))
                yield from _cut(part, words, n[:-1], np.zeros(1), buckets)

    def count_totals(words, sums):
        n = sums[:, 0]
        return np.concatenate(([n.sum(), (n > 0).sum()], ((n + 0.5) * (n > 0)) @ noise(words, k)))

    got, _ = _summed(parts.mapInArrow(counted, _BLOCKS), f"{base}/of-words", np.float64, 1, count_totals, 2 + k, 1)
    counts = _laid_out(parts, f"{base}/of-words", f"{base}/counts", np.float64, 1, buckets)
    stay = np.full((k, k), 0.05 / max(k - 1, 1)) + np.eye(k) * (0.95 - 0.05 / max(k - 1, 1))
    of = Totals(k, got[0], got[1], ends, np.full(k, 1 / k), stay / stay.sum(1)[:, None], np.full(k, 1 / k), np.zeros(k), np.ones(k))
    of.norm = (got[2:] + (ends + 0.5) * (ends > 0) + 0.5) / of.mass
    sums, seen = None, []
    for r in range(rounds if ends else 0):
        of, total = _round(parts, counts, sums, f"{base}/of-words-{r}", of, buckets)
        if sums:
            remove(sums)
        _release(parts.sparkSession)
        sums = _laid_out(parts, f"{base}/of-words-{r}", f"{base}/sums-{r}", np.float32, k, buckets)
        _release(parts.sparkSession)
        seen.append(total)
        if r and seen[-1] - seen[-2] < tolerance * abs(seen[-2]):
            break
    return Trained(of, counts, sums, seen)


def _release(spark) -> None:
    """Lets Spark's cleaner drop the shuffle files of rounds that are over, which it otherwise does every half hour."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _round(parts: DataFrame, counts: str, sums: str | None, folder: str, of: Totals, buckets: int) -> tuple[Totals, float]:
    k, mass = of.states, of.mass

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                part, words, first, sym, n, before = _loaded(b, i, counts, sums, of)
                c, moved, begin, total = np.zeros((len(words) + 1, k)), np.zeros((k, k)), np.zeros(k), 0.0
                for _, own, lattice in _lattices(words, n, before, of, first, sym, _training(b, i)):
                    got = lattice.expected()
                    c[own] += got[0]
                    moved, begin, total = moved + got[1], begin + got[2], total + got[3]
                yield from _cut(part, words, c[:-1].astype(np.float32), np.concatenate((c[-1], moved.ravel(), begin, [total])), buckets)

    def totals(words, c):
        n = np.rint(c.sum(1))
        weight = np.where(n > 0, (n + 0.5) / (n + SMOOTH), 0.0) / mass
        return np.concatenate((weight @ c, [SMOOTH * weight.sum()], c.sum(0)))

    got, own = _summed(parts.mapInArrow(run, _BLOCKS), folder, np.float32, k, totals, 2 * k + 1, 2 * k + k * k + 1)
    end_counts, moved, begin = own[:k], own[k:k + k * k].reshape(k, k) + 1.0, own[k + k * k:2 * k + k * k] + 1.0
    shares = got[k + 1:] + end_counts + 1.0
    shares /= shares.sum()
    norm = got[:k] / shares + got[k] + (of.ends + 0.5) / mass * (end_counts + SMOOTH * shares) / (of.ends + SMOOTH) / shares + 0.5 / mass
    return Totals(k, of.words, of.types, of.ends, begin / begin.sum(), moved / moved.sum(1)[:, None], shares, end_counts, norm), float(own[-1])


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text leaves 1 modulo 5; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def scored(docs: DataFrame, held_out: Column | None = None, states: int = 8, rounds: int = 6, tolerance: float = 1e-3, part_chars: int = 16 << 20,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text; log10 probabilities.

    `held_out` marks rows that nothing is learned from. A null or empty text is the end alone. Repeated rows are scored
    alike. Without training texts every word is unknown. `part_chars` is the text a task holds at once (one text at least);
    results do not depend on it but for the rounding of sums.
    """
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col), (held_out if held_out is not None else is_held_out(id_col)).alias("held_out"))
    parts = parted(rows, id_col, text_col, part_chars)
    fit = baum_welch(parts, states, rounds, tolerance)
    of, counts, sums = fit.of, fit.counts, fit.sums
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                _, words, first, sym, n, c = _loaded(b, i, counts, sums, of)
                everything = np.arange(len(first) - 1)
                found = _lattices(words, n, c, of, first, sym, everything)
                n = np.append(n, of.ends)
                logs = np.log10(n + 0.5)
                score, base = np.zeros(len(everything)), np.add.reduceat(logs[sym], first[:-1])
                known = np.add.reduceat((n > 0)[sym].astype(np.int64), first[:-1])
                for numbers, _, lattice in found:
                    score[numbers] = lattice.forward() / math.log(10)
                size = np.diff(first)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[i].values, b.column("marks")[i].values, pa.array(size), pa.array(known), pa.array(np.full(len(size), round(of.words) + of.ends)),
                     pa.array(base - size * math.log10(of.mass)), pa.array(score)],
                    names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return parts.mapInArrow(run, f"{id_col} {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
