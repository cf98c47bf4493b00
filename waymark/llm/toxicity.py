"""Toxicity: a counterfactual-regularised logistic classifier over the words of whole texts.

Evidence is which words, and which beginnings of words, a text has. In labelled sentences that name a group, the group's
term is swapped for others of its kind, a neutral one among them. The difference of the two sentences' evidence enters the
fit twice, once with each label and without intercept: the loss of such a pair is log(1 + e^z) + log(1 + e^-z), least where
the swap changes the log odds z by nothing. So terms that only go along with toxic labels get the weight of their neutral
counterpart, and neutral mentions of a group are not held against a text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from waymark.llm.store import checkpointed, saved
from waymark.llm.text import _P, _P_INV, _powers, WordBlock, mapped, mixed

#: Labelled documents the classifier is fitted on at most, those with the smallest id hashes.
MOST_LABELS = 20_000
#: Words and beginnings of words the classifier knows at most, those that tell the labels apart best.
MOST_FEATURES = 4_096
#: Bytes of the beginnings of words.
PREFIXES = (5, 6, 7, 8)
#: Interchangeable terms, the neutral one first. Fixed values.
GROUPS = (
    ("people", "women", "men", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "foreigners", "africans", "asians", "arabs", "lesbians", "gays"),
    ("person", "woman", "man", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee", "foreigner", "african", "asian", "arab", "lesbian"),
    ("ordinary", "black", "white", "jewish", "gay", "straight", "transgender", "bisexual", "disabled", "deaf", "blind", "elderly", "indigenous"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "schwule", "lesben", "behinderte"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "étrangers", "homosexuels", "handicapés"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "extranjeros", "homosexuales", "discapacitados"),
)
_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]?")
_TOKEN = re.compile(r"[^\W_]+")
_MASK = np.uint64((1 << 20) - 1)


class Tokens(WordBlock):
    """Runs of ASCII letters, digits and bytes beyond ASCII, A-Z lower-cased."""

    BLANK = np.ones(256, bool)
    BLANK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

    def _hash(self, buf: np.ndarray) -> np.ndarray:
        low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf).astype(np.uint64) + np.uint64(1)
        self._sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(low * _powers(_P, len(buf)))))
        self._down = _powers(_P_INV, len(buf))
        return self._between(self.stop)

    def _between(self, stop: np.ndarray) -> np.ndarray:
        return mixed((self._sums[stop] - self._sums[self.start]) * self._down[self.start]) if len(self.start) else np.zeros(0, np.uint64)

    def features(self) -> list[np.ndarray]:
        """One hash per token and kind: the token itself, then its beginning of each length; 0 where the token is shorter."""
        found = [self.hashes]
        for k in PREFIXES:
            stop = np.minimum(self.start + k, self.stop)
            found.append(np.where(self.stop - self.start >= k, mixed(self._between(stop) ^ np.uint64(k)), np.uint64(0)))
        return found


def feature_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct feature hashes of each text, as signed numbers."""
    block = Tokens(texts)
    kinds = block.features()
    out = []
    for lo, hi in zip(block.first, block.first[1:]):
        x = np.unique(np.concatenate([k[lo:hi] for k in kinds]))
        out.append(x[x != 0].view(np.int64))
    return out


def swapped(text: str, groups, swaps: int):
    """(sentence, the sentence with its group terms swapped) for every sentence with a group term: the neutral term first, then the next ones of the group."""
    place = {t: (g, i) for g, group in enumerate(groups) for i, t in enumerate(group)}
    for sentence in _SENTENCE.findall(text or ""):
        if not any(w.lower() in place for w in _TOKEN.findall(sentence)):
            continue
        for k in range(swaps):
            def other(m, k=k):
                at = place.get(m[0].lower())
                if at is None:
                    return m[0]
                g, i = at
                return groups[g][0] if k == 0 and i else groups[g][(i + max(k, 1)) % len(groups[g])]
            yield sentence, _TOKEN.sub(other, sentence)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, groups, swaps: int, most: int) -> DataFrame:
    """(label, plus, minus) rows: features of labelled documents, and without label the differences of swapped sentences.

    Documents held out (crc32 of the id as text, modulo 3, is 1) are not used. A label given several times counts by
    majority, ties as 0; null labels and ids without a document are ignored.
    """
    votes = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg(label) > 0.5).cast("int").alias("_y"))
    sample = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.col("_y").alias("label"), "text")
    schema = pa.schema([("label", pa.int32()), ("plus", pa.list_(pa.int64())), ("minus", pa.list_(pa.int64()))])
    terms = {t for g in groups for t in g}

    def made(b):
        ys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
        out = [(y, f, []) for y, f in zip(ys, feature_sets(texts))]
        pairs = [p for t in texts if any(w in terms for w in _TOKEN.findall((t or "").lower())) for p in swapped(t, groups, swaps)]
        if pairs:
            before, after = feature_sets([p[0] for p in pairs]), feature_sets([p[1] for p in pairs])
            out += [(None, np.setdiff1d(x, y), np.setdiff1d(y, x)) for x, y in zip(before, after)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], schema.field(k).type) for k in range(3)], schema=schema)

    return saved(mapped(rows, made, "label int, plus array<bigint>, minus array<bigint>"))


def select_features(rows: DataFrame, most: int) -> list[int]:
    """Features that speak for the label beyond chance, ascending: of all with a larger share of label 1 than the whole, those
    whose likelihood ratio exceeds what chance gives the best of that many features, `most` at most, ties to the smaller hash.

    Features of label 0 are left out: long texts have so many words that these would outweigh an insult.
    """
    docs = rows.filter("label is not null")
    n, t = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("t")).first()
    share = t / max(n, 1)
    per = docs.select("label", F.explode("plus").alias("f")).groupBy("f").agg(F.count("*").cast("double").alias("n"), F.sum("label").cast("double").alias("k")).filter("n > 1")
    per = checkpointed(per)
    clean = F.col("n") - F.col("k")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = part(F.col("k"), F.col("n") * share) + part(clean, F.col("n") * (1 - share))
    chosen = per.filter((F.col("k") > F.col("n") * share) & (ratio > np.log(max(per.count(), 2)))).orderBy(ratio.desc(), "f").limit(most)
    return sorted(r.f for r in chosen.select("f").collect())


def fit(rows: DataFrame, features: list[int], strength: float, reg: float):
    """Weights of the features and the intercept; None where a label is missing."""
    known = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not known.get(0) or not known.get(1):
        return None
    at, size = {f: i for i, f in enumerate(features)}, len(features)
    n, pairs = known[0] + known[1], known.get(None, 0)

    @F.udf(VectorUDT())
    def vector(label, plus, minus):  # a bounded number of rows
        found = {at[f]: 1.0 for f in plus if f in at} | {at[f]: -1.0 for f in minus if f in at}
        # the intercept, as a feature of real documents only; large, so that regularisation hardly touches it
        return SparseVector(size + 1, found if label is None else found | {size: 10.0})

    # one empty difference, whose loss is constant, keeps the intercept's feature from being constant, which the fit would leave at 0
    empty = rows.sparkSession.createDataFrame([(None, [], [], 1.0)], "label int, plus array<bigint>, minus array<bigint>, weight double")
    weight = F.when(F.col("label").isNull(), F.lit(strength * n / max(pairs, 1) / 2)).otherwise(1.0).alias("weight")
    # repeated differences weigh as often as they occur; those without a known feature add nothing
    vectors = rows.select("*", weight).unionByName(empty).select(F.explode(F.when(F.col("label").isNull(), F.array(F.lit(0.0), F.lit(1.0))).otherwise(F.array(F.col("label").cast("double")))).alias("label"),
                          vector("label", "plus", "minus").alias("features"), "weight")
    model = LogisticRegression(regParam=reg, maxIter=60, fitIntercept=False, standardization=False, weightCol="weight").fit(checkpointed(vectors))
    weights = np.array(model.coefficients.toArray())
    return weights[:-1], 10.0 * float(weights[-1])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, label: str = "toxic", groups=GROUPS, swaps: int = 3, strength: float = 1.0, reg: float = 1e-4, least: float = 0.7,
           most: int = MOST_LABELS, most_features: int = MOST_FEATURES) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; predicted is 1 from a score of `least`.

    The score depends on the text alone: equal texts score alike, a null text as an empty one, which has the intercept's
    score. Without labels of both kinds all scores are 0. `strength` is the weight of all swapped pairs together against all
    documents, 0 turns them off. A null id is never held out and never labelled. An empty table gives no rows.
    """
    rows = training_rows(docs, labels, label, groups, swaps if strength else 0, most)
    features = select_features(rows, most_features)
    model = fit(rows, features, strength, reg)
    keys = np.array(features, np.int64).view(np.uint64)
    order = np.argsort(keys)
    keys = keys[order]
    weights, bias = (model[0][order], model[1]) if model else (np.zeros(len(keys)), -np.inf)
    maybe = np.zeros(int(_MASK) + 1, bool)
    maybe[(keys & _MASK).astype(np.int64)] = True

    def score(b):
        block = Tokens(b.column(1).to_pylist())
        owner = np.repeat(np.arange(b.num_rows), np.diff(block.first))
        hits = []
        for x in block.features():
            near = np.flatnonzero(maybe[(x & _MASK).astype(np.int64)])
            at = np.minimum(np.searchsorted(keys, x[near]), max(len(keys) - 1, 0))
            ok = keys[at] == x[near] if len(keys) else np.zeros(len(near), bool)
            hits.append(owner[near[ok]] * max(len(keys), 1) + at[ok])
        hits = np.unique(np.concatenate(hits))
        z = bias + np.bincount(hits // max(len(keys), 1), weights[hits % max(len(keys), 1)] if len(keys) else None, b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))) if model else np.zeros(b.num_rows))], ["doc_id", "score"])

    rows = mapped(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), score, "doc_id bigint, score double")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))
