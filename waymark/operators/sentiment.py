"""Text sentiment: lexicon, rating rule, trained classifier, quality figures and place summaries."""

from __future__ import annotations

import re

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from waymark import config
from waymark.functions.rules import first_match, yes
from waymark.functions.text import lexicon_text
from waymark.operators.durable import durable
from waymark.operators.ranking import hash_numbered


def word_hits(clean: Column, words: list[str]) -> Column:
    """How many tokens of a cleaned text are in a word list (entries of several words never are)."""
    single = [re.escape(w) for w in words if w and " " not in w]
    return F.regexp_count(clean, F.lit(rf"(?<![^ ])(?:{'|'.join(single)})(?![^ ])")) if single else F.lit(0)


def _counted(df: DataFrame, text: str, positive: list[str], negative: list[str]) -> DataFrame:
    """Adds _clean, then _p, _n and _k (token count), each computed once."""
    cleaned = df.withColumn("_clean", lexicon_text(F.col(text)))
    tokens = F.when(F.col("_clean") == "", F.lit(0)).otherwise(F.length("_clean") - F.length(F.replace(F.col("_clean"), F.lit(" "), F.lit(""))) + 1)
    return cleaned.withColumns({"_p": word_hits(F.col("_clean"), positive), "_n": word_hits(F.col("_clean"), negative), "_k": tokens})


def lexicon_labels(df: DataFrame, text: str, positive=config.POSITIVE_WORDS, negative=config.NEGATIVE_WORDS) -> DataFrame:
    """Adds label and score by comparing positive with negative token counts."""
    p, n = F.col("_p"), F.col("_n")
    return _counted(df, text, positive, negative).withColumns({
        "label": first_match([(p > n, "positive"), (n > p, "negative")], "neutral"),
        "score": first_match([(p > n, 1.0), (n > p, -1.0)], 0.0)}).drop("_clean", "_p", "_n", "_k")


def rating_labels(df: DataFrame, text: str, rating: Column, positive=config.POSITIVE_WORDS, negative=config.NEGATIVE_WORDS) -> DataFrame:
    """Adds label, score and confidence from the rating, corrected by the words."""
    p, n, k = F.col("_p"), F.col("_n"), F.col("_k")
    high, low = yes(rating >= 4.0), yes(rating <= 2.0)
    turned = high & (n > p) & (n >= 2)
    label = first_match([(turned, "negative"), (high, "positive"), (low, "negative"), (p > n, "positive"), (n > p, "negative")], "neutral")
    score = first_match(
        [(turned, -0.6), (high, F.lit(0.85) + p * 0.03), (low, F.lit(-0.9) + p * 0.02), (p > n, 0.5), (n > p, -0.5)], 0.0)
    return _counted(df, text, positive, negative).withColumns({
        "label": label, "score": F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score)),
        "confidence": F.least(F.lit(1.0), F.lit(0.70) + k * 0.05)}).drop("_clean", "_p", "_n", "_k")


def pseudo_label(rating: Column) -> Column:
    return first_match([(yes(rating >= 4.0), "positive"), (yes(rating <= 2.0), "negative")], "neutral")


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def quality(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy and macro F1 over the labels seen in truth or prediction; computed from the confusion counts."""
    return quality_of(confusion(df, truth, predicted))


def quality_of(counts: DataFrame) -> DataFrame:
    """Accuracy and macro F1 from confusion counts (truth, predicted, n)."""
    long = counts.select(F.explode(F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("t"), F.lit(0).cast("bigint").alias("p"), F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0).alias("h")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("t"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("h")))).alias("x")).select("x.*")
    per = long.groupBy("label").agg(F.sum("t").alias("t"), F.sum("p").alias("p"), F.sum("h").alias("h"))
    f1 = F.coalesce(F.try_divide(F.col("h") * 2.0, F.col("t") + F.col("p")), F.lit(0.0))
    return per.agg(
        F.sum("t").alias("n"), F.round(F.sum("h") / F.sum("t"), 4).alias("accuracy"), F.round(F.avg(f1), 4).alias("macro_f1"))


def place_summary(df: DataFrame, key: str = "place_id") -> DataFrame:
    label = F.col("label")
    return df.groupBy(key).agg(
        F.round(F.avg("score"), 4).alias("sentiment_score_mean"), F.round(F.avg("confidence"), 4).alias("sentiment_confidence_mean"),
        *[F.count_if(label == x).alias(f"{x}_review_count") for x in ("positive", "neutral", "negative")], F.count("*").alias("total_review_count"))


def train(df: DataFrame, text: str, label: str, terms: int = 2500, c: float = 1.0, rounds: int = 100) -> PipelineModel:
    """TF-IDF of one- and two-word terms with multinomial logistic regression, all on executors.

    The inverse document frequency is ln((1 + n) / (1 + df)) + 1, vectors have unit length, and the penalty 1 / (c * n) is
    that of a loss summed over n rows. Rows without a label are left out. Only the vocabulary (at most `terms` entries) and
    the model weights reach the driver.
    """
    data = df.select(lexicon_text(F.col(text)).alias("clean"), F.col(label).alias("label")).filter(F.col("label").isNotNull()).persist()
    try:
        front = Pipeline(stages=[
            StringIndexer(inputCol="label", outputCol="y", handleInvalid="error", stringOrderType="alphabetAsc"),
            RegexTokenizer(inputCol="clean", outputCol="one", pattern=r"\W+", minTokenLength=2),
            NGram(n=2, inputCol="one", outputCol="two"),
            SQLTransformer(statement="SELECT *, concat(one, two) AS terms FROM __THIS__"),
            CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=terms)]).fit(data)
        counted = front.transform(data).select("y", "tf").persist()
        idf = IDF(inputCol="tf", outputCol="_").fit(counted).idf.toArray() + 1.0
        back = [ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="features")]
        ready = PipelineModel(back).transform(counted)
        model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=rounds, tol=1e-4, regParam=1.0 / (c * max(counted.count(), 1)),
                                   elasticNetParam=0.0, standardization=False, family="multinomial").fit(ready)
        counted.unpersist()
        return PipelineModel([*front.stages, *back, model])
    finally:
        data.unpersist()


def apply_model(model: PipelineModel, df: DataFrame, text: str) -> DataFrame:
    """Adds predicted_label and confidence (highest class probability)."""
    names = model.stages[0].labels
    scored = model.transform(df.select(F.struct(*df.columns).alias("_row"), lexicon_text(F.col(text)).alias("clean"), F.lit(names[0]).alias("label")))
    label = F.element_at(F.array(*[F.lit(x) for x in names]), F.least(F.col("prediction").cast("int") + 1, F.lit(len(names))))
    return scored.select("_row.*", label.alias("predicted_label"), F.array_max(vector_to_array("probability")).alias("confidence"))


def _terms() -> PipelineModel:
    """The one- and two-word terms of `clean`, as train() has them."""
    return PipelineModel([RegexTokenizer(inputCol="clean", outputCol="one", pattern=r"\W+", minTokenLength=2), NGram(n=2, inputCol="one", outputCol="two"),
                          SQLTransformer(statement="SELECT *, concat(one, two) AS terms FROM __THIS__")])


def _confusions(df: DataFrame, text: str, label: str, folds: int, terms: int, c: float = 1.0, rounds: int = 100) -> DataFrame:
    """(left_out, part, truth, predicted, n) of the classifiers of train() that leave out one of the folds 0 to `folds` - 1 of
    the column `fold` each; without folds, of the one that leaves out none.

    Terms are counted once, by fold, and every vocabulary is the most frequent terms of the whole less those of a fold (ties
    by the term). Texts become counts over all those terms once; a fit weighs terms outside its vocabulary with zero, which
    is as if they were not there.
    """
    fits = list(range(folds)) or [-1]
    cleaned = df.select(lexicon_text(F.col(text)).alias("clean"), F.col(label).alias("label"), F.col("fold")).persist()
    found = _terms().transform(cleaned)
    # explode would repeat the cutting in a filter of its own
    each = found.filter(F.col("label").isNotNull()).select("fold", F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    left = {f: F.count_if(F.col("fold") != f).alias(f"n{f}") for f in fits}
    by_term = each.groupBy("term").agg(*left.values()).persist()
    members = {f: {r.term for r in by_term.filter(F.col(f"n{f}") > 0).orderBy(F.col(f"n{f}").desc(), "term").limit(terms).select("term").collect()} for f in fits}  # `terms` rows per fit
    by_term.unpersist()
    vocabulary = sorted(set().union(*members.values())) or [""]
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="terms", outputCol="tf").transform(found)
    counted = durable(counted.select("fold", "label", "tf"))
    cleaned.unpersist()
    out = None
    for f in fits:
        mine = counted.filter((F.col("fold") != f) & F.col("label").isNotNull()) if folds else counted.filter(F.col("label").isNotNull())
        index = StringIndexer(inputCol="label", outputCol="y", handleInvalid="error", stringOrderType="alphabetAsc").fit(mine)
        weights = [w + 1.0 if t in members[f] else 0.0 for t, w in zip(vocabulary, IDF(inputCol="tf", outputCol="_").fit(mine).idf.toArray().tolist())]
        back = PipelineModel([ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="tf", outputCol="tfidf"), Normalizer(inputCol="tfidf", outputCol="features")])
        ready = back.transform(index.transform(mine)).select("y", "features")
        model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=rounds, tol=1e-4, regParam=1.0 / (c * max(mine.count(), 1)),
                                   elasticNetParam=0.0, standardization=False, family="multinomial").fit(ready)
        known = index.labels
        predicted = F.element_at(F.array(*[F.lit(x) for x in known]), F.least(F.col("prediction").cast("int") + 1, F.lit(len(known))))
        part = F.when(F.col("fold") == f, "validation").otherwise("train")
        one = model.transform(back.transform(counted)).groupBy(part.alias("part"), F.col("label").alias("truth"), predicted.alias("predicted")).agg(F.count("*").alias("n")).withColumn("left_out", F.lit(f))
        out = one if out is None else out.unionByName(one)
    return durable(out)  # a few rows per fold


def fitted_quality(df: DataFrame, text: str, label: str, terms: int = 2500) -> DataFrame:
    """Quality of the classifier of train() on the rows it is trained on; texts are cut into terms twice, however many rounds it takes."""
    return quality_of(_confusions(df.withColumn("fold", F.lit(0)), text, label, 0, terms))


def assign_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Stratified folds: rows of a label are dealt out in hash order.

    The numbering is sliced by hash, so a label that holds most rows is not sorted in one task.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    numbered = hash_numbered(hashed, [label], "_h", key, "_pos")
    return numbered.withColumn("fold", ((F.col("_pos") - 1) % folds).cast("int")).drop("_h", "_pos")


def cross_validate(df: DataFrame, key: str, text: str, label: str, folds: int = 5, seed: int = 42, terms: int = 2500, gap_limit: float = 0.08) -> DataFrame:
    """Train and validation quality averaged over stratified folds, with a computed verdict on the gap."""
    data = durable(assign_folds(df.select(key, text, label), key, label, folds, seed))
    counts = _confusions(data, text, label, folds, terms).withColumnRenamed("left_out", "fold")
    parts = None
    for f in range(folds):
        for part in ("train", "validation"):
            q = quality_of(counts.filter((F.col("fold") == f) & (F.col("part") == part))).withColumn("part", F.lit(part))
            parts = q if parts is None else parts.unionByName(q)
    mean = lambda p, c: F.avg(F.when(F.col("part") == p, F.col(c)))
    out = parts.agg(
        F.round(mean("train", "accuracy"), 4).alias("train_accuracy"), F.round(mean("validation", "accuracy"), 4).alias("validation_accuracy"),
        F.round(mean("train", "macro_f1"), 4).alias("train_f1"), F.round(mean("validation", "macro_f1"), 4).alias("validation_f1"))
    gap = F.round(F.abs(F.col("train_f1") - F.col("validation_f1")), 4)
    return out.withColumns({"f1_gap": gap, "overfit": gap > gap_limit})
