"""Quality classifier: document evidence combined with host and path posteriors by hierarchical empirical Bayes.

A logistic regression on form features gives each document a log-likelihood ratio. Its soft votes are summed per path and
per host (grouped aggregation over all documents); the share of good documents of a host is shrunk towards the global
share, that of a path towards its host's, each by the strength that the spread between hosts (paths) supports, so a site
with few documents says little. A document's posterior odds are its path's odds times its own likelihood ratio.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from waymark.llm.store import checkpointed, saved

#: Labelled documents the document classifier is fitted on at most; the sites' statistics always cover all documents.
MOST_LABELS = 20_000
#: Rows of the site table up to which it is broadcast; beyond, documents are joined on site and salt.
BROADCAST_SITES = 50_000
SALTS = 32


def form(text: Column) -> list[Column]:
    """Form of a text as numbers between about 0 and 10; zeros for a null or empty text."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    # the characters of a class are what is left when all others are taken out, a run at a time; counted one by one each would be a string
    only = lambda of, others: F.regexp_replace(of, others, "")
    share = lambda count: 10 * (count / n)
    rest = only(t, r"\p{L}+")
    marks = only(rest, r"[\p{N}\s]+")
    lines, words = F.split(t, "\n"), F.split(t, r"\s+")
    return [
        F.log1p(F.length(t)), share(F.length(t) - F.length(rest)), share(F.length(only(t, r"\P{Lu}+"))), share(F.length(only(rest, r"\P{N}+"))), share(F.length(marks)),
        *[share(F.length(only(marks, others))) for others in ("[^!]+", "[^|]+", "[^#$%&*@<>{}=~^]+")], F.least(n / F.size(words), F.lit(30)) / 3,
        100 * (F.size(lines) - 1) / n, 10 * (1 - F.size(F.array_distinct(lines)) / F.size(lines)),
        10 * F.size(F.array_distinct(words)) / F.size(words)]


def features(text: Column) -> Column:
    return F.array(*form(text))


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, id_col: str = "doc_id", text_col: str = "text"):
    """Weights, intercept and prior log odds of the document classifier; None without both labels.

    Of the labelled ids those with the smallest hashes are taken, `most` at most. A label given several times counts by
    majority, ties as 0; null labels and ids without a document are ignored.
    """
    votes = labels.filter("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("double").alias("label"))
    sample = votes.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "doc_id")
    rows = checkpointed(rows.select("label", features(F.col("text")).alias("f"))).select("label", array_to_vector("f").alias("features"))
    known = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(known) < 2:
        return None
    model = LogisticRegression(regParam=1e-3, maxIter=100).fit(rows)
    return [float(x) for x in model.coefficients], float(model.intercept), math.log(known[1.0] / known[0.0])


def evidence(text: Column, model) -> tuple[Column, Column]:
    """The document's own log odds and its log-likelihood ratio (log odds without the prior); zero evidence without a model."""
    if model is None:
        return F.lit(0.0), F.lit(0.0)
    weights, bias, prior = model
    score = reduce(lambda a, z: a + z[0] * z[1], zip(form(text), weights), F.lit(bias))
    return score, score - F.lit(prior)


def _strength(mean: Column, spread: Column) -> Column:
    """Prior counts of a Beta distribution with this mean and variance, 1 to 10,000."""
    return F.greatest(F.lit(1.0), F.least(F.lit(1e4), mean * (1 - mean) / F.greatest(spread, F.lit(1e-9)) - 1))


def sites(votes: DataFrame) -> DataFrame:
    """(host, path, n, p_global, p_host, p_path) from a row per document with host, path and vote (probability of being good).

    A host's own share has weight n against the prior's strength, which is estimated from the spread of the hosts' shares
    (weighted with their documents) around the global share; likewise for paths around their hosts' posterior.
    """
    paths = checkpointed(votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("vote").alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    mean = F.sum("hgood") / F.sum("hn")
    total = hosts.agg(mean.alias("m")).first()
    mu = min(1 - 1e-6, max(1e-6, total.m if total.m is not None else 0.5))
    spread = hosts.agg((F.sum(F.col("hn") * F.pow(F.col("hgood") / F.col("hn") - mu, 2)) / F.sum("hn")).alias("s")).first().s or 0.0
    strength = _strength(F.lit(mu), F.lit(float(spread)))
    hosts = hosts.select("host", ((F.col("hgood") + strength * mu) / (F.col("hn") + strength)).alias("p_host"))
    joined = paths.join(hosts, "host")
    inner = joined.agg((F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("p_host"), 2)) / F.sum("n")).alias("s")).first().s or 0.0
    strength = _strength(F.lit(mu), F.lit(float(inner)))
    return joined.select("host", "path", "n", F.lit(mu).alias("p_global"), "p_host",
                         ((F.col("good") + strength * F.col("p_host")) / (F.col("n") + strength)).alias("p_path"))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def with_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, most: int = MOST_LABELS,
                 id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(_row, _q) of every row: all its columns (or those named in `keep`), and a struct of host, path, p_document, p_host, p_path and p_quality.

    A text's features are computed once: rows and evidence are written to the shared folder and read for the sites and for the result.

    Host and path default to `source` and `lang`; nulls are sites of their own (empty name). The sites' table is broadcast
    while it is small (its rows are counted), else documents meet it on site and one of SALTS salts, so that a site with a
    third of all documents is spread. Without usable labels there is no evidence and every document gets its prior.
    """
    host = F.coalesce(host if host is not None else F.col("source"), F.lit(""))
    path = F.coalesce(path if path is not None else F.col("lang"), F.lit(""))
    model = fit(docs, labels, most, id_col, text_col)
    own, ratio = evidence(F.col(text_col), model)
    salt = F.pmod(F.xxhash64(id_col, text_col), F.lit(SALTS)).cast("int").alias("_own_salt")
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("_row"), F.struct(host.alias("host"), path.alias("path"), own.alias("own"), ratio.alias("ratio")).alias("_e"), salt)
    rows = saved(rows)
    table = checkpointed(sites(rows.select("_e.host", "_e.path", _sigmoid(F.col("_e.own")).alias("vote"))))
    if table.count() <= BROADCAST_SITES:
        site = table.select(F.struct("host", "path").alias("_site"), F.struct("p_host", "p_path").alias("_p"))
        joined = rows.join(F.broadcast(site), F.struct("_e.host", "_e.path") == F.col("_site"))
    else:
        site = table.select(F.struct("host", "path").alias("_site"), F.struct("p_host", "p_path").alias("_p"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
        joined = rows.join(site, (F.struct("_e.host", "_e.path") == F.col("_site")) & (F.col("_own_salt") == F.col("_salt")))
    odds = F.col("_e.ratio") + F.log(F.col("_p.p_path") / (1 - F.col("_p.p_path")))
    return joined.select("_row", F.struct("_e.host", "_e.path", _sigmoid(F.col("_e.own")).alias("p_document"), "_p.p_host", "_p.p_path",
                                          _sigmoid(odds).alias("p_quality")).alias("_q"))


def classified(docs: DataFrame, labels: DataFrame, least: float = 0.5, most: int = MOST_LABELS) -> DataFrame:
    """(doc_id, host, path, p_document, p_host, p_path, p_quality, rejected) of every row; rejected where p_quality is below `least`."""
    rows = with_quality(docs.select("doc_id", "text", "source", "lang"), labels, most=most, keep=["doc_id"])
    return rows.select("_row.doc_id", "_q.*", (F.col("_q.p_quality") < least).alias("rejected"))
