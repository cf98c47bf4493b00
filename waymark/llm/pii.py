"""Personal data by weak supervision, in DataFrame functions only.

Four labelers (pattern, gazetteer, context, surroundings) vote yes, no or nothing on candidate spans: what the strict patterns
match and what looser ones match. The candidates of the whole corpus are counted by their votes and features (a table of
bounded size, whatever the corpus); expectation-maximisation over it estimates how each labeler votes on true and false
spans, without a labelled row, and a logistic regression on the resulting weights becomes the final span classifier.
Strict spans that pass their checks are always kept; the classifier adds loose ones that do not overlap them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from waymark.llm.store import saved

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
# The strict patterns. Possessive runs and look-behinds keep them linear and change no match:
# a match starts at the start of its run or where the match before ended.
STRICT = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms in which the same data are written.
LOOSE = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[(]dot[\])])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[1-9][0-9]?\x20?)?\(?[0-9]{3}\)?[\x20./-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# Gazetteers and context words.
TLDS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "it", "nl", "ch", "at", "be", "pl", "mx", "ar", "br", "ca")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"
YES_WORDS = {
    "email": r"(?i)\b(?:e-?mail|contact|write|mailto|kontakt|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|karte|tarjeta|carte|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telefon|call|fax|mobile|cell|whatsapp|sms|tel[eé]fono|t[eé]l[eé]phone)\b",
}
NO_WORDS = r"(?i)\b(?:version|release|section|isbn|doi|build|invoice|order|serial|commit|chapter|figure)\b"
CONTEXT = 40
SPAN = "struct<start:int,end:int,hit:string,before:string,after:string>"
#: Items of a block whose running values are found by going through the block.
STEP = 32


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _none(kind: str) -> Column:
    return F.from_json(F.lit("[]"), f"array<{kind}>")


def _over(xs: Column, first: Column, stop: Column, combine, zero: Column) -> Column:
    """combine over the elements from `first` to before `stop`."""
    return F.when(stop > first, F.aggregate(F.sequence(first, stop - 1), zero, lambda a, i: combine(a, F.get(xs, i)))).otherwise(zero)


def _blocks(xs: Column, combine, zero: Column) -> Column:
    count = ((F.size(xs) + (STEP - 1)) / STEP).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda k: _over(xs, k * STEP, F.least((k + 1) * STEP, F.size(xs)), combine, zero))).otherwise(F.array().cast("array<int>"))


def running(numbers: Column, combine, zero: Column) -> Column:
    """For each of an array's whole numbers, `combine` over those before it.

    Blocks, blocks of blocks and so on are combined first; an element then looks at fewer than STEP of each level. No array is
    carried along, which Spark would copy at every step, so the time grows with the elements, not with their square.
    """
    def at(levels: list):
        def one(i):
            value, stop = zero, i
            for xs in levels[:-1]:
                first = stop - stop % STEP
                value = combine(value, _over(xs, first, stop, combine, zero))
                stop = (first / STEP).cast("int")
            return combine(value, _over(levels[-1], F.lit(0), stop, combine, zero))
        return F.transform(F.sequence(F.lit(0), F.size(levels[0]) - 1), one)

    def leveled(levels: list):
        return at(levels) if len(levels) == 4 else _let(_blocks(levels[-1], combine, zero), lambda more: leveled([*levels, more]))

    return F.when(F.size(numbers) > 0, _let(numbers, lambda xs: leveled([xs]))).otherwise(F.array().cast("array<int>"))


def located(text: Column, pattern: str) -> Column:
    """Start, end (code points, end exclusive), text, the CONTEXT characters before and the one after of all leftmost non-overlapping
    matches of a pattern that matches no empty text."""
    def last(c: Column) -> Column:
        return F.right(c, F.lit(CONTEXT))

    def placed(hits, pieces, begins):
        def back(i, n):
            """The last n matches and pieces before match i, joined."""
            return F.array_join(F.transform(F.sequence(F.greatest(i - n, F.lit(0)), i), lambda j: F.concat(
                F.when(j > F.greatest(i - n, F.lit(0)), last(F.get(hits, j - 1))).otherwise(""), last(F.get(pieces, j)))), "")

        def one(i):
            piece, following = F.get(pieces, i), F.get(pieces, i + 1)
            # every match has a character, so CONTEXT matches always reach far enough
            before = F.when(F.length(piece) >= CONTEXT, last(piece)).otherwise(_let(back(i, 2), lambda near: F.when((F.length(near) >= CONTEXT) | (i < 3), last(near)).otherwise(last(back(i, CONTEXT)))))
            after = F.left(F.when(following != "", following).otherwise(F.coalesce(F.get(hits, i + 1), F.lit(""))), F.lit(1))
            start = F.get(begins, i) + F.length(piece)
            return F.struct(start.alias("start"), (start + F.length(F.get(hits, i))).alias("end"), F.get(hits, i).alias("hit"), before.alias("before"), after.alias("after"))

        return F.transform(F.sequence(F.lit(0), F.size(hits) - 1), one)

    def found(hits):
        def cut(pieces):
            sizes = F.transform(hits, lambda h, i: F.length(h) + F.length(F.get(pieces, i)))
            return _let(running(sizes, lambda a, b: a + b, F.lit(0)), lambda begins: placed(hits, pieces, begins))
        return F.when(F.size(hits) > 0, _let(F.split(text, pattern, -1), cut)).otherwise(_none(SPAN))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    """The check a strict match must pass."""
    if kind == "ip":
        def small(p):
            q = F.ltrim(p, F.lit("0"))
            return (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255"))
        return F.forall(F.split(hit, "\\."), small)
    if kind == "card":
        return F.length(_digits(hit)).between(16, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == "phone":
        return F.length(_digits(hit)).between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, hit: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1)).isin(*TLDS)
        return _vote(known, ~known)
    if kind == "ip":
        first = F.regexp_extract(hit, r"^0*([0-9]{1,3})\.", 1)
        return _vote(first.cast("int").between(1, 223), first.isin("", "0", "00") | (first.cast("int") > 223))
    if kind == "card":
        known = F.regexp_like(_digits(hit), F.lit(ISSUERS))
        return _vote(known, ~known)
    n = F.length(_digits(hit))
    return _vote(n.between(10, 13), n < 9)


def _seen(kind: str, strict: bool, text: Column) -> Column:
    """Candidates of one kind with votes and features."""
    found = located(text, (STRICT if strict else LOOSE)[kind])

    def described(s):
        hit, before = s["hit"], s["before"]
        around = F.concat(F.right(before, F.lit(1)), s["after"])
        valid = _valid(kind, hit) if strict else F.lit(False)
        glued = F.regexp_like(around, F.lit(r"[\p{L}\p{N}@_]"))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), valid.alias("valid"), F.lit(strict).alias("strict"),
            (F.when(valid, 1).otherwise(-1) if strict else F.lit(0)).alias("v_pattern"), _gazetteer(kind, hit).alias("v_gazetteer"),
            _vote(F.regexp_like(before, F.lit(YES_WORDS[kind])), F.regexp_like(before, F.lit(NO_WORDS))).alias("v_context"),
            _vote(~glued, glued).alias("v_around"), F.regexp_like(hit, F.lit(r"[\x20()./_-]")).cast("int").alias("parted"),
            F.when(F.length(hit) < 10, 0).when(F.length(hit) < 20, 1).otherwise(2).alias("size"))

    return F.transform(found, described)


VOTES = ("v_pattern", "v_gazetteer", "v_context", "v_around")
SHAPE = ("parted", "size")


def with_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with `seen`, all candidates of a text (null: empty) with votes and features."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # texts without the one character that a kind needs skip its patterns
    may = {"email": F.contains(text, F.lit("@")) | F.contains(text, F.lit("at")), "ip": F.regexp_like(text, F.lit("[0-9]")),
           "card": F.regexp_like(text, F.lit("[0-9]")), "phone": F.regexp_like(text, F.lit("[0-9]"))}
    none = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,kind:string,valid:boolean,strict:boolean,v_pattern:int,v_gazetteer:int,v_context:int,"
                                    "v_around:int,parted:int,size:int>>")
    parts = [F.when(may[k], _seen(k, strict, text)).otherwise(none) for k in KINDS for strict in (True, False)]
    return docs.withColumn("seen", F.concat(*parts))


def counted(candidates: DataFrame) -> list[dict]:
    """Candidates of the corpus counted by kind, votes and shape: at most kinds x 3^4 votes x shapes rows."""
    keys = ["kind", *VOTES, *SHAPE]
    rows = candidates.select(F.explode("seen").alias("s")).select("s.*").groupBy(*keys).agg(F.count("*").alias("n"))
    return [r.asDict() for r in rows.collect()]


def expectation_maximisation(rows: list[dict], rounds: int = 50) -> tuple[dict, dict]:
    """Reliabilities P(vote | labeler, truth) and the share of true spans per kind, from vote counts alone.

    The start believes that labelers are right more often than not; add-one smoothing keeps every probability open. Adds
    `truth`, the probability of a true span, to each row.
    """
    rate = {k: 0.5 for k in KINDS}
    table = {(v, y, x): p for v in VOTES for y, ps in ((1, (0.1, 0.3, 0.6)), (0, (0.6, 0.3, 0.1))) for x, p in zip((-1, 0, 1), ps)}
    for _ in range(rounds):
        seen = {k: 1.0 for k in table}
        share = {k: [1.0, 2.0] for k in KINDS}
        for r in rows:
            odds = math.log(rate[r["kind"]] / (1 - rate[r["kind"]])) + sum(math.log(table[v, 1, r[v]] / table[v, 0, r[v]]) for v in VOTES)
            r["truth"] = 1 / (1 + math.exp(-max(-500, min(500, odds))))
            for v in VOTES:
                seen[v, 1, r[v]] += r["n"] * r["truth"]
                seen[v, 0, r[v]] += r["n"] * (1 - r["truth"])
            share[r["kind"]][0] += r["n"] * r["truth"]
            share[r["kind"]][1] += r["n"]
        table = {(v, y, x): seen[v, y, x] / sum(seen[v, y, z] for z in (-1, 0, 1)) for v, y, x in table}
        rate = {k: a / b for k, (a, b) in share.items()}
    return table, rate


def _features(r) -> list:
    """Classifier inputs of a candidate, as numbers of a dict or as columns of a struct; the pattern's own vote stays out, so that
    the classifier also judges spans that no strict pattern matches."""
    flag = (lambda c: c.cast("double")) if isinstance(r["kind"], Column) else float
    return [flag(r["kind"] == k) for k in KINDS[1:]] + [flag(r[v] == x) for v in VOTES[1:] for x in (1, -1)] + [flag(r["parted"] == 1)] + [flag(r["size"] == s) for s in (1, 2)]


def train(spark: SparkSession, rows: list[dict]) -> tuple[list[float], float] | None:
    """Weights and intercept of the span classifier, trained on the counted candidates weighted with their probability of being true."""
    data = [(y, float(r["n"] * w), Vectors.dense(_features(r))) for r in rows for y, w in ((1.0, r["truth"]), (0.0, 1 - r["truth"])) if r["n"] * w > 1e-9]
    if len({y for y, _, _ in data}) < 2:
        return None
    frame = spark.createDataFrame(data, ["label", "weight", "features"]).coalesce(1)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=50, standardization=False).fit(frame)
    return [float(x) for x in model.coefficients], float(model.intercept)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, only: list[str] | None = None) -> DataFrame:
    """The rows with `base` and `spans`: arrays of (kind, start, end) by kind as in KINDS, then start.

    `base` are the strict matches that pass their checks; `spans` adds loose candidates that the classifier gives at least
    `least` and that overlap no base span. Null and empty texts have none; repeated rows are treated alike; without
    candidates of both sorts nothing is added. If `only` names the columns wanted beside them, these and the candidates are
    written once and read for both the counts and the result; else the texts are searched for each.
    """
    rows = with_candidates(docs, id_col, text_col)
    if only is not None:
        rows = saved(rows.select(*only, "seen"))
    counts = counted(rows)
    expectation_maximisation(counts)
    model = train(docs.sparkSession, counts) if counts else None
    keep = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    rows = rows.withColumn("base", F.transform(F.filter("seen", lambda c: c["valid"]), keep))
    if model is None:
        return rows.withColumn("spans", F.col("base")).drop("seen")
    weights, bias = model

    def likely(c):
        score = reduce(lambda a, b: a + b, [F.lit(w) * x for w, x in zip(weights, _features(c))], F.lit(bias))
        return ~c["strict"] & (score >= math.log(least / (1 - least))) & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    rows = rows.withColumn("more", F.transform(F.filter("seen", likely), keep))
    by_kind = [F.array_sort(of_kind(F.concat("base", "more"), k)) for k in KINDS]
    return rows.withColumn("spans", F.when(F.size("more") == 0, F.col("base")).otherwise(F.concat(*by_kind))).drop("seen", "more")


def of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first gives the name and all are covered.

    The text is cut into blocks once and each part is taken from its own blocks, so long texts with many spans stay linear.
    """
    size = 512
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def written(blocks):
        def cut(a, b):
            """Characters a to b (exclusive)."""
            first, last = (a / size).cast("int"), ((b - 1) / size).cast("int")
            head = F.substring(F.get(blocks, first), a % size + 1, b - a)
            inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            several = F.concat(head, inner, F.substring(F.get(blocks, last), F.lit(1), b - last * size))
            return F.when(a >= b, "").when(first == last, head).otherwise(several)

        def parts(ordered, covered):
            written = F.transform(ordered, lambda s, i: F.when(s["start"] >= F.get(covered, i), F.concat(cut(F.get(covered, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(""))
            return F.concat(F.array_join(written, ""), cut(F.array_max(F.transform(ordered, lambda s: s["end"])), F.length(text)))

        return _let(ordered, lambda xs: _let(running(F.transform(xs, lambda s: s["end"]), F.greatest, F.lit(0)), lambda covered: parts(xs, covered)))

    done = _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)), written)
    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(done)
