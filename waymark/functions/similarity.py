"""String similarity for candidate pairs.

Spark has no longest-common-subsequence function, so the exact score of a pair
is an Arrow UDF. It only ever sees pairs that share a key of `gram_keys` and pass the edit distance bound.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType


def _lcs_length(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence: one big-integer step per character of b."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for ch in b:
        hit = open_bits & masks.get(ch, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def indel_percent(a: str, b: str) -> float:
    """200 * LCS / (n + m); two empty texts are equal."""
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * _lcs_length(a, b) / total


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else indel_percent(x, y) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp ratio of the lower-cased, trimmed texts, 0 to 1."""
    out = []
    for x, y in zip(a, b):
        out.append(SequenceMatcher(None, x.lower().strip(), y.lower().strip()).ratio())
    return pd.Series(out, dtype="float64")


def most_edits(n: Column, m: Column, cut: float) -> Column:
    """Most insertions plus deletions between texts of these lengths with a similarity of at least `cut`."""
    return F.floor((n + m) * F.lit(1 - cut) + F.lit(1e-9))


def gram_keys(text: Column, cut: float) -> Column:
    """Prefix-filter keys of a text: any two texts with an indel similarity of at least `cut` have a key in common.

    A deletion touches at most q of a text's q-grams and an insertion q - 1, so a text of length n keeps all but
    (q - 1/2) * edits + (n - m) / 2 of them in a similar text of length m. One more than the most it can lose, in an order that all
    texts share, must meet the other text's. A text too short for that gives all its grams and a key for all such texts. The keys
    are at most one more than the characters.
    """
    q = 3 if cut >= 0.85 else 2
    n = F.length(text)
    least = cut / (2 - cut)
    longer = (q - 0.5) * (1 - cut) > 0.5
    m = F.floor(n / F.lit(least) + F.lit(1e-9)) if longer else F.ceil(n * F.lit(least) - F.lit(1e-9))
    lost = F.floor(F.lit((q - 0.5) * (1 - cut)) * (n + m) + (n - m) / 2 + F.lit(1e-9)).cast("int")
    places = F.when(n >= q, F.sequence(F.lit(1), n - (q - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.array_sort(F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.substring(text, i, F.lit(q))))))
    return F.when(lost < F.size(grams), F.slice(grams, F.lit(1), lost + 1)).otherwise(F.array_append(grams, F.lit(0).cast("bigint")))
