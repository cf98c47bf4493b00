"""Small builders that turn rule lists into column expressions.

Vocabularies, weights and thresholds are plain Python lists handed in by the
caller. They are configuration, so they are compiled into the plan: no join,
no broadcast and no Python at run time.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, functions as F


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def yes(cond: Column) -> Column:
    """A condition with NULL read as false."""
    return F.coalesce(cond, F.lit(False))


def first_match(rules: list[tuple[Column, object]], default=None) -> Column:
    """Value of the first rule that holds."""
    out = None
    for cond, value in rules:
        out = F.when(cond, _col(value)) if out is None else out.when(cond, _col(value))
    return out.otherwise(_col(default))


def weighted_flags(parts: list[tuple[Column, float]]) -> Column:
    """Sum of the weights whose condition holds."""
    zero = F.lit(0) if all(isinstance(w, int) for _, w in parts) else F.lit(0.0)
    return reduce(add, [F.when(yes(c), F.lit(w)).otherwise(zero) for c, w in parts])


def flag_names(flags: list[tuple[Column, object]]) -> Column:
    """Names of the conditions that hold, in rule order."""
    picked = F.array(*[F.when(yes(c), _col(n)) for c, n in flags])
    return F.filter(picked, lambda x: x.isNotNull())


def contains_any(c: Column, words: list[str]) -> Column:
    return yes(reduce(or_, [c.contains(w) for w in words])) if words else F.lit(False)


def word_in(c: Column, word: str) -> Column:
    """Whole-word occurrence."""
    return yes(c.rlike(rf"(?U)\b{re.escape(word)}\b"))


def any_word_in(c: Column, words: list[str]) -> Column:
    return yes(c.rlike(rf"(?U)\b({'|'.join(map(re.escape, words))})\b")) if words else F.lit(False)


def tiers(c: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first threshold reached, thresholds given high to low."""
    return first_match([(c >= F.lit(t), label) for t, label in steps], otherwise)
