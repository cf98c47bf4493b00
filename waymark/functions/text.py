"""Text clean-up as column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# (?U) makes Java treat \s, \w and \b as Unicode classes.
SPACES = r"(?U)\s+"


def collapse_whitespace(c: Column) -> Column:
    """Runs of white space become one blank; empty text becomes NULL."""
    return F.nullif(F.trim(F.regexp_replace(c, SPACES, " ")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def is_filled(c: Column) -> Column:
    """True for non-null text with at least one visible character; never NULL."""
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def matching_name(c: Column, phrases: list[str]) -> Column:
    """Name reduced to its distinctive words.

    The phrases are removed one after the other, longest first (ties keep the
    given order), because a phrase may only appear once another one is gone.
    """
    plain = F.regexp_replace(F.lower(c), r"(?U)[^\w\s]", " ")
    longest_first = sorted(phrases, key=len, reverse=True)
    stripped = reduce(
        lambda acc, phrase: F.regexp_replace(acc, rf"(?U)\b{re.escape(phrase)}\b", " "), longest_first, plain
    )
    return F.coalesce(collapse_whitespace(stripped), F.trim(F.lower(c)))


def lexicon_text(c: Column) -> Column:
    """Lower-case ASCII words separated by single blanks, web addresses removed."""
    lowered = F.trim(F.lower(F.coalesce(c, F.lit(""))))
    no_urls = F.regexp_replace(lowered, r"http\S+|www\S+", "")
    words = F.regexp_replace(no_urls, r"[^a-z0-9\s]", " ")
    return F.trim(F.regexp_replace(words, r"\s+", " "))


def similarity_text(c: Column) -> Column:
    """Letters and digits only, lower case: equal for texts that differ in punctuation."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}_]", "")


def content_hash(c: Column) -> Column:
    return F.sha2(F.trim(F.coalesce(c, F.lit(""))), 256)


def natural_key(*cols: Column) -> Column:
    """Stable surrogate id: a digest of the natural key."""
    return F.sha2(F.concat_ws("|", *[c.cast("string") for c in cols]), 256)


def sorted_tokens(c: Column) -> Column:
    """The words of a text in alphabetical order."""
    return F.array_join(F.array_sort(F.split(F.trim(F.regexp_replace(c, SPACES, " ")), " ")), " ")
