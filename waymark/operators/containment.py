"""Substring joins through an index of character grams.

A text contains a search term only if it has all of the term's grams. Each term is looked up by its rarest gram among the
texts, an equi-join, and `contains` decides on what meets there; terms that are rare anywhere never meet the common texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """The distinct substrings of this many characters."""
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(size))))


def holders(terms: DataFrame, term: str, texts: DataFrame, text: str) -> DataFrame:
    """(text, terms): the distinct texts that contain any of the terms, each with the array of those it contains.

    Null and empty terms and null texts are left out. Terms and texts are compared as they are. An array is at most as long
    as its text has substrings.
    """
    needles = terms.select(F.col(term).alias("term")).filter("term is not null and term <> ''").distinct()
    hays = texts.select(F.col(text).alias("text")).filter("text is not null and text <> ''").distinct()
    sizes = sorted(r[0] for r in needles.select(F.least(F.length("term"), F.lit(GRAM))).distinct().collect())
    own = F.flatten(F.array(*[F.when(F.least(F.length("term"), F.lit(GRAM)) == s, _grams(F.col("term"), s)).otherwise(F.array().cast("array<string>")) for s in sizes])) if sizes else F.array().cast("array<string>")
    wanted = needles.select("term", F.explode(own).alias("gram"))
    found = hays.select("text", F.explode(F.flatten(F.array(*[_grams(F.col("text"), s) for s in sizes])) if sizes else F.array().cast("array<string>")).alias("gram"))
    # only grams of terms are counted; a gram that no text has rules its term out
    counts = found.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = wanted.join(counts, "gram", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).filter("r.n > 0")
    meeting = found.join(rarest.select("term", F.col("r.gram").alias("gram")), "gram").filter(F.col("text").contains(F.col("term")))
    return meeting.groupBy("text").agg(F.array_sort(F.collect_set("term")).alias("terms"))
