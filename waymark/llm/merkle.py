"""Document fingerprints: a Merkle tree over paragraphs and sections, in DataFrame functions only.

A paragraph is a line with its line end. Its node is the SHA-256 of its text; a section is a run of paragraphs that ends
with one whose node begins with the hex digit 0 (about one in sixteen), so an edit moves section borders only around
itself; a section's node is the SHA-256 of its paragraphs' nodes and the root that of the sections' nodes. Equal roots mean
equal texts; where two roots differ, comparing sections and then paragraphs locates the edit.

For likeness every paragraph also has marks: 32-bit hashes of its clauses, cut after punctuation and at most MARK
characters long. The marks cover the whole text; likeness is twice the shared distinct marks over the marks of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

MARK = 32
_PARAGRAPH = r"[^\n]*\n|[^\n]+"
# Punctuation that ends a clause.
_STOPS = r".!?,;:|\n。！？、，；："
_CLAUSE = rf"[^{_STOPS}]{{1,{MARK}}}[{_STOPS}]*|[{_STOPS}]+"
#: Ranges of ids that are numbered on their own: at most this many bounds reach the driver.
MOST_RANGES = 65_536


def _all_of(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def marks(text: Column) -> Column:
    """The distinct 32-bit hashes of a text's clauses."""
    return F.array_distinct(F.transform(_all_of(F.coalesce(text, F.lit("")), _CLAUSE), lambda c: F.hash(c)))


def tree(text: Column) -> Column:
    """root, section nodes and paragraph nodes of a text (null: empty)."""
    paragraphs = F.transform(_all_of(F.coalesce(text, F.lit("")), _PARAGRAPH), lambda p: F.sha2(p.cast("binary"), 256))
    sections = F.transform(
        F.filter(F.split(F.concat(F.lit("#"), F.array_join(paragraphs, "#")), "(?<=#0.{63})"), lambda s: F.length(s) > 1),
        lambda s: F.sha2(F.concat(F.lit("section"), s).cast("binary"), 256))
    root = F.sha2(F.concat(F.lit("document"), F.array_join(sections, "#")).cast("binary"), 256)
    return F.struct(root.alias("root"), sections.alias("sections"), paragraphs.alias("paragraphs"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from the marks of two texts; two empty texts are alike."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """(first, last_a, last_b): the run of paragraphs, counted from 0, outside the common start and end of two trees; null for equal roots.

    This is where an edit of one place lies: paragraphs first..last_a of the one text became first..last_b of the other.
    """
    n, m = F.size(a["paragraphs"]), F.size(b["paragraphs"])
    least = F.least(n, m)

    def same_run(x: Column, y: Column, most: Column) -> Column:
        differs = F.filter(F.sequence(F.lit(0), most), lambda i: (i == most) | ~F.get(x, i).eqNullSafe(F.get(y, i)))
        return F.element_at(differs, 1)

    head = same_run(a["paragraphs"], b["paragraphs"], least)
    tail = same_run(F.reverse(a["paragraphs"]), F.reverse(b["paragraphs"]), least - head)
    return F.when(a["root"] != b["root"], F.struct(head.alias("first"), (n - tail - 1).alias("last_a"), (m - tail - 1).alias("last_b")))


def changed_sections(a: Column, b: Column) -> Column:
    """Sections of the first tree that the second lacks."""
    return F.size(F.array_except(a["sections"], b["sections"]))


def _range_number(key: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at most the key: a 64-way search in a constant array."""
    if not bounds:
        return F.lit(0)
    table = F.from_json(F.lit("[" + ",".join(map(str, bounds)) + "]"), "array<bigint>")

    def passed(at: Column, stride: int) -> Column:
        return F.size(F.filter(F.sequence(F.lit(1), F.lit(64)), lambda k: F.get(table, at + k * stride - 1) <= key))

    at, stride = F.lit(0), 1
    while stride * 64 < len(bounds):
        stride *= 64
    while stride:
        at = at + stride * passed(at, stride)
        stride //= 64
    return at


def _bounds(docs: DataFrame, id_col: str, rows_per_range: int) -> list[int]:
    total = docs.count()
    n = min(MOST_RANGES, -(-total // rows_per_range))
    if n <= 1:
        return []
    got = docs.agg(F.percentile_approx(id_col, [i / n for i in range(1, n)], 4 * n).alias("q")).first().q
    return sorted(set(got or []))


def with_next(docs: DataFrame, id_col: str = "doc_id", values: tuple[str, ...] = (), rows_per_range: int = 1024) -> DataFrame:
    """Every row with `next`, a struct of the given columns of the row before it in ascending id order; the first row gets the last.

    Ids are cut into ranges at quantiles and each range is a window of its own; the last rows of a range are copied into the
    next range, so no window holds more than its range and nothing is sorted in one task. Equal ids (and nulls, which come
    first) follow in the order of the given columns.
    """
    key = F.col(id_col)
    ranged = docs.withColumn("_range", F.when(key.isNull(), F.lit(0)).otherwise(_range_number(key, _bounds(docs, id_col, rows_per_range))))
    last = ranged.groupBy("_range").agg(F.max(id_col).alias("_last"))
    order = W.orderBy("_range")
    # one row per range: bounded by MOST_RANGES
    ends = last.select(F.col("_range").alias("_from"), "_last",
                       F.coalesce(F.lead("_range").over(order), F.first("_range").over(order)).alias("_to"))
    copied = ranged.join(F.broadcast(ends), (F.col("_range") == F.col("_from")) & key.eqNullSafe(F.col("_last")), "left")
    own = F.struct(F.lit(1).alias("own"), F.col("_range").alias("range"))
    both = copied.withColumn("_as", F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(
        F.array(own, F.struct(F.lit(0).alias("own"), F.col("_to").alias("range"))))))
    window = W.partitionBy("_as.range").orderBy("_as.own", F.col(id_col).asc_nulls_first(), *values)
    return both.withColumn("next", F.lag(F.struct(*values)).over(window)).filter("_as.own = 1").drop("_range", "_from", "_last", "_to", "_as")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and where the edit lies.

    The edited text has the last floor(n / 3) code points replaced by the first as many of the next document in descending
    id order (after the last: the first). Null and empty texts have the root of the empty tree and likeness 1 to each other,
    0 to any other. A table of one row is its own next document; equal ids follow in text order; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("marks", marks(F.col("text"))), "doc_id", ("text", "marks"))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 3) as int))"), F.substring("next.text", F.lit(1), cut)))
    rows = rows.withColumns({"tree": tree(F.col("text")), "new": tree(F.col("edited")), "new_marks": marks(F.col("edited"))}).withColumn("at", changed_paragraphs(F.col("tree"), F.col("new")))
    return rows.select(
        "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("tree.root").alias("fingerprint"), F.col("new.root").alias("edited_fingerprint"),
        likeness(F.col("marks"), F.col("new_marks")).alias("near_edited"), likeness(F.col("marks"), F.col("next.marks")).alias("near_next"),
        F.size("tree.sections").alias("n_sections"), F.size("tree.paragraphs").alias("n_paragraphs"),
        changed_sections(F.col("tree"), F.col("new")).alias("changed_sections"), F.col("at.first").alias("first_changed_paragraph"),
        F.col("at.last_a").alias("last_changed_paragraph"))
