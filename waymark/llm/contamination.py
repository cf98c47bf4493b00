"""Benchmark decontamination: short test items inside long documents.

Items are partitioned by their number of shingles. Each size class searches document windows of its own size with MinHash,
so that the Jaccard bound that a containment of 0.8 implies does not sink with the length of the document; candidates are
verified by exact shingle containment in the whole document.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from waymark.llm import text as T
from waymark.llm.windows import PatternIndex

#: Items per pass over the documents: bounds what travels with a task (about 64 hashes and the shingles of each item).
ITEMS_PER_PASS = 4096


def item_blocks(items: DataFrame, per_pass: int = ITEMS_PER_PASS):
    """The items in blocks of at most `per_pass`, each brought to the driver on its own, in ascending id and text."""
    rows = items.select("item_id", "text").distinct()
    after = None
    while True:
        here = rows if after is None else rows.filter(F.struct(
            F.coalesce("item_id", F.lit(-(1 << 63))).alias("i"), F.coalesce("text", F.lit("")).alias("t"), F.col("text").isNotNull().alias("k")) > after)
        block = here.orderBy(F.col("item_id").asc_nulls_first(), F.coalesce("text", F.lit("")), F.col("text").isNotNull()).limit(per_pass).collect()
        if block:
            yield [(r.item_id, r.text) for r in block]
        if len(block) < per_pass:
            return
        last = block[-1]
        after = F.struct(F.lit(-(1 << 63) if last.item_id is None else last.item_id).cast("bigint").alias("i"),
                         F.lit(last.text or "").alias("t"), F.lit(last.text is not None).alias("k"))


def contaminated(docs: DataFrame, items: DataFrame, width: int = 5, containment: float = 0.8, miss: float = 1e-6,
                 id_col: str = "doc_id", text_col: str = "text", per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """(id, item_id, n_shingles, n_found, containment): items of which at least `containment` of the distinct shingles stand in a document.

    Shingles are runs of `width` lower-cased words; an item with fewer words is one shingle of all of them, an item or
    document without words (null, empty) matches nothing. The documents are read once for every `per_pass` items and never
    shuffled. A pair whose shingles stand together is missed with probability `miss` at most; what is returned is exact.
    Repeated documents come back as often as they are given, equal (item_id, text) rows count once.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, item_id long, n_shingles long, n_found long"
    narrow = docs.select(id_col, text_col)
    out = None
    for block in item_blocks(items, per_pass):
        index = PatternIndex(block, width, containment, rows=1, miss=miss, wide=True)
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batch, shared=shared):
            got = shared.value.verified(batch.column(1).to_pylist())
            if got:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([g[0] for g in got], pa.int64())),
                                                  pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                                                  pa.array([g[3] for g in got], pa.int64())], names=[id_col, "item_id", "n_shingles", "n_found"])

        part = T.mapped(narrow, run, schema, text_col)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumn("containment", F.col("n_found") / F.col("n_shingles"))
