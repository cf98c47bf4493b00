"""From raw documents to packed training sequences: five stages, each an operator of waymark.llm over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read back for the next one. All
but the last return the columns of documents. Null, empty and very long texts, repeated rows, empty tables and extra columns
go through every stage as the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from waymark.llm import contamination, packing, pii, quality, simhash
from waymark.llm.queries import table, tokenizer
from waymark.llm.store import checkpointed, shared_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is at least one half."""
    rows = quality.with_quality(docs, table(spark, sf_dir, "labels"))
    return rows.filter("_q.p_quality >= 0.5").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows without an id are kept only if no such row holds one with the same text."""
    key = F.struct(F.col("doc_id").alias("i"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("t"))
    keyed = docs.select(key.alias("_key"), "text", F.struct(*docs.columns).alias("_row"))
    found = contamination.contaminated(keyed.select("_key", "text"), table(spark, sf_dir, "benchmark"), id_col="_key")
    gone = checkpointed(found.select("_key").distinct())
    return keyed.join(F.broadcast(gone) if gone.count() <= simhash.BROADCAST_KEYS else gone, keyed["_key"].eqNullSafe(gone["_key"]), "left_anti").select("_row.*")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets; n_chars follows the text."""
    found = pii.find(docs.select(F.col("text").alias("_text"), F.struct(*docs.columns).alias("_row")), text_col="_text", only=["_row"])
    text = pii.redacted(F.col("_row.text"), F.col("spans"))
    rows = found.select("_row", text.alias("_text"))
    return rows.select(*[F.col("_text").alias(c) if c == "text" else F.length("_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                         else F.col("_row")[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of at most 4096 tokens, ids included."""
    return packing.packed(docs, tokenizer("word_bpe_49k.json"), end_id=2, with_ids=True)


STAGES = [("quality", keep_good), ("near_duplicates", drop_near_copies), ("decontamination", drop_contaminated), ("pii", redact_pii), ("packing", pack_sequences)]
#: SQL has no logistic regression, SimHash or tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps lies as Parquet in the shared folder."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
