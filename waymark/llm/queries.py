"""The operators of this subpackage applied to whole tables, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from waymark.llm import contamination, dialogues, hmm, licenses, merkle, packing, pii, quality, simhash, token_files, toxicity, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    """Where a public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_merkle_fingerprints(spark, sf_dir):
    return merkle.fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op2_warc_normaliser(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op3_quality_classifier(spark, sf_dir):
    return quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_token_files(spark, sf_dir):
    manifest = token_files.write(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)
    return token_files.read(spark, manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op5_hidden_markov_model(spark, sf_dir):
    return hmm.scored(table(spark, sf_dir, "documents"))


@query
def op6_packing(spark, sf_dir):
    cut = packing.packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=2)
    return cut.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op7_pii(spark, sf_dir):
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), only=["doc_id"])
    counts = [F.size(pii.of_kind("base", k)).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


# DuckDB: a text with A-Z lower-cased and every run of blanks as one space, with a space at both ends
_LINE = "' ' || trim(regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D ]+', ' ', 'g'), ' ') || ' '"
_SHINGLES = """
item_words AS (SELECT key, string_split(trim({line}, ' '), ' ') AS w FROM patterns WHERE trim({line}, ' ') <> ''),
item_shingles AS (
  SELECT DISTINCT key, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT key, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM item_words)),
lines AS (SELECT doc_id, {docline} AS line FROM documents),
sizes AS (SELECT key, count(*) AS n FROM item_shingles GROUP BY key),
hits AS (SELECT doc_id, key, count(*) AS n_found FROM lines, item_shingles WHERE contains(line, ' ' || s || ' ') GROUP BY doc_id, key)
""".format(line=_LINE.format("text"), docline=_LINE.format("coalesce(text, '')"))


@query
def op8_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


ORACLES["op8_license_scan"] = ("WITH patterns(key, text) AS (VALUES " + ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in licenses.TEMPLATES) + "), "
                               + _SHINGLES + "SELECT doc_id, key AS template, n AS n_shingles, n_found, n_found / n AS containment "
                               "FROM hits JOIN sizes USING (key) WHERE n_found >= 0.8 * n")


@query
def op9_decontamination(spark, sf_dir):
    return contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op9_decontamination"] = ("WITH patterns AS (SELECT item_id AS key, text FROM benchmark), " + _SHINGLES
                                  + "SELECT doc_id, key AS item_id, n AS n_shingles, n_found, n_found / n AS containment "
                                  "FROM hits JOIN sizes USING (key) WHERE n_found >= 0.8 * n")


@query
def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), tau=2, width=3)


@query
def op11_toxicity(spark, sf_dir):
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op12_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    rows = vector_codes.with_label_error(coded)
    return rows.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256"))


def _lloyd_sql(rounds: int = 2) -> str:
    """Full search in every round, in DuckDB."""
    out = ["""WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, row_number() OVER (ORDER BY vec_id) AS rn
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
parts AS (SELECT vec_id, label, rn, p, v[p * 4 + 1] AS a, v[p * 4 + 2] AS b, v[p * 4 + 3] AS c, v[p * 4 + 4] AS d FROM kept, range(16) AS t(p)),
book0 AS (SELECT p, rn - 1 AS e, a, b, c, d FROM parts WHERE rn <= 64)"""]
    for k in range(rounds + 1):
        out.append(f"""near{k} AS (
  SELECT p, rn, min({{'d': (x.a - y.a) ** 2 + (x.b - y.b) ** 2 + (x.c - y.c) ** 2 + (x.d - y.d) ** 2, 'e': e}}) AS best
  FROM parts x JOIN book{k} y USING (p) GROUP BY p, rn)""")
        if k < rounds:
            mean = ", ".join(f"coalesce(CAST(floor(m.{c} / m.n) AS BIGINT), o.{c}) AS {c}" for c in "abcd")
            out.append(f"""means{k} AS (
  SELECT p, best.e AS e, count(*) AS n, sum(a) AS a, sum(b) AS b, sum(c) AS c, sum(d) AS d FROM near{k} JOIN parts USING (p, rn) GROUP BY p, best.e),
book{k + 1} AS (SELECT o.p, o.e, {mean} FROM book{k} o LEFT JOIN means{k} m USING (p, e))""")
    last = rounds
    out.append(f"""coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{last} JOIN kept USING (rn) GROUP BY vec_id, label, rn),
digest AS (SELECT sha256(string_agg(a || ',' || b || ',' || c || ',' || d, ',' ORDER BY p, e)) AS s FROM book{last})""")
    return ",\n".join(out) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256 FROM coded, digest"""


ORACLES["op12_vector_codes"] = _lloyd_sql()


@query
def op13_dialogue_repair(spark, sf_dir):
    return dialogues.repair(dialogues.damaged(table(spark, sf_dir, "conversations")))
