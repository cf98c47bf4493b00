"""Reading and staging source data."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from waymark.functions.text import blank_to_null
from waymark.operators.ranking import keep_first, ordered_numbered
from waymark.sources import schemas

# Tag keys that make categories, address parts, listing keywords.
CATEGORY_TAGS = ["tourism", "historic", "natural", "waterway", "leisure", "amenity"]
ADDRESS_TAGS = ["addr:street", "addr:housenumber", "addr:city", "addr:postcode"]
LISTING_WORDS = ["pantai", "curup", "air terjun", "pulau", "gunung", "wisata", "taman"]


def path_region(path: Column, default: str = "unknown_region") -> Column:
    """Folder before the first YYYY-MM-DD folder, as a slug."""
    name = F.regexp_extract(F.regexp_replace(path, r"\\", "/"), r"(?:^|/)([^/]+)/[0-9]{4}-[0-9]{2}-[0-9]{2}(?:/|$)", 1)
    slug = F.lower(F.regexp_replace(name, "[- ]", "_"))
    return F.when(name == "", F.lit(default)).otherwise(slug)


def path_date(path: Column, run_date: str) -> Column:
    found = F.regexp_extract(F.regexp_replace(path, r"\\", "/"), r"(?:^|/)([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)", 1)
    return F.when(found == "", F.lit(run_date)).otherwise(found)


def source_path() -> Column:
    """Path of the file a row was read from, as written on disk (Spark reports it URL-encoded)."""
    return F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))


def read_place_export(spark: SparkSession, path: str) -> DataFrame:
    """Rows of place export files (JSON arrays); unreadable files give one row with `_corrupt`."""
    schema = T.StructType(schemas.PLACE_EXPORT.fields + [T.StructField("_corrupt", T.StringType())])
    raw = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return raw.withColumn("file_path", source_path())


def _reject_reason() -> Column:
    return F.when(F.col("_corrupt").isNotNull(), F.lit("Record is not a JSON object")).when(
        F.coalesce("title", F.lit("")) == "", F.lit("Missing title field"))


def export_rejects(raw: DataFrame) -> DataFrame:
    return raw.withColumn("reason", _reject_reason()).filter(F.col("reason").isNotNull()).select("file_path", "reason", F.coalesce("_corrupt", F.to_json(F.struct(*schemas.PLACE_EXPORT.fieldNames()))).alias("payload"))


def export_places(raw: DataFrame, run_time: str) -> DataFrame:
    """Raw place rows from accepted export rows."""
    c = F.col
    made = F.substring(F.sha2(F.concat_ws("_", "title", F.coalesce(c("location.lat").cast("string"), F.lit("0.0")), F.coalesce(c("location.lng").cast("string"), F.lit("0.0"))), 256), 1, 16)
    pid = F.coalesce(blank_to_null(c("placeId")), blank_to_null(c("cid")), made)
    cats = F.coalesce("categories", F.array().cast("array<string>"))
    main = blank_to_null(c("categoryName"))
    region = path_region(c("file_path"))
    good = raw.filter(_reject_reason().isNull())
    return good.select(
        F.concat(F.lit("apify_google_maps_"), pid).alias("source_record_id"), F.lit("apify_google_maps").alias("source"), pid.alias("source_place_id"), c("url").alias("source_url"),
        F.when(region != "unknown_region", region).otherwise(F.coalesce("city", F.lit("unknown_region"))).alias("query_region"), F.coalesce("searchString", F.lit("N/A")).alias("query_keyword"),
        c("title").alias("raw_name"), c("address").alias("raw_address"),
        F.when(main.isNotNull() & ~F.array_contains(cats, main), F.concat(F.array(main), cats)).otherwise(cats).alias("raw_categories"), c("file_path").alias("raw_payload_path"),
        c("location.lat").alias("latitude"), c("location.lng").alias("longitude"), F.coalesce("scrapedAt", F.lit(run_time)).alias("collected_at"),
        c("totalScore").alias("rating"), c("reviewsCount").alias("review_count"), F.coalesce(blank_to_null(c("phoneUnformatted")), c("phone")).alias("phone"), "website",
        c("openingHours").alias("opening_hours"), c("additionalInfo").alias("facilities"), c("permanentlyClosed").alias("permanently_closed"), c("temporarilyClosed").alias("temporarily_closed"),
        "description", c("neighborhood").alias("district"), c("postalCode").alias("postal_code"), c("imageUrl").alias("image_url"))


def flatten_map_elements(payload: DataFrame, region: Column, run_time: str) -> DataFrame:
    """Raw place rows from map elements (column `elements`): named ones only."""
    e = payload.select(region.alias("query_region"), F.explode("elements").alias("e")).select("query_region", "e.*")
    usable = lambda a, b: F.when(F.coalesce(F.col("lat"), F.lit(0.0)).eqNullSafe(0.0) | F.coalesce(F.col("lon"), F.lit(0.0)).eqNullSafe(0.0), b).otherwise(a)
    tag = lambda k: F.try_element_at("tags", F.lit(k))
    name = F.coalesce(blank_to_null(tag("name")), blank_to_null(tag("official_name")))
    cats = F.filter(F.array(*[F.concat(F.lit(f"{k}="), tag(k)) for k in CATEGORY_TAGS]), lambda x: x.isNotNull())
    address = F.array_join(F.filter(F.array(*[blank_to_null(tag(k)) for k in ADDRESS_TAGS]), lambda x: x.isNotNull()), ", ")
    place = F.concat_ws("/", "type", F.col("id").cast("string"))
    return e.select(
        F.concat_ws("_", F.lit("osm"), "type", F.col("id").cast("string")).alias("source_record_id"), F.lit("osm").alias("source"), place.alias("source_place_id"),
        F.concat(F.lit("https://www.openstreetmap.org/"), place).alias("source_url"), "query_region", F.lit("bulk_overpass").alias("query_keyword"), name.alias("raw_name"),
        F.coalesce(blank_to_null(address), tag("addr:full")).alias("raw_address"), cats.alias("raw_categories"),
        usable(F.col("lat"), F.col("center.lat")).alias("latitude"), usable(F.col("lon"), F.col("center.lon")).alias("longitude"), F.lit(run_time).alias("collected_at"),
    ).filter(F.col("raw_name").isNotNull())


def flatten_places_response(responses: DataFrame, column: str, default_name: str = "Unknown") -> DataFrame:
    """Place rows from JSON responses with a `places` array; places without id are dropped."""
    parsed = responses.withColumn("_r", F.from_json(column, schemas.PLACES_RESPONSE))
    p = parsed.select(*[c for c in responses.columns if c != column], F.explode_outer("_r.places").alias("p")).filter(F.coalesce("p.id", F.lit("")) != "")
    return p.select(
        *[c for c in responses.columns if c != column], F.col("p.id").alias("source_place_id"), F.coalesce("p.displayName.text", F.lit(default_name)).alias("raw_name"),
        F.col("p.formattedAddress").alias("raw_address"), F.col("p.location.latitude").alias("latitude"), F.col("p.location.longitude").alias("longitude"),
        F.coalesce("p.types", F.array().cast("array<string>")).alias("raw_categories"), F.col("p.websiteUri").alias("website"), F.col("p.internationalPhoneNumber").alias("phone"))


class _Listing(HTMLParser):
    """Texts of listing elements with their links; nested elements each count."""

    TAGS = ("a", "div", "h3", "h4")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[list] = []
        self.found: list[tuple[str, str | None]] = []
        self.muted = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.muted += 1
        elif tag in self.TAGS:
            self.open.append([tag, dict(attrs).get("href") if tag == "a" else None, []])

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.muted = max(0, self.muted - 1)
        elif tag in self.TAGS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    _, link, parts = self.open.pop(i)
                    self.found.append(("".join(parts).strip(), link))
                    break

    def handle_data(self, data):
        if not self.muted:
            for item in self.open:
                item[2].append(data)


def extract_listing_items(pages: DataFrame, words: list[str] = LISTING_WORDS, shortest: int = 5, longest: int = 100) -> DataFrame:
    """Names in listing elements of stored pages (page_id, url, html) that contain one of the words.

    Length and word filters run in Spark after the parse, so the Python part only parses.
    """
    def parse(batches):
        for pdf in batches:
            rows = []
            for page_id, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                p = _Listing()
                p.feed(html or "")
                p.close()
                for text, link in p.found:
                    if shortest < len(text) < longest:
                        rows.append((page_id, text, urljoin(url, link) if link else url))
            yield pd.DataFrame(rows, columns=["page_id", "name", "url"])

    kind = dict(pages.dtypes)["page_id"]
    items = pages.select("page_id", "url", "html").mapInPandas(parse, f"page_id {kind}, name string, url string")
    hit = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.lower("name").contains(w))
    return items.filter(hit)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV, Parquet or JSON lines by extension, with a declared schema."""
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext == "parquet":
        return spark.read.schema(schema).parquet(path)
    if ext == "csv":
        return spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if ext in ("jsonl", "json"):
        return spark.read.schema(schema).option("multiLine", ext == "json").json(path)
    raise ValueError(f"unknown table format: {path}")


def read_reviews(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Review files (array or single object); mode and batch come from the last two path parts."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    file = source_path()
    return df.select("*", F.regexp_extract(file, r"([^/]+)/[^/]+\.json$", 1).alias("mode"), F.regexp_extract(file, r"([^/]+)\.json$", 1).alias("batch_id"))


# ---- incremental import --------------------------------------------------


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content is not in the manifest yet; of equal new files only the first path.

    files: path, checksum. Checksums from `file_checksums`.
    """
    fresh = files.join(manifest.select("checksum"), "checksum", "left_anti")
    return keep_first(fresh, ["checksum"], [F.col("path").asc()])


def file_checksums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("checksum"))


def upsert_last(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Union of both with the last row per key by (incoming over existing, order)."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, [key], [F.col("_new").desc(), F.col(order).desc()]).drop("_new")


def update_manifest(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """New entries replace old ones of the same path."""
    return manifest.join(entries.select("path"), "path", "left_anti").unionByName(entries)


def import_incremental(files: DataFrame, rows_of, manifest: DataFrame, existing: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """One import run: skip files whose content is known, stage the rows of the others, upsert them, and renew the manifest.

    files and manifest: path, checksum; rows_of(new files) gives their rows. Returns the table and the manifest to be kept.
    """
    fresh = new_files(files, manifest)
    return upsert_last(existing, rows_of(fresh), key, order), update_manifest(manifest, fresh.select(*manifest.columns))


def union_first_wins(sources: list[DataFrame], key: str, seq: str) -> DataFrame:
    """All sources in order; per key the first row of the first source that has it."""
    out = None
    for rank, df in enumerate(sources):
        part = df.withColumn("_rank", F.lit(rank))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return keep_first(out, [key], [F.col("_rank").asc(), F.col(seq).asc()]).drop("_rank")


def reconcile_counts(raw: DataFrame, staged: DataFrame, manifest: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Rows per file in raw, staged and manifest, with whether they agree.

    manifest: key, expected. `strict` raises when any file disagrees.
    """
    a = raw.groupBy(key).agg(F.count("*").alias("raw_rows"))
    b = staged.groupBy(key).agg(F.count("*").alias("staged_rows"))
    out = a.join(b, key, "full").join(manifest, key, "full").fillna(0, ["raw_rows", "staged_rows", "expected"])
    out = out.withColumn("agrees", (F.col("raw_rows") == F.col("staged_rows")) & (F.col("raw_rows") == F.col("expected")))
    if strict:
        bad = out.filter("NOT agrees").count()
        if bad:
            raise ValueError(f"{bad} files do not reconcile")
    return out


# ---- batches -------------------------------------------------------------


def assign_batches(df: DataFrame, key: str, size: int, modes: list[str], first_strategy: str = "review_strategy_v1", strategy: str = "review_strategy_v2",
                   slices: int = 64) -> DataFrame:
    """Rows in key order cut into batches of `size`, one row per member and mode, with strategy and targets."""
    n = ordered_numbered(df.select(key), key, "_n", slices)
    number = F.floor((F.col("_n") - 1) / size) + 1
    b = n.select(key, F.concat(F.lit("batch_"), F.lpad(number.cast("string"), 3, "0")).alias("short"), number.alias("no"))
    b = b.withColumn("batch_id", F.when(F.col("no") < 1000, F.col("short")).otherwise(F.concat(F.lit("batch_"), F.col("no").cast("string"))))
    first = F.col("batch_id") == "batch_001"
    return b.select(
        key, "batch_id", F.explode(F.array(*[F.lit(m) for m in modes])).alias("mode"), F.when(first, F.lit(first_strategy)).otherwise(F.lit(strategy)).alias("strategy_version"),
        F.lit(5).alias("target_positive"), F.when(first, 5).otherwise(3).alias("target_negative"), F.when(first, 3).otherwise(2).alias("target_neutral"))


def batch_states(manifest: DataFrame, batch: str, modes: int = 3) -> DataFrame:
    """Batch status: completed when all modes are there, completed and their files exist."""
    ok = (F.col("status") == "completed") & F.col("file_exists")
    per = manifest.groupBy(batch).agg(F.count_distinct("mode").alias("n_modes"), F.bool_and(ok).alias("all_ok"), F.count("*").alias("n_entries"))
    return per.withColumn("batch_status", F.when((F.col("n_modes") == modes) & F.col("all_ok"), F.lit("completed")).otherwise(F.lit("pending")))


def batch_members(manifest: DataFrame, batch: str, members: str) -> DataFrame:
    return manifest.select(batch, "mode", F.explode(members).alias("canonical_id"))


def resume_set(states: DataFrame, retry_limit: int = 3) -> DataFrame:
    """Entries to run again, with attempts counted and given up after the limit."""
    retry = F.col("status") == "failed"
    attempts = F.when(retry, F.col("attempts") + 1).otherwise(F.col("attempts"))
    status = F.when(retry & (attempts >= retry_limit), F.lit("failed_terminal")).otherwise(F.col("status"))
    out = states.withColumns({"attempts": attempts, "status": status})
    return out.withColumn("run_again", F.col("status").isin("pending", "failed", "processing"))
