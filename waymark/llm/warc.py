"""WARC archives: writing, normalising monolithic gzip files, and reading records by offset.

A monolithic archive is one gzip stream over all records, so no record can be read without inflating what stands before it.
The normaliser inflates such a stream once, writes every record as a gzip member of its own and a sidecar index with each
record's offset and length; readers then fetch single records or ranges of them.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from waymark.llm import text as T
from waymark.llm.store import opened, remove, shared_folder

CRLF = b"\r\n"
DATE = "2026-01-01T00:00:00Z"
PAGE = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Uncompressed bytes after which a writing task starts another archive.
ROLL_BYTES = 256 << 20
CHUNK = 1 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1", *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def _target(url: str) -> str:
    """A url that cannot break a header line: blanks and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit of the page `refers_to`: the HTTP head stays, with the length of the payload it stands for."""
    head = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}".encode()]) + CRLF * 2
    revisit = refers_to is not None
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"),
               ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", _target(url)))
    if revisit:
        headers += [("WARC-Refers-To", f"<{PAGE}{refers_to}>"), ("WARC-Profile", PROFILE)]
    return _record(headers, head if revisit else head + payload)


class RecordReader:
    """Splits an uncompressed WARC stream, fed in pieces, into whole records."""

    def __init__(self):
        self.rest = bytearray()

    def feed(self, data: bytes):
        self.rest += data
        at = 0
        while True:
            head = self.rest.find(CRLF * 2, at)
            if head < 0:
                break
            found = re.search(rb"(?im)^content-length:\s*(\d+)", bytes(self.rest[at:head]))
            stop = head + 4 + int(found[1] if found else 0) + 4
            if stop > len(self.rest):
                break
            yield bytes(self.rest[at:stop])
            at = stop
        del self.rest[:at]


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower case names) and block of one record."""
    head, _, block = record.partition(CRLF * 2)
    fields = {}
    for line in head.split(CRLF)[1:]:
        k, _, v = line.decode("utf-8", "replace").partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields, block[:-4]


def inflated(source, chunk: int = CHUNK):
    """The bytes of a gzip stream of any number of members, inflated piece by piece; a torn end gives what came before it."""
    z = zlib.decompressobj(31)
    while data := source.read(chunk):
        while data:
            yield z.decompress(data, 8 * chunk)
            data = z.unconsumed_tail
            if z.eof:
                data, z = z.unused_data, zlib.decompressobj(31)


def normalise(source, archive, index, level: int = 6) -> tuple[int, int]:
    """Rewrite one gzip stream as a member per record, with a line per record in the index; records written and bytes torn off."""
    reader, n, at = RecordReader(), 0, 0
    for data in inflated(source):
        for record in reader.feed(data):
            fields, _ = parsed(record)
            z = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = z.compress(record) + z.flush()
            archive.write(member)
            line = {"offset": at, "length": len(member), "id": fields.get("warc-record-id"), "type": fields.get("warc-type"),
                    "digest": fields.get("warc-payload-digest"), "url": fields.get("warc-target-uri")}
            index.write(json.dumps({k: v for k, v in line.items() if v is not None}).encode() + b"\n")
            at += len(member)
            n += 1
    return n, len(reader.rest)


def _roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Pages with payload, sha1 and, for revisits, the page they refer to. Equal payloads meet only as a grouped minimum."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload")).withColumn("bytes", F.octet_length("payload"))
    first = rows.groupBy("sha", "bytes").agg(F.min("page_id").alias("first"))
    later = (F.col("bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, ["sha", "bytes"]).select("page_id", "url", "payload", "sha", F.when(later, F.col("first")).alias("refers_to"))


def write_monolithic(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 6) -> list[str]:
    """Write a record per page into whole-file gzip archives below `folder`; their uris."""

    def run(batches):
        out = z = None
        size = 0
        for b in batches:
            for lo, hi in T.blocks([len(p) for p in (x.as_py() for x in b.column("payload"))], 1 << 22):
                for r in b.slice(lo, hi - lo).to_pylist():
                    if out is not None and size >= ROLL_BYTES:
                        out.write(z.flush())
                        out.close()
                        out = None
                    if out is None:
                        fs, path = opened(folder)
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out, z, size = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31), 0
                        yield pa.RecordBatch.from_pydict({"name": [name]})
                    record = page_record(r["page_id"], r["url"], r["payload"], base64.b32encode(bytes.fromhex(r["sha"])).decode(), r["refers_to"])
                    out.write(z.compress(record))
                    size += len(record)
        if out is not None:
            out.write(z.flush())
            out.close()

    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    return [f"{folder}/{r.name}" for r in _roles(pages, least_bytes).mapInArrow(run, "name string").collect()]


def _one_task_each(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema).repartitionByRange(max(1, len(rows)), *[c.split()[0] for c in schema.split(", ")])


def normalise_all(spark: SparkSession, archives: list[str], folder: str, level: int = 6) -> list[dict]:
    """Normalise every archive in a task of its own; uri, index uri, records and torn bytes of the new ones."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, source = opened(r["uri"])
                _, path = opened(folder)
                name = uuid.uuid4().hex
                with fs.open_input_stream(source, compression=None) as s, fs.open_output_stream(f"{path}/{name}.warc.gz", compression=None) as a, \
                        fs.open_output_stream(f"{path}/{name}.index") as i:
                    n, torn = normalise(s, a, i, level)
                yield pa.RecordBatch.from_pydict({"name": [name], "records": pa.array([n], pa.int64()), "torn": pa.array([torn], pa.int64())})

    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)
    if not archives:
        return []
    made = _one_task_each(spark, [(a,) for a in archives], "uri string").mapInArrow(run, "name string, records long, torn long").collect()
    return [{"uri": f"{folder}/{r.name}.warc.gz", "index": f"{folder}/{r.name}.index", "records": r.records, "torn": r.torn} for r in made]


def read(spark: SparkSession, archives: list[dict], records_per_task: int = 4000) -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of all records, each inflated from its own member.

    The digest of a response is taken from the bytes read, that of a revisit from its header; a revisit has a null payload.
    """
    parts = [(a["uri"], a["index"], lo, lo + records_per_task) for a in archives for lo in range(0, a["records"], records_per_task)]
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    if not parts:
        return spark.createDataFrame([], schema)
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                       ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, index = opened(r["index"])
                with fs.open_input_stream(index) as s:
                    lines = [json.loads(x) for x in s.read().splitlines()[r["lo"]:r["hi"]]]
                with fs.open_input_file(opened(r["uri"])[1]) as source:
                    rows, size = [], 0
                    for line in lines:
                        rows.append(_row(zlib.decompress(source.read_at(line["length"], line["offset"]), 31)))
                        size += rows[-1]["payload_bytes"]
                        if size > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return _one_task_each(spark, parts, "uri string, index string, lo long, hi long").mapInArrow(run, schema)


def _page(uri: str | None) -> int | None:
    found = re.fullmatch(rf"<{PAGE}(-?\d+)>", uri or "")
    return int(found[1]) if found else None


def _row(record: bytes) -> dict:
    fields, block = parsed(record)
    head, _, payload = block.partition(CRLF * 2)
    revisit = fields["warc-type"] == "revisit"
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
            "refers_to": _page(fields.get("warc-refers-to")), "payload_bytes": int(length[1]) if revisit else len(payload),
            "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:") if revisit else payload_digest(payload),
            "payload": None if revisit else payload}


def round_trip(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Pages (page_id, url, html) into monolithic archives, normalised, and read back through the sidecar index.

    Of pages with equal payloads of at least `least_bytes` bytes the smallest page_id is the response and the others are
    revisits; rows that repeat that page_id are responses too, and pages with a null id refer to it. Null html is an empty
    payload. Blanks and control characters of a url come back percent-encoded.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark)
    whole = write_monolithic(pages, f"{folder}/whole", least_bytes)
    members = normalise_all(spark, whole, f"{folder}/members")
    remove(f"{folder}/whole")
    return read(spark, members)
