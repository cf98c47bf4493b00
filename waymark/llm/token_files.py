"""Token-id files: the ids of all documents in a row, with Elias-Fano encoded document boundaries.

A file holds the documents of one range of ids, in ascending id order: magic, ids (two bytes each where the vocabulary
allows it, else four), then the footer with document ids and end offsets, both in Elias-Fano form, and a JSON trailer with
the sizes. The select structures give any document's offsets without a table of 64-bit numbers.
"""

from __future__ import annotations

import json
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from waymark.llm import text as T
from waymark.llm.elias_fano import EliasFano
from waymark.llm.store import opened, shared_folder
from waymark.llm.tokens import encoder

MAGIC = b"WMTOKEN1"
_TAIL = struct.Struct("<Q8s")


class TokenFileWriter:
    """Appends documents in ascending id order (nulls first) to one stream."""

    def __init__(self, out, id_bytes: int):
        self.out, self.kind = out, f"<u{id_bytes}"
        self.ids, self.lengths = [], []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids))
        self.out.write(ids.astype(self.kind).tobytes())

    def finish(self) -> dict:
        known = [i for i in self.ids if i is not None]
        least = known[0] if known else 0
        names = EliasFano.of(np.array([i - least for i in known], np.uint64)).to_bytes()
        ends = EliasFano.of(np.cumsum(np.array(self.lengths, np.uint64))).to_bytes()
        meta = {"kind": self.kind, "docs": len(self.ids), "null_ids": len(self.ids) - len(known), "least": least, "names": len(names),
                "ends": len(ends), "tokens": int(sum(self.lengths))}
        tail = json.dumps(meta).encode()
        self.out.write(names + ends + tail + _TAIL.pack(len(tail), MAGIC))
        return meta


class TokenFile:
    """Random access to one file: ids of the i-th document by two selects and one read."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        length, magic = _TAIL.unpack(source.read_at(_TAIL.size, size - _TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.meta = json.loads(source.read_at(length, size - _TAIL.size - length))
        at = size - _TAIL.size - length - self.meta["ends"]
        self.ends = EliasFano.from_bytes(source.read_at(self.meta["ends"], at))
        self.names = EliasFano.from_bytes(source.read_at(self.meta["names"], at - self.meta["names"]))
        self.width = int(self.meta["kind"][2:])

    def __len__(self) -> int:
        return self.meta["docs"]

    def span(self, i: int) -> tuple[int, int]:
        return self.ends.select(i - 1) if i else 0, self.ends.select(i)

    def doc_id(self, i: int) -> int | None:
        return None if i < self.meta["null_ids"] else self.meta["least"] + self.names.select(i - self.meta["null_ids"])

    def ids(self, start: int, stop: int) -> np.ndarray:
        return np.frombuffer(self.source.read_at((stop - start) * self.width, len(MAGIC) + start * self.width), self.meta["kind"])

    def doc_ids(self) -> list[int | None]:
        return [None] * self.meta["null_ids"] + [self.meta["least"] + int(x) for x in self.names.values()]


def write(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_bytes: int = 2, folder: str | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Encode every whole text, append `end_id` and write token files in ascending id order; their manifest, in that order.

    Documents are range-partitioned by id; a task writes its range to a file of its own and the file counts only once the
    task's row is in the manifest, so a task that runs again does no harm. A null or empty text is the end id alone; rows
    with a null id come first; repeated ids stay as separate documents, in text order.
    """
    folder = folder or shared_folder(docs.sparkSession)
    fs, path = opened(folder)
    fs.create_dir(path, recursive=True)

    def run(batches):
        made, out, fs, name = None, None, None, None
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in T.blocks([len(t or "") for t in texts], 1 << 20):
                for doc, raw in zip(ids[lo:hi], encoder(tokenizer_path).encode(texts[lo:hi])):
                    if made is None:
                        fs, path = opened(folder)
                        name = f"{path}/{uuid.uuid4().hex}.tokens"
                        out = fs.open_output_stream(name)
                        made = TokenFileWriter(out, id_bytes)
                    made.add(doc, np.append(np.frombuffer(raw, "<u4"), np.uint32(end_id)))
        if made is not None:
            meta = made.finish()
            out.close()
            known = [i for i in made.ids if i is not None]
            yield pa.RecordBatch.from_pylist([{"name": name.rpartition("/")[2], "docs": meta["docs"], "tokens": meta["tokens"],
                                               "first": known[0] if known else None}], schema=pa.schema(
                [("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("first", pa.int64())]))

    order = [F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first()]
    ranged = docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col).repartitionByRange(F.col(id_col).asc_nulls_first()).sortWithinPartitions(*order)
    made = ranged.mapInArrow(run, "name string, docs long, tokens long, first long").collect()
    manifest, start = [], 0
    for r in sorted(made, key=lambda r: (r.first is not None, r.first or 0)):
        manifest.append({"uri": f"{folder}/{r.name}", "docs": r.docs, "tokens": r.tokens, "start": start})
        start += r.tokens
    return manifest


def read(spark: SparkSession, manifest: list[dict], docs_per_task: int = 20_000, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of every document in the files; ids are little-endian unsigned 32-bit integers in binary."""
    parts = [(m["uri"], lo, min(m["docs"], lo + docs_per_task), m["start"]) for m in manifest for lo in range(0, m["docs"], docs_per_task)]
    schema = f"{id_col} long, start long, n_tokens long, ids binary"

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, path = opened(r["uri"])
                with fs.open_input_file(path) as source:
                    yield from _records(TokenFile(source), r["lo"], r["hi"], r["base"], id_col)

    if not parts:
        return spark.createDataFrame([], schema)
    rows = spark.createDataFrame(parts, "uri string, lo long, hi long, base long").repartitionByRange(len(parts), "uri", "lo")
    return rows.mapInArrow(run, schema)


def _records(file: TokenFile, lo: int, hi: int, base: int, id_col: str, limit: int = 1 << 19):
    """Record batches of the documents lo to hi, of about `limit` ids each."""
    ends = file.ends.values().astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    names = file.doc_ids()
    for a, b in T.blocks((ends - starts)[lo:hi].tolist(), limit):
        a, b = a + lo, b + lo
        first = int(starts[a])
        ids = file.ids(first, int(ends[b - 1])).astype("<u4")
        cut = [ids[s - first:e - first].tobytes() for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(names[a:b], pa.int64()), pa.array(starts[a:b] + base), pa.array(ends[a:b] - starts[a:b]),
                                          pa.array(cut, pa.binary())], names=[id_col, "start", "n_tokens", "ids"])
