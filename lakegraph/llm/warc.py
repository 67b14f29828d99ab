"""WARC archives, index first.

Writing: one gzip member per record, one file per task; each record's offset,
length, URL and payload digest go to an index table. Reading: the selected
index rows are sorted by file and offset, neighbouring byte ranges are read
together, and every record is parsed from its own range.

Of records with equal payloads the one with the largest page_id is a
``response``, the others are ``revisit`` records that refer to it.

Defined cases: a null payload is empty; a null page_id is smaller than any
other (a group without any page_id refers to null); repeated rows of the
largest page_id are the same record and all ``response``; a null url leaves
out the target header; line breaks in a url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegraph.llm import store

DATE = "2020-01-01T00:00:00Z"
READ_BYTES = 8 << 20                     # of archives, in a reading task
GAP, MOST = 64 << 10, 8 << 20      # join ranges this close, into reads of this size
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("page_id long, url string, file string, offset long, length long, "
         "payload_digest string, record_type string")
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload binary")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One uncompressed WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one uncompressed record; a revisit's payload length is
    that of the HTTP header it keeps, its digest that of the WARC header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda key: None if (v := fields[key][10:-1]) == "None" else int(v)  # noqa: E731  <urn:page:N>
    revisit = fields["WARC-Type"] == "revisit"
    return {"page_id": page("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": page("WARC-Refers-To") if revisit else None, "payload": None if revisit else payload,
            "payload_bytes": int(re.search(rb"Content-Length: (\d+)", http)[1]) if revisit else len(payload),
            "payload_digest": fields["WARC-Payload-Digest"][5:] if revisit else base32_sha1(payload)}


def write_archive(pages: DataFrame) -> DataFrame:
    """Write (page_id, url, html) rows as WARC files; returns the index."""
    folder = store.workspace(pages.sparkSession, "warc")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("d", F.sha1("html"))
    groups = (rows.groupBy("d").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("d", "top", F.lit(True).alias("many")))
    rows = rows.join(groups, "d", "left").select(
        "page_id", "url", "html", "top", (F.expr("many and not (page_id <=> top)")).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, offset = None, store.task_file(folder, ".warc.gz"), 0
        for b in batches:
            if b.num_rows and out is None:
                out = store.open_output(path)
            index = []
            for page_id, url, html, top, revisit in zip(*(c.to_pylist() for c in b.columns), strict=True):
                payload = html.encode()
                z = zlib.compressobj(3, zlib.DEFLATED, 31)
                packed = z.compress(record(page_id, url, payload, top, bool(revisit))) + z.flush()
                out.write(packed)
                index.append((page_id, url, path, offset, len(packed), base32_sha1(payload),
                              "revisit" if revisit else "response"))
                offset += len(packed)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*index, strict=True), _INDEX.types, strict=True)]
                                             if index else [pa.array([], t) for t in _INDEX.types], schema=_INDEX)
        if out is not None:
            out.close()

    return store.saved(rows.mapInArrow(write, INDEX), "warc-index")


_INDEX = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64()),
                    ("length", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())])
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Coalesce sorted (file, offset, length) rows: (file, from, to, members)."""
    now = None
    for path, offset, length in rows:
        if now and now[0] == path and offset - now[2] <= GAP and offset + length - now[1] <= MOST:
            now = (path, now[1], max(now[2], offset + length), [*now[3], (offset, length)])
        else:
            if now:
                yield now
            now = (path, offset, offset + length, [(offset, length)])
    if now:
        yield now


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, parsed from the archives."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((f, o, n) for b in batches for f, o, n in zip(*(c.to_pylist() for c in b.columns), strict=True))
        opened, source = None, None
        for path, start, end, members in ranges(rows):
            if path != opened:
                opened, source = path, store.open_input(path)
            source.seek(start)
            data = source.read(end - start)
            got = [parse(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in members]
            for r in got if not with_payload else ():
                r["payload"] = None
            yield pa.RecordBatch.from_pylist(got, schema=_RECORD)

    rows = index.select("file", "offset", "length")
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    # as many tasks as the records have bytes for; a long archive is read by several
    spread = rows.repartition(max(1, -(-total // READ_BYTES)), "file", F.floor(F.col("offset") / READ_BYTES)).sortWithinPartitions("file", "offset")
    return spread.mapInArrow(read, RECORD)
