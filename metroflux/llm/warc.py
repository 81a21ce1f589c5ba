"""WARC archives: write pages, one gzip member per record, and read them
back sequentially.

``write_archives`` writes files of about ``FILE_BYTES`` into the shared
folder (a task writes to names of its own attempt, and only the files of
finished tasks enter the manifest).  ``read_archives`` opens each file as a
stream: members are inflated incrementally, the header ends at the first
empty line, the block is framed by Content-Length, and block and payload
digests are verified; a truncated or damaged file raises an error that names
file and offset.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one
with the largest id is a response record, the others are revisit records
without payload that name it.

Defined cases: a null html is an empty payload; a null url or id is left
out of the record and read back as null; a null id never is the largest;
repeated rows with the largest id are all responses; an empty table writes
no file and reads back empty; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflux.llm.common import materialise, shared_path

REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
CHUNK = 1 << 20
LEVEL = 6
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.uuid5(uuid.NAMESPACE_URL, "page-records")


def sha1_label(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_IDS, f'{page_id} {digest}')}>"


def record(kind: str, headers: dict[str, object], block: bytes) -> bytes:
    """One record as one gzip member; None headers are left out."""
    lines = [VERSION, f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in headers.items() if v is not None],
             f"WARC-Block-Digest: {sha1_label(block)}", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def page_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """A response record, or a revisit record of the page ``refers_to``."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {"WARC-Record-ID": record_id(page_id, digest), "WARC-Date": date, "WARC-Target-URI": None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~"),
               "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
               "WARC-Page-ID": page_id}
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "WARC-Refers-To-Page-ID": refers_to}
    return record("revisit" if revisit else "response", headers, http + (b"" if revisit else payload))


class DamagedArchive(ValueError):
    """A record that does not follow the format or its digests."""


def read_records(stream: BinaryIO, name: str = "archive") -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers by lower-case name, block) of every record."""
    data, at = stream.read(CHUNK), 0
    while data:
        z, held, size = zlib.decompressobj(31), bytearray(), 0
        while not z.eof:
            if not data:
                raise DamagedArchive(f"{name}: the member at {at} is cut off")
            try:
                held += z.decompress(data)
            except zlib.error as e:
                raise DamagedArchive(f"{name}: the member at {at} is damaged: {e}") from e
            size += len(data) - len(z.unused_data)
            data = z.unused_data if z.eof else stream.read(CHUNK)
        head = held.find(b"\r\n\r\n")
        lines = held[:max(head, 0)].decode("utf-8", "replace").split("\r\n")
        if head < 0 or not lines[0].startswith("WARC/"):
            raise DamagedArchive(f"{name}: no record header at {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not headers.get("content-length", "").isdigit():
            raise DamagedArchive(f"{name}: no Content-Length at {at}")
        end = head + 4 + int(headers["content-length"])
        if held[end:] != b"\r\n\r\n":
            raise DamagedArchive(f"{name}: the record at {at} does not end where Content-Length says")
        block = bytes(held[head + 4:end])
        if "warc-block-digest" in headers and headers["warc-block-digest"] != sha1_label(block):
            raise DamagedArchive(f"{name}: wrong block digest at {at}")
        yield at, headers, block
        at += size
        data = data or stream.read(CHUNK)


def page_of(headers: dict[str, str], block: bytes, where: str) -> tuple:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    payload) of a response or revisit record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest, kind = headers["warc-payload-digest"], headers["warc-type"]
    length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    if kind == "response" and (digest != sha1_label(payload) or length != len(payload)):
        raise DamagedArchive(f"{where}: wrong payload digest or length")
    return (headers.get("warc-page-id"), headers.get("warc-target-uri"), length, base64.b32decode(digest.removeprefix("sha1:")).hex(), kind,
            headers.get("warc-refers-to-page-id"), payload if kind == "response" else None)


def write_archives(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write the archives below ``path``; the manifest: file, records, bytes."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload")).withColumn("digest", F.sha1("payload")).withColumn(
        "size", F.octet_length("payload"))
    copies = (rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").select("digest", "size", "largest"))
    other = F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    ready = rows.join(copies, ["digest", "size"], "left").select("page_id", "url", "payload", "digest", other.alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        done, out, name, count, size = [], None, "", 0, 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if out is None:
                    name = f"{base}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):05d}.warc.gz"
                    out, count = store.open_output_stream(name, compression=None), 0
                    info = b"software: page archive writer\r\nformat: WARC File Format 1.1\r\n"
                    head = record("warcinfo", {"WARC-Record-ID": record_id(name.rpartition("/")[2], ""), "WARC-Date": date, "Content-Type": "application/warc-fields"}, info)
                    out.write(head)
                    size = len(head)
                member = page_record(*row, date)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= file_bytes:
                    out.close()
                    done.append((name, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, count, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
                                         ["file", "records", "bytes"])

    return materialise(ready.mapInArrow(write, "file string, records long, bytes long"), "manifest")


def read_archives(manifest: DataFrame, path: str, with_payload: bool = True) -> DataFrame:
    """Every page of the manifest's files: page_id (text), url, payload_bytes,
    payload_digest, record_type, refers_to (text), payload."""
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = fs.FileSystem.from_uri(path)[0]
        for b in batches:
            for name in b.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(name, compression=None) as stream:
                    for at, headers, block in read_records(stream, name):
                        if headers["warc-type"] in ("response", "revisit"):
                            rows.append(page_of(headers, block, f"{name} at {at}")[:7 if with_payload else 6] + (() if with_payload else (None,)))
                            size += len(block)
                        if len(rows) >= 10_000 or size >= 16 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    files = max(1, manifest.count())
    return manifest.select("file").repartition(files).mapInArrow(
        read, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")


def round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write the pages' archives and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to."""
    path = path or shared_path(pages.sparkSession, "warc")
    kind = pages.schema["page_id"].dataType
    back = read_archives(write_archives(pages, path), path, with_payload=False)
    return back.select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
t AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND top <> page_id THEN top END AS refers_to FROM t
"""
