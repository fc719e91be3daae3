"""WARC archives: writing, reading, and assembly of transactions.

`write` stores pages as request, response (or revisit) and metadata records, one gzip member per record, in archives of
bounded size in a shared folder. `read` streams archives back record by record. `captures` joins the records of one
transaction through WARC-Concurrent-To and gives one nested row per capture.

Archives are written by tasks under names of their own; the returned list names the files of the attempts that counted,
so a task that runs twice leaves a file that nobody reads. Folders may be any path or URI that Arrow's file systems open.

Defined results: a null html is an empty payload. Rows with the same page_id, url and payload are one capture, as their
record ids are equal. Of equal payloads of at least `least` bytes the capture with the smallest page_id (null ids last,
then the smallest url) holds the payload, the others revisit it; with a smaller payload all are responses. Null urls
leave the target out. On reading, records cut off or without a valid header give a row with `problem` set and the rest
of that archive is left, other archives are read on. A record concurrent to none is a capture without a response.
Other columns are ignored. Empty tables write nothing and read as empty tables.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from vitrine.session import measured, scratch_path, stored

ARCHIVE_BYTES = 256 << 20
BATCH_ROWS, BATCH_BYTES = 500, 8 << 20
CAPTURED = ("response", "revisit", "resource")
RECORDS = ("archive string, record_id string, type string, concurrent_to array<string>, target_uri string, refers_to string, "
           "payload_digest string, payload_bytes long, payload binary, problem string")
NAMES = [c.split()[0] for c in RECORDS.split(", ")]


def urn(digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(digest)}>"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _record(kind: str, record_id: str, block: bytes, media: str, **more: str | None) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", "WARC-Date: 1970-01-01T00:00:00Z",
             *(f"{name.replace('_', '-')}: {value}" for name, value in more.items() if value is not None),
             f"Content-Type: {media}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n") + packer.compress(block + b"\r\n\r\n") + packer.flush()


def _capture(row: dict) -> list[bytes]:
    """The records of one page."""
    payload, target = (row["html"] or "").encode("utf-8", "surrogatepass"), row["url"]
    uri = quote(target, safe="%/:=&?~#+!$,;'@()*[]") if target else None
    own, request, meta = urn(row["key"]), urn(hashlib.md5(f"request {row['key']}".encode()).hexdigest()), urn(hashlib.md5(f"metadata {row['key']}".encode()).hexdigest())
    digest = f"sha1:{base32_sha1(row['digest'])}"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["key"] != row["first_key"]
    parts = urlsplit(re.sub(r"[\[\]]", "", uri or ""))
    asked = f"GET {parts.path or '/'}{'?' + parts.query if parts.query else ''} HTTP/1.1\r\nHost: {parts.netloc}\r\n\r\n".encode()
    about = json.dumps({"page_id": row["page_id"], "url": target}).encode()
    return [
        _record("revisit" if revisit else "response", own, head if revisit else head + payload, "application/http; msgtype=response",
                WARC_Target_URI=uri, WARC_Payload_Digest=digest, WARC_Refers_To=urn(row["first_key"]) if revisit else None,
                WARC_Profile="http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if revisit else None),
        _record("request", request, asked, "application/http; msgtype=request", WARC_Target_URI=uri, WARC_Concurrent_To=own),
        _record("metadata", meta, about, "application/json", WARC_Target_URI=uri, WARC_Concurrent_To=own)]


def write(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write archives of `pages` (page_id, url, html); returns (path, records), itself a table in the folder."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("bytes"))
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.col("digest"), F.coalesce("url", F.lit("null "))))
    rows = rows.withColumn("key", key)
    first = rows.groupBy(F.col("digest").alias("d"), F.col("bytes").alias("b")).agg(
        F.min(F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url", "key")).alias("first"))
    known = rows.join(first, (F.col("digest") == F.col("d")) & (F.col("bytes") == F.col("b"))).select(
        "page_id", "url", "html", "digest", "key", F.when(F.col("bytes") >= least, F.col("first.key")).otherwise(F.col("key")).alias("first_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        out, path, count, size = None, "", 0, 0
        for batch in batches:
            closed = []
            for i in range(batch.num_rows):
                row = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    path, out = f"{folder}/{name}", system.open_output_stream(f"{root}/{name}", compression=None)
                for record in _capture(row):
                    out.write(record)
                    count, size = count + 1, size + len(record)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    closed.append((path, count))
                    out = None
            yield pa.RecordBatch.from_pydict({"path": pa.array([c[0] for c in closed], pa.string()), "records": pa.array([c[1] for c in closed], pa.int64())})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})
    return known.mapInArrow(run, "path string, records long")


def _fields(raw: bytes) -> list[tuple[str, str]]:
    """Names (lower case) and values of header lines; a line that begins with white space continues the one before."""
    found: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").replace("\r\n", "\n").split("\n"):
        if line[:1] in (" ", "\t") and found:
            found[-1] = (found[-1][0], f"{found[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            found.append((name.strip().lower(), value.strip()))
    return found


def records_of(stream, archive: str) -> Iterator[tuple]:
    """The records of an open, uncompressed archive stream."""
    def broken(problem: str) -> tuple:
        return (archive, None, None, [], None, None, None, None, None, problem)
    try:
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                yield broken("no WARC header where a record should begin")
                return
            head = b""
            while (line := stream.readline()).strip():
                head += line
            fields = _fields(head)
            own = dict(fields)
            length = own.get("content-length", "")
            if not length.isdigit():
                yield broken("a record without a length")
                return
            block = stream.read(int(length))
            if len(block) < int(length):
                yield broken("cut off inside a record")
                return
            payload, declared = block, None
            if own.get("content-type", "").startswith("application/http") or own.get("warc-type") == "revisit":
                http, _, payload = block.partition(b"\r\n\r\n")
                declared = dict(_fields(http)).get("content-length", "")
            revisit = own.get("warc-type") == "revisit"
            if revisit:
                digest, size = own.get("warc-payload-digest", "").removeprefix("sha1:") or None, int(declared) if declared and declared.isdigit() else None
            else:
                digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
            yield (archive, own.get("warc-record-id"), own.get("warc-type"), [v for k, v in fields if k == "warc-concurrent-to"],
                   own.get("warc-target-uri"), own.get("warc-refers-to"), digest, size, None if revisit else payload, None)
    except (EOFError, zlib.error, gzip.BadGzipFile):
        yield broken("cut off or damaged compression")


def read(archives: DataFrame, path: str = "path", tasks: int | None = None) -> DataFrame:
    """The records (see `RECORDS`) of the archives listed; each archive is streamed by one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, own = fs.FileSystem.from_uri(name) if "://" in name else (fs.LocalFileSystem(), name)
                with system.open_input_stream(own, compression=None, buffer_size=1 << 20) as raw:
                    stream, rows, size = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else io.BufferedReader(raw), [], 0
                    for record in records_of(stream, name):
                        rows.append(record)
                        size += len(record[8] or b"")
                        if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays(_columns(rows), names=NAMES)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays(_columns(rows), names=NAMES)
    listed = archives.select(F.col(path).alias("path"))
    return (listed.repartition(tasks) if tasks else listed).mapInArrow(run, RECORDS)


def _columns(rows: list[tuple]) -> list[pa.Array]:
    kinds = [pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    return [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, response (struct), requests and metadata (arrays of structs).

    A record belongs to the response, revisit or resource record that it names, that names it, or that a record it names
    or that names it belongs to. Repeated record ids are one record.
    """
    body = [c for c in NAMES if c not in ("archive", "problem", "record_id")]
    sound = records.filter("problem is null and record_id is not null").groupBy("record_id").agg(F.first(F.struct(*body)).alias("r"))
    response = F.col("r.type").isin(*CAPTURED)
    heads, others = sound.filter(response), sound.filter(~response | F.col("r.type").isNull())
    brief = stored(records.filter("problem is null").select("record_id", "type", "concurrent_to"), "links")
    named = brief.select(F.col("record_id").alias("a"), F.explode("concurrent_to").alias("b"))
    links = named.union(named.select("b", "a")).dropna().toDF("id", "other").distinct()
    head_ids = brief.filter(F.col("type").isin(*CAPTURED)).select(F.col("record_id").alias("other")).distinct()
    direct = links.join(head_ids, "other").select("id", F.col("other").alias("head"))
    over = links.join(direct.toDF("other", "head"), "other").select("id", "head")
    near = direct.withColumn("hops", F.lit(1)).union(over.withColumn("hops", F.lit(2)))
    home = near.groupBy("id").agg(F.min(F.struct("hops", "head"))["head"].alias("head"))
    placed = others.join(home.withColumnRenamed("id", "record_id"), "record_id", "left").withColumn("head", F.coalesce("head", "record_id"))
    own = F.struct("record_id", "r.target_uri", "r.payload", "r.payload_bytes", "r.payload_digest")
    sides = placed.groupBy("head").agg(F.collect_list(F.when(F.col("r.type") == "request", own)).alias("requests"),
                                       F.collect_list(F.when(F.col("r.type") == "metadata", own)).alias("metadata"),
                                       F.collect_list(F.when(~F.coalesce(F.col("r.type"), F.lit("")).isin("request", "metadata"), own)).alias("others"))
    whole = heads.select(F.col("record_id").alias("head"), F.col("r").alias("response"))
    return whole.join(sides, "head", "full").withColumnRenamed("head", "capture_id")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write `pages` as archives, read these back, assemble the captures; page_id, payload_bytes, payload_digest,
    record_type, refers_to."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    archives, seen = measured(write(pages, folder, least), "archives", F.count("*").alias("n"))
    # The query reports on payloads without repeating them; they are read, hashed and left out here.
    records = read(archives, tasks=max(seen["n"], 1)).withColumn(
        "payload", F.when(~F.col("type").isin(*CAPTURED), F.col("payload")))
    found = captures(stored(records, "records"))
    page = F.get_json_object(F.get("metadata", F.lit(0))["payload"].cast("string"), "$.page_id").cast(pages.schema["page_id"].dataType)
    rows = found.select("capture_id", page.alias("page_id"), "response.payload_bytes", "response.payload_digest",
                        F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("of"))
    rows, _ = measured(rows, "captures")
    firsts = rows.filter("record_type = 'response'").select(F.col("capture_id").alias("of"), F.col("page_id").alias("refers_to"))
    return rows.join(firsts, "of", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
