"""WARC archives with one Zstandard frame per record and a dictionary per file.

A writing task buffers records up to ``ARCHIVE_BYTES``, builds a dictionary from them, and writes a file: the dictionary in
a leading skippable frame, then every record compressed on its own. Files go to the shared folder under new names; the
manifest, written by Spark, lists the files of successful tasks, so that what a lost or repeated task left behind is never
read. Records with equal payloads of at least ``REVISIT_BYTES`` are written once, as the response of the largest page id;
the others become revisit records that refer to it.

Defined results. Null html is an empty payload. Null page ids are never referred to; a payload whose rows all lack an id
is a response each time. Rows that repeat the largest id are responses too. Null urls get a name made of the id. Empty
tables write no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, new_path, shared_join, stored
from trajspark.llm.registry import query

REVISIT_BYTES = 1000
#: Uncompressed bytes of records per archive; a longer record makes a longer archive.
ARCHIVE_BYTES = 16 << 20
#: Size of a dictionary, and the most bytes it is built from: evenly spaced pieces of the archive's records.
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 1 << 20
PIECE_BYTES = 4 << 10
LEVEL = 3
#: Fixed values of the format: the skippable frame that holds a dictionary, the revisit profile, a date for records.
DICT_FRAME = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
ID = "urn:page:"


def _record(page_id, url: str | None, payload: bytes | None, size: int, sha1: str, refers_to) -> bytes:
    """One WARC record; a revisit has no payload, only the HTTP header of it."""
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"{ID}{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + (payload or b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {uri}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{ID}{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _samples(records: list[bytes]) -> list[bytes]:
    """Pieces of records, spread evenly over the bytes of the archive, SAMPLE_BYTES at most."""
    total = sum(map(len, records))
    step = max(1, min(PIECE_BYTES, total // 64))
    samples, passed, taken = [], 0, 0
    for record in records:
        for at in range(0, len(record), step):
            size = min(step, len(record) - at)
            passed += size
            if (taken + size) * total <= passed * min(total, SAMPLE_BYTES):
                samples.append(record[at : at + size])
                taken += size
    return samples


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary from pieces of the records; none for archives below 8 kB, or where nothing is common."""
    samples = _samples(records)
    size = min(DICT_BYTES, sum(map(len, samples)) // 8)
    if size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=512, d=8)
    except zstandard.ZstdError:  # the samples have nothing in common
        return None


def _write_archive(folder: str, records: list[bytes]) -> tuple[str, int, int]:
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    name = f"{uuid.uuid4().hex}.warc.zst"
    dictionary = _dictionary(records)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    written = 0
    with store.open_output_stream(f"{base}/{name}", compression=None) as out:
        if dictionary is not None:
            body = dictionary.as_bytes()
            written += out.write(struct.pack("<II", DICT_FRAME, len(body)) + body)
        for record in records:
            written += out.write(compressor.compress(record))
    return name, len(records), written


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(_record(*row))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    done.append(_write_archive(folder, held))
                    held, size = [], 0
        if held:
            done.append(_write_archive(folder, held))
        if done:
            names, counts, sizes = (list(x) for x in zip(*done, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], ["name", "records", "bytes"])

    return run


def records_of(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive."""
    frame = source.read(8)
    dictionary = None
    if len(frame) == 8 and struct.unpack("<II", frame)[0] == DICT_FRAME:
        dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", frame)[1]))
    else:
        source.seek(0)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(source, read_across_frames=True)
    stream = io.BufferedReader(reader, 1 << 20)
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield headers, block


def _reader(folder: str, number: pa.DataType):
    def page(urn: str | None):
        value = urn.strip("<>").removeprefix(ID) if urn else ""
        return (int(value) if pa.types.is_integer(number) else value) if value else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [number, pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), number]

        def send(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_file(f"{base}/{name}") as source:
                    for headers, block in records_of(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind = headers["warc-type"]
                        sha1 = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        if kind == "response" and (length, sha1) != (len(payload), hashlib.sha1(payload).hexdigest()):
                            raise ValueError(f"{headers['warc-record-id']}: the payload does not match its digest")
                        whole = payload if kind == "response" else None
                        rows.append((page(headers["warc-record-id"]), headers["warc-target-uri"], whole, length, sha1, kind, page(headers.get("warc-refers-to"))))
                        size += len(block)
                        if size > 8 << 20:
                            yield send(rows)
                            rows, size = [], 0
                if rows:
                    yield send(rows)

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives into ``folder`` and return their manifest: name, records, bytes."""
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    size = F.octet_length("payload").cast("long")
    keyed = rows.select("page_id", F.sha2("payload", 256).alias("key"), size.alias("size")).filter(F.col("size") >= REVISIT_BYTES)
    groups = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first")).filter("n > 1")
    groups = stored(groups, "warc-groups")
    # Payloads below REVISIT_BYTES are in no group, so their keys only spread the rows.
    alone = F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))
    key = F.when(size >= REVISIT_BYTES, F.sha2("payload", 256)).otherwise(alone)
    rows = rows.withColumns({"size": size, "sha1": F.sha1("payload"), "key": key})
    joined = shared_join(rows, groups, ["key"], "n", ["page_id", "url"])
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    records = joined.withColumn("refers_to", refers)
    body = F.when(F.col("refers_to").isNull(), F.col("payload"))
    records = records.select("page_id", "url", body.alias("payload"), "size", "sha1", "refers_to")
    return stored(arrow_map(records, _writer(folder), "name string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """All records of the archives in ``manifest``; payload is null for revisits."""
    number = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())
    files = manifest.select("name").repartition("name")
    schema = f"page_id {id_type}, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to {id_type}"
    return files.mapInArrow(_reader(folder, number), schema)


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p),
r AS (SELECT *, CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r
"""


@query("op2_warc_dictionary", SQL)
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = document_table(spark, sf_dir, "pages")
    folder = new_path(spark, "warc")
    manifest = write_archives(pages, folder)
    rows = read_archives(manifest, folder, pages.schema["page_id"].dataType.simpleString())
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
