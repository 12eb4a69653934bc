"""WARC archives, and their deduplication with revisit records.

Pages become archives of one response record each. To deduplicate them, the
headers of all records are shuffled by payload digest: of records with equal
payloads of at least ``LEAST_BYTES`` the one with the largest page id stays a
response, the others become revisits that refer to it. The records are then
joined to the originals of their digest and written to new archives with fresh
headers: a new record id and date each (the old date is kept as the date of
capture), and revisits with the new id, the address and the date of what they
refer to. The table of originals is sent to
the records while it is small (a checked size), so that payloads are not
shuffled; a larger one is joined by digest.

An archive is a gzip text file of complete WARC records behind one
``warcinfo`` record. A task packs records until ``ARCHIVE_BYTES`` are
reached and hands them to Spark as one value, which becomes one file: archives
are bounded by bytes (and one record), land in any store Spark can write to, and a lost
task is written again. Reading takes whole files as values and walks the
records by their content length.

Null html is an empty payload, a null id sorts before all others, of equal ids
the record with the larger record id counts as the larger, a null url is an
empty one, an empty table gives no archives. Repeated rows are records of their
own. Columns other than page_id, url and html are not archived.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.text import pieces
from tideline.operators.joins import is_small
from tideline.session import written

CRLF = "\r\n"
LEAST_BYTES = 1000
ARCHIVE_BYTES = 32 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = (
    "record_type string, record_id string, page_id long, url string, date string, payload_digest string, payload_bytes long, "
    "refers_to_record string, payload string"
)


def _header(name: str, value: Column) -> Column:
    """A header line; missing values have none, line ends inside a value become spaces."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), "[\r\n]", " "), F.lit(CRLF)), F.lit(""))


def _urn(name: Column) -> Column:
    """A record id that follows from ``name``."""
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(F.md5(name), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _record(kind: Column, record_id: Column, at: str, page_id: Column, url: Column, payload: Column, digest: Column,
            refers_to: Column, refers_to_url: Column, refers_to_date: Column, captured: Column) -> Column:
    """A whole record but for the empty line at its end. ``captured`` is the date of the record it was written from."""
    is_response = kind == "response"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"), F.lit(CRLF + CRLF),
    )
    block = F.when(is_response, F.concat(http, payload)).otherwise(F.lit(""))
    size = F.when(is_response, F.octet_length(http) + F.octet_length(payload)).otherwise(F.lit(0))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id),
        _header("WARC-Date", F.lit(at)), _header("WARC-Target-URI", url), _header("X-Page-Id", page_id),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        _header("WARC-Profile", F.when(~is_response, F.lit(PROFILE))), _header("WARC-Refers-To", refers_to),
        _header("WARC-Refers-To-Target-URI", refers_to_url), _header("WARC-Refers-To-Date", refers_to_date),
        _header("X-Capture-Date", captured),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"), _header("Content-Length", size), F.lit(CRLF), block,
    )


def _about(at: str, first: bytes) -> bytes:
    """The record that opens an archive; its id follows from the first record behind it."""
    block = f"software: tideline{CRLF}format: WARC File Format 1.1{CRLF}".encode()
    head = f"WARC/1.1{CRLF}WARC-Type: warcinfo{CRLF}WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, hashlib.sha1(first).hexdigest())}>{CRLF}"
    return f"{head}WARC-Date: {at}{CRLF}Content-Type: application/warc-fields{CRLF}Content-Length: {len(block)}{CRLF}{CRLF}".encode() + block


def _archives(at: str, most: int):
    """Records as values of about ``most`` bytes, each an archive."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "value", 4 << 20):
            for record in batch.column("value").cast(pa.binary()).to_pylist():
                if held and size + len(record) > most:
                    yield archive(held)
                    held, size = [], 0
                held.append(record)
                size += len(record) + 4
        if held:
            yield archive(held)

    def archive(held: list[bytes]) -> pa.RecordBatch:
        value = (CRLF + CRLF).encode().join([_about(at, held[0]), *held])
        return pa.RecordBatch.from_arrays([pa.array([value], pa.binary()).cast(pa.string())], ["value"])

    return run


def _write(records: DataFrame, path: str, at: str, most: int) -> None:
    values = records.select("value").mapInArrow(_archives(at, most), "value string")
    values.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def write_pages(pages: DataFrame, path: str, at: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """One response record per page, dated ``at`` (now)."""
    payload, none, at = F.coalesce(F.col("html"), F.lit("")), F.lit(None).cast("string"), at or _now()
    unique = F.concat_ws("/", F.monotonically_increasing_id().cast("string"), F.col("page_id").cast("string"), "url")
    record = _record(
        F.lit("response"), _urn(unique), at, F.col("page_id"), F.coalesce(F.col("url"), F.lit("")), payload,
        F.sha1(F.encode(payload, "UTF-8")), none, none, none, none,
    )
    _write(pages.select(record.alias("value")), path, at, archive_bytes)


def records_in(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an open archive."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.removesuffix("\n").removesuffix("\r").removeprefix(" ")
        block = stream.read(int(headers["content-length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} does not end where its length says")
        yield headers, block


def _parsed(with_payload: bool):
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    kinds = [pa.int64() if x.endswith("long") else pa.string() for x in READ_SCHEMA.split(", ")]

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind, page = headers["warc-type"], headers.get("x-page-id")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        payload = size = None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            size, found = len(payload), hashlib.sha1(payload).hexdigest()
            if found != digest:
                raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
        return (
            kind, headers["warc-record-id"], None if page is None else int(page), headers.get("warc-target-uri"),
            headers.get("warc-date"), digest, size,
            headers.get("warc-refers-to"), payload.decode() if with_payload and payload is not None else None,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, held = [], 0
                with gzip.open(io.BytesIO(content.as_py())) as stream:
                    for headers, block in records_in(stream):
                        if headers["warc-type"] == "warcinfo":
                            continue
                        rows.append(row(headers, block))
                        held += len(block) + 500
                        if held > 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_parsed(with_payload), READ_SCHEMA)


def deduplicate(spark: SparkSession, source: str, target: str, at: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """New archives of the records in ``source`` in which repeated payloads are revisits, dated ``at`` (now)."""
    headers, at = read_records(spark, source), at or _now()
    originals = headers.filter(F.col("payload_bytes") >= LEAST_BYTES).groupBy("payload_digest").agg(
        F.max(F.struct("page_id", "record_id", "url")).alias("original"), F.count(F.lit(1)).alias("n")
    )
    originals = written(originals.filter("n > 1").select("payload_digest", "original"), "originals")
    records = read_records(spark, source, with_payload=True)
    joined = records.join(F.broadcast(originals) if is_small(originals) else originals, "payload_digest", "left")
    original = F.col("original")
    revisit = original.isNotNull() & (F.col("record_id") != original["record_id"])
    fresh = lambda record_id: _urn(F.concat(F.lit("deduplicated/"), record_id))
    record = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), fresh(F.col("record_id")), at, F.col("page_id"), F.col("url"),
        F.col("payload"), F.col("payload_digest"), F.when(revisit, fresh(original["record_id"])), F.when(revisit, original["url"]),
        F.when(revisit, F.lit(at)), F.col("date"),
    )
    _write(joined.select(record.alias("value")), target, at, archive_bytes)


def resolved(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of deduplicated archives; revisits get size and page of the response they refer to."""
    records = written(read_records(spark, path).drop("payload"), "records")
    responses = records.filter("record_type = 'response'")
    found = responses.select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("original_bytes")
    )
    plain = responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = records.filter("record_type = 'revisit'").join(found, "refers_to_record").select(
        "page_id", F.col("original_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
    return plain.unionByName(revisits)
