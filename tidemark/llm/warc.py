"""WARC archives in which equal payloads are stored once.

Headers (page, digest, size) are grouped by payload digest; the group's original is joined
back to them, and the pages are written as fresh records: a response with its payload, or a
revisit that refers to the response's record. Records go through Spark's text writer, whose
line separator is the end of a WARC record, so archives are committed like any other output
and may lie in any store Spark writes to.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import staging

END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NO_DATE = "1970-01-01T00:00:00Z"

RECORDS = "page_id long, url string, record_id string, record_type string, refers_to_id string, payload_bytes long, payload_digest string, payload binary"


def base32(hex_digest: Column) -> Column:
    """A hex digest of a multiple of 20 bits in base32: five hex digits are four characters."""

    def character(i: Column) -> Column:
        bits = F.conv(F.substring(hex_digest, F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        five = F.call_function("shiftright", bits, F.lit(15) - i % 4 * 5).bitwiseAND(F.lit(31))
        return F.substring(F.lit(BASE32), five + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), character), "")


def _record_id(at: Column, page_id: Column) -> Column:
    digest = F.md5(F.concat_ws("/", F.lit("page"), page_id, at))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digest, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line; a null value gives none, and line breaks in a value are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def resolve(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> DataFrame:
    """Staged rows (at, page_id, url, payload, bytes, digest, original): `original` is null for responses.

    Of equal payloads of at least `min_bytes` bytes the row with the largest key is the
    response, and of repeated keys one of them; a null key is the smallest. Null payloads
    are empty. Equality is that of SHA-1, size and a second hash.
    """
    rows = staging.staged(pages.select(F.monotonically_increasing_id().alias("at"), F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload")), "pages")
    headers = rows.select("at", "page_id", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"), F.xxhash64("payload").alias("second"))
    headers = staging.staged(headers, "headers")
    groups = headers.where(F.col("bytes") >= min_bytes).groupBy("sha1", "bytes", "second").agg(F.max(F.struct("page_id", "at")).alias("last"), F.count("*").alias("n"))
    # only groups that hold a revisit have something to tell
    groups = staging.staged(groups.where("n > 1").drop("n"), "originals")
    found = headers.join(groups, ["sha1", "bytes", "second"], "left")
    original = F.when(F.col("last.at") != F.col("at"), F.struct(F.col("last.page_id").alias("page_id"), F.col("last.at").alias("at")))
    found = found.select("at", "bytes", base32(F.col("sha1")).alias("digest"), original.alias("original"))
    return rows.join(found, "at")


def write(resolved: DataFrame, path: str, date: str = NO_DATE, compression: str = "gzip") -> None:
    """One WARC/1.1 record for each row of resolve(), in files of about a partition each."""
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    refers = F.when(revisit, _record_id(F.col("original.at"), F.col("original.page_id")))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("at"), F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Refers-To", refers),
        _header("WARC-Profile", F.when(revisit, PROFILE)),
        _header("X-Page-ID", F.col("page_id").cast("string")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
        _header("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    resolved.select(record.alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of an archive, plain or gzip; header names in lower case."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BytesIO(raw)
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip(" \t\r\n")
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends inside a record")
        yield headers, block


def _page(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    else:
        size = next(int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page = headers.get("x-page-id")
    return (None if page is None else int(page), headers.get("warc-target-uri"), headers["warc-record-id"], headers["warc-type"], headers.get("warc-refers-to"), size, digest, payload if with_payload else None)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record below `path`: what the archives hold, payload digests verified.

    payload_bytes and payload_digest of a revisit are those of the full payload.
    """
    names = RECORDS.replace(",", "").split()[::2]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names)

        for files in batches:
            for content in files.column(0):
                rows, held = [], 0
                for headers, block in records(content.as_py()):
                    rows.append(_page(headers, block, with_payload))
                    held += 1000 + len(block) * with_payload
                    if held > 8 << 20:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select("content").mapInArrow(parse, RECORDS)


def with_referred(records_read: DataFrame) -> DataFrame:
    """read() with refers_to: the page of the response to which a revisit refers by record id."""
    read_once = staging.staged(records_read, "records")
    responses = read_once.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    return read_once.join(responses, "refers_to_id", "left")
