"""WARC archives: writing by Spark's file writer, and a salvage reader.

Writing: a record ends in two line ends, so a file of records is a text file with that as its line separator. Tasks
write archives through Spark's own writer, to any store and under its commit rules.

Reading: each task walks through one archive and checks every record: version line, headers, length, end mark, and the
payload's digest if one is given. Plain records and gzip members may follow each other; a member may hold many records,
which are walked through alike, and all have the member's bytes as their place. After a failed check it searches for the
next version line or the next gzip member that can be unpacked and holds a good record, whichever is nearer, goes on there,
and logs the bytes in between as a quarantined gap; a gap inside a member that has good records is logged as that member. An archive is read as one value, so it may have up to 2 GB; the writer here makes smaller ones.

Defined cases: a NULL payload is empty; a NULL or empty address is left out; rows with equal payloads of at least
`least_bytes` are one response (largest id) and revisits of it, rows that repeat the largest id are responses too, rows
without an id are responses; rows that share an id but not the payload are told apart by its digest; ids are whole numbers; an empty table gives an empty archive and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlane.llm.common import small, written

END = "\r\n\r\n"
ID_PREFIX = "urn:x-page:"
#: Up to so many records per archive, and so many bytes of payloads per batch of rows.
ARCHIVE_RECORDS = 20_000
ARCHIVE_BYTES = 1 << 30
BATCH_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# --- writing ------------------------------------------------------------------------------------------------


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four digits to base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _lines(*lines: Column | str) -> Column:
    return F.concat_ws("\r\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def write_archives(
    pages: DataFrame,
    place: str,
    id_column: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    least_bytes: int = 0,
    archive_records: int = ARCHIVE_RECORDS,
) -> None:
    """One record per row: a response, or a revisit that refers to the response with the same payload.

    Only digests and ids are grouped; the payloads stay in their partitions. An archive has at most archive_records
    records, and fewer where the largest payload would let it grow beyond ARCHIVE_BYTES.
    """
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("body").cast("binary")), "bytes": F.octet_length("body")})
    largest = rows.agg(F.max("bytes")).first()[0] or 0
    archive_records = max(1, min(archive_records, ARCHIVE_BYTES // (largest + 1024)))
    copies = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = written(copies.filter("n > 1").select(F.col("digest").alias("copied"), "first"), "copied")
    enough = F.col("bytes") >= least_bytes
    joined = rows.join(small(copies), (F.col("digest") == F.col("copied")) & enough, "left")
    revisit = F.col("first").isNotNull() & F.col("id").isNotNull() & (F.col("first") != F.col("id"))
    clean_url = F.regexp_replace(F.trim("url"), r"[\x00-\x20\x7F]", "_")
    http = F.concat(_lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", F.concat(F.lit("Content-Length: "), "bytes")), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "body"))
    name = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    head = _lines(
        "WARC/1.1",
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name("id")),
        f"WARC-Date: {date}",
        F.when(F.length(clean_url) > 0, F.concat(F.lit("WARC-Target-URI: "), clean_url)),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name("first"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        "Content-Type: application/http;msgtype=response",
        F.concat(F.lit("Content-Length: "), F.octet_length("block")),
    )
    records = joined.withColumn("block", block).select(F.concat(head, F.lit(END), "block").alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", archive_records).text(place)


# --- reading ------------------------------------------------------------------------------------------------

VERSION = re.compile(rb"WARC/\d\.\d\r?\n")
HEAD_END = re.compile(rb"\r?\n\r?\n")
MEMBER = b"\x1f\x8b\x08"
BEGIN = re.compile(re.escape(MEMBER) + b"|" + VERSION.pattern)


class Broken(ValueError):
    """A record that fails a check, with the reason."""


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers (names in lower case), block and end of the record that begins at a position."""
    if not VERSION.match(data, at):
        raise Broken("version")
    start = data.index(b"\n", at) + 1
    end = HEAD_END.search(data, start - 1)
    if not end:
        raise Broken("headers")
    headers: dict[str, str] = {}
    for line in data[start : end.start()].decode("utf-8", "replace").splitlines():
        name, colon, value = line.partition(":")
        if not colon:
            raise Broken("headers")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Broken("length")
    block = data[end.end() : end.end() + int(length)]
    if len(block) < int(length):
        raise Broken("truncated")
    stop = end.end() + int(length)
    if data[stop : stop + 4] != END.encode():
        raise Broken("end")
    return headers, block, stop + 4


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """What a record carries, without the HTTP headers; checked against the digest unless the record is a revisit."""
    payload = block
    if headers.get("content-type", "").replace(" ", "").startswith("application/http"):
        parts = HEAD_END.split(block, maxsplit=1)
        if len(parts) < 2:
            raise Broken("http")
        payload = parts[1]
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind == "sha1" and headers.get("warc-type") != "revisit" and digest.upper() != sha1_of(payload):
        raise Broken("digest")
    return payload


def sha1_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The unpacked bytes and the end of the gzip member that begins at a position, fed piece by piece."""
    unpack, parts, piece = zlib.decompressobj(31), [], 1 << 16
    while not unpack.eof:
        if at >= len(data):
            raise Broken("truncated")
        try:
            parts.append(unpack.decompress(data[at : at + piece]))
        except zlib.error as e:
            raise Broken("member") from e
        at = min(at + piece, len(data))
    return b"".join(parts), at - len(unpack.unused_data)


def walk(data: bytes, members: bool = True) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(start, stop, headers, payload, "") of each good record and (start, stop, None, b"", reason) of each gap, in order.

    Without `members`, as inside of one, only version lines begin a record.
    """
    at, gap, reason, after = 0, None, "", False
    begin = BEGIN if members else VERSION
    while at < len(data):
        try:
            if members and data.startswith(MEMBER, at):
                record, stop = _member(data, at)
                found = _records(record)
            else:
                headers, block, stop = parse_record(data, at)
                found = iter([(headers, payload_of(headers, block), "")])
        except Broken as e:
            if gap is None:
                # What follows a member and is no record either should have been one.
                gap, reason = at, "member" if after and str(e) == "version" else str(e)
            following = begin.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at, None, b"", reason
            gap = None
        for headers, payload, why in found:
            yield at, stop, headers, payload, why
        at, after = stop, members and data.startswith(MEMBER, at)
    if gap is not None:
        yield gap, len(data), None, b"", reason


def _records(member: bytes) -> Iterator[tuple[dict[str, str] | None, bytes, str]]:
    """The records and gaps of an unpacked member; one without a good record is broken."""
    inner, gaps_before = walk(member, members=False), []
    for _, _, headers, payload, why in inner:
        if headers is not None:
            rest = ((h, p, w) for _, _, h, p, w in inner)
            return itertools.chain(gaps_before, [(headers, payload, why)], rest)
        gaps_before.append((headers, payload, why))
    raise Broken(gaps_before[0][2] if gaps_before else "member")


RECORDS = (
    "archive string, start long, stop long, reason string, record_type string, record_id string, url string,"
    " refers_to string, payload binary, payload_bytes long, payload_digest string"
)


def read_archives(spark: SparkSession, place: str, keep_payload: bool = True) -> DataFrame:
    """A row per record, and a row with a reason per quarantined gap [start, stop) of an archive."""

    def salvage(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORDS.split(", ")]
        rows, size = [], 0
        for frame in frames:
            for archive, data in zip(frame["path"], frame["content"], strict=True):
                for start, stop, headers, payload, reason in walk(data):
                    if headers is None:
                        rows.append((archive, start, stop, reason, *[None] * 7))
                    else:
                        body = payload if keep_payload else None
                        head = [headers.get(h) for h in ("warc-type", "warc-record-id", "warc-target-uri", "warc-refers-to")]
                        rows.append((archive, start, stop, None, *head, body, len(payload), _digest_of(headers, payload)))
                    size += 200 + (len(payload) if keep_payload else 0)
                    if size > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
        yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(place).select("path", "content")
    return files.mapInPandas(salvage, RECORDS)


def _digest_of(headers: dict[str, str], payload: bytes) -> str:
    """The payload's digest; a revisit, which has no payload, names that of the payload it stands for."""
    named = headers.get("warc-payload-digest", "")
    return named[5:].upper() if headers.get("warc-type") == "revisit" and named.lower().startswith("sha1:") else sha1_of(payload)


def gaps(records: DataFrame) -> DataFrame:
    """The log of quarantined bytes: archive, start, stop, reason."""
    return records.filter("reason IS NOT NULL").select("archive", "start", "stop", "reason")


def resolved(records: DataFrame) -> DataFrame:
    """record id, type, size and digest of the full payload, and the response that a revisit refers to.

    A revisit carries no payload: its size is that of a response with the record id and the digest that it names, as
    record ids may repeat with other payloads. A revisit whose response was lost has no size and no digest.
    """
    good = records.filter("reason IS NULL").select("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest")
    responses = good.filter("record_type <> 'revisit'").select(
        F.col("record_id").alias("target"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest")
    )
    revisits = good.filter("record_type = 'revisit'").drop("payload_bytes")
    wanted = revisits.select(F.col("refers_to").alias("wanted"), F.col("payload_digest").alias("wanted_digest")).distinct()
    same = F.expr("target = wanted AND digest = wanted_digest")
    referred = responses.join(wanted, same).dropDuplicates(["target", "digest"]).select("target", "digest", "bytes")
    found = revisits.join(small(written(referred, "referred")), F.expr("refers_to = target AND payload_digest = digest"), "left")
    found = found.select("record_id", "record_type", "refers_to", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"))
    return good.filter("record_type <> 'revisit'").unionByName(found)


def page_id(name: Column) -> Column:
    """The id within a record's name, NULL for rows that had none."""
    return F.regexp_extract(name, rf"<{ID_PREFIX}(-?\d+)>", 1).try_cast("long")
