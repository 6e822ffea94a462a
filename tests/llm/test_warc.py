"""WARC archives: round trip, salvage, revisits."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from freightlane.llm import warc
from freightlane.llm.queries import op2_warc_salvage
from freightlane.session import work_folder


def record(number, payload, kind="resource"):
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x-page:{number}>\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
    return f"{head}Content-Length: {len(payload)}\r\n\r\n".encode() + payload + b"\r\n\r\n"


PAYLOADS = [b"first", b"", b"has WARC/1.1\r\nWARC-Type: response\r\n\r\n inside", bytes(range(256)) * 40, b"last \x1f\x8b\x08 one"]


def good(data):
    return [(headers["warc-record-id"], payload) for _, _, headers, payload, _ in warc.walk(data) if headers]


def gaps(data):
    return [(start, stop) for start, stop, headers, _, _ in warc.walk(data) if headers is None]


@pytest.mark.parametrize("pack", [lambda r: r, gzip.compress], ids=["plain", "gzip"])
class TestSalvage:
    def parts(self, pack):
        return [pack(record(i, p)) for i, p in enumerate(PAYLOADS)]

    def test_whole_archive(self, pack):
        data = b"".join(self.parts(pack))
        assert [p for _, p in good(data)] == PAYLOADS and not gaps(data)

    def test_a_damaged_record_costs_only_itself(self, pack):
        for bad in range(len(PAYLOADS)):
            parts = self.parts(pack)
            broken = bytearray(parts[bad])
            broken[len(broken) // 2 if bad else 3] ^= 0x55
            if pack is not gzip.compress:
                broken[-1] = 0
            parts[bad] = bytes(broken)
            data = b"".join(parts)
            assert [n for n, _ in good(data)] == [f"<urn:x-page:{i}>" for i in range(len(PAYLOADS)) if i != bad]
            start = sum(map(len, parts[:bad]))
            assert gaps(data)[0][0] == start
            assert gaps(data)[-1][1] == start + len(parts[bad])

    def test_truncated_records_and_junk(self, pack):
        parts = self.parts(pack)
        data = b"junk" + parts[0] + parts[1][:-7] + parts[2] + b"\0" * 9 + parts[3] + parts[4][:-3]
        assert [n for n, _ in good(data)] == [f"<urn:x-page:{i}>" for i in (0, 2, 3)]
        assert gaps(data)[0] == (0, 4)
        covered = sorted((a, b) for a, b, *_ in warc.walk(data))
        assert covered[0][0] == 0 and covered[-1][1] == len(data)
        assert all(b == c for (_, b), (c, _) in zip(covered, covered[1:], strict=False))

    def test_random_damage_loses_no_good_record(self, pack):
        draw = random.Random(5)
        for _ in range(60):
            parts = self.parts(pack)
            bad = draw.randrange(len(parts))
            cut = draw.randrange(1, len(parts[bad]))
            parts[bad] = parts[bad][:cut]
            names = [n for n, _ in good(b"".join(parts))]
            assert set(names) >= {f"<urn:x-page:{i}>" for i in range(len(parts)) if i != bad}


def names(data):
    return [int(n.rpartition(":")[2][:-1]) for n, _ in good(data)]


def test_plain_archive_that_begins_damaged_and_holds_gzip():
    long = record(0, b"x" * 70_000)
    parts = [long.replace(b"WARC/1.1", b"WARX/1.1"), record(1, gzip.compress(b"body")), record(2, b"y"), record(3, gzip.compress(record(9, b"z")))]
    data = b"".join(parts)
    assert names(data) == [1, 2, 3] and gaps(data) == [(0, len(long))]
    # A damaged record with a gzip body, and one after it.
    broken = parts[1].replace(b"Content-Length: ", b"Content-Length: 9")
    assert names(broken + parts[2]) == [2] and gaps(broken + parts[2]) == [(0, len(broken))]


def test_members_of_many_records():
    parts = [record(i, p) for i, p in enumerate(PAYLOADS)]
    whole = gzip.compress(b"".join(parts))
    assert [p for _, p in good(whole)] == PAYLOADS and not gaps(whole)
    parts[1] = parts[1].replace(b"Content-Length", b"Content")
    two = gzip.compress(b"".join(parts)) + gzip.compress(record(7, b"7")) + record(8, b"8")
    size = len(gzip.compress(b"".join(parts)))
    assert names(two) == [0, 2, 3, 4, 7, 8] and gaps(two) == [(0, size)]


def test_nothing_good_in_a_member():
    data = gzip.compress(b"") + gzip.compress(b"no record") + record(2, b"y")
    assert names(data) == [2] and gaps(data) == [(0, len(data) - len(record(2, b"y")))]


def test_empty_archive():
    assert list(warc.walk(b"")) == []


SCHEMA = "page_id long, url string, html string, digest string, id long"


def test_round_trip_with_revisits(spark):
    rows = [
        (1, "http://a/ b\nc", "same", "d", 1),
        (2, None, "same", "d", 1),
        (2, None, "same", "d", 1),
        (3, "", None, None, None),
        (4, "http://x", "", "d", 1),
        (5, "http://x", "ein Ä WARC/1.1\r\n\r\n\r\nx", "d", 1),
        (None, "http://y", "lonely", "d", 1),
    ]
    place = work_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).repartition(3), place, archive_records=2)
    records = warc.read_archives(spark, place)
    assert warc.gaps(records).count() == 0
    payloads = {bytes(r["payload"]).decode() for r in records.filter("record_type = 'response'").collect()}
    assert payloads == {"same", "", "ein Ä WARC/1.1\r\n\r\n\r\nx", "lonely"}
    got = sorted(
        (warc_id(r["record_id"]), r["payload_bytes"], r["record_type"], warc_id(r["refers_to"]))
        for r in warc.resolved(records).collect()
    )
    assert got == [
        ("1", 4, "revisit", "2"),
        ("2", 4, "response", ""),
        ("2", 4, "response", ""),
        ("3", 0, "revisit", "4"),
        ("4", 0, "response", ""),
        ("5", 22, "response", ""),
        ("none", 6, "response", ""),
    ]


def warc_id(name):
    return (name or "").removeprefix("<urn:x-page:").removesuffix(">")


def test_small_payloads_are_no_revisits(spark):
    place = work_folder(spark, "test-warc")
    rows = [(1, "u", "ab", None, None), (2, "u", "ab", None, None), (3, "u", "abc", None, None), (4, "u", "abc", None, None)]
    warc.write_archives(spark.createDataFrame(rows, SCHEMA), place, least_bytes=3)
    kinds = {warc_id(r["record_id"]): r["record_type"] for r in warc.read_archives(spark, place).collect()}
    assert kinds == {"1": "response", "2": "response", "3": "revisit", "4": "response"}


def test_no_pages(spark):
    place = work_folder(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), place)
    assert warc.read_archives(spark, place).count() == 0


def test_damaged_files_are_read_on(spark, tmp_path):
    data = b"".join(record(i, b"x" * 50) for i in range(6))
    (tmp_path / "a.warc").write_bytes(data.replace(b"urn:x-page:2>", b"urn:x-page:2>\r\nbroken line"))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(record(i, b"y")) for i in (7, 8)) + b"tail")
    records = warc.read_archives(spark, str(tmp_path))
    assert {warc_id(r["record_id"]) for r in records.filter("reason IS NULL").collect()} == {"0", "1", "3", "4", "5", "7", "8"}
    assert [r["reason"] for r in warc.gaps(records).orderBy("archive").collect()] == ["headers", "member"]


def test_query_against_brute_force(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    last = {}
    for p in pages:
        last[p["html"]] = max(p["page_id"], last.get(p["html"], -1))
    expected = set()
    for p in pages:
        body, first = (p["html"] or "").encode(), last[p["html"]]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = first != p["page_id"]
        expected.add((p["page_id"], len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    out = op2_warc_salvage(spark, folder)
    assert {tuple(r) for r in out.collect()} == expected and out.count() == len(pages)


def test_base32_matches_the_library(spark):
    texts = ["", "a", "é", "x" * 1000]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["d"] for r in frame.select("t", warc.base32_sha1(F.col("t").cast("binary")).alias("d")).collect()}
    assert got == {t: warc.sha1_of(t.encode()) for t in texts}


def test_repeated_ids_with_other_payloads(spark):
    rows = [(5, "AAAA"), (5, "BBBBBBBB"), (2, "BBBBBBBB"), (3, "AAAA"), (5, "AAAA")]
    place = work_folder(spark, "warc")
    warc.write_archives(spark.createDataFrame([(i, "u", p) for i, p in rows], "page_id long, url string, html string"), place)
    found = warc.resolved(warc.read_archives(spark, place, keep_payload=False)).collect()
    got = sorted((r["record_id"], r["record_type"], r["payload_bytes"], r["payload_digest"]) for r in found)
    last = {"AAAA": 5, "BBBBBBBB": 5}
    digest = lambda p: base64.b32encode(hashlib.sha1(p.encode()).digest()).decode()
    assert got == sorted((f"<urn:x-page:{i}>", "response" if i == last[p] else "revisit", len(p), digest(p)) for i, p in rows)
