import base64
import hashlib
import io
import struct

import pytest
import zstandard

from murmur.llm.common import scratch
from murmur.llm.warc import (
    ArchiveRules,
    ArchiveWriter,
    InvalidArchive,
    archive_round_trip,
    read_archive,
    read_archives,
    record,
    write_archives,
)

ROWS = [
    (1, "http://a", "<p>one</p>"),
    (2, "http://b", None),
    (3, None, ""),
    (4, "http://d\r\nX: y", "<p>one</p>"),
    (9, "é", "<p>é 的</p>\r\n\r\nWARC/1.1\r\n"),
    (9, "é", "<p>é 的</p>\r\n\r\nWARC/1.1\r\n"),
    (None, "n", "<p>one</p>"),
    (None, "m", "<p>alone</p>"),
    (10, "long", "x<b>y" * 400_000),
] + [(100 + i, f"http://h/{i}", f"<html><body>page {i % 90} of many</body></html>") for i in range(300)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip_equals_the_pages(spark):
    largest = {}
    for page, _, html in ROWS:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    expected = []
    for page, _, html in ROWS:
        owner = largest.get(html or "")
        kind = "response" if owner in (None, page) else "revisit"
        expected.append((page, len((html or "").encode()), sha(html), kind, None if kind == "response" else owner))
    found = [tuple(r) for r in archive_round_trip(pages(spark)).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


def test_small_archives_and_payloads(spark):
    folder = f"file://{scratch(spark, 'warc')}"
    rules = ArchiveRules(archive_bytes=5_000, sample_records=10)
    archives = write_archives(pages(spark).repartition(3), folder, rules)
    assert archives.count() > 3
    read = read_archives(archives, folder, with_payload=True).collect()
    texts = {r["page_id"]: r["payload"].decode() for r in read if r["record_type"] == "response"}
    assert texts[10] == "x<b>y" * 400_000 and texts[9] == ROWS[4][2]


class Sink(io.BytesIO):
    def close(self):
        pass


def archive(n=30):
    sink = Sink()
    writer = ArchiveWriter(sink, ArchiveRules())
    for i in range(n):
        writer.add(record("response", i, "u", f"<p>{i}</p>".encode() * 20, None))
    writer.close()
    return sink.getvalue()


def test_reader_takes_one_frame_per_record():
    data = archive()
    assert struct.unpack("<I", data[:4])[0] == 0x184D2A5D
    assert len(list(read_archive(io.BytesIO(data)))) == 30
    assert list(read_archive(io.BytesIO(b""))) == []


def test_compressed_dictionaries_are_understood():
    data = archive()
    size = struct.unpack("<I", data[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + size])
    changed = data[:4] + struct.pack("<I", len(packed)) + packed + data[8 + size :]
    assert len(list(read_archive(io.BytesIO(changed)))) == 30


def test_damage_is_refused():
    data = archive()
    with pytest.raises(InvalidArchive):
        list(read_archive(io.BytesIO(data[:-5])))
    with pytest.raises(InvalidArchive):
        list(read_archive(io.BytesIO(data[8:])))
    with pytest.raises(InvalidArchive):
        list(read_archive(io.BytesIO(data[:-40] + bytes(8) + data[-32:])))


@pytest.mark.parametrize("change", [(b"Content-Length: ", b"Content-Length: 1"), (b"WARC/1.1", b"WARC/9.1"), (b"<p>", b"<q>"), (b"WARC-Date", b"X-Date")])
def test_broken_records_are_refused(change):
    raw = record("response", 1, "u", b"<p>text</p>", None).replace(*change, 1)
    frame = zstandard.ZstdCompressor().compress(raw)
    with pytest.raises(InvalidArchive):
        list(read_archive(io.BytesIO(struct.pack("<II", 0x184D2A5D, 8) + bytes(8) + frame)))


def test_empty_table(spark):
    assert archive_round_trip(pages(spark, [])).count() == 0
