"""WARC archives in Zstandard: writing, and a reader that validates every record.

An archive starts with a skippable frame that holds the compression dictionary of all its
records; then comes one frame per record, so a record can be read alone. Payloads that
occur more than once are stored by one response record; the others are revisits of it.

The response among equal payloads is the record with the largest page_id; repeated rows
with that page_id are all responses. A row without page_id revisits a page that has one,
and is a response where there is none. Null payloads count as empty. Tasks write archives
under a name of their own attempt and rename them when complete, so a lost executor leaves
no part of an archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.llm.common import byte_values, scratch, stored

#: Fixed values of the format: magic numbers of the dictionary frame and of Zstandard frames.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"


class InvalidArchive(ValueError):
    """An archive or record that breaks the format."""


@dataclass(frozen=True)
class ArchiveRules:
    level: int = 3
    dictionary_bytes: int = 65_536
    sample_records: int = 400
    sample_bytes: int = 4 << 20
    archive_bytes: int = 1 << 30
    revisit_bytes: int = 0


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the digest and length of its payload, not the payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if kind == "revisit" else http + payload
    clean = "".join(c for c in url or "" if c > " " and c != "\x7f")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page is None else page}>"),
        ("WARC-Target-URI", clean),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields.insert(4, ("WARC-Refers-To", f"<urn:page:{refers_to}>"))
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """The fields of one record, validated: version line, lengths, digests."""
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] != VERSION:
        raise InvalidArchive("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8").partition(":")
        if not colon or not name:
            raise InvalidArchive(f"no header field: {line!r}")
        fields[name.lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - fields.keys()
    if missing:
        raise InvalidArchive(f"missing fields: {sorted(missing)}")
    if not fields["content-length"].isdigit():
        raise InvalidArchive("content length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise InvalidArchive("record and content length differ")
    block = rest[:length]
    if fields.get("warc-block-digest") != f"sha1:{digest(block)}":
        raise InvalidArchive("block digest differs")
    http, mark, payload = block.partition(b"\r\n\r\n")
    if not mark:
        raise InvalidArchive("no HTTP header")
    size, claimed = int(fields["x-payload-length"]), fields["warc-payload-digest"]
    if fields["warc-type"] == "response":
        if len(payload) != size or claimed != f"sha1:{digest(payload)}":
            raise InvalidArchive("payload differs from its digest")
    elif fields["warc-type"] != "revisit" or payload or "warc-refers-to" not in fields:
        raise InvalidArchive("neither response nor revisit")
    return fields | {"payload": payload, "payload-length": size}


class ArchiveWriter:
    """Holds the first records as samples of the dictionary, then streams frames."""

    def __init__(self, sink, rules: ArchiveRules):
        self.sink, self.rules = sink, rules
        self.held: list[bytes] | None = []
        self.size = self.written = 0

    def add(self, raw: bytes) -> None:
        if self.held is None:
            self._frame(raw)
            return
        self.held.append(raw)
        self.size += len(raw)
        if len(self.held) >= self.rules.sample_records or self.size >= self.rules.sample_bytes:
            self._begin()

    def _begin(self) -> None:
        rules = self.rules
        try:
            trained = zstandard.train_dictionary(
                min(rules.dictionary_bytes, max(1_024, self.size // 8)), self.held
            )
            content = trained.as_bytes()
        except zstandard.ZstdError:
            # Too few or too uniform samples: the records themselves are the dictionary.
            content = b"".join(self.held)[-rules.dictionary_bytes :]
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
        shared = zstandard.ZstdCompressionDict(content)
        self.compressor = zstandard.ZstdCompressor(
            level=rules.level, dict_data=shared, write_checksum=True, write_content_size=True
        )
        held, self.held = self.held, None
        for raw in held:
            self._frame(raw)

    def _frame(self, raw: bytes) -> None:
        self._put(self.compressor.compress(raw))

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.written += len(data)

    def close(self) -> None:
        if self.held:
            self._begin()
        self.sink.close()


class _Source:
    """Buffered reads of exact lengths from a stream."""

    def __init__(self, stream, size: int = 1 << 20):
        self.stream, self.size, self.buffer = stream, size, b""

    def fill(self) -> bool:
        more = self.stream.read(self.size)
        self.buffer += more
        return bool(more)

    def take(self, count: int) -> bytes:
        while len(self.buffer) < count:
            if not self.fill():
                raise InvalidArchive("archive ends inside a frame")
        out, self.buffer = self.buffer[:count], self.buffer[count:]
        return out

    def ended(self) -> bool:
        return not self.buffer and not self.fill()


def read_archive(stream) -> Iterator[dict]:
    """Validated records of one archive, one frame at a time."""
    source = _Source(stream)
    if source.ended():
        return
    magic, length = struct.unpack("<II", source.take(8))
    if magic != DICTIONARY_MAGIC:
        raise InvalidArchive("no leading dictionary frame")
    content = source.take(length)
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstandard.ZstdDecompressor().decompress(content)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    while not source.ended():
        frame = reader.decompressobj()
        pieces = []
        while not frame.eof:
            if not source.buffer and not source.fill():
                raise InvalidArchive("archive ends inside a frame")
            try:
                pieces.append(frame.decompress(source.buffer))
            except zstandard.ZstdError as broken:
                raise InvalidArchive(str(broken)) from broken
            source.buffer = frame.unused_data if frame.eof else b""
        yield parsed(b"".join(pieces))


def _page_number(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _located(folder: str):
    """The file system and path of a folder URI or an absolute path."""
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, rules: ArchiveRules = ArchiveRules()) -> DataFrame:
    """Writes the pages (page_id, url, html) to archives in ``folder``; a row per archive."""
    body = F.coalesce("html", F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        body.alias("html"),
        F.sha1(body).alias("digest"),
        F.octet_length(body).alias("bytes"),
    )
    owners = (
        keyed.where(F.col("bytes") >= rules.revisit_bytes)
        .groupBy(F.col("digest").alias("owner_digest"), F.col("bytes").alias("owner_bytes"))
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("copies"))
        .where("copies > 1 and owner is not null")
        .drop("copies")
    )
    same = (F.col("digest") == F.col("owner_digest")) & (F.col("bytes") == F.col("owner_bytes"))
    revisit = F.col("owner").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    planned = keyed.join(owners, same, "left").select(
        "page_id",
        "url",
        "html",
        F.when(revisit, F.col("owner")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _located(folder)
        store.create_dir(base, recursive=True)
        done: list[tuple[str, int]] = []
        writer, name, count = None, "", 0

        def finish() -> None:
            writer.close()
            store.move(f"{base}/.{name}.part", f"{base}/{name}")
            done.append((name, count))

        for batch in batches:
            rows = zip(
                batch.column(0).to_pylist(),
                batch.column(1).to_pylist(),
                byte_values(batch.column(2)),
                batch.column(3).to_pylist(),
            )
            for page, url, payload, owner in rows:
                if writer is None:
                    name, count = f"{uuid.uuid4().hex}.warc.zst", 0
                    sink = store.open_output_stream(f"{base}/.{name}.part", compression=None)
                    writer = ArchiveWriter(sink, rules)
                kind = "response" if owner is None else "revisit"
                writer.add(record(kind, page, url, payload, owner))
                count += 1
                if writer.written > rules.archive_bytes:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.string()), pa.array([c for _, c in done], pa.int64())],
            names=["archive", "records"],
        )

    return stored(planned.mapInArrow(write, "archive string, records long"), "archives")


_READ_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read_archives(archives: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the listed archives; ``with_payload`` adds the stored payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _located(folder)
        for batch in batches:
            names, counts = (batch.column(i).to_pylist() for i in (0, 1))
            for name, count in zip(names, counts):
                rows, size, seen = [], 0, 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for fields in read_archive(stream):
                        rows.append(fields)
                        seen += 1
                        size += len(fields["payload"])
                        if len(rows) >= 2_000 or size > 16 << 20:
                            yield _read_batch(rows, with_payload)
                            rows, size = [], 0
                if seen != count:
                    raise InvalidArchive(f"{name} holds {seen} records, not {count}")
                yield _read_batch(rows, with_payload)

    # One archive is one unit of work.
    spread = archives.select("archive", "records").repartition(
        max(1, archives.count()), "archive"
    )
    return spread.mapInArrow(read, _READ_SCHEMA + ", payload binary" * with_payload)


def _read_batch(rows: list[dict], with_payload: bool) -> pa.RecordBatch:
    columns = {
        "page_id": pa.array([_page_number(r["warc-record-id"]) for r in rows], pa.int64()),
        "payload_bytes": pa.array([r["payload-length"] for r in rows], pa.int64()),
        "payload_digest": pa.array(
            [r["warc-payload-digest"].removeprefix("sha1:") for r in rows], pa.string()
        ),
        "record_type": pa.array([r["warc-type"] for r in rows], pa.string()),
        "refers_to": pa.array([_page_number(r.get("warc-refers-to")) for r in rows], pa.int64()),
    }
    if with_payload:
        columns["payload"] = pa.array([r["payload"] for r in rows], pa.binary())
    return pa.RecordBatch.from_pydict(columns)


def archive_round_trip(pages: DataFrame, rules: ArchiveRules = ArchiveRules()) -> DataFrame:
    """Every page written to an archive in the shared folder and read back."""
    folder = scratch(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(pages, folder, rules), folder)
