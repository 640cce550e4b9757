"""WARC archives with a dictionary: each record a Zstandard frame of its own.

An archive begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, trained from records of the
archive; then come the records, compressed one by one with it, so that any record can be read alone by its
offset. Of equal payloads of at least ``REVISIT`` bytes one record has the payload; the others are revisits.

Only digests are shuffled to find equal payloads; what is a revisit then joins the pages by page_id. Writers hold
the records that train the dictionary, then one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlens.llm.files import new_file, open_file
from bazaarlens.session import settle

#: Shorter payloads are never revisits.
REVISIT = 1000
DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: Records of an archive that train its dictionary: this many bytes of records, each up to the second figure.
SAMPLE_BYTES = 2 << 20
SAMPLE_RECORD = 16 << 10
ARCHIVE_BYTES = 256 << 20
#: Date of records that are given none.
EPOCH = "1970-01-01T00:00:00Z"
LEVEL = 3

_PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary, offset long"


def _uri(url: str | None) -> str:
    return "".join(c for c in url or "" if c >= " ")  # no line ends in a header


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None,
    refers_uri: str | None = None, place: str = "", date: str = EPOCH,
) -> bytes:
    """A WARC 1.1 record of an HTTP response; a revisit has its headers alone.

    ``place`` names the record's place in an archive and makes its id unique, whatever rows repeat. Page numbers are
    in fields of their own, which other readers skip.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{place} {page_id}')}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Target-URI: {_uri(refers_uri)}",
            f"WARC-Refers-To-Date: {date}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head.append(f"Content-Length: {len(block)}\r\n\r\n")
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    number = lambda x: int(fields[x]) if x in fields else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError("a payload does not fit its digest")
    return {
        "page_id": number("X-Page-ID"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
        "payload_bytes": size, "payload_digest": digest.hex(), "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


class Archive:
    """Writes one archive. The first records wait until there are enough to train the dictionary."""

    def __init__(self, folder: str):
        self.path, self.out = new_file(folder, "archive.warc.zst")
        self.waiting: list[bytes] = []
        self.size = self.records = self.raw = 0
        self.press: zstandard.ZstdCompressor | None = None

    def add(self, data: bytes) -> None:
        self.raw += len(data)
        self.records += 1
        if self.press is None:
            self.waiting.append(data)
            if self.raw >= SAMPLE_BYTES:
                self._begin()
        else:
            self.out.write(self.press.compress(data))

    def _begin(self) -> None:
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, [x[:SAMPLE_RECORD] for x in self.waiting], d=8, k=256, steps=1)
        except zstandard.ZstdError:  # too few records, or too much alike: they are the dictionary themselves
            trained = zstandard.ZstdCompressionDict(b"".join(x[:SAMPLE_RECORD] for x in self.waiting)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw = trained.as_bytes()
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.press = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        for data in self.waiting:
            self.out.write(self.press.compress(data))
        self.waiting = []

    def close(self) -> None:
        if self.press is None:
            self._begin()
        self.out.close()


def read_archive(path: str, step: int = 1 << 20) -> Iterator[tuple[int, dict]]:
    """Offset and fields of every record, one after another."""
    file = open_file(path)
    magic, size = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError(f"{path} does not begin with a dictionary")
    unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(file.read(size)))
    at, data = 8 + size, b""
    while True:
        frame, out = unpress.decompressobj(), []
        begin = at
        while not frame.eof:
            data = data or file.read(step)
            if not data:
                if out or at != begin:
                    raise ValueError(f"{path} ends within a record")
                return
            at += len(data)
            out.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else b""
        at -= len(data)
        yield begin, parse(b"".join(out))


def write_archives(pages: DataFrame, folder: str, revisit: int = REVISIT, date: str | None = None) -> DataFrame:
    """Write a record for every row of ``pages`` below ``folder``; returns the manifest: path, records, bytes.

    The payload is the html in UTF-8; NULL is empty. Of equal payloads of at least ``revisit`` bytes the record with
    the largest page_id is the response and the others refer to it; rows that repeat its page_id are responses too,
    and rows without page_id only refer if another has one. All records bear ``date`` (UTC, by default that of the call).
    An empty table gives an empty manifest. Other columns, whatever their names, are not read.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    html = F.coalesce(pages["html"], F.lit("")).cast("binary")
    digests = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), F.length(html).alias("size"), F.sha1(html).alias("digest")
    ).filter(F.col("size") >= revisit)
    groups = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.max_by("url", "page_id").alias("refers_uri"), F.count("*").alias("n")).filter("n > 1")
    # only rows that refer to another: Spark broadcasts them while they are few
    refers = settle(
        digests.join(groups, "digest")
        .filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .groupBy("page_id", "digest")
        .agg(F.max("refers_to").alias("refers_to"), F.max("refers_uri").alias("refers_uri")),
        "revisits",
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done = None, []

        def close() -> None:
            archive.close()
            done.append((archive.path, archive.records, archive.raw))

        for batch in batches:
            for page_id, url, payload, digest, refers_to, refers_uri in zip(*batch.columns, strict=True):
                if archive is None:
                    archive = Archive(folder)
                raw, place = bytes.fromhex(digest.as_py()), f"{archive.path} {archive.records}"
                archive.add(record(page_id.as_py(), url.as_py(), payload.as_py(), raw, refers_to.as_py(), refers_uri.as_py(), place, date))
                if archive.raw >= ARCHIVE_BYTES:
                    close()
                    archive = None
        if archive is not None:
            close()
        if done:
            yield pa.record_batch([list(x) for x in zip(*done, strict=True)], names=["path", "records", "bytes"])

    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), html.alias("payload"), F.sha1(html).alias("digest")
    )
    other = refers.select(F.col("page_id").alias("other_id"), F.col("digest").alias("other_digest"), "refers_to", "refers_uri")
    marked = rows.join(other, rows["page_id"].eqNullSafe(other["other_id"]) & (rows["digest"] == other["other_digest"]), "left")
    return settle(marked.select("page_id", "url", "payload", "digest", "refers_to", "refers_uri").mapInArrow(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to, url, offset (and payload)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload", "offset"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64()]

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[n] for r in rows], kind) for n, kind in zip(names, kinds, strict=True)], names=names)

        for batch in batches:
            for path in batch.column(0):
                rows: list[dict] = []
                for offset, row in read_archive(path.as_py()):
                    rows.append(row | {"offset": offset} | ({} if with_payload else {"payload": None}))
                    if len(rows) == 1000:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)

    found = manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(read, _PAGES)
    return found if with_payload else found.drop("payload")
