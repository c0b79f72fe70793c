"""WARC archives as seekable Zstandard bundles.

A bundle is one file: the records, in order, in independent Zstandard frames of a few records
each, then a seek table in a skippable frame with every frame's compressed and plain size, as
the seekable format has it. An index maps a record's identifier to its bundle, frame and place
inside the plain frame, so that reading one record means unpacking one frame.

A bundle is a row with its bytes in a table; ``export`` in a shell is writing that cell to a
file. Tables go where Spark can write, so no task needs a file system of its own.

Of records with equal payloads (by SHA-1) of at least ``min_bytes`` bytes, the one with the
smallest page_id is the response, the others are revisits of it without payload. Rows that
share that smallest page_id are all responses. A null page_id is no smallest one: such rows
revisit if a row with an id has the payload, else they are responses; their record ids are
made from the payload's digest. A null html is an empty payload, a null url an empty target.
Other columns are ignored."""

from __future__ import annotations

import base64
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.shared import stored

FRAME_BYTES, BUNDLE_BYTES = 256_000, 8_000_000
LEVEL = 3
# The seekable format's numbers (fixed values).
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def record_id(page: int | None, digest: str) -> str:
    name = f"page:{page}" if page is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(SPACE, name)}>"


def record(page, url: str, payload: bytes, digest: str, refers: int | None, mark: bool) -> bytes:
    """One WARC record; ``mark`` makes it a revisit of page ``refers``."""
    url = "".join(c for c in url if c not in "\r\n")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if mark else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if mark else 'response'}",
        f"WARC-Record-ID: {record_id(page, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page is not None:
        head.append(f"Page-ID: {page}")
    if mark:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers, digest)}",
            f"Refers-To-Page-ID: {refers}",
        ]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames)
    body += struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(bundle: bytes) -> list[tuple[int, int]]:
    """(offset, compressed size) of each frame, from the bundle's end."""
    many, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    body = bundle[-9 - 8 * many : -9]
    sizes = [struct.unpack_from("<II", body, 8 * k)[0] for k in range(many)]
    at = [0, *np.cumsum(sizes).tolist()]
    return list(zip(at[:-1], sizes, strict=True))


class Writer:
    """Fills one bundle and its index."""

    def __init__(self):
        self.frames, self.data, self.open, self.index = [], [], bytearray(), []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False)
        self.size = 0

    def add(self, name: str, data: bytes) -> None:
        if self.open and len(self.open) + len(data) > FRAME_BYTES:
            self.close_frame()
        self.index.append((name, len(self.frames), len(self.open), len(data)))
        self.open += data

    def close_frame(self) -> None:
        packed = self.packer.compress(bytes(self.open))
        self.frames.append((len(packed), len(self.open)))
        self.data.append(packed)
        self.size += len(packed)
        self.open = bytearray()

    def finish(self) -> bytes:
        if self.open:
            self.close_frame()
        return b"".join([*self.data, seek_table(self.frames)])


def write_bundles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """A row per bundle: name, data, and index, an array of (record, frame, start, size)."""
    slim = pages.select(
        "page_id", F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).alias("digest"),
        F.octet_length(F.coalesce("html", F.lit(""))).alias("bytes"),
    )
    first = slim.where(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.min("page_id").alias("refers"), F.count("*").alias("copies"),
        F.max(F.col("page_id").isNull()).alias("nameless"),
    ).where("refers is not null and copies > 1")
    later = slim.join(first, ["digest", "bytes"]).where("page_id is null or page_id > refers")
    # One row per id and payload that revisits; joined by id, and by digest where ids repeat.
    later = later.select("page_id", "digest", "refers").distinct()
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    full = full.join(
        later.select(
            F.col("page_id").alias("id"), F.col("refers").cast("long").alias("refers"), "digest"
        ),
        F.col("page_id").eqNullSafe(F.col("id"))
        & (F.sha1(F.encode("html", "UTF-8")) == F.col("digest")),
        "left",
    ).select("page_id", "url", "html", "refers")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        writer = Writer()

        def bundle() -> pa.RecordBatch:
            data = writer.finish()
            kind = pa.struct(
                [("record", pa.string()), ("frame", pa.int32()), ("start", pa.int64()),
                 ("size", pa.int64())]
            )
            index = [dict(zip(("record", "frame", "start", "size"), x, strict=True)) for x in writer.index]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"pages-{hashlib.sha1(data).hexdigest()[:16]}.warc.zst"]),
                    pa.array([data], pa.binary()),
                    pa.array([index], pa.list_(kind)),
                ],
                ["name", "data", "index"],
            )

        for batch in batches:
            for page, url, html, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = html.encode()
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                data = record(page, url, payload, digest, refers, refers is not None)
                writer.add(record_id(page, digest), data)
                if writer.size >= BUNDLE_BYTES:
                    yield bundle()
                    writer = Writer()
        if writer.index:
            yield bundle()

    return full.mapInArrow(
        write,
        "name string, data binary, "
        "index array<struct<record: string, frame: int, start: long, size: long>>",
    )


def read_bundles(bundles: DataFrame) -> DataFrame:
    """Every record of the bundles, found through the index and the seek table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for data, index in zip(batch.column("data"), batch.column("index"), strict=True):
                data = data.as_buffer().to_pybytes()
                frames = read_seek_table(data)
                rows: list[tuple] = []
                frame, plain = -1, b""
                for entry in index.as_py():
                    if entry["frame"] != frame:
                        frame = entry["frame"]
                        at, size = frames[frame]
                        plain = unpack.decompress(data[at : at + size])
                    fields, payload = parse(plain[entry["start"] : entry["start"] + entry["size"]])
                    page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
                    rows.append(
                        (
                            None if page is None else int(page),
                            int(fields["Payload-Length"]),
                            fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                            fields["WARC-Type"],
                            None if refers is None else int(refers),
                            fields["WARC-Target-URI"],
                            payload.decode(),
                        )
                    )
                    if len(rows) >= 1000:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"],
        )

    return bundles.select("data", "index").mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, url string, payload string",
    )


def archive(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages to bundles in the shared folder and read them back."""
    return read_bundles(stored(write_bundles(pages, min_bytes)))
