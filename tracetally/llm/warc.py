"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent frames, each with a group of whole records, and a footer frame
with the seek table (compressed and plain size of each frame) in the published seekable format.
Any Zstandard reader unpacks such a file from start to end; with the index, which maps a record's
identifier to bundle, frame, offset and length within the frame, one frame is read for one record.

Records with equal payloads of at least ``least`` bytes are stored once, by the row with the
largest id; the others are revisits of it. A record's block is an HTTP response header whose
Content-Length is that of the whole payload, and for responses the payload.

Files are written on the executors below a folder that all of them share. A file's name has the
task attempt, and the index names the files of the attempts that Spark committed: where a task ran
twice, the other attempt's files stay unused.

Defined results: NULL payload is the empty payload; a NULL id is smaller than all others; rows that
repeat the largest id and its payload are responses all of them; a record's identifier counts
repeated rows, so none is lost; empty tables write nothing and read back as no rows; other columns
of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracetally.llm.common import ship, stored

ship(__name__)

# Fixed values of the seekable format: footer frame, seek table, descriptor without checksums.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: Plain bytes after which a frame, and after which a bundle, is closed.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 25
INDEX = (
    "record string, bundle string, frame_at bigint, frame_bytes bigint, offset bigint, "
    "length bigint"
)
RECORDS = (
    "record string, id bigint, url string, record_type string, refers_to bigint, "
    "payload_bytes bigint, payload_digest string, payload binary"
)


def prepared(pages: DataFrame, key: str, url: str, html: str, least: int) -> DataFrame:
    """One row per record: ``id``, ``url``, ``payload``, ``size``, ``digest``, ``first`` (the id of
    the response, NULL for responses).

    Digests are reduced before they are shuffled, and only those that several ids share are joined
    back, so a payload with a third of all rows costs one row per task.
    """
    rows = pages.select(
        F.col(key).alias("id"),
        F.col(url).alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    ).select(
        "*", F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("digest")
    )
    slim = rows.where(F.col("size") >= least).groupBy(
        F.col("digest").alias("_digest"), F.col("size").alias("_size")
    )
    shared = stored(
        slim.agg(F.max("id").alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    )
    same = (F.col("digest") == F.col("_digest")) & (F.col("size") == F.col("_size"))
    other = ~F.col("id").eqNullSafe(F.col("_last"))
    return rows.join(shared, same, "left").select(
        "id",
        "url",
        F.when(F.col("_n").isNotNull() & other, None).otherwise(F.col("payload")).alias("payload"),
        "size",
        "digest",
        F.when(other, F.col("_last")).alias("first"),
    )


def _record(name: str, row: dict) -> bytes:
    revisit = row["first"] is not None
    payload = b"" if revisit else row["payload"]
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['size']}\r\n\r\n"
    ).encode()
    # A line break in a URL would end the header; it can't be part of a valid one.
    url = (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name}>",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"X-Row-Id: {'' if row['id'] is None else row['id']}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Row-Id: {row['first']}",
        ]
    head += ["Content-Type: application/http; msgtype=response"]
    head += [f"Content-Length: {len(http) + len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


class _Bundle:
    """One file under construction; the open frame is in memory, closed frames are in the file."""

    def __init__(self, filesystem: pafs.FileSystem, folder: str, name: str):
        self.name = name
        filesystem.create_dir(folder, recursive=True)
        self.out = filesystem.open_output_stream(f"{folder}/{name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.at = self.plain = 0
        self.buffer = bytearray()
        self.waiting: list[tuple[str, int, int]] = []

    def add(self, name: str, record: bytes) -> Iterator[tuple]:
        self.waiting.append((name, len(self.buffer), len(record)))
        self.buffer += record
        if len(self.buffer) >= FRAME_BYTES:
            yield from self.end_frame()

    def end_frame(self) -> Iterator[tuple]:
        if not self.waiting:
            return
        frame = zstandard.ZstdCompressor(level=3).compress(bytes(self.buffer))
        self.out.write(frame)
        for name, offset, length in self.waiting:
            yield name, self.name, self.at, len(frame), offset, length
        self.frames.append((len(frame), len(self.buffer)))
        self.at += len(frame)
        self.plain += len(self.buffer)
        self.buffer, self.waiting = bytearray(), []

    def close(self) -> Iterator[tuple]:
        yield from self.end_frame()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes the bundles below ``folder`` (a URI) and returns their index, stored.

    A task writes its own rows one after the other, holding one open frame.
    """

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        part = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        filesystem, path = pafs.FileSystem.from_uri(folder)
        number = serial = 0
        bundle, found = None, []
        names = [field.split()[0] for field in INDEX.split(", ")]

        def index(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema)

        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                bundle = bundle or _Bundle(filesystem, path, f"{part}-{number:05d}.warc.zst")
                name = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{part}/{serial}/{row['id']}')}"
                serial += 1
                found += bundle.add(name, _record(name, row))
                if bundle.plain >= BUNDLE_BYTES:
                    found += bundle.close()
                    bundle, number = None, number + 1
            if found:
                yield index(found)
                found = []
        if bundle:
            found += bundle.close()
            yield index(found)

    schema = pa.schema(
        [
            ("record", pa.string()),
            ("bundle", pa.string()),
            ("frame_at", pa.int64()),
            ("frame_bytes", pa.int64()),
            ("offset", pa.int64()),
            ("length", pa.int64()),
        ]
    )
    return stored(records.mapInArrow(bundles, INDEX))


def parse(record: bytes) -> dict:
    """A record's fields; the payload of a revisit is None."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no record starts where the index has one")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(line.split(b":")[1])
        for line in http.split(b"\r\n")
        if line.lower().startswith(b"content-length:")
    )
    revisit = fields["WARC-Type"] == "revisit"
    number = lambda text: int(text) if text.strip() else None
    return {
        "record": fields["WARC-Record-ID"].strip("<>"),
        "id": number(fields["X-Row-Id"]),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "refers_to": number(fields.get("X-Refers-To-Row-Id", "")),
        "payload_bytes": length,
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "payload": None if revisit else payload,
    }


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` lists (all, or any selection of it), parsed from the bundles.

    Each task seeks to the frames it needs; rows of one frame are next to each other, and a frame
    is unpacked once for them. A payload that differs from its digest fails the read.
    """
    frames = index.repartition("bundle", "frame_at").sortWithinPartitions("bundle", "frame_at")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = pafs.FileSystem.from_uri(folder)
        at, plain = None, b""
        for batch in batches:
            rows, size = [], 0
            for row in batch.to_pylist():
                if at != (row["bundle"], row["frame_at"]):
                    with filesystem.open_input_file(f"{path}/{row['bundle']}") as file:
                        packed = file.read_at(row["frame_bytes"], row["frame_at"])
                    plain = zstandard.ZstdDecompressor().decompress(packed)
                    at = (row["bundle"], row["frame_at"])
                record = parse(plain[row["offset"] : row["offset"] + row["length"]])
                if record["record"] != row["record"]:
                    raise ValueError(f"{row['record']} is not where the index has it")
                payload = record["payload"]
                if payload is not None and (
                    hashlib.sha1(payload).hexdigest() != record["payload_digest"]
                    or len(payload) != record["payload_bytes"]
                ):
                    raise ValueError(f"payload of {row['record']} is damaged")
                rows.append(record)
                size += row["length"]
                if size > 8 * FRAME_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema(
        [
            ("record", pa.string()),
            ("id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    return frames.mapInArrow(records, RECORDS)


def seek_table(file: io.BufferedIOBase) -> list[tuple[int, int]]:
    """(packed, plain) size of each frame, from the footer of a bundle."""
    file.seek(-9, io.SEEK_END)
    count, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table")
    file.seek(-9 - 8 * count, io.SEEK_END)
    return [struct.unpack("<II", file.read(8)) for _ in range(count)]


def round_trip(
    spark: SparkSession,
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 1000,
) -> DataFrame:
    """Writes the archives below ``folder`` and returns their records as read back."""
    index = write(prepared(pages, key, url, html, least), folder)
    return read(index, folder)
