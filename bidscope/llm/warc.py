"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames of about ``frame_bytes`` of
records each, then a skippable frame with the seek table (compressed and
decompressed size of every frame) and its footer, as the seekable format has it.
With a bundle goes an index from record identifier to frame number, offset inside
the frame and length, so one record is read by decompressing one frame.

Bundles are rows of a Parquet table in the scratch folder (executors share no local
disk); ``save_bundles`` writes them out as ``.warc.zst`` files.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import materialise, ship

# Fixed values of the two formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "bundle_id string, archive binary, records array<struct<record_id:string,frame:int,offset:long,length:long>>"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


@dataclass(frozen=True)
class Bundling:
    """Sizes in bytes before compression; ``salts``: parts into which pages of one payload are dealt; ``least``: smallest payload that is revisited."""

    frame_bytes: int = 256 << 10
    bundle_bytes: int = 8 << 20
    level: int = 3
    salts: int = 16
    least: int = 0


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(identifier: str) -> int | None:
    number = identifier[len("<urn:page:") : -1]
    return int(number) if number else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with its payload, or a revisit with the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Target-URI", "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "about:blank")),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and the position after the record that begins at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not at the beginning of a record")
    fields = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(fields["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return fields, data[start:stop], stop + 4


class BundleWriter:
    """Frames, seek table and index of one bundle."""

    def __init__(self, bundling: Bundling):
        import zstandard

        self.compressor = zstandard.ZstdCompressor(level=bundling.level, write_content_size=True)
        self.bundling = bundling
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.pending = bytearray()
        self.index: list[dict] = []
        self.total = 0

    def add(self, identifier: str, record: bytes) -> None:
        if self.pending and len(self.pending) + len(record) > self.bundling.frame_bytes:
            self.close_frame()
        self.index.append({"record_id": identifier, "frame": len(self.frames), "offset": len(self.pending), "length": len(record)})
        self.pending += record
        self.total += len(record)

    def close_frame(self) -> None:
        if self.pending:
            frame = self.compressor.compress(bytes(self.pending))
            self.frames.append(frame)
            self.sizes.append((len(frame), len(self.pending)))
            self.pending.clear()

    def finish(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(table)) + table


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer."""
    count, flags, magic = struct.unpack("<IBI", archive[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    width = 12 if flags & 0x80 else 8
    at, out, start = len(archive) - 9 - count * width, [], 0
    for i in range(count):
        packed, plain = struct.unpack_from("<II", archive, at + i * width)
        out.append((start, packed, plain))
        start += packed
    return out


def read_frame(archive: bytes, entry: tuple[int, int, int]) -> bytes:
    import zstandard

    start, packed, plain = entry
    return zstandard.ZstdDecompressor().decompress(archive[start : start + packed], max_output_size=plain)


def read_record(archive: bytes, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: only its frame is decompressed."""
    fields, block, _ = parse_record(read_frame(archive, seek_table(archive)[frame])[offset : offset + length])
    return fields, block


def _typed(pages: DataFrame, bundling: Bundling) -> DataFrame:
    """page_id, url, html, digest (hex) and refers_to: null for responses."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    shared = (
        rows.filter(F.octet_length("html") >= bundling.least).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("digest", "first_id", F.explode(F.sequence(F.lit(0), F.lit(bundling.salts - 1))).alias("salt"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(bundling.salts)).cast("int"))
    joined = salted.join(shared, ["digest", "salt"], "left")
    first = F.col("first_id").isNull() | F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "html", "digest", F.when(~first, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, bundling: Bundling = Bundling()) -> DataFrame:
    """Bundles of one record for each page row: bundle_id, archive, records (the index).

    Of pages with equal payloads of at least ``least`` bytes those with the smallest
    page_id are responses and the others revisits of it; null payloads are empty. A
    null page_id is never the smallest; pages without any other id are responses.
    Repeated rows make repeated records. A bundle is named by the task that wrote it, its
    number there and its bytes, so no two share a name whatever their records. An empty
    table gives no bundle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, bundles = BundleWriter(bundling), 0
        part = TaskContext.get().partitionId()

        def bundle() -> pa.RecordBatch:
            archive = writer.finish()
            kind = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{part:06d}-{bundles:06d}-{hashlib.sha1(archive).hexdigest()[:16]}"]), pa.array([archive], pa.binary()), pa.array([writer.index], kind)],
                ["bundle_id", "archive", "records"],
            )

        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*[batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to")]):
                page_id = page_id.as_py()
                base32 = base64.b32encode(bytes.fromhex(digest.as_py())).decode()
                record = build_record(page_id, url.as_py(), html.as_py(), base32, refers_to.as_py())
                writer.add(record_id(page_id), record)
                if writer.total >= bundling.bundle_bytes:
                    yield bundle()
                    writer, bundles = BundleWriter(bundling), bundles + 1
        if writer.total:
            yield bundle()

    ship(pages.sparkSession)
    return materialise(_typed(pages, bundling).mapInArrow(run, ARCHIVES), "warc")


def read_archives(archives: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, read through the index.

    A response's payload is measured and hashed again and must agree with its
    header; a revisit's length and digest are those its headers give.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, records in zip(batch.column("archive"), batch.column("records")):
                archive, rows = archive.as_py(), []
                table, held, frame = seek_table(archive), -1, b""
                for entry in records.as_py():
                    if entry["frame"] != held:
                        held = entry["frame"]
                        frame = read_frame(archive, table[held])
                    fields, block, end = parse_record(frame, entry["offset"])
                    if end - entry["offset"] != entry["length"] or fields["WARC-Record-ID"] != entry["record_id"]:
                        raise ValueError(f"the index of {entry['record_id']} points elsewhere")
                    head, payload = block.split(b"\r\n\r\n", 1)
                    size = int(head.rsplit(b"Content-Length: ", 1)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if fields["WARC-Type"] == "response":
                        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                            raise ValueError(f"the payload of {entry['record_id']} has changed")
                    refers = fields.get("WARC-Refers-To")
                    rows.append((_page_of(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers and _page_of(refers)))
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return archives.mapInArrow(run, RESULT)


def save_bundles(archives: DataFrame, folder: str) -> None:
    """Write each bundle as ``<bundle_id>.warc.zst`` and its index as ``.json`` to a folder (URI) that all executors reach."""
    def save(rows) -> None:
        import json

        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        for r in rows:
            for name, data in ((f"{r.bundle_id}.warc.zst", bytes(r.archive)), (f"{r.bundle_id}.json", json.dumps([x.asDict() for x in r.records]).encode())):
                with store.open_output_stream(f"{root}/{name}") as out:
                    out.write(data)

    archives.foreachPartition(save)


# Five hexadecimal digits are four base-32 digits.
_FIVE = "('0x' || substr(sha1(h), 5 * i + 1, 5))::INT"
_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ({_FIVE} >> {s} & 31) + 1, 1)" for s in (15, 10, 5, 0))
ORACLE = f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first_id FROM p GROUP BY h),
d AS (SELECT rid, string_agg({_BASE32}, '' ORDER BY i) AS payload_digest FROM p, (SELECT unnest(range(8)) AS i) GROUP BY rid)
SELECT page_id, strlen(h) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p JOIN f USING (h) JOIN d USING (rid)
"""
