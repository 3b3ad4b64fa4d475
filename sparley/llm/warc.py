"""WARC archives in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames of whole records and, last, a
skippable frame with the seek table of the public seekable format: the compressed and
plain size of each frame. `write_archive` also returns an index row for each record:
its bundle, frame and offset within the frame's plain bytes, so one record is read by
decompressing one frame.

Executors write bundles under names of their own; the index names those of the tasks
that counted, so a repeated task leaves nothing but an unread file.

A record's id has its page_id and the address of the row that it was written from, so
that null and repeated page_ids have records of different ids; the one response that others
revisit has its payload's digest instead, which those know.

Defined results: a null payload is empty; a null page_id is written as `null` and read
as null; rows that tie on a group's largest page_id are all responses; a null url gives
no target header; a record longer than a frame is a frame of its own; an empty table
gives an archive without bundles. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FILE, ROW, addressed, open_fs

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 512 << 20
#: Only payloads of at least this many bytes are ever revisited.
LEAST_REVISIT = 1000
#: Frames that are read as one unit, and units of a task where there are very many.
FRAMES_PER_TASK, UNITS_PER_TASK = 64, 16
#: Fixed values of the seekable format: the skippable frame's magic number and the footer's.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def assign_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null for responses) and
    name, which tells all records apart."""
    html = F.coalesce("html", F.lit(""))
    keyed = addressed(pages.select("page_id", "url", html.alias("html"), F.octet_length(html).cast("long").alias("payload_bytes"), F.sha1(F.encode(html, "UTF-8")).alias("payload_digest")))
    top = F.max(F.struct("page_id", FILE, ROW)).alias("top")  # null is least
    groups = keyed.filter(F.col("payload_bytes") >= least).groupBy(F.col("payload_digest").alias("d")).agg(top, F.count("*").alias("n"))
    groups = groups.filter("n > 1 AND top.page_id IS NOT NULL").select("d", "top")
    joined = keyed.join(groups.hint("shuffle_hash"), F.col("payload_digest") == F.col("d"), "left")
    revisits = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top.page_id"))
    stands = F.coalesce((F.col(FILE) == F.col(f"top.{FILE}")) & (F.col(ROW) == F.col(f"top.{ROW}")), F.lit(False))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    name = F.when(stands, F.concat_ws(":", page, "payload_digest")).otherwise(F.concat_ws(":", page, F.concat(F.hex(FILE), F.lit("-"), F.col(ROW).cast("string"))))
    return joined.select("page_id", "url", "html", "payload_bytes", "payload_digest", F.when(revisits, F.col("top.page_id")).alias("refers_to"), name.alias("name"))


def record_id(name: str) -> str:
    return f"urn:sparley:page:{name}"


def encode_record(name: str, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A WARC/1.1 record. A revisit's block has the HTTP header alone, which keeps the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id(name)}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_id(f'{refers_to}:{digest}')}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def decode_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """Header fields, block and offset of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *fields = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at offset {at}")
        header = dict(x.split(": ", 1) for x in fields)
        begin, size = end + 4, int(header["Content-Length"])
        yield header, data[begin : begin + size], at
        at = begin + size + 4


def parse_record(header: dict[str, str], block: bytes) -> dict:
    """The RECORD columns and the payload (None for a revisit); checks a response's digest."""
    page = lambda x: None if (n := x.strip("<>").split(":")[3]) == "null" else int(n)
    digest = base64.b32decode(header["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\nContent-Length: (\d+)", http)[1])
    kind = header["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {header['WARC-Record-ID']}")
    refers = page(header["WARC-Refers-To"]) if kind == "revisit" else None
    return {"page_id": page(header["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers, "payload": payload if kind == "response" else None}


class BundleWriter:
    """Appends frames to a stream and ends it with the seek table."""

    def __init__(self, out, level: int = 3):
        import zstandard

        self.out, self.packer, self.sizes, self.bytes = out, zstandard.ZstdCompressor(level=level, write_checksum=True), [], 0

    def frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.sizes.append((len(packed), len(data)))
        self.bytes += len(packed)

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *x) for x in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of each frame, from the footer."""
    end = file.size()
    file.seek(end - 9)
    n, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(end - 9 - 8 * n)
    entries, at, out = file.read(8 * n), 0, []
    for packed, plain in struct.iter_unpack("<II", entries):
        out.append((at, packed, plain))
        at += packed
    return out


def read_frame(file, entry: tuple[int, int, int]) -> bytes:
    import zstandard

    file.seek(entry[0])
    return zstandard.ZstdDecompressor().decompress(file.read(entry[1]), max_output_size=entry[2])


def _writer(folder: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "page_id", "bundle", "frame", "offset", "length"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
        files, path = open_fs(folder)
        bundle, name, frame, rows, ready, size = None, "", [], [], [], 0

        def flush() -> None:
            nonlocal frame, rows, size
            if frame:
                bundle.frame(b"".join(frame))
                ready.extend(rows)
                frame, rows, size = [], [], 0

        for batch in batches:
            for page_id, url, html, n, digest, refers_to, record in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                if bundle is None:
                    name = f"bundle-{uuid.uuid4().hex}.warc.zst"
                    files.create_dir(path, recursive=True)
                    bundle = BundleWriter(files.open_output_stream(f"{path}/{name}", compression=None))
                data = encode_record(record, url, html.encode() if refers_to is None else b"", n, digest, refers_to)
                if size and size + len(data) > frame_bytes:
                    flush()
                rows.append((record_id(record), page_id, name, len(bundle.sizes), size, len(data)))
                frame.append(data)
                size += len(data)
                if bundle.bytes >= bundle_bytes:
                    flush()
                    bundle.close()
                    bundle = None
            if ready:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), types, strict=True)], names)
                ready.clear()
        flush()
        if bundle is not None:
            bundle.close()
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready, strict=True), types, strict=True)], names)

    return write


def write_archive(pages: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes page_id, url, html as records under `folder`; returns the index, a table there."""
    assign_records(pages).mapInArrow(_writer(folder, frame_bytes, bundle_bytes), INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        files, path = open_fs(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{path}/{row['bundle']}") as file:
                    for entry in read_seek_table(file)[row["begin"] : row["begin"] + FRAMES_PER_TASK]:
                        found = [parse_record(h, b) for h, b, _ in decode_records(read_frame(file, entry))]
                        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in zip(names, types, strict=True)], names)

    return read


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The RECORD columns of all records of an archive, decoded from its bundles."""
    index = spark.read.schema(INDEX).parquet(f"{folder}/index")
    units = index.groupBy("bundle").agg(F.max("frame").alias("last")).select("bundle", F.explode(F.expr(f"sequence(0, last, {FRAMES_PER_TASK})")).alias("begin"))
    # An explicit number of partitions, as tiny rows that stand for much work would be put into one task.
    n = units.count()
    tasks = max(1, min(n, 4 * spark.sparkContext.defaultParallelism), n // UNITS_PER_TASK)
    return units.repartition(tasks).mapInArrow(_reader(folder), RECORD)


def read_payload(folder: str, bundle: str, frame: int, offset: int) -> dict:
    """One record by its index entry: decompresses one frame."""
    files, path = open_fs(folder)
    with files.open_input_file(f"{path}/{bundle}") as file:
        data = read_frame(file, read_seek_table(file)[frame])
    header, block, _ = next(decode_records(data[offset:]))
    return parse_record(header, block)
