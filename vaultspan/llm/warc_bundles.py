"""WARC records in seekable Zstandard bundles.

A task groups the records of its rows into frames of about a megabyte, compresses each
frame by itself and appends a seek table in a skippable frame: compressed size,
decompressed size and checksum of every frame, after the public seekable format of
Zstandard. So any Zstandard tool reads a bundle as one WARC file, and a reader that has
the footer decompresses one frame to reach a record. The index maps the id of every
record to bundle, frame, and offset and length inside the decompressed frame.

Of pages with equal payloads of at least ``least`` bytes one is written in full, that
with the largest id (then the largest url), all others are revisits that refer to it. The
narrow rows are stored with a number each, so rows equal in everything are told apart
once and for all. Equal payloads meet in an aggregation that keeps one of them, so a
payload that a third of all pages have is combined before the shuffle, and revisits
travel without theirs.

Bundles have names of their attempt; the index is stored before it is used and names only
those of successful attempts, so a task that is run again does no harm.

Defined results: a null payload is empty; a null id counts as smaller than any; a null url
is left out of the record, control characters in one are percent-encoded; repeated rows
are a record each; a record larger than a frame has a frame of its own; an empty table
gives no bundles and an empty result; other columns are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultspan.llm.scratch import Scratch
from vaultspan.llm.token_files import _opened

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 30  # of records; a bundle ends with the frame that brings it past that
READ_BYTES = 64 << 20  # of records for a reading task

# Fixed values of the formats.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "record_id string, page_id long, record_type string, bundle string, frame int, offset long, length long"
RECORD = "record_id string, page_id long, record_type string, refers_to_id string, url string, payload binary, payload_bytes long, payload_digest string"


class BundleWriter:
    """Records go in, independent frames and at last the seek table go out."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES):
        self._sink, self._frame_bytes = sink, frame_bytes
        self._compress = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self._records: list[bytes] = []
        self._entries: list[bytes] = []
        self._open = 0
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset in it) that the record gets."""
        if self._open and self._open + len(record) > self._frame_bytes:
            self._flush()
        at = self._open
        self._records.append(record)
        self._open += len(record)
        return len(self._entries), at

    def _flush(self) -> None:
        frame = b"".join(self._records)
        packed = self._compress.compress(frame)
        self._sink.write(packed)
        self._entries.append(struct.pack("<III", len(packed), len(frame), xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF))
        self.written += len(frame)
        self._records, self._open = [], 0

    def close(self) -> None:
        if self._open:
            self._flush()
        table = b"".join(self._entries) + struct.pack("<IBI", len(self._entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self._sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self._sink.close()


class Bundle:
    """Random access to the frames of a bundle; the last one read is kept."""

    def __init__(self, place: str):
        system, path = _opened(place)
        self._file = system.open_input_file(path)
        size = self._file.size()
        count, flags, magic = struct.unpack("<IBI", self._file.read_at(9, size - 9))
        width = 12 if flags & HAS_CHECKSUMS else 8
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{place} has no seek table")
        table = self._file.read_at(count * width, size - 9 - count * width)
        self._entries = [struct.unpack_from("<III" if width == 12 else "<II", table, k * width) for k in range(count)]
        self._starts = [0]
        for entry in self._entries:
            self._starts.append(self._starts[-1] + entry[0])
        self._at: tuple[int, bytes] | None = None

    def __len__(self) -> int:
        return len(self._entries)

    def frame(self, number: int) -> bytes:
        if self._at is None or self._at[0] != number:
            packed, size, *check = self._entries[number]
            frame = zstandard.ZstdDecompressor().decompress(self._file.read_at(packed, self._starts[number]), max_output_size=size)
            if len(frame) != size or check and xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF != check[0]:
                raise ValueError(f"frame {number} is damaged")
            self._at = (number, frame)
        return self._at[1]

    def close(self) -> None:
        self._file.close()


def _urn(seed: bytes) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(seed).digest()[:16], version=5)}>"


def _record(
    record_id: str, page_id: int | None, url: str | None, date: str, sha1: bytes, payload: bytes | None, refers_to: str | None
) -> bytes:
    """A response with the whole payload, or a revisit of ``refers_to`` with the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        http += b"Content-Length: %d\r\n" % len(payload)
    block = http + b"\r\n" + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Date: {date}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {refers_to}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields by lower-case name, payload) of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, rest[:size].partition(b"\r\n\r\n")[2]


def _decided(scratch: Scratch, pages: DataFrame, least: int) -> DataFrame:
    """A row per record: id, url, SHA-1, payload (null for revisits), and the SHA-256 of a payload that others may share."""
    payload = F.coalesce(F.col("payload"), F.lit(b""))
    pages = pages.select("page_id", "url", payload.alias("payload"))
    big = F.octet_length("payload") >= least
    sums = [F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1")]
    small = pages.where(~big).select("page_id", "url", F.sha1("payload").alias("sha1"), "payload", F.lit(None).cast("string").alias("shared"), F.lit(False).alias("again"))
    # one payload of each kind, combined before the shuffle; equal rows are interchangeable
    whole = (
        pages.where(big)
        .select("page_id", "url", "payload", *sums)
        .groupBy("sha256", "sha1")
        .agg(F.max(F.struct("page_id", "url")).alias("best"), F.first("payload").alias("payload"))
        .select("best.page_id", "best.url", "sha1", "payload", F.col("sha256").alias("shared"), F.lit(False).alias("again"))
    )
    narrow = scratch.store(pages.where(big).select("page_id", "url", *sums, F.monotonically_increasing_id().alias("row")), "large-pages")
    best = narrow.groupBy("sha256").agg(F.max(F.struct("page_id", "url", "row")).alias("best")).select("sha256", F.col("best.row").alias("best"))
    revisits = narrow.join(best, "sha256").where("row <> best").select(
        "page_id", "url", "sha1", F.lit(None).cast("binary").alias("payload"), F.col("sha256").alias("shared"), F.lit(True).alias("again")
    )
    return whole.unionByName(small).unionByName(revisits)


def write_bundles(
    scratch: Scratch,
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least: int = 1000,
    folder: str | None = None,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write the records into bundles below ``folder`` (the scratch folder, if none); return the stored index."""
    folder = folder or f"{scratch.folder}/warc"
    rows = _decided(
        scratch,
        pages.select(
            F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), F.col(payload_column).cast("binary").alias("payload")
        ),
        least,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _opened(folder)
        writer = name = None
        count = 0
        for batch in batches:
            index = []
            for page_id, url, sha1, payload, shared, again in zip(*[c.to_pylist() for c in batch.columns]):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    name, count = f"{uuid.uuid4().hex}.warc.zst", 0
                    writer = BundleWriter(system.open_output_stream(f"{base}/{name}", compression=None), frame_bytes)
                # a shared payload names its record, so that revisits can; other records are named by their place
                response = _urn(f"payload {shared}".encode()) if shared else None
                record_id = response if response and not again else _urn(f"{name} {count}".encode())
                count += 1
                record = _record(record_id, page_id, url, date, bytes.fromhex(sha1), payload, response if again else None)
                frame, at = writer.add(record)
                index.append((record_id, page_id, "revisit" if again else "response", f"{folder}/{name}", frame, at, len(record)))
                if writer.written >= bundle_bytes:
                    writer.close()
                    writer = None
            if index:
                kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64())
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*index), kinds)],
                    names=["record_id", "page_id", "record_type", "bundle", "frame", "offset", "length"],
                )
        if writer is not None:
            writer.close()

    return scratch.store(rows.mapInArrow(run, INDEX), "index")


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of an index name, each frame decompressed once by the task that has its rows.

    ``payload_bytes`` and ``payload_digest`` are those of the bytes read; a revisit has none. The number of
    tasks follows the bytes to be read, which the index gives.
    """
    total = index.agg(F.sum("length").alias("bytes")).first()["bytes"] or 0
    tasks = max(int(total // READ_BYTES) + 1, index.sparkSession.sparkContext.defaultParallelism)
    placed = index.select("bundle", "frame", "offset", "length").repartition(tasks, "bundle", "frame")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = opened = None
        for batch in batches:
            out = []
            for name, frame, offset, length in zip(*[c.to_pylist() for c in batch.columns]):
                if name != place:
                    if opened is not None:
                        opened.close()
                    place, opened = name, Bundle(name)
                fields, payload = parse(opened.frame(frame)[offset : offset + length])
                full = fields["warc-type"] == "response"
                if full and base64.b32encode(hashlib.sha1(payload).digest()).decode() != fields["warc-payload-digest"][5:]:
                    raise ValueError(f"{fields['warc-record-id']} does not have the digest it names")
                page_id = fields.get("page-id")
                out.append(
                    (
                        fields["warc-record-id"], int(page_id) if page_id else None, fields["warc-type"],
                        fields.get("warc-refers-to"), fields.get("warc-target-uri"), payload if full and payloads else None,
                        len(payload) if full else None, hashlib.sha1(payload).hexdigest() if full else None,
                    )
                )
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string())
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=[part.split()[0] for part in RECORD.split(", ")])
        if opened is not None:
            opened.close()

    return placed.sortWithinPartitions("bundle", "frame", "offset").mapInArrow(run, RECORD)


def resolved(scratch: Scratch, records: DataFrame) -> DataFrame:
    """Every record with size and digest of its full payload; a revisit takes them, and the page, from what it refers to."""
    found = scratch.store(records.drop("payload"), "records")
    own = ["page_id", "url", "record_id", "record_type"]
    full = found.where("record_type = 'response'")
    target = full.select(
        F.col("record_id").alias("refers_to_id"), "payload_bytes", "payload_digest", F.col("page_id").alias("refers_to")
    )
    again = found.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(target, "refers_to_id", "left")
    results = [*own, "payload_bytes", "payload_digest", "refers_to"]
    return full.withColumn("refers_to", F.lit(None).cast("long")).select(results).unionByName(again.select(results))
