"""Seekable Zstandard bundles of WARC records.

A bundle holds zstandard frames of some records each, every frame readable by itself; then, in a
skippable frame, the index from record identifiers to frame and offset within the frame; then
the seek table of the seekable format, which any reader of that format understands.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, ready, whole_text
from tidemark.llm.files import opened, written
from tidemark.session import shared_dir, stage

LEAST_SHARED = 1000          # payloads below are written each
FRAME_BYTES = 1 << 18        # a frame is closed when it holds so much
ROWS_PER_BUNDLE = 2048
LEVEL = 6

# The seekable format, and words of the WARC 1.1 format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEK_MAGIC = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages come without the time of their capture
_SEEK_FOOTER, _ENTRY = struct.Struct("<IBI"), struct.Struct("<II")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page_id(record: str) -> int | None:
    name = record.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, revisits: tuple[int | None] | None) -> bytes:
    """A response record, or, of a payload written elsewhere, a revisit record without it.

    The block keeps the head of the HTTP message, so a revisit still says how long its payload is.
    """
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if revisits is None else b"")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", "response" if revisits is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "about:blank", safe="%/:=&?~#+!$,;'@()*[]")), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisits is not None:
        fields[3:3] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(revisits[0]))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(content: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Fields of the record, fields of the HTTP message, payload."""
    def fields(lines: bytes) -> dict[str, str]:
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:])}

    head, _, rest = content.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    named = fields(head)
    block = rest[:int(named["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return named, fields(http), payload


def _skippable(magic: int, content: bytes) -> bytes:
    return _ENTRY.pack(magic, len(content)) + content


class BundleWriter:
    def __init__(self, out):
        self.out, self.frames, self.index, self.held, self.size = out, [], [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, name: str, content: bytes) -> None:
        self.index.append((name, len(self.frames), self.size, len(content)))
        self.held.append(content)
        self.size += len(content)
        if self.size >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        frame = self.compressor.compress(b"".join(self.held))
        self.out.write(frame)
        self.frames.append((len(frame), self.size))
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.held:
            self._close_frame()
        columns = list(zip(*self.index, strict=True)) or [[]] * 4
        table = pa.table([pa.array(c, t) for c, t in zip(columns, _INDEX.types, strict=True)], schema=_INDEX)
        with pa.ipc.new_stream(sink := pa.BufferOutputStream(), _INDEX) as stream:
            stream.write_table(table)
        index = self.compressor.compress(sink.getvalue().to_pybytes())
        self.out.write(_skippable(SKIPPABLE_INDEX, index))
        self.frames.append((len(index) + _ENTRY.size, 0))  # to a reader of the seek table a frame of nothing
        entries = b"".join(_ENTRY.pack(*f) for f in self.frames)
        self.out.write(_skippable(SKIPPABLE_SEEK, entries + _SEEK_FOOTER.pack(len(self.frames), 0, SEEK_MAGIC)))


_INDEX = pa.schema([("record", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()), ("size", pa.int64())])


def read_bundle(name: str, wanted: set[str] | None = None) -> Iterator[bytes]:
    """The records of a bundle, or those wanted, each from its own frame."""
    with opened(name) as file:
        size = file.size()
        file.seek(size - _SEEK_FOOTER.size)
        count, flags, magic = _SEEK_FOOTER.unpack(file.read(_SEEK_FOOTER.size))
        if magic != SEEK_MAGIC or flags:
            raise ValueError(f"{name} has no seek table, or was cut short")
        file.seek(size - _SEEK_FOOTER.size - count * _ENTRY.size)
        frames, at = [], 0
        for packed, raw in _ENTRY.iter_unpack(file.read(count * _ENTRY.size)):
            frames.append((at, packed, raw))
            at += packed
        expand = zstandard.ZstdDecompressor()
        at, packed, _ = frames.pop()
        file.seek(at + _ENTRY.size)
        index = pa.ipc.open_stream(expand.decompress(file.read(packed - _ENTRY.size))).read_all().to_pydict()
        loaded, content = -1, b""
        for record_name, frame, offset, length in zip(*index.values(), strict=True):
            if wanted is None or record_name in wanted:
                if frame != loaded:
                    at, packed, raw = frames[frame]
                    file.seek(at)
                    loaded, content = frame, expand.decompress(file.read(packed), max_output_size=raw)
                yield content[offset:offset + length]


def write_bundles(pages: DataFrame, folder: str, least: int = LEAST_SHARED) -> DataFrame:
    """Write a record per page; one row per bundle: file, records. A bundle is a range of page_id."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"),
        F.xxhash64(html).alias("place"),
    )
    # What a page refers to is found without its payload, which then is shuffled once: a note goes
    # to the place where its page goes, and lies before it there.
    digest = F.unhex(F.sha2("html", 256))
    digests = stage(keyed.where(F.octet_length("html") >= least).select("page_id", "place", digest.alias("digest")), "digests")
    shared = digests.groupBy("digest").agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1")
    notes = digests.join(shared, "digest").where("response IS NOT NULL AND NOT page_id <=> response").groupBy("page_id", "place").agg(
        F.max("response").alias("refers_to")
    )
    number = max(1, -(-pages.count() // ROWS_PER_BUNDLE))
    order = [F.col("page_id"), F.col("place")]
    ranged = keyed.select("page_id", "url", F.lit(None).cast("long").alias("refers_to"), "place", whole_text("html").alias("text")).union(
        notes.select("page_id", F.lit(None).cast("string"), "refers_to", "place", F.lit(b""))
    ).repartitionByRange(number, *order).sortWithinPartitions(*order, F.col("refers_to").desc_nulls_last())

    def write(parts):
        name, records = f"{folder}/bundle-{TaskContext.get().partitionId():08d}.warc.zst", 0
        groups = batches(parts)
        group = next(groups, None)
        if group is None:
            return
        noted = None, None, None
        with written(name) as out:
            bundle = BundleWriter(out)
            while group is not None:
                rest, payloads = group
                for page_id, url, note, place, payload in zip(*(rest.column(c).to_pylist() for c in range(4)), payloads, strict=True):
                    if note is not None:
                        noted = page_id, place, note
                        continue
                    refers_to = noted[2:] if noted[:2] == (page_id, place) and noted[2] is not None else None
                    bundle.add(record_id(page_id), record(page_id, url, payload, refers_to))
                    records += 1
                group = next(groups, None)
            bundle.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [records]})

    return stage(ranged.mapInArrow(write, "file string, records long"), "bundles")


def archive(pages: DataFrame) -> DataFrame:
    """One row per page, from the bundles read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The payload is the html in UTF-8; null is empty. Of equal payloads of at least LEAST_SHARED
    bytes the page with the largest page_id holds the payload and the others refer to it; rows of
    that very page_id hold it each. Rows whose page_id is null refer to it like others, and are
    responses where all are null. Equal means equal SHA-256. A null url is written as
    ``about:blank``. An empty table writes no bundle and gives no rows. Other columns are not read.
    Rows of one page_id with unlike payloads are told apart by a 64-bit hash of these.
    A response's digest is taken again of the payload that was read; one that differs from the
    record's own raises.
    """
    spark = ready(pages.sparkSession)
    bundles = write_bundles(pages, shared_dir(spark, "warc"))
    spread = bundles.select("file").repartition(max(1, bundles.count()), "file")

    def read(parts):
        for batch in parts:
            for name in batch.column(0).to_pylist():
                rows = []
                for content in read_bundle(name):
                    named, http, payload = parse(content)
                    digest = base64.b32decode(named["warc-payload-digest"].removeprefix("sha1:")).hex()
                    kind, refers_to = named["warc-type"], named.get("warc-refers-to")
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: the payload of {named['warc-record-id']} is not what was written")
                    rows.append((
                        _page_id(named["warc-record-id"]), int(http["content-length"]), digest, kind, refers_to and _page_id(refers_to)
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _ROW, strict=True)],
                        ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
                    )

    return spread.mapInArrow(read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


_ROW = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

ORACLE_SQL = f"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), r AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS response, payload_bytes >= {LEAST_SHARED} AS shared FROM p
)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN shared AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN shared AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM r
"""
