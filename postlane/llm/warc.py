"""WARC archives with segmented records and chunked transfer framing.

Writing: every row becomes a record whose HTTP body is framed in chunks. A payload that several
rows share is stored once, by the largest id; the others become revisit records. A block longer
than ``segment_bytes`` is spread over a first record and continuation records, which name the
first one's id and their number; the last one states the total length. Records are gzip members
of their own, files roll at a target size.

Reading: records that are whole are decoded where they are read. Segments are grouped by the id of
their first record, ordered by number and joined as they stream by, so that no more than one
record is held; gaps, a wrong total length, bad framing and a wrong digest are errors. Segments may
lie in different files.

A null payload counts as empty, a null URL is not written. Rows without an id are kept. Rows with
the same id and payload give records with one id; each of them is read back. Other columns are
ignored, and an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.files import one_task_each, open_new, open_old, unique_name
from postlane.llm.words import bounded_batches
from postlane.shared import new_folder, settle

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = (
    b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    b"Transfer-Encoding: chunked\r\n\r\n"
)
CHUNK_BYTES = 4096
SEGMENT_BYTES = 16_384
FILE_BYTES = 64_000_000
LEAST_SHARED = 1000
BATCH_BYTES = 4_000_000
FILES = "path string, records long, bytes long"
RECORDS = (
    "record_id string, record_type string, page_id long, url string, refers_to string, "
    "origin string, segment int, total_length long, digest string, payload binary, block binary"
)
_COLUMNS = [part.strip().split(" ")[0] for part in RECORDS.split(",")]
PAYLOADS = "record_id string, record_type string, page_id long, url string, refers_to string, payload binary"


def framed(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a body."""
    out = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        out += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def unframed(body: bytes) -> bytes:
    """Decode chunked framing; chunk extensions and trailers are allowed."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunked body ends inside a chunk size")
        size = int(body[at:end].split(b";", 1)[0].strip(), 16)
        at = end + 2
        if not size:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The decoded body of an HTTP response."""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"transfer-encoding" and b"chunked" in value.lower():
            return unframed(body)
    return body


def record_name(page_id: int | None, digest: str) -> str:
    """The id of the record that stores a payload for a page; any reader can derive it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}')}>"


def _digest_field(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [VERSION, *[f"{name}: {value}" for name, value in fields if value is not None]]
    lines.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    text = "\r\n".join(lines).encode() + b"\r\n\r\n"
    return packer.compress(text + block + b"\r\n\r\n") + packer.flush()


def records_for(
    page_id: int | None, url: str | None, payload: bytes, digest: str, holder: int | None,
    segment_bytes: int,
) -> Iterator[bytes]:
    """All records of one row; ``holder`` is the page whose record stores the payload, if another."""
    revisit = holder is not None and holder != page_id
    name = record_name(page_id, digest)
    if url is not None:
        url = "".join(f"%{ord(c):02X}" if c < " " or c in "%\x7f" else c for c in url)
    common = [
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url),
        ("Page-Id", page_id),
        ("WARC-Payload-Digest", _digest_field(digest)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if revisit:
        stored = [("WARC-Refers-To", record_name(holder, digest)), ("WARC-Profile", PROFILE)]
        yield _record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common, *stored], HTTP_HEAD
        )
        return
    block = HTTP_HEAD + framed(payload)
    parts = [block[at : at + segment_bytes] for at in range(0, len(block), segment_bytes)]
    if len(parts) == 1:
        yield _record([("WARC-Type", "response"), ("WARC-Record-ID", name), *common], block)
        return
    for number, part in enumerate(parts, 1):
        last = [("WARC-Segment-Total-Length", len(block))] if number == len(parts) else []
        if number == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", name), *common]
        else:
            own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{name}/{number}')}>"
            fields = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", own), ("WARC-Date", DATE),
                ("WARC-Segment-Origin-ID", name),
            ]
        yield _record([*fields, ("WARC-Segment-Number", number), *last], part)


def write_warc(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_shared: int = LEAST_SHARED,
    segment_bytes: int = SEGMENT_BYTES,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write archives below ``folder`` and return the table of the files written."""
    rows = bounded_batches(pages).select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    shared = settle(
        rows.where(F.octet_length("payload") >= least_shared)
        .groupBy("digest")
        .agg(F.max("page_id").alias("holder"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "holder"),
        "shared-payloads",
    )
    rows = rows.join(shared, "digest", "left").select("page_id", "url", "payload", "digest", "holder")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        out, path, records, size = None, "", 0, 0

        def finish():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns):
                for record in records_for(*row, segment_bytes):
                    if out is not None and size + len(record) > file_bytes:
                        yield finish()
                        out = None
                    if out is None:
                        path = unique_name(folder, f"pages-{part:06d}-{number:04d}", "warc.gz")
                        out, records, size, number = open_new(path), 0, 0, number + 1
                    out.write(record)
                    records, size = records + 1, size + len(record)
        if out is not None:
            yield finish()

    return settle(rows.mapInArrow(write, FILES), "warc-files")


def members(source, piece: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time."""
    data = source.read(piece)
    while data:
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not data:
                raise ValueError("archive ends inside a record")
            out.append(unpacker.decompress(data))
            data = unpacker.unused_data if unpacker.eof else source.read(piece)
        yield b"".join(out)
        data = data or source.read(piece)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and the block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("record is shorter than its Content-Length")
    return fields, rest[:length]


def _check_digest(payload: bytes, field: str | None) -> None:
    if field and field != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError("payload does not fit its digest")


def _unquoted(url: str | None) -> str | None:
    from urllib.parse import unquote

    return None if url is None else unquote(url)


def _to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
    )


def _arrow(names: list[str]) -> pa.Schema:
    kinds = {
        "page_id": pa.int64(), "total_length": pa.int64(), "segment": pa.int32(),
        "payload": pa.binary(), "block": pa.binary(),
    }
    return pa.schema([(name, kinds.get(name, pa.string())) for name in names])


def read_records(files: DataFrame, segments: bool) -> DataFrame:
    """One row per record, either of whole ones, decoded, or of segments with their part."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(_COLUMNS)
        rows, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_old(path) as source:
                    for raw in members(source):
                        fields, block = parse_record(raw)
                        kind, number = fields["warc-type"], fields.get("warc-segment-number")
                        if (number is not None) != segments:
                            continue
                        payload = None
                        if kind == "response" and number is None:
                            payload, block = payload_of(block), None
                            _check_digest(payload, fields.get("warc-payload-digest"))
                        elif number is None:
                            block = None
                        name, page = fields["warc-record-id"], fields.get("page-id")
                        total = fields.get("warc-segment-total-length")
                        rows.append(
                            (
                                name, kind, None if page is None else int(page),
                                _unquoted(fields.get("warc-target-uri")), fields.get("warc-refers-to"),
                                fields.get("warc-segment-origin-id", name),
                                None if number is None else int(number),
                                None if total is None else int(total),
                                fields.get("warc-payload-digest"), payload, block,
                            )
                        )
                        size += len(raw)
                        if size > BATCH_BYTES:
                            yield _to_batch(rows, schema)
                            rows, size = [], 0
        if rows:
            yield _to_batch(rows, schema)

    return one_task_each(files.select("path")).mapInArrow(read, RECORDS)


def reassemble(segments: DataFrame) -> DataFrame:
    """Join the segments of each record, check them, and decode their payload."""
    ordered = segments.repartition("origin").sortWithinPartitions("origin", "segment")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(["record_id", "record_type", "page_id", "url", "refers_to", "payload"])
        firsts: list[dict] = []
        parts: dict[int, bytes] = {}
        total, origin = None, None
        rows, size = [], 0

        def whole() -> list[tuple]:
            block = b"".join(parts.values())
            if not firsts or list(parts) != list(range(1, len(parts) + 1)):
                raise ValueError(f"{origin}: a segment is missing")
            if total != len(block):
                raise ValueError(f"{origin}: {len(block)} bytes instead of {total}")
            payload = payload_of(block)
            _check_digest(payload, firsts[0]["digest"])
            return [
                (origin, "response", one["page_id"], one["url"], None, payload) for one in firsts
            ]

        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in _COLUMNS if name != "payload"}
                if row["origin"] != origin:
                    if origin is not None:
                        rows += whole()
                        size += sum(len(part) for part in parts.values())
                    origin, firsts, parts, total = row["origin"], [], {}, None
                    if size > BATCH_BYTES:
                        yield _to_batch(rows, schema)
                        rows, size = [], 0
                if row["segment"] == 1:
                    firsts.append(row)
                parts.setdefault(row["segment"], row["block"])
                total = row["total_length"] or total
        if origin is not None:
            rows += whole()
        if rows:
            yield _to_batch(rows, schema)

    return ordered.mapInArrow(join, PAYLOADS)


def read_warc(files: DataFrame) -> DataFrame:
    """One row per response or revisit: ids, URL, what it refers to, and the decoded payload."""
    whole = read_records(files, segments=False).select(
        "record_id", "record_type", "page_id", "url", "refers_to", "payload"
    )
    return whole.unionByName(reassemble(read_records(files, segments=True)))


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write all rows to archives in the shared folder, read them back and resolve revisits.

    page_id, payload_bytes, payload_digest, record_type, refers_to (a page id).
    """
    folder = new_folder(pages.sparkSession, "warc")
    found = read_warc(write_warc(pages, folder, **options)).select(
        "record_id",
        "record_type",
        "page_id",
        "refers_to",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )
    found = settle(found, "warc-records")
    stored = (
        found.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(
            F.max("page_id").alias("stored_id"),
            F.max("payload_bytes").alias("stored_bytes"),
            F.max("payload_digest").alias("stored_digest"),
        )
    )
    revisits = found.where("record_type = 'revisit'").join(stored, "refers_to", "left").select(
        "page_id",
        F.col("stored_bytes").alias("payload_bytes"),
        F.col("stored_digest").alias("payload_digest"),
        "record_type",
        F.col("stored_id").alias("refers_to"),
    )
    responses = found.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    )
    return responses.unionByName(revisits)
