"""Token-id files in patched frame-of-reference blocks.

A file holds the ids of whole documents, in ascending id order, as blocks of 128 ids. A block
stores its minimum, the differences to it in a bit width that fits a chosen share of them, and a
list of exceptions (place, difference) for the rest. The start of every block is indexed, so
any document can be read without decoding what stands before it.

File layout, little-endian::

    "PFR1"  u32 version
    blocks: u32 minimum, u8 width, u8 exceptions, 16 * width bytes of packed differences,
            u8 place per exception, u32 difference per exception
    u64 start of each block
    i64 document id, u8 whether it is null, u64 length: each for all documents
    u64 ids, u64 blocks, u64 documents, u64 start of the index, "PFR1"

Null text counts as empty, a null id sorts first, repeated ids are kept and ordered by their
texts. An empty table gives no files and no rows. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.files import one_task_each, open_new, open_old, unique_name, with_starts
from postlane.llm.token_ids import TextEncoder
from postlane.llm.words import bounded_batches, ragged, release
from postlane.shared import new_folder, settle

BLOCK = 128
MAGIC = b"PFR1"
PERCENTILE = 0.9
IDS_PER_FILE = 1 << 21
_FOOTER = "<QQQQ4s"
_ROWS = 2048

FILES = "part int, file_no int, path string, documents long, ids long"


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.uint64(1) << np.arange(32, dtype=np.uint64), values, "right")


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all blocks and the start of each."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint8), np.zeros(0, np.uint64)
    table = np.full(blocks * BLOCK, ids[-1], np.uint32)
    table[:n] = ids
    table = table.reshape(blocks, BLOCK)
    minimum = table.min(axis=1)
    above = table - minimum[:, None]
    bits = _bit_lengths(above).astype(np.uint8)
    rank = max(0, int(np.ceil(percentile * BLOCK)) - 1)
    width = np.partition(bits, rank, axis=1)[:, rank].astype(np.int64)
    odd = bits > width[:, None]
    odd_count = odd.sum(axis=1)
    size = 6 + 16 * width + 5 * odd_count
    start = np.concatenate(([0], np.cumsum(size)))
    out = np.zeros(int(start[-1]), np.uint8)
    start = start[:-1]
    out[start[:, None] + np.arange(4)] = minimum.astype("<u4").view(np.uint8).reshape(blocks, 4)
    out[start + 4] = width
    out[start + 5] = odd_count
    for wide in np.unique(width[width > 0]):
        places = np.flatnonzero(width == wide)
        for some in np.array_split(places, -(-len(places) // _ROWS)):
            low = np.where(odd[some], 0, above[some])
            packed = (low[:, :, None] >> np.arange(wide, dtype=np.uint32)) & np.uint32(1)
            packed = np.packbits(
                packed.astype(np.uint8).reshape(len(some), -1), axis=1, bitorder="little"
            )
            out[start[some][:, None] + 6 + np.arange(16 * wide)] = packed
    block, place = np.nonzero(odd)
    if len(block):
        nth = np.arange(len(block)) - np.repeat(np.cumsum(odd_count) - odd_count, odd_count)
        base = start[block] + 6 + 16 * width[block]
        out[base + nth] = place
        base = base + odd_count[block] + 4 * nth
        values = above[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        out[base[:, None] + np.arange(4)] = values
    return out, start.astype(np.uint64)


def decode_blocks(data: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Ids of the blocks that begin at ``start``; ``n`` of them."""
    start = start.astype(np.int64)
    blocks = len(start)
    if not blocks:
        return np.zeros(0, np.uint32)
    minimum = data[start[:, None] + np.arange(4)].copy().view("<u4").reshape(blocks)
    width = data[start + 4].astype(np.int64)
    odd_count = data[start + 5].astype(np.int64)
    table = np.zeros((blocks, BLOCK), np.uint32)
    for wide in np.unique(width[width > 0]):
        places = np.flatnonzero(width == wide)
        for some in np.array_split(places, -(-len(places) // _ROWS)):
            packed = data[start[some][:, None] + 6 + np.arange(16 * wide)]
            bits = np.unpackbits(packed, axis=1, bitorder="little")
            bits = bits.reshape(len(some), BLOCK, wide)
            value = np.zeros((len(some), BLOCK), np.uint32)
            for bit in range(wide):
                value |= bits[:, :, bit].astype(np.uint32) << np.uint32(bit)
            table[some] = value
    if odd_count.sum():
        block = np.repeat(np.arange(blocks), odd_count)
        nth = ragged(np.zeros(blocks, np.int64), odd_count)
        base = start[block] + 6 + 16 * width[block]
        place = data[base + nth]
        base = base + odd_count[block] + 4 * nth
        table[block, place] = data[base[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    return (table + minimum[:, None]).reshape(-1)[:n]


def write_file(path: str, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> None:
    data, start = encode_blocks(ids)
    index_at = 8 + len(data)
    with open_new(path) as out:
        out.write(MAGIC + struct.pack("<I", 1))
        out.write(data.tobytes())
        out.write(start.astype("<u8").tobytes())
        out.write(np.array([value or 0 for value in doc_ids], "<i8").tobytes())
        out.write(np.array([value is None for value in doc_ids], np.uint8).tobytes())
        out.write(np.array(lengths, "<u8").tobytes())
        out.write(struct.pack(_FOOTER, len(ids), len(start), len(doc_ids), index_at, MAGIC))


def read_file(path: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths, and all ids of a file."""
    with open_old(path) as source:
        raw = np.frombuffer(source.read(), np.uint8)
    ids, blocks, documents, index_at, magic = struct.unpack(_FOOTER, raw[-struct.calcsize(_FOOTER) :].tobytes())
    if magic != MAGIC or raw[:4].tobytes() != MAGIC:
        raise ValueError(f"{path} is no token file")
    at = index_at
    start = np.frombuffer(raw, "<u8", blocks, at)
    at += 8 * blocks
    doc_ids = np.frombuffer(raw, "<i8", documents, at)
    at += 8 * documents
    missing = raw[at : at + documents]
    lengths = np.frombuffer(raw, "<u8", documents, at + documents).astype(np.int64)
    named = [None if gone else int(value) for value, gone in zip(doc_ids, missing)]
    return named, lengths, decode_blocks(raw[8:index_at], start, ids)


def read_documents(path: str, first: int, last: int) -> list[np.ndarray]:
    """Ids of documents ``first`` to ``last - 1`` of a file, decoding only their blocks."""
    with open_old(path) as source:
        size = source.size()
        ids, blocks, documents, index_at, _ = struct.unpack(_FOOTER, 
            source.read_at(struct.calcsize(_FOOTER), size - struct.calcsize(_FOOTER))
        )
        start = np.frombuffer(source.read_at(8 * blocks, index_at), "<u8")
        lengths = np.frombuffer(
            source.read_at(8 * documents, index_at + 8 * blocks + 9 * documents), "<u8"
        ).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(lengths)))
        begin, end = int(ends[first]), int(ends[last])
        if begin == end:
            return [np.zeros(0, np.uint32) for _ in range(first, last)]
        from_block, to_block = begin // BLOCK, -(-end // BLOCK)
        data_end = int(start[to_block]) if to_block < blocks else index_at - 8
        data_begin = int(start[from_block])
        data = np.frombuffer(source.read_at(data_end - data_begin, 8 + data_begin), np.uint8)
    some = start[from_block:to_block].astype(np.int64) - data_begin
    decoded = decode_blocks(data, some, min(ids, to_block * BLOCK) - from_block * BLOCK)
    shift = from_block * BLOCK
    return [decoded[ends[at] - shift : ends[at + 1] - shift] for at in range(first, last)]


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    ids_per_file: int = IDS_PER_FILE,
) -> DataFrame:
    """Encode documents, write files of about ``ids_per_file`` ids, return the files' table.

    Documents are dealt out by ranges of their ids (with a hash of the text, so that many rows
    of one id are split as well); ``part`` and ``file_no`` give the order of files.
    """
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    salt = F.xxhash64("text")
    rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), salt)
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), salt, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = TextEncoder.of(tokenizer), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        names: list[int | None] = []
        lengths: list[int] = []
        file_no = size = 0

        def flush():
            nonlocal file_no, size
            path = unique_name(folder, f"ids-{part:06d}-{file_no:06d}", "pfr")
            write_file(path, names, lengths, np.concatenate(held))
            row = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "file_no": pa.array([file_no], pa.int32()),
                    "path": [path],
                    "documents": [len(names)],
                    "ids": [size],
                }
            )
            file_no, size = file_no + 1, 0
            held.clear(), names.clear(), lengths.clear()
            return row

        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            for some, ids, starts in encoder.batches(batch.column(1)):
                for name, begin, end in zip(ids_of[some], starts[:-1].tolist(), starts[1:].tolist()):
                    if size and size + end - begin + 1 > ids_per_file:
                        yield flush()
                    held.append(ids[begin:end])
                    held.append(np.array([end_id], np.uint32))
                    names.append(name)
                    lengths.append(end - begin + 1)
                    size += end - begin + 1
                if held:  # do not keep the whole batch's ids alive for a few documents
                    held[:] = [np.concatenate(held)]
        if names:
            yield flush()

    return settle(rows.mapInArrow(write, FILES), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document: its id, where it starts among all ids, its length and a checksum."""
    placed = one_task_each(with_starts(files, "ids", "start").select("path", "start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names, lengths, ids = read_file(path)
                ids = np.ascontiguousarray(ids, "<u4")
                ends = np.concatenate(([0], np.cumsum(lengths)))
                edges = ends.tolist()
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(names, pa.int64()),
                        "start": begin + ends[:-1],
                        "n_tokens": lengths,
                        "ids_crc32": pa.array(
                            [zlib.crc32(ids[a:b]) for a, b in zip(edges, edges[1:])], pa.int64()
                        ),
                    }
                )
        release()

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, end_id: int, **names) -> DataFrame:
    """Write the files to a new place in the shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder, tokenizer, end_id, **names))
