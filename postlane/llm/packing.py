"""Packing documents into sequences by best-two-fit.

Documents longer than a sequence are cut into full pieces; only their last piece may be shorter.
Pieces are dealt evenly into shards of bounded size, and each shard is packed for itself, so a
shard costs at most one sequence that could have been shared with another.

Inside a shard a sequence is filled greedily with the longest pieces that still fit. Then its
smallest piece is taken out if two unpacked pieces together fit the gap, which is now larger,
more tightly than it did; of all such pairs the one that leaves least is taken.

Null text counts as empty: such a document is its end token alone. Null ids and repeated rows are
packed like any others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.token_ids import TextEncoder
from postlane.llm.words import bounded_batches, release
from postlane.shared import settle

PIECES_PER_SHARD = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, doc_id: str, text: str
) -> DataFrame:
    """One row per piece; ``row`` numbers the pieces across tasks without gaps inside a task."""
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = TextEncoder.of(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            names = batch.column(0).to_pylist()
            for some, ids, starts in encoder.batches(batch.column(1)):
                out: dict[str, list] = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
                for name, begin, end in zip(names[some], starts[:-1].tolist(), starts[1:].tolist()):
                    whole = np.empty(end - begin + 1, "<u4")
                    whole[:-1] = ids[begin:end]
                    whole[-1] = end_id
                    for piece, at in enumerate(range(0, len(whole), capacity)):
                        part = whole[at : at + capacity]
                        out["doc_id"].append(name)
                        out["piece"].append(piece)
                        out["start"].append(at)
                        out["length"].append(len(part))
                        out["ids_crc32"].append(zlib.crc32(part))
                n = len(out["piece"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(out["doc_id"], pa.int64()),
                        pa.array(out["piece"], pa.int32()),
                        *(pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32")),
                        pa.array(range(row, row + n), pa.int64()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "row"],
                )
                row += n

    return rows.mapInArrow(cut, PIECES)


def best_two_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of places into ``lengths``; every length is at most ``capacity``."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for place in range(len(lengths) - 1, -1, -1):
        waiting[lengths[place]].append(place)
    left = np.zeros(capacity + 1, np.int64)
    for length, places in waiting.items():
        left[length] = len(places)
    sizes = np.arange(capacity + 1)
    # below[x]: the longest waiting length of at most x, or 0
    below = np.maximum.accumulate(np.where(left > 0, sizes, 0))

    def take(length: int) -> int:
        left[length] -= 1
        if not left[length]:
            shorter = below[length - 1]
            end = length + int(np.searchsorted(below[length:], length, "right"))
            below[length:end] = shorter
        return waiting[length].pop()

    def give(length: int, place: int) -> None:
        waiting[length].append(place)
        left[length] += 1
        if left[length] == 1:
            end = length + int(np.searchsorted(below[length:], length, "left"))
            below[length:end] = length

    bins = []
    while below[capacity]:
        chosen: list[tuple[int, int]] = []
        gap = capacity
        while gap and below[gap]:
            length = int(below[gap])
            chosen.append((length, take(length)))
            gap -= length
        if gap and len(chosen) > 1 and below[capacity]:
            smallest, place = chosen[-1]
            room = gap + smallest
            firsts = np.flatnonzero(left[: room // 2 + 1])  # the shorter one of the pair
            if len(firsts):
                # With its partner the shorter one may be the only piece of its length.
                seconds = below[room - firsts]
                alone = (seconds == firsts) & (left[firsts] < 2)
                seconds = np.where(alone, below[firsts - 1], seconds)
                both = np.where(seconds > 0, firsts + seconds, 0)
                best = int(np.argmax(both))
                if both[best] > smallest:
                    chosen.pop()
                    give(smallest, place)
                    for length in (int(firsts[best]), int(seconds[best])):
                        chosen.append((length, take(length)))
        bins.append([place for _, place in chosen])
    return bins


def pack_pieces(
    pieces: DataFrame, capacity: int, per_shard: int = PIECES_PER_SHARD
) -> DataFrame:
    """Give each piece its sequence and its place there. ``pieces`` must be a settled table."""
    shards = max(1, -(-pieces.count() // per_shard))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        sequence = np.zeros(len(table), np.int64)
        offset = np.zeros(len(table), np.int64)
        lengths = table["length"].to_pylist()
        for number, places in enumerate(best_two_fit(lengths, capacity)):
            at = 0
            for place in places:
                sequence[place], offset[place] = number, at
                at += lengths[place]
        shard = table["shard"][0].as_py() if len(table) else 0
        release()
        return (
            table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
            .append_column("sequence_id", pa.array(sequence + (shard << 32)))
            .append_column("offset", pa.array(offset))
        )

    return dealt.groupBy("shard").applyInArrow(pack, PACKED)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    capacity: int = 4096,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Cut, settle and pack whole documents."""
    pieces = settle(cut_pieces(docs, tokenizer, end_id, capacity, doc_id, text), "pieces")
    return pack_pieces(pieces, capacity)
