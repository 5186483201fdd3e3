"""Benchmark decontamination through a positional inverted index of the training texts.

The index is a table of segments. A segment holds the postings of some neighbouring documents:
its different words, and for each word the ascending list of its places. Nothing is shuffled to
build it, a frequent word is a list in every segment rather than one long list, and a row is as
large as its segment.

A window of a test item is a phrase. In each segment, windows with a word that has no list are out.
The others start from the list of their rarest word, moved back by the word's offset in the
window; these candidate starts are intersected with the list of the next rarest word, moved by its
own offset, and so on. What is left are exact occurrences. The same lists answer proximity:
places of the rarest word that have all other words of the window within ``slop`` words.

Test items are cut into windows by tasks, which write them to the shared folder in blocks of bounded size; a
long item spans several. Only the blocks' paths reach the driver. Searching tasks load one block at a time, for all
segments of a batch, so the test set may be of any size. Null texts have no words; items without words have no
windows. Rows keep their ids, null and repeated ones too; an item without an id counts under an
empty id. Empty tables give no rows, or no hits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.files import open_new, open_old, unique_name
from postlane.llm.words import ALNUM, bounded_batches, ragged, release, text_chunks, word_codes
from postlane.shared import new_folder, settle

WINDOW = 10
SLOP = 20
SEGMENT_BYTES = 320_000
BLOCK_WORDS = 250_000
SEGMENTS = "doc_ids array<long>, doc_ends array<int>, terms binary, ends array<int>, places binary"
HITS = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, n_near_items long"
)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of the index, settled in the shared folder."""
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0)
            for some, texts in text_chunks(batch.column(1), SEGMENT_BYTES):
                words = word_codes([text.translate(ALNUM) for text in texts])
                used, codes = np.unique(words.codes, return_inverse=True)
                places = np.argsort(codes, kind="stable")
                kind = np.uint16 if len(codes) <= 1 << 16 else np.uint32
                terms = words.terms.take(pa.array(used)).cast(pa.large_binary()).to_pylist()
                own = names.slice(some.start, some.stop - some.start)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([own.to_pylist()], pa.list_(pa.int64())),
                        pa.array([words.starts[1:]], pa.list_(pa.int32())),
                        pa.array([b"\n".join(terms)], pa.binary()),
                        pa.array([np.cumsum(np.bincount(codes, minlength=len(used)))], pa.list_(pa.int32())),
                        pa.array([places.astype(kind).tobytes()], pa.binary()),
                    ],
                    names=["doc_ids", "doc_ends", "terms", "ends", "places"],
                )

    return settle(rows.mapInArrow(build, SEGMENTS), "positional-index")


@dataclass
class Block:
    """Windows of some test items: numbers of their words, -1 beyond a short window's end."""

    terms: list[bytes]
    windows: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    item_ids: list[str]


def make_block(rows: list[tuple[int | None, list[bytes]]], width: int = WINDOW) -> Block:
    """The windows of (item, words) rows."""
    numbers: dict[bytes, int] = {}
    windows, items = [], []
    for at, (_, words) in enumerate(rows):
        codes = [numbers.setdefault(word, len(numbers)) for word in words]
        for begin in range(max(1, len(codes) - width + 1) if codes else 0):
            window = codes[begin : begin + width]
            windows.append(window + [-1] * (width - len(window)))
            items.append(at)
    table = np.array(windows, np.int64).reshape(-1, width)
    ids = ["" if item is None else str(item) for item, _ in rows]
    return Block(list(numbers), table, (table >= 0).sum(axis=1), np.array(items, np.int64), ids)


def runs_of_words(words: list[bytes], most: int, width: int = WINDOW) -> Iterator[list[bytes]]:
    """An item's words in runs of at most ``most``, which together hold each of its windows once."""
    step = max(1, most - width + 1)
    for at in range(0, max(1, len(words) - width + 1), step):
        yield words[at : at + step + width - 1]


def write_blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> list[str]:
    """Let tasks write the items' windows to the shared folder, in blocks of about ``block_words`` words."""
    rows = bounded_batches(items).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")
    )
    letters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    folder = new_folder(items.sparkSession, "test-windows")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int | None, list[bytes]]] = []

        def finish() -> pa.RecordBatch:
            path = unique_name(folder, "block", "bin")
            with open_new(path) as out:
                out.write(pickle.dumps(vars(make_block(waiting))))
            waiting.clear()
            return pa.RecordBatch.from_pydict({"path": [path]})

        held = 0
        for batch in batches:
            for some, texts in text_chunks(batch.column(1)):
                for item, text in zip(batch.column(0).to_pylist()[some], texts):
                    for words in runs_of_words(text.translate(ALNUM).split(), block_words):
                        if not words:
                            continue
                        if held and held + len(words) > block_words:
                            yield finish()
                            held = 0
                        waiting.append((item, words))
                        held += len(words)
        if held:
            yield finish()

    # Few tasks, so that a small test set is one block.
    tasks = max(1, -(-int(letters) // (6 * block_words)))
    paths = settle(rows.repartition(tasks).mapInArrow(write, "path string"), "test-blocks")
    return [row["path"] for row in paths.collect()]


def load_block(path: str) -> Block:
    with open_old(path) as source:
        return Block(**pickle.loads(source.read()))


@dataclass
class Segment:
    doc_ends: np.ndarray
    terms: pa.Array
    ends: np.ndarray
    places: np.ndarray
    size: int


def occurrences(segment: Segment, block: Block, slop: int) -> tuple[np.ndarray, ...]:
    """Windows and their starts that occur as phrases; windows and documents that do nearly."""
    none = np.zeros(0, np.int64)
    if not len(block.windows) or not segment.size:
        return none, none, none, none
    own = pc.fill_null(pc.index_in(pa.array(block.terms, pa.large_binary()), segment.terms), -1)
    own = np.asarray(own).astype(np.int64)
    begins = np.concatenate(([0], segment.ends[:-1]))
    counts = np.where(own >= 0, segment.ends[own] - begins[own], 0)
    rarity = np.where(block.windows >= 0, counts[block.windows], segment.size + 1)
    alive = np.flatnonzero(rarity.min(axis=1) > 0)
    if not len(alive):
        return none, none, none, none
    order = np.argsort(rarity[alive], axis=1, kind="stable")
    lists = own[block.windows[alive]]
    lengths = block.lengths[alive]
    # Postings stand in order of (word, place), so a list is a range of these numbers.
    keys = np.repeat(np.arange(len(segment.ends)), segment.ends - begins) * segment.size + segment.places
    first = lists[np.arange(len(alive)), order[:, 0]]
    amount = segment.ends[first] - begins[first]
    window = np.repeat(np.arange(len(alive)), amount)
    place = segment.places[ragged(begins[first], amount)].astype(np.int64)
    document = np.searchsorted(segment.doc_ends, place, "right")
    doc_begin = np.concatenate(([0], segment.doc_ends))[document]
    doc_end = segment.doc_ends[document]

    start = place - order[window, 0]
    good = (start >= doc_begin) & (start + lengths[window] <= doc_end)
    phrase, at = window[good], start[good]
    for step in range(1, order.shape[1]):
        slot = order[phrase, step]
        wanted = lists[phrase, slot] * segment.size + at + slot
        found = keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted
        kept = found | (step >= lengths[phrase])
        phrase, at = phrase[kept], at[kept]

    near, low, high, home = window, np.maximum(place - slop, doc_begin), np.minimum(place + slop, doc_end - 1), document
    for step in range(1, order.shape[1]):
        base = lists[near, order[near, step]] * segment.size
        where = np.minimum(np.searchsorted(keys, base + low), len(keys) - 1)
        found = (keys[where] >= base + low) & (keys[where] <= base + high)
        kept = found | (step >= lengths[near])
        near, low, high, home = near[kept], low[kept], high[kept], home[kept]
    return alive[phrase], at, alive[near], home


class Tally:
    """What the blocks seen so far find in one segment."""

    def __init__(self, doc_ids: list[int | None], segment: Segment):
        self.doc_ids, self.segment = doc_ids, segment
        self.edges = np.zeros(segment.size + 1, np.int64)
        self.items: list[set[str]] = [set() for _ in doc_ids]
        self.nearly: list[set[str]] = [set() for _ in doc_ids]

    @classmethod
    def of(cls, batch: pa.RecordBatch, at: int) -> Tally:
        size = {2: np.uint16, 4: np.uint32}
        ends = np.asarray(batch.column(3)[at].values).astype(np.int64)
        raw, total = batch.column(4)[at].as_py(), int(ends[-1]) if len(ends) else 0
        terms = batch.column(2)[at].as_py()
        segment = Segment(
            np.asarray(batch.column(1)[at].values).astype(np.int64),
            pa.array(terms.split(b"\n") if total else [], pa.large_binary()),
            ends,
            np.frombuffer(raw, size[len(raw) // total] if total else np.uint16),
            total,
        )
        return cls(batch.column(0)[at].as_py(), segment)

    def add(self, block: Block, slop: int) -> None:
        window, start, near, home = occurrences(self.segment, block, slop)
        np.add.at(self.edges, start, 1)
        np.add.at(self.edges, start + block.lengths[window], -1)
        holder = np.searchsorted(self.segment.doc_ends, start, "right")
        for found, document, item in ((self.items, holder, window), (self.nearly, home, near)):
            pairs = np.unique(np.stack([document, block.items[item]], axis=1), axis=0)
            for one, number in pairs.tolist():
                found[one].add(block.item_ids[number])

    def rows(self) -> pa.RecordBatch:
        ends = self.segment.doc_ends
        hit = np.concatenate(([0], np.cumsum(np.cumsum(self.edges[:-1]) > 0)))
        begins = np.concatenate(([0], ends[:-1]))
        n_hit = hit[ends] - hit[begins]
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(self.doc_ids, pa.int64()),
                "n_words": ends - begins,
                "n_hit": n_hit,
                "n_items": pa.array([len(found) for found in self.items], pa.int64()),
                "items_sha256": [hashlib.sha256(",".join(sorted(found)).encode()).hexdigest() for found in self.items],
                "contaminated": n_hit > 0,
                "n_near_items": pa.array([len(found) for found in self.nearly], pa.int64()),
            }
        )


def search_index(index: DataFrame, block_paths: list[str], slop: int = SLOP) -> DataFrame:
    """One row per document of the index, in terms of the test items whose windows occur there."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = load_block(block_paths[0]) if len(block_paths) == 1 else None
        for batch in batches:
            tallies = [Tally.of(batch, at) for at in range(batch.num_rows)]
            for path in block_paths:
                block = only or load_block(path)
                for tally in tallies:
                    tally.add(block, slop)
            for tally in tallies:
                yield tally.rows()
        release()

    return index.mapInArrow(search, HITS)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    slop: int = SLOP,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Index the documents, search all windows of all items, one row per document."""
    paths = write_blocks(items, item_id, item_text, block_words)
    return search_index(build_index(docs, doc_id, text), paths, slop)


def without_contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """The documents that hold no window of any item, with all their columns.

    Documents go by id: of rows that share an id, all go if one is hit. Rows without an id stay.
    """
    hit = contamination(docs, items, doc_id, text, **options).where("contaminated")
    hit = settle(hit.select(F.col("doc_id").alias("__hit_id")).dropna().distinct(), "contaminated")
    return docs.join(hit, F.col(doc_id).cast("long") == F.col("__hit_id"), "left_anti")
