"""Words of whole texts as integer codes, worked out per Arrow batch inside tasks."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

CHUNK_BYTES = 3_000_000
WORKER_STORE = "postlane_llm_worker_store"
BATCHES = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
}

# Upper case ASCII to lower case; ASCII that is neither a letter nor a digit becomes a space.
ALNUM = bytes(
    code + 32
    if 65 <= code <= 90
    else code
    if code >= 128 or 48 <= code <= 57 or 97 <= code <= 122
    else 32
    for code in range(256)
)
LOWER = bytes(code + 32 if 65 <= code <= 90 else code for code in range(256))


@dataclass
class Words:
    """Words of several texts: ``codes[starts[i]:starts[i + 1]]`` are those of text ``i``."""

    codes: np.ndarray
    starts: np.ndarray
    terms: pa.Array

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.starts)

    def text_of(self) -> np.ndarray:
        """For each word, the text that it stands in."""
        return np.repeat(np.arange(len(self.starts) - 1), self.counts)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column; null becomes empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def bounded_batches(df: DataFrame) -> DataFrame:
    """Let Spark hand rows to Python in Arrow batches of a few megabytes, whatever their texts."""
    for name, value in BATCHES.items():
        df.sparkSession.conf.set(name, value)
    return df


def release() -> None:
    """Give freed memory back, as Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def text_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES, keep_store: bool = False
) -> Iterator[tuple[slice, list[bytes]]]:
    """Runs of rows of about ``limit`` bytes with their texts; only one run is held at a time.

    What a worker remembers from task to task goes, unless the caller is who needs it.
    """
    if not keep_store:
        sys.modules.pop(WORKER_STORE, None)
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    begin = size = 0
    for at, more in enumerate(sizes):
        if size and size + more > limit:
            yield slice(begin, at), texts_of(column.slice(begin, at - begin))
            begin, size = at, 0
        size += more
    if begin < len(sizes):
        yield slice(begin, len(sizes)), texts_of(column.slice(begin))
    release()


def word_codes(texts: list[bytes]) -> Words:
    """Split at ASCII white space and number the different words."""
    split = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
    offsets = np.asarray(split.offsets)
    encoded = pc.dictionary_encode(split.flatten())
    codes = np.asarray(encoded.indices).astype(np.int64)
    empty = pc.index(encoded.dictionary, "").as_py()
    if empty >= 0:
        real = codes != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets - offsets[0]]
        codes = codes[real]
    return Words(codes, offsets - offsets[0], encoded.dictionary)


def sums_by_text(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of a value per word over each text."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[starts[1:]] - total[starts[:-1]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``start .. start + length - 1`` of every pair, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (splitmix64 finalizer)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def repeated_window_words(words: Words, width: int) -> np.ndarray:
    """Per text: words inside windows of ``width`` words that stand in it twice or more."""
    codes, starts = words.codes, words.starts
    n = len(codes)
    texts = len(starts) - 1
    if n < width:
        return np.zeros(texts, np.int64)
    text = words.text_of()
    first = np.arange(n - width + 1)
    first = first[starts[text[first] + 1] - first >= width]
    if not len(first):
        return np.zeros(texts, np.int64)
    spread = mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    key = mixed(text[first].astype(np.uint64) + np.uint64(1))
    for step in range(width):
        key = key * np.uint64(0x100000001B3) + spread[first + step]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    left, right = first[order[:-1][same]], first[order[1:][same]]
    equal = text[left] == text[right]
    for step in range(width):
        equal &= codes[left + step] == codes[right + step]
    if not equal.all():  # a collision of hashes: compare the windows themselves
        whole = np.stack([text[first], *(codes[first + step] for step in range(width))], axis=1)
        _, group, size = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
        twice = first[size[group.ravel()] > 1]
    else:
        twice = np.concatenate((left, right))
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + width, -1)
    return sums_by_text((np.cumsum(edges[:-1]) > 0).astype(np.int64), starts)
