"""Token ids of whole texts with a public BPE tokenizer.

The same words come again and again, so each worker encodes a different word once, with the
tokenizers library, and puts texts together from the words' ids. That is exact for tokenizers
that never join characters across white space; ``TextEncoder`` refuses others.

Known words are held in plain arrays and found by 128 bits of hash, so a batch of words is looked up at
once, without an object for each. When there are more than ``CACHE_WORDS``, the half that was used least goes.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa

from postlane.llm.words import WORKER_STORE, mixed, ragged, release, text_chunks, word_codes

# Bound of the words one Python worker remembers, about 50 bytes each; longer words are not remembered.
CACHE_WORDS = 300_000
LONGEST_WORD = 64
_PLAIN = re.compile(r"([A-Za-zß-öø-ÿÀ-ÖØ-Þ]+)([.,]?)")


def _worker_store() -> dict:
    """A store that outlives a task: functions arrive anew with every task, modules stay."""
    if WORKER_STORE not in sys.modules:
        module = types.ModuleType(WORKER_STORE)
        module.values = {}
        sys.modules[WORKER_STORE] = module
    return sys.modules[WORKER_STORE].values


def _byte_letters() -> list[str]:
    """Byte-level BPE shows printable Latin-1 bytes as they are and moves others above 255."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, moved = {code: chr(code) for code in kept}, 256
    for code in range(256):
        if code not in letters:
            letters[code] = chr(moved)
            moved += 1
    return [letters[code] for code in range(256)]


def term_hashes(terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each term (large strings), and its bytes; hashes of long ones mean nothing."""
    offsets = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
    data = terms.buffers()[2]
    whole = np.zeros((data.size if data else 0) + 16, np.uint8)
    if data:
        whole[: data.size] = np.frombuffer(data, np.uint8)
    # Eight bytes from any place on, as one number.
    eights = np.lib.stride_tricks.as_strided(whole[:8].view("<u8"), (len(whole) - 7,), (1,))
    lengths = np.diff(offsets)
    masks = np.array([(1 << (8 * size)) - 1 for size in range(9)], np.uint64)
    first = mixed(lengths.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    second = mixed(first + np.uint64(0x6A09E667F3BCC909))
    some = np.flatnonzero((lengths > 0) & (lengths <= LONGEST_WORD))
    at, left = offsets[:-1][some], lengths[some]
    while len(some):
        piece = eights[at] & masks[np.minimum(left, 8)]
        first[some] = mixed((first[some] ^ piece) * np.uint64(0xD6E8FEB86659FD93))
        second[some] = mixed((second[some] + piece) * np.uint64(0xA0761D6478BD642F))
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    return first, second, lengths


class WordTable:
    """Ids of known words: sorted hashes, and where each word's ids stand."""

    def __init__(self, limit: int = CACHE_WORDS):
        self.limit = limit
        self.key, self.check = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.uses = np.zeros(0, np.int32)
        self.ids = np.zeros(1 << 20, np.uint32)
        self.used = 0

    def __len__(self) -> int:
        return len(self.key)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The row of each word, or -1."""
        if not len(self.key):
            return np.full(len(key), -1)
        row = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[row] == key) & (self.check[row] == check), row, -1)

    def put(self, ids: list[int]) -> None:
        """Write ids behind the known ones; they stay until the next call, or for good if ``used`` moves on."""
        end = self.used + len(ids)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), end))
        self.ids[self.used : end] = ids

    def add(self, key: np.ndarray, check: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        order = np.argsort(key, kind="stable")
        order = order[np.concatenate((np.ones(min(1, len(key)), bool), np.diff(key[order]) != 0))]
        at = np.searchsorted(self.key, key[order])
        if len(self.key):  # two words with one key: the first one keeps it
            free = self.key[np.minimum(at, len(self.key) - 1)] != key[order]
            order, at = order[free], at[free]
        self.key = np.insert(self.key, at, key[order])
        self.check = np.insert(self.check, at, check[order])
        self.start = np.insert(self.start, at, start[order])
        self.size = np.insert(self.size, at, size[order])
        self.uses = np.insert(self.uses, at, 0)

    def shrink(self) -> None:
        """Keep the half of the words that was used most, when there are too many."""
        if len(self.key) <= self.limit:
            return
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: self.limit // 2])
        self.key, self.check, self.size = self.key[kept], self.check[kept], self.size[kept]
        self.uses = self.uses[kept] // 2
        ids = self.ids[ragged(self.start[kept], self.size.astype(np.int64))]
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size
        self.used = len(ids)
        self.ids = np.resize(ids, max(1 << 20, 2 * len(ids)))


class TextEncoder:
    """Encode texts with a tokenizer file, ``add_special_tokens=False``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        self.tokenizer = Tokenizer.from_file(path)
        parts = (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)
        steps = " ".join(part.__getstate__().decode() for part in parts if part is not None)
        if '"Split"' not in steps or "\\\\s\\\\p{L}" not in steps:
            raise ValueError(f"{path}: white space must separate tokens")
        self.lower = '"Lowercase"' in steps
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.known = WordTable()
        release()

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        """The worker's encoder for a file, kept from task to task."""
        store = _worker_store()
        if path not in store:
            store[path] = cls(path)
        return store[path]

    def _ids(self, word: str) -> list[int]:
        plain = _PLAIN.fullmatch(word) if self.lower else None
        if plain is None:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        body = plain[1].lower()
        if not body.isascii():
            letters = self.letters
            body = "".join([letters[code] for code in body.encode()])
        ids = [token.id for token in self.model.tokenize(body)]
        if plain[2]:
            ids += self._ids_of_mark(plain[2])
        return ids

    def _ids_of_mark(self, mark: str) -> list[int]:
        return [token.id for token in self.model.tokenize(mark)]

    def _found(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each term stand in the table's ids, and how many there are."""
        known = self.known
        known.shrink()
        key, check, lengths = term_hashes(terms)
        short = lengths <= LONGEST_WORD
        row = np.where(short, known.find(key, check), -1)
        hit = row >= 0
        known.uses[row[hit]] += 1
        start, size = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        start[hit], size[hit] = known.start[row[hit]], known.size[row[hit]]
        # Words not to be remembered come last, so that the next call writes over their ids.
        new = np.concatenate((np.flatnonzero(~hit & short), np.flatnonzero(~hit & ~short)))
        if len(new):
            ids = [self._ids(word) for word in terms.take(pa.array(new)).to_pylist()]
            size[new] = [len(one) for one in ids]
            start[new] = known.used + np.cumsum(size[new]) - size[new]
            known.put([number for one in ids for number in one])
            kept = new[short[new]]
            known.used += int(size[kept].sum())
            known.add(key[kept], check[kept], start[kept], size[kept])
        return start, size

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another (uint32), and where each text's ids start."""
        words = word_codes(texts)
        start, size = self._found(words.terms.cast(pa.large_string()))
        begin, lengths = start[words.codes], size[words.codes]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        return self.known.ids[ragged(begin, lengths)], ends[words.starts]

    def batches(self, column: pa.Array, limit: int = 400_000):
        """``(slice, ids, starts)`` of runs of rows, so that memory stays bounded."""
        for part, texts in text_chunks(column, limit, keep_store=True):
            yield (part, *self.encode(texts))
