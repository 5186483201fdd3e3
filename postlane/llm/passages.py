"""Passages that repeat, exactly or nearly, across documents, by collinear chaining.

Seeds are hashes of five neighbouring words; of each run of twelve neighbouring seeds at least the
smallest hash is kept (minimizers), so 16 equal words always share a seed. Five times the same word
is no seed: a word repeated over and over is no passage. Every occurrence of a
seed is matched with one in the smallest document that has it (the n-th with the n-th there, or else
the first), which makes a number of matches linear in the copies of a passage. Matches of two documents are merged into runs on one
diagonal, and runs are chained in order of both texts: a chain earns its words and pays for the gap
and for the shift between runs, and the best chain before each run is found through a Fenwick tree of
prefix maxima. The words between the runs of a chain are aligned, its ends are extended, and
what has at least ``MIN_WORDS`` words, of which ``SIMILARITY`` are matched, is a passage. A chain that is
none is split at its dearest gap, and its parts are tried in the same way, down to equal words.

Occurrences that no passage explains, by holding them or ending right beside them, are matched again
among themselves: each seed, and 2, 4 and 8 neighbouring seeds as one key, with the smallest document that
has them. So two documents meet on a passage of stock lines too, whose lines by themselves occur in other
documents. Then the documents that came first go, and the rest meet again, ``ROUNDS`` times.

What is in no passage of its document by then is compared without regard to who came first, with every smaller
document that has seeds in common which a chain of a passage's span can begin with: two that chain at once
and are as far apart as a passage needs, or two that chain and a third one as far away (``chain_starts``). One seed
alone, however common, makes no two documents meet. The number of such documents is quadratic where these
seeds are common and nothing explains them, e.g. in a stock paragraph too short for a passage; they are
dealt over tasks in blocks. Documents of fewer words than a passage are left out there, and runs that reach too few words are
told by the words beside them, before whole texts are joined.

Words are what stands between ASCII white space, in lower case as far as ASCII goes. A null text has no words. Rows without an id, or
whose id appears more than once with other texts, cannot be addressed: the former are not compared,
of the latter one text is. Repeated rows of one id are one document. Empty tables give no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.llm.words import LOWER, bounded_batches, mixed, release, text_chunks, word_codes
from postlane.shared import Scratch, forget, gate, scratch, settle

K = 5
WINDOW = 12
MIN_WORDS = 50
SIMILARITY = 0.8
MAX_GAP = 60
GAP_COST, SHIFT_COST = 0.1, 0.5
DROP = 8
# Words beside a run that tell whether it goes on.
BESIDE = 16
_SEED = 0x5EED
LONGER = (2, 4, 8)
ROUNDS = 4
# Documents that share seeds and that one task compares with all of the others.
PER_BLOCK = 1_000
# Words of 64 bits in the filter of documents whose words are wanted.
FILTER_WORDS = 1 << 18
SEEDS = "h long, doc_id long, pos int, nth int"
STARTS = "key long, doc_id long, apart int"
KEYS = "h long, base long, doc_id long, pos int, nth int, span int, low long"
RUN = "struct<begin: int, other: int, length: int>"
CHAINS = f"doc_id long, rep long, chains array<array<{RUN}>>"
PASSAGES = (
    "doc_id long, start_word long, end_word long, source_doc_id long, source_start_word long, "
    "source_end_word long, n_matched long, similarity double"
)


def _term_hashes(terms: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    values = [digest(term, _SEED) for term in terms.cast(pa.large_binary()).to_pylist()]
    return np.array(values, np.uint64)


def _smallest_of(values: np.ndarray, width: int, pick) -> np.ndarray:
    """Minimum (or maximum) over ``width`` neighbours, beginning at each place."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def seeds_of(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and place of the seeds of several texts, given the hashes of their words."""
    n = len(hashes)
    none = np.zeros(0, np.int64)
    if n < K:
        return none.astype(np.uint64), none, none
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    key = np.zeros(n - K + 1, np.uint64)
    for step in range(K):
        key = key * np.uint64(0x9E3779B97F4A7C15) + hashes[step : n - K + 1 + step]
    key = mixed(key)
    whole = text[: n - K + 1] == text[K - 1 :]
    neighbours = [hashes[step : n - K + 1 + step] for step in range(K)]
    whole &= np.any([one != neighbours[0] for one in neighbours[1:]], axis=0)
    largest = np.uint64(2**64 - 1)
    ranked = np.where(whole, key, largest)
    pad = np.full(WINDOW - 1, largest, np.uint64)
    least = _smallest_of(np.concatenate([pad, ranked, pad]), WINDOW, np.minimum)
    # A seed stays if it is the least of some window that holds it.
    best = _smallest_of(least, WINDOW, np.maximum)
    kept = np.flatnonzero(whole & (best == ranked))
    return key[kept], text[kept], kept - starts[text[kept]]


def repeats_before(key: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each key, how often its text has it at earlier places."""
    order = np.lexsort((place, key, text))
    first = np.ones(len(key), bool)
    first[1:] = (key[order[1:]] != key[order[:-1]]) | (text[order[1:]] != text[order[:-1]])
    at = np.arange(len(key))
    nth = np.empty(len(key), np.int32)
    nth[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return nth


def find_seeds(docs: DataFrame) -> DataFrame:
    """Seeds of all documents (doc_id, text); ``nth`` counts repeats inside a document, from 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.asarray(batch.column(0)).astype(np.int64)
            for some, texts in text_chunks(batch.column(1)):
                words = word_codes([text.translate(LOWER) for text in texts])
                key, text, place = seeds_of(_term_hashes(words.terms)[words.codes], words.starts)
                nth = repeats_before(key, text, place)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        pa.array(names[some][text]),
                        pa.array(place.astype(np.int32)),
                        pa.array(nth),
                    ],
                    names=["h", "doc_id", "pos", "nth"],
                )

    return docs.mapInArrow(work, SEEDS)


def longer_seeds(shared: DataFrame) -> DataFrame:
    """The shared seeds, and rows of ``LONGER`` neighbouring ones as further keys.

    A row's hash takes in the distances of its seeds, ``span`` is the distance of the outermost;
    ``low`` is the smallest of the first documents of its seeds.
    """
    one = F.struct("pos", "h", "base", "nth", "rep")
    whole = shared.groupBy("doc_id").agg(F.collect_set(one).alias("seeds"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = np.diff(np.asarray(lists.offsets))
            text = np.repeat(np.arange(batch.num_rows), sizes)
            found = lists.flatten()
            pos, h, base, nth, rep = (np.asarray(found.field(k)) for k in range(5))
            order = np.lexsort((h, pos, text))
            text, pos, h, base, nth, rep = (part[order] for part in (text, pos, h, base, nth, rep))
            names = np.asarray(batch.column(0))
            zero = np.zeros(len(pos), np.int32)
            parts = [(h, base, text, pos, nth, zero, rep)]
            n = len(pos)
            near = np.zeros(n, bool)  # close to the seed before it
            near[1:] = (text[1:] == text[:-1]) & (pos[1:] > pos[:-1]) & (pos[1:] - pos[:-1] <= MAX_GAP + K)
            chained = np.cumsum(~near)
            for width in LONGER:
                if n < width:
                    break
                m = n - width + 1
                key, low = np.full(m, width, np.uint64), rep[:m]
                for step in range(width):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + h[step : m + step].view(np.uint64))
                    key = key + (pos[step : m + step] - pos[:m]).astype(np.uint64)
                    low = np.minimum(low, rep[step : m + step])
                kept = np.flatnonzero(chained[:m] == chained[width - 1 :])
                key = mixed(key[kept]).view(np.int64)
                span = (pos[width - 1 :] - pos[:m])[kept]
                repeats = repeats_before(key, text[kept], pos[kept])
                parts.append((key, key, text[kept], pos[kept], repeats, span, low[kept]))
            h, base, text, pos, nth, span, low = (np.concatenate(column) for column in zip(*parts))
            columns = (h, base, names[text], pos, nth, span, low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in columns], names=["h", "base", "doc_id", "pos", "nth", "span", "low"]
            )
        release()

    return whole.mapInArrow(work, KEYS)


class PrefixMaxima:
    """Fenwick tree: the best (value, owner) at places up to a bound."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def put(self, place: int, value: float, owner: int) -> None:
        at = place + 1
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, owner)
            at += at & -at

    def up_to(self, place: int) -> tuple[float, int]:
        found, at = (float("-inf"), -1), place + 1
        while at > 0:
            if self.best[at][0] > found[0]:
                found = self.best[at]
            at -= at & -at
        return found


def merge_runs(
    pos: np.ndarray, rep_pos: np.ndarray, span: np.ndarray | int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (begin, begin in the other text, length) of matches that touch on one diagonal."""
    order = np.lexsort((pos, pos - rep_pos))
    last = (pos + span)[order]
    pos, rep_pos = pos[order], rep_pos[order]
    diagonal = pos - rep_pos
    group = np.cumsum(np.concatenate(([0], diagonal[1:] != diagonal[:-1])))
    wide = int(last.max()) + 1
    last = np.maximum.accumulate(last + group * wide) - group * wide
    new = np.ones(len(pos), bool)
    new[1:] = (diagonal[1:] != diagonal[:-1]) | (pos[1:] - last[:-1] > WINDOW + K)
    first = np.flatnonzero(new)
    end = np.concatenate((first[1:], [len(pos)])) - 1
    return pos[first], rep_pos[first], last[end] - pos[first] + K


def chain_runs(begin: np.ndarray, other: np.ndarray, length: np.ndarray) -> list[list[int]]:
    """Disjoint chains of runs, each in order of both texts.

    A run's score is its length plus the best predecessor's, less ``GAP_COST`` per word between
    them in both texts. With ``score + GAP_COST * (end + other end)`` stored, the best
    predecessor that ends before a run in the other text is a prefix maximum. Gaps beyond
    ``MAX_GAP`` and strong shifts begin a new chain.
    """
    n = len(begin)
    order = np.lexsort((other, begin))
    ends, other_ends = begin + length, other + length
    places = np.unique(other_ends)
    tree = PrefixMaxima(len(places))
    score, before = np.zeros(n), np.full(n, -1)
    waiting = sorted(range(n), key=lambda run: (ends[run], run))
    joined = 0
    slack = K - 1  # a wrong word leaves neighbouring runs that overlap by less than a seed
    for run in order.tolist():
        while joined < n and ends[waiting[joined]] <= begin[run] + slack:
            ready = waiting[joined]
            joined += 1
            if ready == run or score[ready] == 0:
                continue
            value = score[ready] + GAP_COST * (ends[ready] + other_ends[ready])
            tree.put(int(np.searchsorted(places, other_ends[ready])), value, ready)
        score[run] = length[run]
        value, last = tree.up_to(int(np.searchsorted(places, other[run] + slack, "right")) - 1)
        if last >= 0:
            gap, other_gap = begin[run] - ends[last], other[run] - other_ends[last]
            gain = value - GAP_COST * (begin[run] + other[run]) - SHIFT_COST * abs(gap - other_gap)
            if gain > 0 and max(gap, other_gap) <= MAX_GAP:
                score[run] += gain
                before[run] = last
    used = np.zeros(n, bool)
    chains = []
    for run in np.lexsort((begin, -score)).tolist():
        chain = []
        while run >= 0 and not used[run]:
            used[run] = True
            chain.append(run)
            run = int(before[run])
        if chain:
            chains.append(chain[::-1])
    return chains


def find_chains(pairs: DataFrame, least: int) -> DataFrame:
    """Per pair of documents, the chains that span at least ``least`` words, best first."""
    run_kind = pa.struct([(name, pa.int32()) for name in ("begin", "other", "length")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, reps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for at in range(batch.num_rows):
                found = batch.column(2)[at].values
                pos = np.asarray(found.field(0)).astype(np.int64)
                rep_pos = np.asarray(found.field(1)).astype(np.int64)
                runs = merge_runs(pos, rep_pos, np.asarray(found.field(2)).astype(np.int64))
                begin, _, length = runs
                chains = [
                    chain
                    for chain in chain_runs(*runs)
                    if begin[chain[-1]] + length[chain[-1]] - begin[chain[0]] >= least
                ]
                if chains:
                    names = ("begin", "other", "length")
                    nested = [
                        [dict(zip(names, one)) for one in zip(*(part[chain].tolist() for part in runs))]
                        for chain in chains
                    ]
                    rows.append((docs[at], reps[at], nested))
            columns = list(zip(*rows)) or [[], [], []]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.list_(run_kind))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                names=["doc_id", "rep", "chains"],
            )
        release()

    return pairs.mapInArrow(work, CHAINS)


def aligned(left: np.ndarray, right: np.ndarray) -> int:
    """Words matched in order: the longest common subsequence of two short runs of words."""
    if not len(left) or not len(right):
        return 0
    if len(left) == len(right):
        same = int((left == right).sum())
        if same >= len(left) - 1:
            return same
    row = np.zeros(len(right) + 1, np.int64)
    for word in left:
        hit = np.where(right == word, row[:-1] + 1, 0)
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], hit))
    return int(row[-1])


def extension(left: np.ndarray, right: np.ndarray) -> int:
    """Words by which two texts go on alike: best sum of matches (+1) and mismatches (-2)."""
    n = min(len(left), len(right))
    at, best, place, total = 0, 0, 0, 0
    while at < n:  # in pieces, as most extensions are short
        piece = np.where(left[at : min(n, at + 256)] == right[at : min(n, at + 256)], 1, -2)
        sums = total + np.cumsum(piece)
        peak = np.maximum.accumulate(np.maximum(sums, best))
        stop = np.flatnonzero(peak - sums > DROP)
        seen = sums[: stop[0]] if len(stop) else sums
        if len(seen) and seen.max() > best:
            best, place = int(seen.max()), at + int(seen.argmax()) + 1
        if len(stop):
            break
        total, at = int(sums[-1]), at + len(piece)
    return place


def align_chain(x: np.ndarray, y: np.ndarray, begin: list[int], other: list[int], length: list[int]):
    """(start, end, other start, other end, matched words) of a chain with its ends extended."""
    matched = end = other_end = 0
    first, other_first = begin[0], other[0]
    back = extension(x[:first][::-1], y[:other_first][::-1])
    start, other_start = first - back, other_first - back
    matched += aligned(x[start:first], y[other_start:other_first])
    for at, (a, b, n) in enumerate(zip(begin, other, length)):
        if at:
            overlap = max(0, end - a, other_end - b)
            a, b, n = a + overlap, b + overlap, max(0, n - overlap)
            matched += aligned(x[end:a], y[other_end:b])
        run, other_run = x[a : a + n], y[b : b + n]
        m = min(len(run), len(other_run))
        matched += int((run[:m] == other_run[:m]).sum())
        end, other_end = max(end, a + n), max(other_end, b + n)
    ahead = extension(x[end:], y[other_end:])
    matched += aligned(x[end : end + ahead], y[other_end : other_end + ahead])
    return start, end + ahead, other_start, other_end + ahead, matched


def costliest_gap(chain: list[tuple[int, int, int]]) -> int:
    """Number of the run (begin, begin in the other text, length) that the dearest gap stands before."""
    costs = []
    for (a, b, n), (c, d, _) in zip(chain, chain[1:]):
        gap, other_gap = c - a - n, d - b - n
        costs.append(GAP_COST * (gap + other_gap) + SHIFT_COST * abs(gap - other_gap))
    return 1 + int(np.argmax(costs))


def equal_parts(x: np.ndarray, y: np.ndarray, begin: int, other: int, length: int) -> list[tuple[int, int, int]]:
    """The stretches of a run whose words are equal, as runs."""
    n = min(length, len(x) - begin, len(y) - other)
    same = np.zeros(n + 2, np.int8)
    same[1:-1] = x[begin : begin + n] == y[other : other + n]
    step = np.diff(same)
    edges = zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())
    return [(begin + a, other + a, b - a) for a, b in edges]


def _words_of(chains: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, x) and (rep, y): the words of a document go only where it is needed, as the later one, the smaller one or both."""
    mine = likely_named(words, chains.select("doc_id")).select("doc_id", F.col("words").alias("x"))
    theirs = likely_named(words, chains.select(F.col("rep").alias("doc_id")))
    return mine, theirs.select(F.col("doc_id").alias("rep"), F.col("words").alias("y"))


def reach(run: int, left: np.ndarray, other_left: np.ndarray, right: np.ndarray, other_right: np.ndarray) -> int | None:
    """Words of a run with its ends extended, given up to ``BESIDE`` words beside them; None where it may go on further."""
    total = run
    for x, y in ((left[::-1], other_left[::-1]), (right, other_right)):
        if len(x) == len(y) == BESIDE:  # equal words behind them show whether the extension has ended before
            equal = np.zeros(2 * DROP, x.dtype)
            x, y = np.concatenate([x, equal]), np.concatenate([y, equal])
        words = extension(x, y)
        if words > BESIDE:
            return None
        total += words
    return total


def far_reaching(chains: DataFrame, words: DataFrame, min_words: int) -> DataFrame:
    """The pairs of ``chains`` without those that have only runs too short for a passage, alone and with their ends extended.

    The parts of such a run reach no further than it does. So pairs that share no more than a stock paragraph do
    not take their whole texts along; only words beside the runs are compared for them.
    """
    mine, theirs = _words_of(chains, words)
    short = F.forall("chains", lambda chain: (F.size(chain) == 1) & (F.get(chain, F.lit(0))["length"] < min_words))
    runs = chains.where(short).select("doc_id", "rep", F.explode("chains").alias("chain"))
    runs = runs.selectExpr("doc_id", "rep", "chain[0].begin AS begin", "chain[0].other AS other", "chain[0].length AS length")
    beside = lambda text, at: (
        f"substring({text}, 4 * greatest({at} - {BESIDE}, 0) + 1, 4 * least({at}, {BESIDE})) AS {text}_left",
        f"substring({text}, 4 * ({at} + length) + 1, {4 * BESIDE}) AS {text}_right",
    )
    runs = runs.join(mine, "doc_id").selectExpr("doc_id", "rep", "other", "length", *beside("x", "begin"))
    runs = runs.join(theirs, "rep").selectExpr("doc_id", "rep", "length", "x_left", "x_right", *beside("y", "other"))
    runs = runs.select("doc_id", "rep", "length", "x_left", "y_left", "x_right", "y_right")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at, (length, *sides) in enumerate(zip(*(column.to_pylist() for column in batch.columns[2:]))):
                words = reach(length, *(np.frombuffer(side, "<u4") for side in sides))
                if words is None or words >= min_words:
                    kept.append(at)
            yield batch.select(["doc_id", "rep"]).take(pa.array(kept, pa.int64()))
        release()

    far = settle(runs.mapInArrow(work, "doc_id long, rep long").distinct(), "far-reaching")
    return settle(chains.where(~short).unionByName(chains.join(far, ["doc_id", "rep"], "left_semi")), "chains")


def align_chains(chains: DataFrame, words: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Passages among the chains; ``words`` holds the word hashes of the documents they name."""
    mine, theirs = _words_of(chains, words)
    joined = chains.join(mine, "doc_id").join(theirs, "rep")
    joined = joined.select("doc_id", "rep", "chains", "x", "y")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.strip().split(" ")[0] for part in PASSAGES.split(",")]
        kinds = [pa.int64()] * 7 + [pa.float64()]
        for batch in batches:
            rows = []
            for doc, rep, chains, x, y in zip(*(column.to_pylist() for column in batch.columns)):
                x, y = np.frombuffer(x, "<u4"), np.frombuffer(y, "<u4")
                done: list[tuple[int, int, int, int]] = []
                if len(x) == len(y) >= min_words and (x == y).all():
                    rows.append((doc, 0, len(x), rep, 0, len(x), len(x), 1.0))
                    continue
                waiting = [[tuple(run[k] for k in ("begin", "other", "length")) for run in chain] for chain in chains[::-1]]
                while waiting:
                    chain = waiting.pop()
                    begin, other, length = (list(column) for column in zip(*chain))
                    inside = (begin[0], begin[-1] + length[-1], other[0], other[-1] + length[-1])
                    if any(a <= inside[0] and inside[1] <= b and c <= inside[2] and inside[3] <= d for a, b, c, d in done):
                        continue  # an extension has reached it
                    start, end, first, last, matched = align_chain(x, y, begin, other, length)
                    share = matched / max(end - start, last - first)
                    if min(end - start, last - first) >= min_words and share >= similarity:
                        rows.append((doc, start, end, rep, first, last, matched, share))
                        done.append((start, end, first, last))
                    elif len(chain) > 1:  # a gap may be what is unlike: its sides are tried alone
                        cut = costliest_gap(chain)
                        waiting += [chain[cut:], chain[:cut]]
                    elif len(parts := equal_parts(x, y, *chain[0])) > 1:
                        waiting.append(parts)
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names
            )
        release()

    return joined.mapInArrow(work, PASSAGES)


def word_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, words): 32 bits of each word's hash, a row for each of ``docs``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, texts in text_chunks(batch.column(1)):
                words = word_codes([text.translate(LOWER) for text in texts])
                codes = (_term_hashes(words.terms) & np.uint64(0xFFFFFFFF)).astype("<u4")[words.codes]
                edges = words.starts.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(some.start, some.stop - some.start),
                        pa.array([codes[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                    ],
                    names=["doc_id", "words"],
                )

    return docs.mapInArrow(work, "doc_id long, words binary")


def likely_named(rows: DataFrame, named: DataFrame, by: str = "doc_id") -> DataFrame:
    """The rows whose ``by`` is in ``named``, and some others, without a shuffle of their texts.

    The values of ``named`` set bits in a table of at most ``FILTER_WORDS`` rows, which is broadcast.
    """
    h = F.xxhash64(by)
    slot = F.pmod(h, F.lit(FILTER_WORDS)).cast("int").alias("__slot")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({by}) div {FILTER_WORDS}, 64) AS int))").alias("__bit")
    bits = named.select(slot, bit).groupBy("__slot").agg(F.bit_or("__bit").alias("__bits"))
    likely = rows.select("*", slot, bit).join(F.broadcast(bits), "__slot").where("(__bits & __bit) <> 0")
    return likely.select(*rows.columns)


def first_holders(seeds: DataFrame) -> DataFrame:
    """(h, rep): the smallest document of each seed that several documents hold.

    Settled, as a join of two plain shuffles can be split where one seed is very common.
    """
    owners = seeds.groupBy("h").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("most"))
    return settle(owners.where("rep < most").select("h", "rep"), "first-holders")


def linked(apart: Column, other: Column) -> Column:
    """Whether a chain may go from its first seed to one ``apart`` words on, ``other`` words in the other text, as its second.

    Either both are of one run, or the first is a run of its own and pays for the gap and the shift.
    """
    cost = GAP_COST * (apart + other - 2 * K) + SHIFT_COST * F.abs(apart - other)
    return (apart == other) & (apart <= WINDOW + K) | (cost <= K + 1e-6)


def chain_starts(seeds: DataFrame, link: int, nearest: int, furthest: int, close: int) -> DataFrame:
    """(key, doc_id, apart): seeds of a document that a chain may begin with, ``apart`` being the distance of the first two.

    These are two seeds from ``nearest`` to ``link`` words apart, or one seed, a second up to ``close`` words on and a third
    from ``nearest`` to ``furthest`` words on. The key takes in the hashes of all of them.
    """
    whole = seeds.groupBy("doc_id").agg(F.collect_set(F.struct("pos", "h")).alias("seeds"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            text = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(lists.offsets)))
            found = lists.flatten()
            pos, h = np.asarray(found.field(0)).astype(np.int64), np.asarray(found.field(1))
            order = np.lexsort((h, pos, text))
            text, pos, h = text[order], pos[order], h[order].view(np.uint64)
            begin = np.arange(len(pos))
            names, parts = np.asarray(batch.column(0)), []

            def later(at: np.ndarray, first: np.ndarray, furthest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
                """Numbers of rows, and of the seeds that stand after theirs and not too far from their first, step by step."""
                rows, step = np.arange(len(at)), 0
                while len(rows):
                    step += 1
                    rows = rows[at[rows] + step < len(pos)]
                    to = at[rows] + step
                    near = (text[to] == text[first[rows]]) & (pos[to] - pos[first[rows]] <= furthest)
                    rows, to = rows[near], to[near]
                    ahead = pos[to] > pos[at[rows]]
                    yield rows[ahead], to[ahead]

            for first, second in later(begin, begin, link):
                apart = pos[second] - pos[first]
                key = mixed(h[first] * np.uint64(0x9E3779B97F4A7C15) + h[second])
                far = apart >= nearest
                parts.append((mixed(key[far]), text[first[far]], apart[far]))
                first, second, key, apart = (part[apart <= close] for part in (first, second, key, apart))
                for rows, third in later(second, first, furthest):
                    far = pos[third] - pos[first[rows]] >= nearest
                    rows, third = rows[far], third[far]
                    parts.append((mixed(key[rows] + h[third]), text[first[rows]], apart[rows]))
            if parts:
                key, text, apart = (np.concatenate(column) for column in zip(*parts))
                order = np.lexsort((apart, key, text))
                key, text, apart = key[order], text[order], apart[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (apart[1:] != apart[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[new].view(np.int64)), pa.array(names[text[new]]), pa.array(apart[new].astype(np.int32))],
                    names=["key", "doc_id", "apart"],
                )
        release()

    return whole.mapInArrow(work, STARTS)


def later_and_earlier(later: DataFrame, earlier: DataFrame, least: int) -> DataFrame:
    """(doc_id, rep): every document of ``later`` with each smaller one of ``earlier`` that a passage of chained seeds may join.

    A chain spans ``least`` words and has no gap beyond ``MAX_GAP``, so the first of its seeds that is ``least``
    from its beginning is not much further away; in the other document it is at most twice as far. Either that seed is the
    chain's second, or the second stands before it, and the first has to pay for the way to the second. The
    documents that share such seeds are dealt into blocks, each of which meets all of the earlier ones.
    """
    near, far = least - K, least + MAX_GAP
    # The furthest that one seed pays for, where both texts have the same gap.
    link = int(K + K / (2 * GAP_COST))
    # Where the first two are as far apart as that, the two are a key, and no third one is needed.
    later = settle(chain_starts(later, link, near, far, near - 1), "chain-starts")
    earlier = chain_starts(earlier, link, 1, 2 * far, link)
    blocks = F.ceil(F.count(F.lit(1)) / PER_BLOCK).cast("int")
    held = settle(later.groupBy("key").agg(blocks.alias("blocks"), F.max("doc_id").alias("most")), "chain-starts-held")
    earlier = settle(earlier.join(held, "key").where("doc_id < most"), "earlier")
    later = later.join(held, "key").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    earlier = earlier.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    later = later.select("key", "block", "doc_id", "apart")
    earlier = earlier.select("key", "block", F.col("doc_id").alias("rep"), F.col("apart").alias("other"))
    met = later.join(earlier, ["key", "block"]).where((F.col("rep") < F.col("doc_id")) & linked(F.col("apart"), F.col("other")))
    return settle(met.select("doc_id", "rep").distinct(), "later-and-earlier")


def all_matches(later: DataFrame, seeds: DataFrame, least: int, short: DataFrame) -> DataFrame:
    """Matches (doc_id, rep, pos, nth, span, places, first_pos) of all documents that may have a passage in common.

    ``later`` are the seeds to be matched, ``seeds`` those of all documents. The documents (doc_id) of ``short`` have
    fewer words than a passage and meet none.
    """
    later = settle(later.join(short, "doc_id", "left_anti"), "later-seeds")
    # A plain join: a left semi join would be pushed below the filter, and all seeds be shuffled.
    earlier = settle(likely_named(seeds, later.select("h"), by="h").join(later.select("h").distinct(), "h"), "earlier-seeds")
    met = later_and_earlier(later, earlier.join(short, "doc_id", "left_anti"), least)
    held = places_of(earlier, ["doc_id", "h"]).withColumnRenamed("doc_id", "rep")
    return met.join(later.select("h", "doc_id", "pos", "nth", F.lit(0).alias("span")), "doc_id").join(held, ["rep", "h"])


def places_of(seeds: DataFrame, by: list[str]) -> DataFrame:
    """(places, first_pos) per ``by``: where a seed stands in a document, the n-th at index n.

    An array is no longer than that one document; what has been explained is null in it.
    """
    held = F.sort_array(F.collect_set(F.struct("nth", "pos")))
    heads = seeds.groupBy(*by).agg(held.alias("held"))
    before = lambda i: F.when(i > 0, F.get("held", i - 1)["nth"]).otherwise(-1)
    heads = heads.withColumn("held", F.filter("held", lambda one, i: one["nth"] > before(i)))
    holes = lambda one, i: F.array_repeat(F.lit(None).cast("int"), one["nth"] - before(i) - 1)
    filled = F.flatten(F.transform("held", lambda one, i: F.concat(holes(one, i), F.array(one["pos"]))))
    return settle(heads.select(*by, filled.alias("places"), F.get("held", F.lit(0))["pos"].alias("first_pos")), "first-places")


def unexplained(seeds: DataFrame, passages: DataFrame) -> DataFrame:
    """The seeds that are not in or right beside a passage; ``at_source`` tells which are where a passage stood first."""
    spans = passages.selectExpr("doc_id", "struct(start_word AS a, end_word AS b, false AS source) AS span").unionByName(
        passages.selectExpr(
            "source_doc_id AS doc_id", "struct(source_start_word AS a, source_end_word AS b, true AS source) AS span"
        )
    )
    spans = spans.distinct().groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    inside = lambda span: (F.col("pos") >= span["a"] - WINDOW) & (F.col("pos") <= span["b"] + WINDOW)
    own = F.exists("spans", lambda span: inside(span) & ~span["source"])
    at_source = F.exists("spans", lambda span: inside(span) & span["source"])
    left = seeds.join(spans, "doc_id", "left").where(~F.coalesce(own, F.lit(False)))
    return left.withColumn("at_source", F.coalesce(at_source, F.lit(False))).drop("spans")


def short_documents(rows: DataFrame, min_words: int) -> DataFrame:
    """(doc_id): documents of fewer than ``min_words`` words."""
    enough = F.col("text").rlike(r"^(?:[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++){%d}" % max(1, min_words))
    return rows.where(~F.coalesce(enough, F.lit(False))).select("doc_id")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text).cast("string"))


def one_text_each(rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Rows (doc_id, text) with one text for each id, and which one that is where an id has several rows.

    The second table, (doc_id, text_hash), is None where no id comes twice. Of the texts of an id the one with the smallest
    hash is taken; they are merged within each task first.
    """
    twice = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    twice = settle(twice, "repeated-ids")
    if twice.isEmpty():
        return rows, None
    several = rows.join(twice, "doc_id", "left_semi")
    chosen = several.groupBy("doc_id").agg(F.min_by("text", text_hash("text")).alias("text"))
    chosen = settle(chosen, "one-text-each")
    single = rows.join(twice, "doc_id", "left_anti")
    return single.unionByName(chosen), chosen.select("doc_id", text_hash("text").alias("text_hash"))


def repeated_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    min_words: int = MIN_WORDS, similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per passage of a document that another document, with a smaller id, holds too.

    Words are counted from 0, ``end_word`` is the one after the last.
    """
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    ).where("doc_id is not null")
    with scratch() as outer:
        found = _passage_rounds(one_text_each(rows)[0], min_words, similarity, outer)
    if not found:
        return rows.sparkSession.createDataFrame([], PASSAGES)
    return reduce(DataFrame.unionByName, found)


def _passage_rounds(rows: DataFrame, min_words: int, similarity: float, outer: Scratch) -> list[DataFrame]:
    """The passages of every round, settled and kept; what a round alone needs goes at its end."""
    seeds = settle(find_seeds(rows), "seeds")
    # Of equal words, the outermost seeds stand less than a window from both ends.
    least = max(K + 1, min_words - 2 * (WINDOW + 2))
    found, afterwards, every, later = [], [], None, None
    for number in range(ROUNDS + 1):
        with scratch() as scope:
            shared = seeds.join(first_holders(seeds), "h").select("h", F.col("h").alias("base"), "doc_id", "pos", "nth", "rep")
            shared = settle(shared, "shared-seeds")
            if shared.isEmpty():
                break
            if number:
                keys = settle(longer_seeds(shared), "keys")
                shared = settle(keys.join(first_holders(keys), "h"), "shared-keys")
            else:
                every = scope.keep(shared)
                shared = shared.selectExpr("*", "0 AS span", "rep AS low")
            places = places_of(shared.where("doc_id = rep"), ["h"])
            matches = shared.where("doc_id <> rep and (span = 0 or rep <> low)").join(places, "h")
            passages = _matched_passages(matches, rows, min_words, similarity, least)
            rest = shared.where("span = 0 and doc_id <> rep" if number else "span = 0")
            rest = rest.select(F.col("base").alias("h"), "doc_id", "pos", "nth", "rep")
            if passages is not None:
                found.append(outer.keep(scope.keep(passages)))
                rest = unexplained(rest, passages)
            else:
                rest = rest.withColumn("at_source", F.lit(False))
            if number:
                afterwards += found[-1:] if passages is not None else []
                left = scope.keep(settle(rest.where("not at_source").select("h", "doc_id", "pos", "nth"), "unexplained"))
            else:  # what stands at a source is compared in the end, but not in the rounds
                later = scope.keep(settle(rest.where("not at_source or doc_id <> rep"), "unexplained"))
                left = later.where("not at_source").select("h", "doc_id", "pos", "nth")
        forget(seeds)
        seeds = left
    if every is None:
        return found
    with scratch() as scope:
        later = later.where("doc_id <> rep").drop("at_source")
        if afterwards:
            later = unexplained(later, reduce(DataFrame.unionByName, afterwards))
        later = later.select("h", "doc_id", "pos", "nth")
        short = settle(short_documents(rows, min_words), "short-documents")
        matches = all_matches(later, every, least, short)
        passages = _matched_passages(matches, rows, min_words, similarity, least, crowded=True)
        if passages is not None:
            found.append(outer.keep(scope.keep(passages)))
    return found


def _matched_passages(
    matches: DataFrame, rows: DataFrame, min_words: int, similarity: float, least: int, crowded: bool = False
) -> DataFrame | None:
    """The passages that matches make, settled; None where there is no chain at all.

    In ``crowded`` ones many documents share short runs, which are looked at before whole texts are joined.
    """
    # The n-th occurrence goes to the n-th one there, or else to the first.
    matches = matches.withColumn("rep_pos", F.coalesce(F.get("places", F.col("nth")), F.col("first_pos")))
    pairs = (
        matches.groupBy("doc_id", "rep")
        .agg(F.collect_list(F.struct("pos", "rep_pos", "span")).alias("matches"))
        .where(
            F.array_max(F.transform("matches", lambda one: one["pos"] + one["span"]))
            - F.array_min("matches.pos") + K >= least
        )
    )
    chains = settle(find_chains(pairs, least), "chains")
    if chains.isEmpty():
        return None
    named = chains.select("doc_id").union(chains.select("rep"))
    words = settle(word_hashes(likely_named(rows.select("doc_id", "text"), named)), "words")
    if crowded:
        chains = far_reaching(chains, words, min_words)
    return settle(align_chains(chains, words, min_words, similarity), "passages")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without the passages that a document with a smaller id holds too.

    Passages are cut from the text with the white space before them. A document of which nothing is
    left goes. All columns stay; rows without an id, rows not touched, and rows of an id whose other text was
    compared, stay as they are.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    compared = one_text_each(named.where("doc_id is not null"))[1]
    passages = repeated_passages(docs, doc_id, text, **options)
    spans = passages.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_set(F.struct(F.col("start_word").alias("a"), F.col("end_word").alias("b"))).alias("__spans")
    )
    if compared is None:
        spans = spans.withColumn("__hash", F.lit(None).cast("long"))
    else:
        compared = compared.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
        spans = spans.join(compared, "__id", "left")
    spans = settle(spans, "cut-spans")
    # Where an id has several texts, the places are those of one of them.
    same = F.col("__hash").isNull() | (F.col("__hash") == text_hash(text))
    joined = docs.join(spans, (F.col(doc_id).cast("long") == F.col("__id")) & same, "left")

    @F.pandas_udf("string")
    def cut(texts, spans):
        import re

        import pandas as pd

        out = []
        for text, found in zip(texts, spans):
            if found is None or text is None:
                out.append(text)
                continue
            words = [match.span() for match in re.finditer(r"[^\x20\x09-\x0D]+", text)]
            kept, at = [], 0
            for a, b in sorted((span["a"], span["b"]) for span in found):
                begin = words[a - 1][1] if a else 0
                if begin > at:
                    kept.append(text[at:begin])
                at = max(at, words[min(b, len(words)) - 1][1])
            kept.append(text[at:])
            out.append("".join(kept))
        return pd.Series(out, dtype=object)

    touched = F.col("__spans").isNotNull()
    kept = joined.where(touched).withColumn(text, cut(F.col(text), F.col("__spans")))
    # A plain filter would go below the cut and have every text cut twice, by two Python workers.
    kept = gate(kept, F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    return joined.where(~touched).select(*docs.columns).unionByName(kept.select(*docs.columns))
