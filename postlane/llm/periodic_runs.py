"""Runs: stretches of words that repeat with a period, found through minimizers at several scales.

A run is a stretch of consecutive words with smallest period q, at least ``max(6, 4 * q)`` words
long, that cannot be made longer on either side with that period. All runs of a text are found.

Periods up to ``SHORT`` are found by comparing the words with those ``q`` places on. Longer ones
have a scale each, (16, 32], (32, 64] and so on. At the scale above ``low``, every place has the
hash of the ``w = low / 2`` words from there on, and a place is a minimizer if its hash is the
smallest of some ``w`` neighbouring places. Inside a run minimizers come again at distance q, as the
windows around them have the same words. Equal minimizers at most ``w / 3`` apart stand in a
stretch of a much shorter period, so only the last of such a cluster stands for it; the last ones
also come again at distance q, and as they are more than ``w / 3`` apart, each has a bounded number of
successors within the scale. Such a pair seeds an extension: it gives a lag and a place, and the stretch
around it whose words equal those one lag on is measured on the words themselves. A run holds
such a pair because it is at least four periods long, and every stretch is checked, so the result is
exact but for collisions of 64-bit hashes, which could only hide a run.

A stretch long enough found at a lag that is not its smallest period is a run of that smaller period too,
with the same ends; of equal stretches the smallest lag is kept.

Words are what stands between ASCII white space. Null or empty texts have no words and no runs. Null
ids and repeated rows are treated one by one, an empty table gives no rows.
Other columns are ignored. Work per text is n log n in its words, whatever they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.words import bounded_batches, mixed, text_chunks, word_codes

LEAST_WORDS = 6
LEAST_PERIODS = 4
SHORT = 16
RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
RUNS = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

Rewrite = Callable[[int | None, int], np.ndarray | None]


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least (or greatest) of ``width`` neighbours, beginning at each place."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def minimizers(key: np.ndarray, width: int) -> np.ndarray:
    """Places whose key is the smallest of some ``width`` neighbouring places."""
    pad = np.full(width - 1, ~np.uint64(0), np.uint64)
    least = _extreme(np.concatenate((pad, key, pad)), width, np.minimum)
    return np.flatnonzero(_extreme(least, width, np.maximum) == key)


def seed_pairs(key: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of pairs of equal minimizers with a lag in (low, 2 * low]."""
    width = low // 2
    near = width // 3
    place = minimizers(key, width)
    place = place[np.argsort(key[place], kind="stable")]
    found = key[place]
    last = np.ones(len(place), bool)
    last[:-1] = (found[1:] != found[:-1]) | (place[1:] - place[:-1] > near)
    place, found = place[last], found[last]
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, 2 * low // (near + 1) + 1):
        if step >= len(place):
            break
        lag = place[step:] - place[:-step]
        fits = (found[step:] == found[:-step]) & (lag > low) & (lag <= 2 * low)
        places.append(place[:-step][fits])
        lags.append(lag[fits])
    place, lag = np.concatenate(places), np.concatenate(lags)
    # A run's stretch is longer than six windows, so the next or the last window agrees as well.
    top = len(key) - 1
    after, before = np.minimum(place + width, top), np.maximum(place - width, 0)
    agrees = key[after] == key[np.minimum(place + width + lag, top)]
    agrees |= key[before] == key[np.minimum(before + lag, top)]
    return place[agrees], lag[agrees]


def reach(codes: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many places from ``at`` on, forwards or backwards, have the word one lag on."""
    far, piece = 0, 64
    n = len(codes) - lag
    while True:
        if step > 0:
            a, b = at + far, min(n, at + far + piece)
            same = codes[a:b] == codes[a + lag : b + lag]
        else:
            a, b = max(0, at - far - piece + 1), at - far + 1
            same = (codes[a:b] == codes[a + lag : b + lag])[::-1]
        if b <= a:
            return far
        if not same.all():
            return far + int(same.argmin())
        far, piece = far + b - a, min(2 * piece, 1 << 16)


def long_stretches(codes: np.ndarray, places: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, lag) of the stretches around seeds that are long enough for a run."""
    found = []
    order = np.lexsort((places, lags))
    known_lag, known_end = 0, 0
    for at, lag in zip(places[order].tolist(), lags[order].tolist()):
        if lag == known_lag and at < known_end:
            continue  # inside the stretch measured last
        end = at + reach(codes, at, lag, 1)
        start = at - reach(codes, at - 1, lag, -1) if at else 0
        known_lag, known_end = lag, end
        length = end - start + lag
        if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            found.append((start, length, lag))
    return found


def runs_of(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs of several texts, by text, start and period.

    ``codes[starts[i]:starts[i + 1]]`` are the words of text ``i`` as numbers from 0.
    """
    texts = len(starts) - 1
    sizes = np.diff(starts)
    # Behind each text a number of its own, which equals nothing: no stretch passes it.
    whole = np.empty(len(codes) + texts, np.int64)
    text = np.repeat(np.arange(texts), sizes + 1)
    ends = starts[1:] + np.arange(texts)
    inside = np.ones(len(whole), bool)
    inside[ends] = False
    whole[inside] = codes
    whole[ends] = -1 - np.arange(texts)
    longest = int(sizes.max()) if texts else 0

    found = [np.zeros((0, 3), np.int64)]
    for lag in range(1, min(SHORT, longest // LEAST_PERIODS) + 1):
        same = np.zeros(len(whole) - lag + 2, np.int8)
        same[1:-1] = whole[lag:] == whole[:-lag]
        edges = np.flatnonzero(np.diff(same))
        begin, length = edges[::2], edges[1::2] - edges[::2] + lag
        fits = length >= max(LEAST_WORDS, LEAST_PERIODS * lag)
        found.append(np.stack((begin[fits], length[fits], np.full(fits.sum(), lag)), axis=1))

    key = mixed(whole.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x51ED27))
    place, width, low = np.arange(len(whole)), 1, SHORT
    while longest >= LEAST_PERIODS * (low + 1):
        # Only texts that can hold a run of this scale go on. Words beyond a text's end are in
        # hashes that hold the number behind it, too, and those equal none anyway.
        kept = sizes[text[place]] >= LEAST_PERIODS * (low + 1)
        key, place = key[kept], place[kept]
        while width < low // 2:
            shifted = np.concatenate((key[width:], np.zeros(min(width, len(key)), np.uint64)))
            key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + mixed(shifted + np.uint64(width)))
            width *= 2
        at, lag = seed_pairs(key, low)
        stretches = long_stretches(whole, place[at], lag)
        if stretches:
            found.append(np.array(stretches, np.int64))
        low *= 2

    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[first]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = text[runs[:, 0]]
    return owner, runs[:, 0] - (starts[owner] + owner), runs[:, 1], runs[:, 2]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """False for words that a run holds after its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) == 0


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rewrite: Rewrite | None = None
) -> DataFrame:
    """Per row: doc_id, n_words, its runs in order, and its words without the repeats, one space apart.

    ``rewrite`` may give a text other words, all of them its own: called with the id and the number of words,
    it returns the place to take each word from, or None to leave the text as it is.
    """
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for some, texts in text_chunks(batch.column(1)):
                words = word_codes(texts)
                codes, starts = words.codes, words.starts
                if rewrite is not None:
                    for name, a, b in zip(names[some], starts[:-1].tolist(), starts[1:].tolist()):
                        taken = rewrite(name, b - a)
                        if taken is not None:
                            codes[a:b] = codes[a:b][taken]
                owner, start, length, period = runs_of(codes, starts)
                kept = kept_words(len(codes), start + starts[owner], length, period)
                terms = words.terms.cast(pa.large_binary()).to_pylist()
                left = [terms[code] for code in codes[kept].tolist()]
                edges = np.concatenate(([0], np.cumsum(kept)))[starts].tolist()
                runs = pa.StructArray.from_arrays(
                    [pa.array(column.astype(np.int64)) for column in (start, length, period)], fields=list(RUN)
                )
                offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[some], pa.int64()),
                        pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(offsets), runs),
                        pa.array([b" ".join(left[a:b]) for a, b in zip(edges, edges[1:])], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(work, RUNS)


def run_digests(found: DataFrame) -> DataFrame:
    """Of ``periodic_runs``: the number of runs, the greatest one, and digests of runs and words left."""
    order = F.transform(
        "runs",
        lambda run: F.struct(
            (-run["length"]).alias("shorter"), run["start"].alias("start"), run["period"].alias("period")
        ),
    )
    lines = F.transform(
        "runs",
        lambda run: F.concat_ws(
            ",", run["start"].cast("string"), run["length"].cast("string"), run["period"].cast("string")
        ),
    )
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.withColumn("best", F.array_min(order))
    length, period = -F.col("best.shorter"), F.col("best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(-1000 * best.shorter) div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
