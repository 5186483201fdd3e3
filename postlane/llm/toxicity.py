"""Toxicity by a gap-weighted subsequence kernel, a support vector machine and Nystroem landmarks.

Strings are compared by their subsequences of three letters, which may skip letters inside a span of
five; a skipped letter costs a factor. So "idiot" stays close to "idxiot" and a stem stays close to
the same stem with another ending. The strings of a text are runs of a few letters: of its
words, without anything that is no letter ("i.d*i-o.t"), and of neighbouring words of one letter each
("i d i o t"). Word ends count as letters.

Labels belong to whole texts, so the strings that make a text toxic are found while learning (multiple
instances): words that labelled toxic texts hold far more often than clean ones give a first machine. Then, in
rounds, the word that the machine scores highest stands for each toxic text, and words of clean texts
that score highest join the negatives. Landmarks are taken from
both; the machine is linear in the Nystroem features of the kernel to the landmarks. As the kernel
has few features (triples of letters), the trained machine is one weight per triple, and scoring is
a lookup. A text's value is that of its highest string, and a logistic curve fitted on training texts
makes it a score.

At most about ``MAX_LABELLED`` labelled texts are learnt from, chosen by a hash of their id; copies
of a text count once. Rows whose id has a CRC-32 divisible by five are never learnt from.

A null text is empty. Strings of less than three letters have the lowest value, and so have
texts without others. A string of more than ``LONGEST`` letters counts as several that overlap, so one very
long word takes no more memory than many short ones. Letters outside a-z are told apart in 13 classes only. A null id is scored and counts as
held out. A text labelled both ways counts as toxic. Without any word typical of toxic texts,
the score is the share of toxic labels. Repeated rows stay; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlane.llm.words import bounded_batches, release, text_chunks, word_codes
from postlane.shared import settle

MAX_LABELLED = 40_000
POSITIVES, NEGATIVES, MINED, LANDMARKS = 400, 1500, 500, 256
ROUNDS = 3
LETTERS = 42
UNLIKE = 0.5
ALTERED = 0.1
LEAST_LETTERS = 3
# Longer strings count as several, which overlap; so many letters are worked on at once.
LONGEST, OVERLAP = 1000, 50
LETTERS_AT_ONCE, UNITS_AT_ONCE = 300_000, 10_000
# Runs of letters that training compares with landmarks at once, and whose kernel it holds at once.
ROWS_AT_ONCE, RUNS_AT_ONCE = 100, 2000
TYPICAL_SHARE = 0.05
SPAN, GAP_COST, STARTS = 5, 0.65, 4
LEAST_RATIO = 10.8  # chi-square at 0.001, one degree of freedom
LOWEST = -2.0
_STEPS = [
    (second, third, GAP_COST ** (third - 2))
    for second, third in itertools.combinations(range(1, SPAN), 2)
]


@dataclass
class Model:
    """Weight of each triple of letters, and the logistic curve."""

    weights: np.ndarray | None
    slope: float
    shift: float

    def scores(self, values: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(values), self.shift)
        return 1 / (1 + np.exp(-np.clip(self.slope * values + self.shift, -700, 700)))


def letters_only(word: str) -> str:
    word = word.lower()
    if word.isalpha():
        return word
    some = (word[at : at + LETTERS_AT_ONCE] for at in range(0, len(word), LETTERS_AT_ONCE))
    return "".join(["".join(filter(str.isalpha, part)) for part in some])


def pieces_of(unit: str) -> list[str]:
    """The string itself, or what a long one counts as."""
    return [unit[at : at + LONGEST] for at in range(0, max(1, len(unit) - OVERLAP), LONGEST - OVERLAP)]


def text_strings(texts: list[bytes]) -> tuple[list[str], list[np.ndarray]]:
    """Different strings of letters, and for each text the numbers of those it holds."""
    words = word_codes(texts)
    units = [letters_only(word) for word in words.terms.to_pylist()]
    single = np.array([len(unit) == 1 for unit in units], bool)
    extra: dict[str, int] = {}
    held = []

    def numbers(pieces: list[str]) -> list[int]:
        return [extra.setdefault(piece, len(units) + len(extra)) for piece in pieces]

    parts = {}
    for code, unit in enumerate(units):
        if len(unit) > LONGEST:
            units[code], *rest = pieces_of(unit)
            parts[code] = numbers(rest)
    long = np.array(sorted(parts), np.int64)
    for begin, end in itertools.pairwise(words.starts.tolist()):
        own = np.unique(words.codes[begin:end])
        more = [number for code in np.intersect1d(own, long).tolist() for number in parts[code]]
        alone = np.concatenate(([False], single[words.codes[begin:end]], [False]))
        if alone.any():
            edges = np.flatnonzero(alone[1:] != alone[:-1])
            for first, last in zip(edges[::2], edges[1::2]):
                if last - first > 2:
                    joined = "".join(units[code] for code in words.codes[begin + first : begin + last])
                    more += numbers(pieces_of(joined))
        held.append(np.union1d(own, np.array(more, np.int64)) if more else own)
    return units + list(extra), held


def _flat(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all strings with their ends, as numbers, and where each string begins."""
    joined = "".join([f"^{unit}$" for unit in units])
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 96, 27 + points % 13)
    codes[points == 94], codes[points == 36] = 40, 41
    return codes, np.concatenate(([0], np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 2)))


def _triples(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Triples that begin at each letter (a column per pattern), and their weights (0: none)."""
    ends = np.repeat(starts[1:], np.diff(starts))
    padded = np.concatenate((codes, np.zeros(SPAN, np.int64)))
    at = np.arange(len(codes))
    found = np.empty((len(codes), len(_STEPS)), np.int64)
    weight = np.zeros((len(codes), len(_STEPS)))
    for column, (second, third, factor) in enumerate(_STEPS):
        found[:, column] = (codes * LETTERS + padded[at + second]) * LETTERS + padded[at + third]
        weight[:, column] = np.where(at + third < ends, factor, 0)
    return found, weight


def _runs(starts: np.ndarray) -> np.ndarray:
    """Whether a run of ``STARTS`` letters may begin at a letter."""
    lengths = np.diff(starts)
    room = np.repeat(starts[1:] - np.minimum(lengths, STARTS), lengths)
    return np.arange(starts[-1]) <= room


def _over_runs(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum over the letters of the run that begins at each letter, inside its string.

    Added up letter by letter, so that a string's sum does not depend on the strings beside it.
    """
    room = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(values))
    padded = np.concatenate((values, np.zeros(STARTS)))
    total = np.zeros(len(values))
    for step in range(STARTS):
        total += np.where(step < room, padded[step : step + len(values)], 0.0)
    return total


def _runs_of_units(units: list[str]) -> Iterator[slice]:
    """Neighbouring strings that are worked on together, of bounded number and length."""
    begin = letters = 0
    for at, unit in enumerate(units):
        if at > begin and (at - begin >= UNITS_AT_ONCE or letters + len(unit) > LETTERS_AT_ONCE):
            yield slice(begin, at)
            begin, letters = at, 0
        letters += len(unit)
    yield slice(begin, len(units))


def unit_values(units: list[str], weights: np.ndarray) -> np.ndarray:
    """The machine's value of each string: that of its best run."""
    if not units:
        return np.zeros(0)
    out = []
    for some in _runs_of_units(units):
        codes, starts = _flat(units[some])
        found, weight = _triples(codes, starts)
        value = _over_runs((weights[found] * weight).sum(axis=1), starts)
        norm = np.sqrt(np.maximum(_over_runs((weight**2).sum(axis=1), starts), 1e-12))
        value = np.where(_runs(starts) & (norm > 1e-3), value / norm, LOWEST)
        best = np.maximum.reduceat(value, starts[:-1])
        out.append(np.where(np.diff(starts) - 2 < LEAST_LETTERS, LOWEST, best))
    return np.concatenate(out)


def text_values(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    found = [np.zeros(0)]
    for _, texts in text_chunks(column):
        units, held = text_strings(texts)
        values = unit_values(units, weights)
        found.append(np.array([values[own].max() if len(own) else LOWEST for own in held]))
    return np.concatenate(found)


def _run_vectors(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Triples and normed weights of all runs, and the string each belongs to."""
    codes, starts = _flat(units)
    found, weight = _triples(codes, starts)
    begin = np.flatnonzero(_runs(starts))
    home = np.searchsorted(starts, begin, "right") - 1
    at = begin[:, None] + np.arange(STARTS)
    inside = at < starts[home + 1][:, None]
    at = np.minimum(at, len(codes) - 1)
    triples = found[at].reshape(len(begin), -1)
    weights = (weight[at] * inside[:, :, None]).reshape(len(begin), -1)
    norm = np.sqrt((weights**2).sum(axis=1))
    real = norm > 1e-3
    return triples[real], weights[real] / norm[real][:, None], home[real]


def _kernel_to(triples: np.ndarray, weights: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Kernel of runs to landmarks, given as a dense row per triple of letters."""
    out = np.empty((len(triples), dense.shape[1]), np.float32)
    for at in range(0, len(triples), ROWS_AT_ONCE):
        part = slice(at, at + ROWS_AT_ONCE)
        out[part] = np.einsum("nk,nkm->nm", weights[part].astype(np.float32), dense[triples[part]])
    return out


def _features(triples: np.ndarray, weights: np.ndarray, dense: np.ndarray, project: np.ndarray) -> np.ndarray:
    """Nystroem features of runs, and a column of ones; the kernel is held for some runs at once."""
    x = np.ones((len(triples), project.shape[1] + 1))
    # A short rest goes with the runs before it: products of few rows are rounded otherwise.
    edges = [*range(0, max(1, len(triples) - RUNS_AT_ONCE + 1), RUNS_AT_ONCE), len(triples)]
    for begin, end in itertools.pairwise(edges):
        x[begin:end, :-1] = _kernel_to(triples[begin:end], weights[begin:end], dense) @ project
    return x


def _machine(x: np.ndarray, sign: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss, by Newton steps. The last feature is one."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    ridge[-1] = 1e-6
    for _ in range(30):
        margin = sign * (x @ w)
        active = margin < 1
        some = x if active.all() else x[active]
        part = some * weight[active][:, None]
        gradient = ridge * w - part.T @ (sign[active] * (1 - margin[active]))
        bend = part.T @ some
        del some, part
        step = np.linalg.solve(bend + np.diag(ridge), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _rows_of(triples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The triples that occur, each a row of a table, and the row of every triple; others get one more row, of zeros."""
    used = np.unique(triples)
    row = np.full(LETTERS**3, len(used), np.int32)
    row[used] = np.arange(len(used))
    return used, row


def _spread(triples: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """Landmarks that differ: in the given order, runs unlike those taken before; then the rest."""
    used, row = _rows_of(triples)
    triples = row[triples]
    taken, later, total = [], [], np.zeros((len(used), most), np.float32)
    for at in range(len(triples)):
        if len(taken) == most:
            break
        near = (total[triples[at], : len(taken)] * weights[at][:, None]).sum(axis=0)
        if len(near) and near.max() > UNLIKE:
            later.append(at)
            continue
        np.add.at(total[:, len(taken)], triples[at], weights[at])
        taken.append(at)
    return np.array(taken + later[: most - len(taken)], np.int64)


def train_weights(
    positives: list[str], importance: np.ndarray, negatives: list[str], seed: int = 7
) -> np.ndarray:
    """One weight per triple. ``positives`` begin with the most typical; the curve adds the intercept."""
    rng = np.random.default_rng(seed)
    # A letter put inside must not hide a word: learn that from altered copies.
    altered = [
        unit[:at] + chr(97 + letter) + unit[at:]
        for unit in positives
        for at, letter in [(1 + rng.integers(max(1, len(unit) - 1)), rng.integers(26))]
    ]
    positives = positives + altered
    importance = np.concatenate([importance, importance * ALTERED])
    p_triples, p_weights, p_home = _run_vectors(positives)
    n_triples, n_weights, _ = _run_vectors(negatives)
    size = LETTERS**3

    def mean(triples, weights):
        return np.bincount(triples.ravel(), weights.ravel(), size) / max(1, len(triples))

    importance = np.clip(importance / importance.mean(), 0.02, 50.0)
    shared = importance[p_home][:, None] * p_weights
    weights = mean(p_triples, shared) - mean(n_triples, n_weights)
    for _ in range(ROUNDS):
        value = (weights[p_triples] * p_weights).sum(axis=1)
        order = np.lexsort((-value, p_home))
        best = order[np.concatenate(([True], p_home[order][1:] != p_home[order][:-1]))]
        half = LANDMARKS // 2
        p_marks = _spread(p_triples[best], p_weights[best], half)
        p_marks = best[p_marks]
        n_value = (weights[n_triples] * n_weights).sum(axis=1)
        hard = np.argsort(-n_value, kind="stable")[: half // 2]
        n_marks = np.union1d(hard, rng.permutation(len(n_triples))[: half // 2])
        triples = np.concatenate([p_triples[p_marks], n_triples[n_marks]])
        norms = np.concatenate([p_weights[p_marks], n_weights[n_marks]])
        used, row = _rows_of(triples)
        dense = np.zeros((len(used) + 1, len(triples)), np.float32)
        for mark in range(len(triples)):
            np.add.at(dense[:, mark], row[triples[mark]], norms[mark])
        between = _kernel_to(row[triples], norms, dense).astype(np.float64)
        spectrum, vectors = np.linalg.eigh((between + between.T) / 2)
        real = spectrum > 1e-4
        project = vectors[:, real] / np.sqrt(spectrum[real])
        x = _features(
            np.concatenate([row[p_triples[best]], row[n_triples]]), np.concatenate([p_weights[best], n_weights]),
            dense, project,
        )
        sign = np.concatenate([np.ones(len(best)), -np.ones(len(n_triples))])
        balance = np.concatenate(
            [importance[p_home[best]], np.full(len(n_triples), max(0.2, len(best) / len(n_triples)))]
        )
        w, _ = _machine(x, sign, balance)
        del x
        # In pieces, as the rows of all triples in double precision take more memory than all the rest.
        direction = project @ w
        weights = np.concatenate([dense[row[at : at + 4096]] @ direction for at in range(0, size, 4096)])
    return weights


def trained_weights(
    spark: SparkSession, positives: list[str], importance: np.ndarray, negatives: list[str]
) -> np.ndarray:
    """``train_weights`` in a task: its matrices would come on top of what the driver holds for the whole job."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            weights = train_weights(positives, importance, negatives).tobytes()
            release()
            yield pa.RecordBatch.from_pydict({"weights": [weights]})

    [row] = spark.range(1, numPartitions=1).mapInArrow(work, "weights binary").collect()
    return np.frombuffer(row.weights)


def fit_curve(values: np.ndarray, toxic: np.ndarray, counts: np.ndarray) -> tuple[float, float]:
    """Logistic curve through counted (value, label) pairs, with Platt's smoothed targets."""
    high, low = counts[toxic > 0].sum(), counts[toxic == 0].sum()
    target = np.where(toxic > 0, (high + 1) / (high + 2), 1 / (low + 2))
    mean = values.mean()
    x = np.stack([values - mean, np.ones(len(values))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts * (p - target)) + 1e-3 * w
        bend = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, gradient)
        step *= min(1.0, 5 / max(1e-9, np.abs(step).max()))
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0]), float(w[1] - w[0] * mean)


def _held_out(doc_id: Column) -> Column:
    rest = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))
    return F.coalesce(rest == 0, F.lit(True))


def _training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, toxic) of the labelled texts to learn from; about ``most`` rows at most."""
    known = (
        labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
        .dropna()
        .where(~_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    share = min(1.0, most / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = settle(known, "labelled")
    texts = docs.join(F.broadcast(known), "doc_id").groupBy(F.xxhash64("text").alias("h"))
    return settle(texts.agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).drop("h"), "training")


def _count_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that hold each string, by label."""
    for batch in batches:
        toxic = np.asarray(batch.column(1)).astype(np.int64)
        for some, texts in text_chunks(batch.column(0)):
            units, held = text_strings(texts)
            number = {unit: at for at, unit in enumerate(dict.fromkeys(units))}
            same = np.array([number[unit] for unit in units], np.int64)
            counts = np.zeros((2, len(number)), np.int64)
            for own, label in zip(held, toxic[some]):
                counts[int(label > 0), np.unique(same[own])] += 1
            yield pa.RecordBatch.from_pydict({"unit": list(number), "n0": counts[0], "n1": counts[1]})


def _ratio(n0: Column, n1: Column, all0: float, all1: float) -> Column:
    """Likelihood ratio of a string standing in more toxic texts than expected."""
    share = all1 / (all0 + all1)
    expected = (n0 + n1) * share
    rest = (n0 + n1) * (1 - share)
    part = lambda seen, hoped: F.when(seen > 0, seen * F.log(seen / hoped)).otherwise(0.0)
    return F.when(n1 > expected, 2 * (part(n1, expected) + part(n0, rest))).otherwise(0.0)


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Learn from the labelled texts that are not held out."""
    docs = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    training = _training_rows(docs, labels, max_labelled)
    sums = {row.toxic: row["count"] for row in training.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    all1, all0 = sums.get(True, 0), sums.get(False, 0)
    nothing = Model(None, 0.0, all1 / max(1, all0 + all1))
    if not all1 or not all0:
        return nothing
    learnt = docs.join(F.broadcast(training), "doc_id").select("text", "toxic")
    seen = learnt.mapInArrow(_count_strings, "unit string, n0 long, n1 long")
    seen = seen.where(F.length("unit") >= LEAST_LETTERS).groupBy("unit").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    seen = settle(seen.withColumn("ratio", _ratio(F.col("n0"), F.col("n1"), all0, all1)), "strings")
    typical = (
        seen.where(f"n1 > 1 and ratio >= {LEAST_RATIO} and n1 > 4 * n0 * {all1 / all0}")
        .orderBy(F.desc("ratio"), "unit").limit(POSITIVES)
    )
    found = typical.select("unit", "ratio").collect()
    found = [row for row in found if row.ratio >= TYPICAL_SHARE * found[0].ratio]
    positives, importance = [row.unit for row in found], np.array([row.ratio for row in found])
    if not positives:
        return nothing
    clean = seen.where(f"n0 > 0 and ratio < {LEAST_RATIO}")
    negatives = [row.unit for row in clean.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES).collect()]
    if not negatives:
        return nothing
    weights = trained_weights(docs.sparkSession, positives, importance, negatives)
    bad = learnt.where("toxic > 0").select("text")
    for _ in range(2):
        # What stands for each toxic text now, and the clean strings most like it.
        stands = bad.mapInArrow(_witness(weights), "unit string").groupBy("unit").count()
        found = stands.orderBy(F.desc("count"), "unit").limit(POSITIVES).collect()
        total = sum(row["count"] for row in found)
        weight = dict(zip(positives, importance / importance.sum()))
        for row in found:
            weight[row.unit] = weight.get(row.unit, 0.0) + row["count"] / total
        positives, importance = list(weight), np.array(list(weight.values()))
        scored = clean.select("unit").mapInPandas(_scorer(weights), "unit string, value double")
        hard = scored.orderBy(F.desc("value"), "unit").limit(MINED).collect()
        negatives = list(dict.fromkeys([*negatives, *[row.unit for row in hard]]))
        weights = trained_weights(docs.sparkSession, positives, importance, negatives)
    release()
    value = values_of(weights)
    counts = learnt.select((F.col("toxic") > 0).cast("int").alias("toxic"), F.round(value("text"), 2).alias("value"))
    rows = counts.groupBy("toxic", "value").count().orderBy("toxic", "value").collect()
    slope, shift = fit_curve(
        np.array([row.value for row in rows]),
        np.array([row.toxic for row in rows]),
        np.array([row["count"] for row in rows], float),
    )
    return Model(weights, slope, shift)


def _scorer(weights: np.ndarray):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(value=unit_values(frame["unit"].tolist(), weights))

    return score


def _witness(weights: np.ndarray):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for _, texts in text_chunks(batch.column(0)):
                units, held = text_strings(texts)
                values = unit_values(units, weights)
                for own in held:  # of equal values the first string, in whatever batch it stands
                    most = values[own].max() if len(own) else LOWEST
                    best += [min(units[at] for at in own[values[own] == most])] if len(own) else []
            yield pa.RecordBatch.from_pydict({"unit": pa.array([unit for unit in best if unit], pa.string())})

    return find


def values_of(weights: np.ndarray):
    """A column function: the machine's value of a text."""

    @F.arrow_udf("double")
    def value(texts: pa.Array) -> pa.Array:
        return pa.array(text_values(texts, weights))

    return value


def score_of(model: Model, text: Column) -> Column:
    """Score of a text, 0 to 1."""
    if model.weights is None:
        return F.lit(float(model.shift))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(text_values(texts, model.weights)))

    return score(text.cast("string"))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels, doc_id, text)
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        _held_out(F.col(doc_id).cast("long")).alias("held_out"),
        score_of(model, F.col(text)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that score below one half, with all their columns."""
    return docs.where(score_of(train(docs, labels, doc_id, text), F.col(text)) < 0.5)
