"""Quality rules whose cutoffs are controlled for the risk of rejecting good documents.

Each rule measures a share that is higher in bad text. Documents with a quality label give the
cutoffs, for each stratum on its own and from two disjoint halves. The first half proposes, per
rule, the cutoff that best tells bad from good documents; of equally good ones the middle one. The
second half certifies: from the loosest cutoff to the proposed one, the number of good documents
rejected is tested against the rule's share of the permitted risk with an exact binomial test,
which is the Clopper-Pearson upper bound read the other way. The strictest cutoff before the first
failure counts. Testing in a fixed order needs no correction inside a rule; across rules and strata
the error level is divided by their number (Bonferroni). So with probability ``1 - error`` no
stratum loses more than ``risk`` of its good documents to these rules. A rule without certified cutoff
rejects nothing, as in strata with few labels.

The base rules come first and are fixed: at least ``MIN_WORDS`` words, and no more than 30 % of
words inside repeated windows of eight. Documents that fail them are not used for cutoffs.

A null text has no words. A null stratum is a stratum. A document labelled both ways counts as good.
Repeated rows stay; an empty table gives no rows; without labels only the base rules decide. Other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.words import bounded_batches, repeated_window_words, sums_by_text, text_chunks, word_codes
from postlane.shared import settle

MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
RISK, ERROR = 0.06, 0.05
SYMBOLS = b"#*$%&|<>"
SPACES = b"\t\n\x0b\x0c\r "
RULES = ("symbol_rate", "dup_line_share", "repeat_share", "sameness")
# Loosest first.
CUTOFFS = (3.0, 2.5, 2.0, 1.5, 1.2, *[round(1 - step / 50, 2) for step in range(50)])
MEASURED = (
    "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, n_lines long, n_different long"
)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The counts that rules use, over whole texts."""
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.col(stratum).cast("string").alias("stratum"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, part in text_chunks(batch.column(1)):
                words = word_codes(part)
                sizes = np.asarray(pc.utf8_length(words.terms)).astype(np.int64)
                symbols, dup, lines = [], [], []
                for text in part:
                    symbols.append(len(text) - len(text.translate(None, SYMBOLS)))
                    real = [line for line in text.split(b"\n") if line.strip(SPACES)]
                    lines.append(len(real))
                    dup.append(len(real) - len(set(real)))
                home = words.text_of()
                pairs = np.unique(home * max(1, len(words.terms)) + words.codes)
                different = np.bincount(pairs // max(1, len(words.terms)), minlength=len(part))
                at, n = some.start, len(part)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column(0).slice(at, n),
                        "stratum": batch.column(2).slice(at, n),
                        "n_words": words.counts.astype(np.int64),
                        "word_chars": sums_by_text(sizes[words.codes], words.starts),
                        "n_symbols": pa.array(symbols, pa.int64()),
                        "n_dup_lines": pa.array(dup, pa.int64()),
                        "n_repeat_words": repeated_window_words(words, REPEAT_WINDOW),
                        "n_lines": pa.array(lines, pa.int64()),
                        "n_different": different.astype(np.int64),
                    }
                )

    counted = rows.mapInArrow(work, MEASURED)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))
    return counted.select(
        "*",
        failed.alias("base_failed"),
        share("n_symbols", "n_words").alias("symbol_rate"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        F.when(F.col("n_words") > 0, 1 - share("n_different", "n_words")).otherwise(0.0).alias("sameness"),
    )


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial distribution, summed exactly in logarithms."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1)
        + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(value - top) for value in logs))


def choose_cutoff(
    tune_good: np.ndarray, tune_bad: np.ndarray, hold_good: np.ndarray, level: float, risk: float
) -> int | None:
    """Place of the cutoff in ``CUTOFFS``, from counts of documents by strictest passed cutoff.

    Entry ``i`` counts documents whose value reaches cutoff ``i`` but no looser one; the last entry
    those that reach none.
    """
    bad, good = tune_bad.sum(), tune_good.sum()
    if not bad or not good:
        return None
    gain = np.cumsum(tune_bad)[:-1] / bad - np.cumsum(tune_good)[:-1] / good
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    if gain.max() <= 0:
        return None
    run = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)[0]
    proposed = int(run[len(run) // 2])
    rejected, n = np.cumsum(hold_good)[:-1], int(hold_good.sum())
    chosen = None
    for place in range(proposed + 1):
        if binomial_cdf(int(rejected[place]), n, risk) > level:
            break
        chosen = place
    return chosen


def cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR,
    label_id: str = "doc_id", label: str = "quality",
) -> DataFrame:
    """(stratum, one column per rule): certified cutoffs, null where there is none."""
    marked = (
        labels.select(F.col(label_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("good"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"))
    )
    known = measured.where(~F.col("base_failed")).join(marked, "doc_id")
    place = lambda rule: sum((F.col(rule) < cutoff).cast("int") for cutoff in CUTOFFS)
    counts = (
        known.select(
            "stratum",
            F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)).alias("half"),
            "good",
            F.explode(
                F.array(*[F.struct(F.lit(rule).alias("rule"), place(rule).alias("place")) for rule in RULES])
            ).alias("at"),
        )
        .groupBy("stratum", "at.rule", "half", "good", "at.place")
        .agg(F.count("*").alias("n"))
    )
    counts = settle(counts, "label-counts")
    strata = max(1, counts.select("stratum").distinct().count())
    level, share = error / (strata * len(RULES)), risk / len(RULES)

    def choose(table: pa.Table) -> pa.Table:
        found = {name: np.zeros((2, 2, len(CUTOFFS) + 1), np.int64) for name in RULES}
        for rule, half, good, at, n in zip(
            *(table[name].to_pylist() for name in ("rule", "half", "good", "place", "n"))
        ):
            found[rule][half, int(good > 0), at] += n
        row = {"stratum": table["stratum"].slice(0, 1).cast(pa.string()).combine_chunks()}
        for rule, seen in found.items():
            place_of = choose_cutoff(seen[0, 1], seen[0, 0], seen[1, 1], level, share)
            row[rule] = pa.array([None if place_of is None else CUTOFFS[place_of]], pa.float64())
        return pa.table(row)

    schema = "stratum string, " + ", ".join(f"{rule} double" for rule in RULES)
    return settle(counts.groupBy("stratum").applyInArrow(choose, schema), "cutoffs")


def judge(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``kept``: passed the base rules and stays below every certified cutoff of its stratum."""
    limits = limits.select(
        F.col("stratum").alias("__stratum"), *[F.col(rule).alias(f"max_{rule}") for rule in RULES]
    )
    joined = measured.join(limits, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    rejected = F.lit(False)
    for rule in RULES:
        rejected = rejected | F.coalesce(F.col(rule) >= F.col(f"max_{rule}"), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected)


def quality(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """Counts, base verdict and final verdict of every document."""
    measured = settle(measure(docs, **names), "measured")
    return judge(measured, cutoffs(measured, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
