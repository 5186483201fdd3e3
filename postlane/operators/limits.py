"""Batches that also end on elapsed time and on a gap between messages.

Where a batch ends depends on where it began, so the rule is sequential. It is spread all the
same: a source is cut into segments, each segment works out for every possible entry point
(there are no more than a batch has messages) where the last batch begun in it leaves the
segment, and these small tables are chained to find the real entry of every segment.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.operators.batching import BUCKET_WIDTH, batch_by_count, number_in_order
from postlane.options import DEFAULT_BATCH_SIZE

SEGMENT_ROWS = 50_000
SEGMENTS_PER_GROUP = 200

# Columns to join on are declared not null: a filter for nulls would make two of one exchange.
CHAIN = "source string NOT NULL, segment long NOT NULL, leaves array<int>, cuts array<int>"
GROUPS = "source string, grp long, leaves array<int>, cuts array<long>"
ENTRIES = "source string NOT NULL, grp long NOT NULL, entry int, base long"
SEGMENT_ENTRIES = "source string, segment long, entry int, base long"
ASSIGNED = "source string, ordinal long, batch_no long"


def first_reaching(times: np.ndarray, wait: int) -> np.ndarray:
    """For each message the next one at least ``wait`` later, or the length if there is none."""
    count = len(times)
    if np.all(times[1:] >= times[:-1]):
        return np.searchsorted(times, times + wait, side="left")
    # Times that go back: keep, from the right, the messages later than all between them and here.
    found = np.full(count, count, dtype=np.int64)
    places: list[int] = []
    negated: list[int] = []
    for at in range(count - 1, -1, -1):
        now = int(times[at])
        spot = bisect_right(negated, -(now + wait)) - 1
        if spot >= 0:
            found[at] = places[spot]
        while negated and -negated[-1] <= now:
            negated.pop()
            places.pop()
        negated.append(-now)
        places.append(at)
    return found


def next_batch(times: np.ndarray, size: int, max_ms: int, gap_ms: int | None) -> np.ndarray:
    """For a batch begun at each message, the message that begins the following batch."""
    count = len(times)
    here = np.arange(count, dtype=np.int64)
    following = np.minimum(here + size, count)
    if gap_ms is not None:
        breaks = np.flatnonzero(np.diff(times) > gap_ms) + 1
        ends = np.append(breaks, count)
        following = np.minimum(following, ends[np.searchsorted(breaks, here, side="right")])
    if max_ms > 0:
        # The message that reaches the deadline still belongs to the batch it closes.
        following = np.minimum(following, np.minimum(first_reaching(times, max_ms) + 1, count))
    return following


def leave_segment(following: np.ndarray, own: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where batches begun at the first ``size`` messages lead, and how many begin on the way."""
    goes = following[:own].copy()
    begun = np.ones(own, dtype=np.int64)
    while True:
        inside = goes < own
        if not inside.any():
            break
        onward = goes[inside]
        begun[inside] += begun[onward]
        goes[inside] = goes[onward]
    return (goes - own)[:size], begun[:size]


def _runs(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with equal keys, across the borders of Arrow batches."""
    held: list[pd.DataFrame] = []
    held_key = None
    for frame in frames:
        if frame.empty:
            continue
        values = [frame[key].to_numpy() for key in keys]
        changes = np.zeros(len(frame), dtype=bool)
        for column in values:
            changes[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(changes), len(frame)]
        for begin, end in zip(starts, starts[1:]):
            key = tuple(column[begin] for column in values)
            if held and key != held_key:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held_key = key
            held.append(frame.iloc[begin:end])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _in_order(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def _gather(parts: Iterator[pd.DataFrame], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Small frames joined to larger ones before they go back to the JVM."""
    held: list[pd.DataFrame] = []
    count = 0
    for part in parts:
        held.append(part)
        count += len(part)
        if count >= rows:
            yield pd.concat(held)
            held, count = [], 0
    if held:
        yield pd.concat(held)


def batch_by_limits(
    messages: DataFrame,
    size: int = DEFAULT_BATCH_SIZE,
    max_ms: int = 0,
    gap_ms: int | None = None,
    time: str = "jms_timestamp",
    segment_rows: int = SEGMENT_ROWS,
    segments_per_group: int = SEGMENTS_PER_GROUP,
    bucket_width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Add ``batch_no``, ending a batch at ``size`` messages, after ``max_ms``, or at a gap.

    A message begins a new batch when the current one is full, when the message before it
    arrived ``max_ms`` or more after the batch's first, or when it came more than ``gap_ms``
    after the message before it. ``max_ms`` 0 means no time limit, ``gap_ms`` None no gap rule.
    A message without a time counts as time 0.
    """
    if size < 1:
        raise ValueError("a batch needs room for at least one message")
    if max_ms <= 0 and gap_ms is None:
        return batch_by_count(messages, size, bucket_width)
    in_order = number_in_order(messages, bucket_width=bucket_width)
    return cut_numbered(in_order, size, max_ms, gap_ms, time, segment_rows, segments_per_group).drop("ordinal")


def cut_numbered(
    in_order: DataFrame,
    size: int = DEFAULT_BATCH_SIZE,
    max_ms: int = 0,
    gap_ms: int | None = None,
    time: str = "jms_timestamp",
    segment_rows: int = SEGMENT_ROWS,
    segments_per_group: int = SEGMENTS_PER_GROUP,
) -> DataFrame:
    """``batch_by_limits`` for messages whose ``ordinal``, 1, 2, 3 … per source, is given."""
    if max_ms <= 0 and gap_ms is None:
        return in_order.withColumn("batch_no", F.expr(f"(ordinal - 1) div {size} + 1"))
    width = max(segment_rows, 2 * size)
    numbered = in_order.select(
        "source",
        "ordinal",
        F.coalesce(time, F.lit(0)).cast("long").alias("ms"),
        F.expr(f"(ordinal - 1) div {width}").alias("segment"),
    )

    # Each segment also sees the first messages of the next one, as far as a batch can reach.
    reaches_back = (F.expr(f"(ordinal - 1) % {width}") < size) & (F.col("segment") > 0)
    seen_by = F.array_compact(
        F.array(F.col("segment"), F.when(reaches_back, F.col("segment") - 1))
    )
    rows = numbered.select(
        "source", "ordinal", "ms", F.col("segment").alias("owner"), F.explode(seen_by).alias("segment")
    )

    def chain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[pd.DataFrame]:
            for run in _runs(frames, ["source", "segment"]):
                own = int((run["owner"] == run["segment"]).sum())
                following = next_batch(run["ms"].to_numpy(), size, max_ms, gap_ms)
                leaves, cuts = leave_segment(following, own, size)
                yield pd.DataFrame(
                    {
                        "source": run["source"].iloc[:1].to_numpy(),
                        "segment": run["segment"].iloc[:1].to_numpy(),
                        "leaves": [leaves],
                        "cuts": [cuts],
                    }
                )

        yield from _gather(parts(), 200)

    chained = _in_order(rows, ["source", "segment"], ["ordinal"]).mapInPandas(chain, CHAIN)
    # Both uses below read this one exchange.
    chained = chained.withColumn("grp", F.expr(f"coalesce(segment div {segments_per_group}, 0)"))
    chained = chained.repartition("source", "grp")

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for run in _runs(frames, ["source", "grp"]):
            place = np.arange(size, dtype=np.int64)
            total = np.zeros(size, dtype=np.int64)
            for leaves, cuts in zip(run["leaves"], run["cuts"]):
                inside = place < len(leaves)
                total[inside] += np.asarray(cuts)[place[inside]]
                place[inside] = np.asarray(leaves)[place[inside]]
            yield pd.DataFrame(
                {
                    "source": run["source"].iloc[:1].to_numpy(),
                    "grp": run["grp"].iloc[:1].to_numpy(),
                    "leaves": [place],
                    "cuts": [total],
                }
            )

    def enter_groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, entry, base = None, 0, 0
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if row.source != source:
                    source, entry, base = row.source, 0, 0
                out.append((row.source, row.grp, entry, base))
                base += int(row.cuts[entry])
                entry = int(row.leaves[entry])
            yield pd.DataFrame(out, columns=["source", "grp", "entry", "base"])

    def enter_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, entry, base = None, 0, 0
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if (row.source, row.grp) != current:
                    current, entry, base = (row.source, row.grp), int(row.entry), int(row.base)
                out.append((row.source, row.segment, entry, base))
                if entry < len(row.leaves):
                    base += int(row.cuts[entry])
                    entry = int(row.leaves[entry])
            yield pd.DataFrame(out, columns=["source", "segment", "entry", "base"])

    groups = chained.sortWithinPartitions("source", "grp", "segment").mapInPandas(fold, GROUPS)
    group_entries = _in_order(groups, ["source"], ["grp"]).mapInPandas(enter_groups, ENTRIES)
    entries = _in_order(
        chained.join(group_entries, ["source", "grp"]), ["source", "grp"], ["segment"]
    ).mapInPandas(enter_segments, SEGMENT_ENTRIES)

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def parts() -> Iterator[pd.DataFrame]:
            for run in _runs(frames, ["source", "segment"]):
                entry, base = int(run["entry"].iloc[0]), int(run["base"].iloc[0])
                own = run.iloc[1:]
                following = next_batch(own["ms"].to_numpy(), size, max_ms, gap_ms)
                begins = np.zeros(len(own), dtype=np.int64)
                at = entry
                while at < len(own):
                    begins[at] = 1
                    at = following[at]
                yield pd.DataFrame(
                    {
                        "source": own["source"].to_numpy(),
                        "ordinal": own["ordinal"].to_numpy(),
                        "batch_no": base + np.cumsum(begins),
                    }
                )

        yield from _gather(parts())

    # The entry travels as the first row of its segment, which spares a join.
    marked = numbered.select(
        "source",
        "segment",
        "ordinal",
        "ms",
        F.lit(0).alias("entry"),
        F.lit(0).cast("long").alias("base"),
    ).unionByName(
        entries.select(
            "source",
            "segment",
            F.lit(0).cast("long").alias("ordinal"),
            F.lit(0).cast("long").alias("ms"),
            "entry",
            "base",
        )
    )
    assigned = _in_order(marked, ["source", "segment"], ["ordinal"]).mapInPandas(assign, ASSIGNED)
    return in_order.join(assigned, ["source", "ordinal"]).select(*in_order.columns, "batch_no")
