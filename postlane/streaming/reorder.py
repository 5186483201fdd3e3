"""Messages of a stream in the order of their arrival numbers, in whatever order they land.

A message waits until all numbers before it in its source are there. A hole is given up when a message
behind it has waited ``delay_ms`` by the messages' own times: the newest time seen in its source lies that much
later. Numbers given up are reported; a message that comes after its number was given up, or a copy of one
already released, is released at once, out of order, and never lost. Without ``delay_ms`` a hole is waited for.

What waits lies in a table, not in one task's state: the first hole of a source is found by numbering its
numbers, so a source may hold any share of the messages. A micro-batch rewrites the messages that wait.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.operators.batching import number_in_order
from postlane.shared import settle

FIRST_NUMBER = 1
# The number each source goes on with, and the newest time seen in it.
FRONTIER = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("next_seq", T.LongType()),
        T.StructField("newest_ms", T.LongType()),
    ]
)
# Numbers that were not waited for any longer.
HOLES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("first_seq", T.LongType()),
        T.StructField("last_seq", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Released:
    """``ready`` may be published now, ``waiting`` not yet; ``frontier`` and ``holes`` say where sources stand."""

    ready: DataFrame
    waiting: DataFrame
    frontier: DataFrame
    holes: DataFrame


def release_in_order(
    messages: DataFrame, frontier: DataFrame, delay_ms: int | None = None, first_number: int = FIRST_NUMBER
) -> Released:
    """Split ``messages``, those of a micro-batch and those that waited, by what may be released.

    ``messages`` is read several times and should be a settled table. A source without a frontier
    begins at ``first_number``. Messages without a source or a number are refused.
    """
    starts = _starts(messages, frontier, delay_ms, first_number)
    # Numbers from the start on are consecutive as long as they keep step with their places.
    here = starts.select("source", "next_seq", "start")
    ahead = _numbers(messages, here, F.col("arrival_seq") >= F.col("start")).select("source", "arrival_seq")
    placed = number_in_order(ahead).join(here, "source")
    in_step = F.col("arrival_seq") - F.col("start") == F.col("ordinal") - 1
    steps = placed.groupBy("source").agg(F.count_if(in_step).alias("steps"))
    reached = F.col("start") + F.coalesce("steps", F.lit(0))
    moved = starts.join(steps, "source", "left").select(
        "source", reached.cast("long").alias("next_seq"), "newest_ms"
    )
    moved = settle(moved, "frontier")
    judged = messages.join(moved.select("source", "next_seq"), "source")
    return Released(
        judged.where("arrival_seq < next_seq").select(*messages.columns),
        judged.where("arrival_seq >= next_seq").select(*messages.columns),
        moved,
        _holes(messages, starts),
    )


def _starts(messages: DataFrame, frontier: DataFrame, delay_ms: int | None, first_number: int) -> DataFrame:
    """Per source the number it stood at, the newest time, and the number to go on with (``start``)."""
    ms = F.coalesce("jms_timestamp", F.lit(0).cast("long"))
    seen = messages.groupBy("source").agg(
        F.max(ms).alias("seen_ms"), F.count_if(F.col("arrival_seq").isNull()).alias("unplaced")
    )
    known = frontier.select(F.col("source").alias("__source"), "next_seq", "newest_ms")
    sources = seen.join(known, F.col("source").eqNullSafe(F.col("__source")), "full").select(
        F.coalesce("source", "__source").alias("source"),
        F.coalesce("next_seq", F.lit(first_number)).cast("long").alias("next_seq"),
        F.greatest("newest_ms", "seen_ms").alias("newest_ms"),
        F.coalesce("unplaced", F.lit(0)).alias("unplaced"),
    )
    sources = settle(sources, "sources")
    refused = sources.where("source IS NULL OR unplaced > 0").limit(1).collect()
    if refused:
        raise ValueError("messages need a source and an arrival number to be put in order")
    sources = sources.drop("unplaced")
    if delay_ms is None:
        return sources.withColumn("start", F.col("next_seq"))
    overdue = messages.join(sources.select("source", "newest_ms"), "source").where(
        ms <= F.col("newest_ms") - delay_ms
    )
    last = overdue.groupBy("source").agg(F.max("arrival_seq").alias("__last"))
    start = F.greatest("next_seq", F.col("__last") + 1)
    return settle(sources.join(last, "source", "left").withColumn("start", start).drop("__last"), "starts")


def _numbers(messages: DataFrame, starts: DataFrame, wanted) -> DataFrame:
    """The different numbers that fulfil a condition."""
    return messages.select("source", "arrival_seq").join(starts, "source").where(wanted).distinct()


def _holes(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """The numbers missing between where a source stood and where it goes on."""
    spark = messages.sparkSession
    moved = starts.where("start > next_seq").select("source", "next_seq", "start")
    if moved.isEmpty():
        return spark.createDataFrame([], HOLES)
    between = (F.col("arrival_seq") >= F.col("next_seq")) & (F.col("arrival_seq") < F.col("start"))
    found = _numbers(messages, moved, between).select("source", "arrival_seq")
    edges = moved.select("source", (F.col("next_seq") - 1).alias("arrival_seq"))
    islands = (
        number_in_order(found.unionByName(edges))
        .groupBy("source", (F.col("arrival_seq") - F.col("ordinal")).alias("island"))
        .agg(
            F.min("arrival_seq").alias("first"),
            F.max("arrival_seq").alias("last"),
            F.min("ordinal").alias("begin"),
            F.max("ordinal").alias("end"),
        )
    )
    islands = settle(islands, "islands")
    before = islands.select("source", (F.col("end") + 1).alias("begin"), (F.col("last") + 1).alias("first_seq"))
    after = islands.select("source", "begin", (F.col("first") - 1).alias("last_seq"))
    return before.join(after, ["source", "begin"]).select(*HOLES.names)
