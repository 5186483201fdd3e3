"""Continuous ingest: messages are cut into batches, numbered, written once.

A batch stays open from one micro-batch to the next until it is full, its time is up, or a gap ends
it. The messages of a source's open batch, no more than a batch holds and without their bodies, are kept with the
positions; the next micro-batch cuts them again in front of its own messages, so the batches are
those of ``batch_by_limits`` however the stream is split. That takes no task per source either.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from postlane.operators.batching import number_in_order
from postlane.operators.delivery import DELIVERED, FIRST_SEQUENCE, continue_sequence, own_key, state_snapshot
from postlane.operators.limits import cut_numbered
from postlane.operators.records import to_records
from postlane.operators.routing import route_by
from postlane.options import IngestOptions, delivery_mode
from postlane.schemas import OFFSETS, STATE
from postlane.shared import scratch, settle
from postlane.sources.state import complete_versions, forget_versions, read_table, replace_table
from postlane.streaming.reorder import FIRST_NUMBER, FRONTIER, HOLES, release_in_order

RUN = T.StructType([T.StructField("run_id", T.StringType())])
# A message of an open batch; ``ordinal`` is its place in the batch.
OPEN = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("ordinal", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("jms_timestamp", T.LongType()),
    ]
)


@dataclass(frozen=True)
class InOrder:
    """Publish each source's messages in the order of their numbers (see ``release_in_order``)."""

    delay_ms: int | None = None
    first_number: int = FIRST_NUMBER


class IngestLog:
    """What a query remembers beside its checkpoint, in numbered versions.

    ``positions`` holds the last sequence id of every source after each micro-batch, version 0
    being where the query began and version n+1 the outcome of micro-batch n; ``open`` holds the messages of
    the open batches, and ``delivered`` the last batch of every source, in the same way. ``state`` holds
    the batches of the micro-batch in flight. A micro-batch that runs again starts from the same
    positions and open batches and so finds its old sequence ids.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def begin(self, offsets: DataFrame | None) -> str:
        """Fix the starting point once; a restart finds it there. Returns the run's name."""
        run = read_table(self.spark, f"{self.path}/run", RUN).head()
        if run is not None:
            return run["run_id"]
        start = self.spark.createDataFrame([], OFFSETS) if offsets is None else offsets
        replace_table(start.select(*OFFSETS.names), f"{self.path}/positions", 0)
        name = uuid.uuid4().hex
        replace_table(self.spark.createDataFrame([(name,)], RUN), f"{self.path}/run", 0)
        return name

    def positions(self, before_batch: int | None = None) -> DataFrame:
        bound = None if before_batch is None else before_batch + 1
        return read_table(self.spark, f"{self.path}/positions", OFFSETS, bound)

    def in_flight(self) -> DataFrame:
        """The state rows of the newest micro-batch."""
        return read_table(self.spark, f"{self.path}/state", STATE)

    def record_units(self, batch_id: int, units: DataFrame) -> DataFrame:
        replace_table(units.select(*STATE.names), f"{self.path}/state", batch_id)
        return self.spark.read.schema(STATE).parquet(f"{self.path}/state/version={batch_id}")

    def open_messages(self, before_batch: int) -> DataFrame:
        return read_table(self.spark, f"{self.path}/open", OPEN, before_batch + 1)

    def delivered(self, before_batch: int | None = None) -> DataFrame:
        """One state row per source: its last batch, as far as it is delivered."""
        bound = None if before_batch is None else before_batch + 1
        return read_table(self.spark, f"{self.path}/delivered", STATE, bound)

    def commit(self, batch_id: int, known: DataFrame, units: DataFrame, still_open: DataFrame) -> None:
        moved = units.select("source", "sequence_id")
        merged = known.unionByName(moved).groupBy("source").agg(
            F.max("sequence_id").alias("sequence_id")
        )
        latest = self.delivered(batch_id).unionByName(units.withColumn("last_known_state", F.lit(DELIVERED)))
        latest = latest.groupBy("source").agg(F.max_by(F.struct(*STATE.names), "sequence_id").alias("last"))
        replace_table(still_open.select(*OPEN.names), f"{self.path}/open", batch_id + 1)
        replace_table(latest.select("last.*"), f"{self.path}/delivered", batch_id + 1)
        replace_table(merged, f"{self.path}/positions", batch_id + 1)
        # A restart can only repeat the newest micro-batch, so older versions are done with.
        for kind in ("positions", "state", "open", "delivered"):
            forget_versions(self.spark, f"{self.path}/{kind}", batch_id)

    def waiting(self, schema: T.StructType, before_batch: int | None = None) -> DataFrame:
        """The messages that wait for earlier ones."""
        bound = None if before_batch is None else before_batch + 1
        return read_table(self.spark, f"{self.path}/waiting", schema, bound)

    def frontier(self, before_batch: int | None = None) -> DataFrame:
        """The number each source goes on with when messages are put in order."""
        bound = None if before_batch is None else before_batch + 1
        return read_table(self.spark, f"{self.path}/frontier", FRONTIER, bound)

    def holes(self) -> DataFrame:
        """All numbers given up so far, each when it was passed over."""
        done = complete_versions(self.spark, f"{self.path}/holes")
        if not done:
            return self.spark.createDataFrame([], HOLES)
        return self.spark.read.schema(HOLES).parquet(*[f"{self.path}/holes/version={number}" for number in done])

    def put_in_order(self, batch: DataFrame, batch_id: int, order: InOrder) -> DataFrame:
        """The messages that may be published now; the others, and where sources stand, are kept.

        All is kept under the micro-batch's number, so that one that runs again starts from the same.
        """
        waiting = self.waiting(batch.schema, batch_id)
        both = settle(batch.unionByName(waiting), "to-order")
        found = release_in_order(both, self.frontier(batch_id), order.delay_ms, order.first_number)
        replace_table(found.holes, f"{self.path}/holes", batch_id + 1)
        replace_table(found.waiting, f"{self.path}/waiting", batch_id + 1)
        replace_table(found.frontier, f"{self.path}/frontier", batch_id + 1)
        for kind in ("waiting", "frontier"):
            forget_versions(self.spark, f"{self.path}/{kind}", batch_id)
        return found.ready


def cut_onward(
    batch: DataFrame, opened: DataFrame, known: DataFrame, options: IngestOptions
) -> DataFrame:
    """The messages of open batches and of a micro-batch, cut together, with ``sequence_id`` and ``fresh``.

    The micro-batch's messages come after the open ones, whatever their numbers. ``ordinal`` is the place after the
    first message of the source's open batch.
    """
    before = opened.groupBy("source").agg(
        F.count(F.lit(1)).alias("__held"), (F.max("sequence_id") - 1).alias("__open_base")
    )
    new = number_in_order(batch).join(before.select("source", "__held"), "source", "left")
    new = new.withColumn("ordinal", F.col("ordinal") + F.coalesce("__held", F.lit(0))).drop("__held")
    old = opened.drop("sequence_id").withColumn("fresh", F.lit(False))
    both = new.withColumn("fresh", F.lit(True)).unionByName(old, allowMissingColumns=True)
    both = both.withColumn("fresh", F.coalesce("fresh", F.lit(False)))
    cut = cut_numbered(both, options.batch_size, options.max_poll_ms, options.gap_ms or None)
    bases = known.join(before, "source", "full").select(
        "source", F.coalesce("__open_base", "sequence_id", F.lit(FIRST_SEQUENCE)).alias("base")
    )
    return continue_sequence(cut, settle(bases, "bases")).drop("batch_no")


def open_batches(cut: DataFrame, options: IngestOptions) -> DataFrame:
    """The messages (``OPEN``) of the last batch of each source that a further message may still join.

    A last batch is closed when it is full or its last message has reached the deadline. Whether a gap has
    ended it only the next message tells.
    """
    ms = F.coalesce("jms_timestamp", F.lit(0).cast("long"))
    sizes = cut.groupBy("source", "sequence_id").agg(
        F.count(F.lit(1)).alias("held"),
        F.min(F.struct("ordinal", ms.alias("ms"))).alias("first"),
        F.max(F.struct("ordinal", ms.alias("ms"))).alias("last"),
    )
    newest = sizes.groupBy("source").agg(
        F.max_by(F.struct("sequence_id", "held", "first", "last"), "sequence_id").alias("at")
    )
    full = F.col("at.held") >= options.batch_size
    if options.max_poll_ms > 0:
        full = full | (F.col("at.last.ms") >= F.col("at.first.ms") + options.max_poll_ms)
    left = newest.where(~full).select(
        "source", F.col("at.sequence_id").alias("sequence_id"), (F.col("at.first.ordinal") - 1).alias("__before")
    )
    return (
        cut.join(left, ["source", "sequence_id"])
        .withColumn("ordinal", F.col("ordinal") - F.col("__before"))
        .select(*OPEN.names)
    )


def publish_batch(
    batch: DataFrame,
    batch_id: int,
    options: IngestOptions,
    sink: str,
    log: IngestLog,
    run: str,
    in_order: InOrder | None = None,
) -> None:
    """One micro-batch: what waits, then state, then records, then positions.

    All are overwritten when the micro-batch runs again, so nothing appears twice.
    """
    folder = f"{sink}/run={run}/batch_id={batch_id}"
    with scratch():
        if in_order is not None:
            batch = log.put_in_order(batch, batch_id, in_order)
        if delivery_mode(options) == "at-least-once":
            records = to_records(batch.withColumn("sequence_id", F.lit(None).cast("long")), options)
            _write(route_by(records, options), folder)
            return
        known = log.positions(batch_id)
        # Written once, so that the input is read once however often the batches are looked at.
        cut = settle(cut_onward(batch, log.open_messages(batch_id), known, options), "micro-batch")
        units = log.record_units(batch_id, state_snapshot(cut, order="ordinal"))
        records = to_records(cut.where("fresh").drop("fresh", "ordinal"), options)
        _write(route_by(records, options), folder)
        # Open batches of sources without new messages are part of the cut, too.
        log.commit(batch_id, known, units, open_batches(cut, options))


def _write(records: DataFrame, folder: str) -> None:
    records.write.mode("overwrite").partitionBy("topic").parquet(folder)


def run_ingest(
    stream: DataFrame,
    options: IngestOptions,
    sink: str,
    checkpoint: str,
    offsets: DataFrame | None = None,
    trigger: dict | None = None,
    in_order: InOrder | None = None,
) -> StreamingQuery:
    """Start publishing a message stream below ``sink``.

    ``offsets`` says where sequence ids begin for a new checkpoint and is ignored by a restart.
    The sink holds ``run=…/batch_id=…/topic=…`` folders. With ``in_order`` a source's messages are published in
    the order of their numbers, over micro-batches too; those that wait stay in the log until a later one.
    """
    spark = stream.sparkSession
    log = IngestLog(spark, f"{checkpoint}-log")
    run = log.begin(offsets)

    def publish(batch: DataFrame, batch_id: int) -> None:
        publish_batch(batch, batch_id, options, sink, log, run, in_order)

    writer = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def dedupe_stream(records: DataFrame, delay: str) -> DataFrame:
    """Drop copies that arrive within ``delay`` of the first, with bounded state.

    Time is that of arrival, so a message is never late, however old it is: each comes out once at
    least, and a copy that arrives after ``delay`` may come out again. Records without an id are
    never taken for copies of each other.
    """
    return (
        records.withColumns({"__key": own_key(), "__arrived": F.current_timestamp()})
        .withWatermark("__arrived", delay)
        .dropDuplicatesWithinWatermark(["source", "__key"])
        .drop("__key", "__arrived")
    )
