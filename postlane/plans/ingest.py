"""The steps put together for tables: recover what a lost run left, then publish the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.operators.delivery import (
    DELIVERED,
    REDELIVER,
    REMOVE,
    STOPPED,
    assign_sequence,
    before_stop,
    check_heads,
    check_removal,
    continue_sequence,
    planned_ids,
    promote_state,
    recovery_plan,
    redeliver,
    stopped_sources,
    validate_state,
)
from postlane.operators.limits import batch_by_limits
from postlane.operators.records import to_records
from postlane.operators.routing import route_by
from postlane.options import IngestOptions, delivery_mode
from postlane.shared import settle
from postlane.sources.ledger import Ledger, batches_in_flight, beyond
from postlane.sources.topics import write_topics


@dataclass(frozen=True)
class Recovery:
    """What a start finds, for all sources at once."""

    plan: DataFrame
    state: DataFrame
    unsent: DataFrame
    waiting: DataFrame


def recover(messages: DataFrame, state: DataFrame, offsets: DataFrame) -> Recovery:
    """Decide per source, and split its messages accordingly.

    ``unsent`` has the messages to deliver again, under their old sequence id; ``waiting`` has
    those to start normal work with, without the delivered and without the unsent ones.
    """
    plan = recovery_plan(validate_state(state), offsets)
    check_removal(messages, plan)
    planned = planned_ids(plan, REMOVE, REDELIVER)
    waiting = messages.join(planned, ["source", "message_id"], "left_anti")
    return Recovery(
        plan,
        promote_state(state, plan),
        redeliver(messages, plan),
        waiting.select(*messages.columns),
    )


def cut_batches(messages: DataFrame, options: IngestOptions) -> DataFrame:
    """Add ``batch_no`` by the size and time limits of the options."""
    return batch_by_limits(
        messages, options.batch_size, options.max_poll_ms, options.gap_ms or None
    )


def table_records(
    messages: DataFrame, options: IngestOptions, state: DataFrame, offsets: DataFrame
) -> DataFrame:
    """All records of a message table, routed, and numbered when delivery is exactly once."""
    if delivery_mode(options) == "at-least-once":
        numbered = messages.withColumn("sequence_id", F.lit(None).cast("long"))
    else:
        numbered = assign_sequence(cut_batches(messages, options), state, offsets)
    return route_by(to_records(numbered, options), options)


def publish_table(
    messages: DataFrame,
    options: IngestOptions,
    state: DataFrame,
    offsets: DataFrame,
    sink: str,
) -> DataFrame | None:
    """Publish what is new in a message table to topic folders below ``sink``, each message once.

    The first call starts from ``state`` and ``offsets``; later ones go on where the sink's own
    ledger stands, finishing first what a lost run left open. Without tolerance a source stops before its first batch that
    holds an unreadable message; that batch and all after it wait for a later call. Returns the
    stopped sources with their reasons. With at-least-once delivery records are appended, and nothing is returned.
    """
    if delivery_mode(options) == "at-least-once":
        write_topics(table_records(messages, options, state, offsets), sink)
        return None
    ledger = Ledger(messages.sparkSession, sink)
    if not ledger.begun():
        begin_ledger(ledger, messages, state, offsets)
    finish_open_unit(ledger, messages, options)
    return publish_waiting(ledger, messages, options)


def begin_ledger(ledger: Ledger, messages: DataFrame, state: DataFrame, offsets: DataFrame) -> None:
    """Take over the state and offsets of an earlier run: nothing delivered comes again, nothing unsent is lost."""
    plan = recovery_plan(validate_state(state), offsets)
    check_heads(messages, plan, REMOVE, REDELIVER)
    heads = messages.select("source", "arrival_seq", "message_id").join(
        planned_ids(plan, REMOVE), ["source", "message_id"]
    )
    last = heads.groupBy("source").agg(F.max(F.struct("arrival_seq", "message_id")).alias("last"))
    # A batch to redeliver is not delivered yet: its source stands at the number before it.
    redelivered = F.col("action") == REDELIVER
    delivered = plan.join(settle(last, "last-delivered"), "source", "left").select(
        "source",
        (F.col("base_sequence_id") - F.when(redelivered, 1).otherwise(0)).alias("sequence_id"),
        F.when(~redelivered, F.col("message_ids")).alias("message_ids"),
        F.when(~redelivered, DELIVERED).alias("last_known_state"),
        F.col("last.arrival_seq").alias("arrival_seq"),
        F.col("last.message_id").alias("message_id"),
    )
    unsent = settle(batches_in_flight(redeliver(messages, plan)), "unsent")
    ledger.begin(delivered, None if unsent.isEmpty() else unsent)


def finish_open_unit(ledger: Ledger, messages: DataFrame, options: IngestOptions) -> None:
    """Finish the unit a lost run left: its records again unless readers see them already, then its end."""
    unit = ledger.open_unit()
    if unit is None:
        return
    if unit not in ledger.visible():
        records = to_records(ledger.messages_of(messages, unit), options)
        ledger.write_records(unit, route_by(records, options))
        ledger.write_manifest(unit)
    ledger.write_delivered(unit)


def publish_waiting(ledger: Ledger, messages: DataFrame, options: IngestOptions) -> DataFrame:
    """Publish the messages after those delivered as one unit; returns the sources that stopped."""
    delivered = ledger.delivered()
    bases = delivered.select("source", F.col("sequence_id").alias("base"))
    sequenced = continue_sequence(cut_batches(beyond(messages, delivered), options), bases)
    strict = options.tolerance == "none"
    if strict:
        # Written once with their errors: where a source stops is known only when all bodies were read.
        records = settle(to_records(sequenced, options), "records")
        stopped = settle(stopped_sources(records), "stopped")
        records = before_stop(records, stopped)
        sequenced = records
    else:
        records = to_records(sequenced, options)
        stopped = messages.sparkSession.createDataFrame([], STOPPED)
    unit = ledger.next_unit()
    batches = settle(
        batches_in_flight(sequenced.select("source", "sequence_id", "arrival_seq", "message_id")), "batches"
    )
    if not batches.isEmpty():
        ledger.write_state(unit, batches)
        ledger.write_records(unit, route_by(records, options).drop("batch_no"))
        ledger.write_manifest(unit)
        ledger.write_delivered(unit)
    return stopped
