"""Delivery bookkeeping: sequence ids, in-flight state, recovery, duplicates, audits.

State and offset tables have one row per source; message tables may be of any size and one
source may hold most of them, so nothing here groups or sorts a message table by source alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.shared import gate, settle
from postlane.sources.messages import holds_more_than_one, peek

# States, start-up actions and the field order of state texts.
IN_FLIGHT = "IN_FLIGHT"
DELIVERED = "DELIVERED"
NORMAL = "NORMAL_OPERATION"
REMOVE = "REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE"
REDELIVER = "REDELIVER_UNSENT_BATCH"
STATE_FIELDS = ("sequenceId", "messageIds", "lastKnownState")
FIRST_SEQUENCE = 0

STOPPED = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("failed_batch", T.LongType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("class", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

STATE_JSON = T.StructType(
    [
        T.StructField("sequenceId", T.LongType()),
        T.StructField("messageIds", T.ArrayType(T.StringType())),
        T.StructField("lastKnownState", T.StringType()),
    ]
)


class DeliveryStateError(RuntimeError):
    """Stored state and messages contradict each other; a person has to look."""


def _fail_if_any(bad: DataFrame, complaint: str) -> None:
    """Raise with a few of the offending sources named."""
    found = [row["source"] for row in bad.select("source").limit(5).collect()]
    if found:
        raise DeliveryStateError(f"{complaint}: {', '.join(map(str, found))}")


def sequence_bases(state: DataFrame, offsets: DataFrame) -> DataFrame:
    """Where the sequence of each source stands: at its state, else its offset."""
    from_state = state.select("source", F.col("sequence_id").alias("state_id"))
    from_offset = offsets.select("source", F.col("sequence_id").alias("offset_id"))
    return from_state.join(from_offset, "source", "full").select(
        "source", F.coalesce("state_id", "offset_id").alias("base")
    )


def continue_sequence(batched: DataFrame, bases: DataFrame) -> DataFrame:
    """Add ``sequence_id``: one per batch, counting on from ``base``, or from 0.

    ``bases`` has one row per source and should be a stored table: the planner then knows
    whether it is small enough to be sent to the messages instead of shuffling them.
    """
    return (
        batched.join(bases.select("source", "base"), "source", "left")
        .withColumn("sequence_id", F.coalesce("base", F.lit(FIRST_SEQUENCE)) + F.col("batch_no"))
        .drop("base")
    )


def assign_sequence(batched: DataFrame, state: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``sequence_id``: one per batch, counting on from the state, the offset, or 0."""
    return continue_sequence(batched, settle(sequence_bases(state, offsets), "bases"))


def state_snapshot(
    sequenced: DataFrame, last_known_state: str = IN_FLIGHT, order: str = "arrival_seq"
) -> DataFrame:
    """The state row of every batch: its message ids in arrival order.

    A group is one batch, so its list is no longer than the batch size.
    """
    listed = F.sort_array(F.collect_list(F.struct(order, "message_id")))
    return (
        sequenced.groupBy("source", "sequence_id")
        .agg(listed.alias("__listed"))
        .select(
            "source",
            "sequence_id",
            F.col("__listed.message_id").alias("message_ids"),
            F.lit(last_known_state).alias("last_known_state"),
        )
    )


def encode_state(state: DataFrame) -> DataFrame:
    """``source`` and the state as JSON text."""
    columns = ("sequence_id", "message_ids", "last_known_state")
    fields = [F.col(name).alias(field) for name, field in zip(columns, STATE_FIELDS)]
    return state.select("source", F.to_json(F.struct(*fields)).alias("state_json"))


def decode_state(texts: DataFrame) -> DataFrame:
    """State rows from their JSON texts; a text that is no state fails the job."""
    schema = T.StructType([*STATE_JSON.fields, T.StructField("__corrupt", T.StringType())])
    parsed = texts.withColumn(
        "__state",
        F.from_json("state_json", schema, {"columnNameOfCorruptRecord": "__corrupt"}),
    )
    found = F.col("__state")
    known = found["lastKnownState"].isNull() | found["lastKnownState"].isin(IN_FLIGHT, DELIVERED)
    fields = F.json_object_keys("state_json")
    usable = (
        found["__corrupt"].isNull()
        & known
        & (F.size(F.array_except(fields, F.array(*map(F.lit, STATE_FIELDS)))) == 0)
    )
    complaint = F.concat(F.lit("not a delivery state: "), F.coalesce("state_json", F.lit("null")))
    return gate(parsed, F.coalesce(usable, F.lit(False)), F.raise_error(complaint)).select(
        "source",
        F.coalesce(found["sequenceId"], F.lit(FIRST_SEQUENCE)).alias("sequence_id"),
        found["messageIds"].alias("message_ids"),
        found["lastKnownState"].alias("last_known_state"),
    )


def state_conflicts(state: DataFrame) -> DataFrame:
    """Sources with more than one state row."""
    return holds_more_than_one(state, "source").where("more_than_one").select("source")


def validate_state(state: DataFrame) -> DataFrame:
    """The state table itself, once it is sure that no source has two rows."""
    _fail_if_any(state_conflicts(state), "more than one delivery state for")
    return state


def latest_offset(records: DataFrame) -> DataFrame:
    """The last committed sequence id per source; sources without one are absent."""
    return (
        records.where(F.col("sequence_id").isNotNull())
        .groupBy("source")
        .agg(F.max("sequence_id").alias("sequence_id"))
    )


def recovery_plan(state: DataFrame, offsets: DataFrame) -> DataFrame:
    """What to do for each source before normal work, and where its sequence stands.

    The plan is read by several later jobs, so it is settled once.
    """
    left = state.select(
        "source",
        F.col("sequence_id").alias("state_id"),
        "message_ids",
        "last_known_state",
    )
    right = offsets.select("source", F.col("sequence_id").alias("offset_id"))
    proven = F.coalesce("offset_id", F.lit(-1)) == F.col("state_id")
    action = (
        F.when(F.col("last_known_state") == DELIVERED, REMOVE)
        .when((F.col("last_known_state") == IN_FLIGHT) & proven, REMOVE)
        .when(F.col("last_known_state") == IN_FLIGHT, REDELIVER)
        .otherwise(NORMAL)
    )
    plan = left.join(right, "source", "full").select(
        "source",
        "state_id",
        "offset_id",
        "last_known_state",
        action.alias("action"),
        F.coalesce("state_id", "offset_id", F.lit(FIRST_SEQUENCE)).alias("base_sequence_id"),
        "message_ids",
    )
    return settle(plan, "recovery-plan")


def promote_state(state: DataFrame, plan: DataFrame) -> DataFrame:
    """The state table with batches marked delivered where the offset proves it."""
    removing = plan.where(F.col("action") == REMOVE).select("source", F.lit(True).alias("__sent"))
    settled = F.when(F.col("__sent"), F.lit(DELIVERED)).otherwise(F.col("last_known_state"))
    return (
        state.join(removing, "source", "left")
        .withColumn("last_known_state", settled)
        .drop("__sent")
    )


def recovery_ready(messages: DataFrame, plan: DataFrame) -> DataFrame:
    """Whether each recovering source shows its unfinished batch at the head, or must wait."""
    heads = peek(messages).select("source", F.col("message_id").alias("head_id"))
    there = F.coalesce(F.array_contains("message_ids", F.col("head_id")), F.lit(False))
    return (
        plan.where(F.col("action") != NORMAL)
        .join(heads, "source", "left")
        .select("source", "action", "head_id", F.when(there, "ready").otherwise("wait").alias("decision"))
    )



def planned_ids(plan: DataFrame, *actions: str) -> DataFrame:
    """The messages of unfinished batches, one row each; at most one batch per source."""
    return (
        plan.where(F.col("action").isin(*actions))
        .select(
            "source",
            F.col("state_id").alias("sequence_id"),
            F.explode("message_ids").alias("message_id"),
        )
        .dropDuplicates(["source", "message_id"])
    )


def redeliver(messages: DataFrame, plan: DataFrame) -> DataFrame:
    """The messages of unsent batches, with the sequence id they had before."""
    return messages.join(planned_ids(plan, REDELIVER), ["source", "message_id"]).select(
        *messages.columns, "sequence_id"
    )


def foreign_heads(messages: DataFrame, plan: DataFrame, *actions: str) -> DataFrame:
    """Sources whose first messages are not all from the batch that the plan names.

    With k messages in the batch, the first k must all be known. That is so exactly when all k come
    before the first unknown message. One pass finds the first place of each known message, and of all unknown ones
    together: at most k + 1 rows of a source, whatever its size, are left before anything moves.
    """
    actions = actions or (REMOVE,)
    ids = planned_ids(plan, *actions).select("source", "message_id", F.lit(True).alias("__known"))
    expected = plan.where(F.col("action").isin(*actions)).select(
        "source", F.size(F.array_distinct(F.coalesce("message_ids", F.array()))).alias("expected")
    )
    places = (
        messages.select("source", "arrival_seq", "message_id")
        .join(expected, "source", "left_semi")
        .join(ids, ["source", "message_id"], "left")
        .groupBy("source", F.when(F.col("__known"), F.col("message_id")).alias("known"))
        .agg(F.min("arrival_seq").alias("place"))
    )
    unknown = F.min(F.when(F.col("known").isNull(), F.col("place"))).alias("unknown")
    known = F.collect_list(F.when(F.col("known").isNotNull(), F.col("place"))).alias("known")
    heads = places.groupBy("source").agg(unknown, known)
    before = F.filter("known", lambda place: F.col("unknown").isNull() | (place < F.col("unknown")))
    return (
        expected.join(heads.select("source", F.size(before).alias("leading")), "source", "left")
        .where(F.coalesce("leading", F.lit(0)) < F.col("expected"))
        .select("source")
    )


def check_heads(messages: DataFrame, plan: DataFrame, *actions: str) -> None:
    """Fail when a source does not begin with the messages of its unfinished batch."""
    _fail_if_any(foreign_heads(messages, plan, *actions), "unexpected messages before the unfinished batch of")


def check_removal(messages: DataFrame, plan: DataFrame) -> None:
    """Fail when a source does not begin with the messages it has delivered."""
    _fail_if_any(foreign_heads(messages, plan), "unexpected messages before the delivered batch of")


def drop_delivered(messages: DataFrame, plan: DataFrame) -> DataFrame:
    """The messages without those a previous run has delivered already."""
    check_removal(messages, plan)
    return messages.join(planned_ids(plan, REMOVE), ["source", "message_id"], "left_anti").select(
        *messages.columns
    )


def own_key() -> Column:
    """What makes a message the same message: its id; without one, its place."""
    return F.coalesce(
        F.concat(F.lit("id "), F.col("message_id")),
        F.concat(F.lit("no "), F.col("arrival_seq").cast("string")),
    )


def merge_copies(records: DataFrame, order: tuple[str, ...] = ("arrival_seq",)) -> DataFrame:
    """One record per message, the earliest, in one shuffle of all records.

    Copies are merged before the shuffle, so a message copied very often stays a few rows.
    """
    kept = F.min_by(F.struct(*records.columns), F.struct(*order)).alias("__kept")
    return records.groupBy("source", own_key().alias("__key")).agg(kept).select("__kept.*")


def dedupe(records: DataFrame, order: tuple[str, ...] = ("arrival_seq",)) -> DataFrame:
    """One record per message: the earliest copy. Records without an id are left apart.

    There is one plan whatever the number of copies, and the records are evaluated once.
    """
    return merge_copies(records, order)


def first_failed_batch(records: DataFrame, failed: Column | None = None) -> DataFrame:
    """The first batch of each source that holds a failed record."""
    failed = F.col("error").isNotNull() if failed is None else failed
    return (
        records.where(failed)
        .groupBy("source")
        .agg(F.min("batch_no").alias("failed_batch"))
    )


def committed_prefix(records: DataFrame) -> DataFrame:
    """Add ``committed``: false from the first batch on that holds a failed record.

    A batch fails as a unit, and a source stops at its first failed batch.
    """
    failed = settle(first_failed_batch(records), "failed-batches")
    before = F.col("failed_batch").isNull() | (F.col("batch_no") < F.col("failed_batch"))
    return (
        records.join(failed, "source", "left").withColumn("committed", before).drop("failed_batch")
    )


def stopped_sources(records: DataFrame) -> DataFrame:
    """Each source's first batch with a failed record, and the first failure in it (``STOPPED``)."""
    first = F.min(
        F.when(
            F.col("error").isNotNull(),
            F.struct("batch_no", "arrival_seq", F.col("error.class"), F.col("error.message")),
        )
    ).alias("first")
    found = records.groupBy("source").agg(first).where("first IS NOT NULL")
    return found.select(
        "source",
        F.col("first.batch_no").alias("failed_batch"),
        F.col("first.arrival_seq").alias("arrival_seq"),
        F.col("first.class").alias("class"),
        F.col("first.message").alias("message"),
    )


def before_stop(records: DataFrame, stopped: DataFrame) -> DataFrame:
    """The records of the batches before the one at which their source stops."""
    stops = stopped.select("source", "failed_batch")
    before = F.col("failed_batch").isNull() | (F.col("batch_no") < F.col("failed_batch"))
    return records.join(stops, "source", "left").where(before).drop("failed_batch")


def delivery_audit(sequenced: DataFrame, acks: DataFrame) -> DataFrame:
    """Expected and acknowledged messages per batch; a batch is complete when all are there."""
    keys = ["source", "sequence_id", "message_id"]
    acked = acks.select(*keys).dropDuplicates(keys).withColumn("__acked", F.lit(True))
    return (
        sequenced.select(*keys)
        .join(acked, keys, "left")
        .groupBy("source", "sequence_id")
        .agg(
            F.count(F.lit(1)).alias("expected"),
            F.count("__acked").alias("acked"),
        )
        .withColumn("complete", F.col("acked") == F.col("expected"))
    )
