"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlane.functions import failures, headers, values
from postlane.functions.encoding import to_topic_rows
from postlane.functions.keys import with_key
from postlane.operators import delivery, routing
from postlane.operators.batching import batch_by_count, number_in_order, partition_by_key, partition_offsets
from postlane.operators.limits import batch_by_limits
from postlane.operators.records import to_records, with_position
from postlane.options import IngestOptions
from postlane.plans import fixtures
from postlane.plans.ingest import publish_table, publish_waiting
from postlane.schemas import ERROR, OFFSETS, STATE
from postlane.shared import new_folder, settle
from postlane.sources import messages as envelopes
from postlane.sources.ledger import Ledger, read_published
from postlane.sources.topics import read_topic, write_topics
from postlane.streaming.ingest import IngestLog, InOrder, dedupe_stream, run_ingest

Query = Callable[[SparkSession, str], DataFrame]

MAIN = "events.main"
DEAD = "events.dead"
JSON_TO_DEAD = IngestOptions(
    topic=MAIN,
    queue="Q",
    builder="json",
    body_jms=True,
    key_header="JMSMessageID",
    tolerance="all",
    dlq_topic=DEAD,
)
JSON_WITH_HEADERS = IngestOptions(
    topic=MAIN,
    queue="Q",
    builder="json",
    body_jms=True,
    copy_properties=True,
    tolerance="all",
    dlq_topic=DEAD,
    dlq_context_headers=True,
)
NUMBERED = replace(JSON_TO_DEAD, state_queue="STATE", tasks_max="1")
TYPED = IngestOptions(topic=MAIN, body_jms=True, tolerance="all", copy_properties=True)
POSITION = ("source", "arrival_seq")
GRAVE_VALUE = 250.0
LIMIT_SIZE, LIMIT_MS, GAP_MS = 10, 8 * 3_600_000, 2 * 3_600_000


def routed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records keyed by message id, unreadable ones to the dead-letter topic."""
    records = to_records(fixtures.event_messages(spark, sf_dir), JSON_TO_DEAD)
    return routing.route_by(records, JSON_TO_DEAD)


def _topic_summary(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"),
        F.count("key_text").alias("keyed"),
        F.sum(F.try_variant_get("value_json", "$.k", "bigint")).alias("sum_k"),
        F.sum(F.length("value_bytes")).cast("bigint").alias("dead_bytes"),
    )


def flagship_route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topic_summary(routed_events(spark, sf_dir))


def _key_query(key_header: str | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        keyed = with_key(fixtures.event_messages(spark, sf_dir), key_header)
        return keyed.select(
            *POSITION,
            "key_type",
            "key_text",
            F.lower(F.hex("key_bytes")).alias("key_hex"),
            F.col("key_error.class").alias("error"),
        )

    return query


def key_group_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_key(fixtures.conversation_messages(spark, sf_dir), "JMSXGroupID")
    return keyed.select("arrival_seq", "key_text", F.md5("body_text").alias("body_md5"))


def partitions_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = IngestOptions(topic="talk", body_jms=True, key_header="JMSXGroupID")
    records = to_records(fixtures.conversation_messages(spark, sf_dir), options)
    return (
        partition_by_key(routing.route_by(records, options), 16)
        .groupBy("key_text")
        .agg(
            F.count_distinct("topic_partition").alias("partitions"),
            F.count(F.lit(1)).alias("records"),
        )
    )


def partition_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of each key's records as a reader of its topic partition sees them; one key has a third of all."""
    hot = F.when(F.col("arrival_seq") % 3 == 0, F.lit("GROUP-hot")).otherwise(F.col("group_id"))
    messages = fixtures.event_messages(spark, sf_dir).withColumn("group_id", hot)
    keyed = with_key(messages.select(*POSITION, "group_id"), "JMSXGroupID").where("key_text IS NOT NULL")
    placed = partition_offsets(keyed, 16).select(*POSITION, "key_text", "topic_partition", "topic_offset")
    seen = number_in_order(settle(placed, "offsets"), by="key_text", order="topic_offset")
    return seen.select(*POSITION, "key_text", F.col("ordinal").alias("key_place"))


def _value_summary(built: DataFrame) -> DataFrame:
    return built.select(
        *POSITION,
        "value_type",
        F.md5("value_text").alias("text_md5"),
        F.md5("value_bytes").alias("bytes_md5"),
        F.length("value_bytes").cast("long").alias("n_bytes"),
        F.col("value_error.message").alias("error"),
    )


def value_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_summary(values.build_raw(fixtures.event_messages(spark, sf_dir)))


def value_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_summary(values.build_typed(fixtures.event_messages(spark, sf_dir)))


def value_raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_summary(values.build_raw(fixtures.document_messages(spark, sf_dir)))


def value_typed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _value_summary(values.build_typed(fixtures.document_messages(spark, sf_dir)))


def value_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = values.build_json(fixtures.event_messages(spark, sf_dir))
    return built.select(
        *POSITION,
        "value_type",
        F.try_variant_get("value_json", "$.k", "bigint").alias("k"),
        F.col("value_error.class").alias("error"),
    )


def value_json_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = values.build_json(
        fixtures.order_json_messages(spark, sf_dir), schema=fixtures.ORDER_SCHEMA
    )
    return built.select(
        "arrival_seq",
        "value_type",
        F.col("value.order_key").alias("order_key"),
        F.col("value.status").alias("status"),
        F.col("value.even").alias("even"),
        F.array_join("value.marks", "|").alias("marks"),
        F.col("value.placed_by.priority").alias("priority"),
        F.col("value.placed_by.customer").alias("customer"),
        F.col("value_error.class").alias("error"),
    )


def value_json_embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = values.build_json(
        fixtures.order_envelope_messages(spark, sf_dir), schemas_enable=True
    )
    fields = {"order_key": "bigint", "customer": "int", "status": "string", "priority": "string"}
    return built.select(
        "arrival_seq",
        "value_type",
        *[
            F.try_variant_get("value_json", f"$.{name}", kind).alias(name)
            for name, kind in fields.items()
        ],
        F.col("value_error.class").alias("error"),
    )


def value_json_many_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = values.build_json(fixtures.order_version_messages(spark, sf_dir), schemas_enable=True)
    fields = {"order_key": "bigint", "total": "double", "version": "int"}
    return built.select(
        "arrival_seq",
        "value_type",
        *[F.try_variant_get("value_json", f"$.{name}", kind).alias(name) for name, kind in fields.items()],
        F.col("value_error.class").alias("error"),
    )


def value_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = values.build_xml(
        fixtures.order_xml_messages(spark, sf_dir),
        "Key long NOT NULL, Status string, Priority string",
        root="Order",
    )
    return built.select(
        "arrival_seq",
        F.col("value.Key").alias("order_key"),
        F.col("value.Status").alias("status"),
        F.col("value.Priority").alias("priority"),
        F.col("value_error.class").alias("error"),
    )


def value_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    def speaker_lines(messages: DataFrame) -> DataFrame:
        role = headers.header("role", headers=headers.property_headers())
        line = F.concat(role, F.lit("> "), "body_text")
        return messages.withColumns({"value_type": F.lit("STRING"), "value_text": line})

    options = IngestOptions(topic="talk", builder=speaker_lines)
    records = to_records(fixtures.conversation_messages(spark, sf_dir), options)
    return routing.route_by(records, options).select(
        "topic", *POSITION, "value_type", F.md5("value_text").alias("text_md5")
    )


def _with_all_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.event_messages(spark, sf_dir)
    return headers.with_headers(messages, copy=True, descriptor_fields=True)


def headers_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = headers.explode_headers(
        _with_all_headers(spark, sf_dir).select("arrival_seq", "headers")
    )
    return exploded.select(
        "arrival_seq", "position", "key", "type", "text", F.hex("bytes").alias("bytes_hex")
    )


def headers_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    copied = headers.with_headers(fixtures.event_messages(spark, sf_dir), copy=True)
    return copied.select(
        "arrival_seq",
        headers.header("event_type").alias("event_type"),
        headers.header("user_id", "bigint").alias("user_id"),
        headers.header("flag", "boolean").alias("flag"),
        headers.header("small", "int").alias("small"),
        headers.header("JMS_IBM_MQMD_MsgId").alias("descriptor"),
        F.size("headers").alias("n_headers"),
    )


def _encoded_headers(mode: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        copied = _with_all_headers(spark, sf_dir).select("arrival_seq", "headers")
        entry = F.struct("type", "text", "bytes")
        return headers.explode_headers(copied).select(
            "arrival_seq", "position", headers.encode_header(entry, mode).alias("encoded")
        )

    return query


def records_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = to_records(fixtures.event_messages(spark, sf_dir), TYPED)
    placed = with_position(records, "typed.topic")
    return placed.select(
        "topic",
        *POSITION,
        "sequence_id",
        "ts_ms",
        "value_type",
        F.size("headers").alias("n_headers"),
        F.col("error.class").alias("error"),
    )


def dlq_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = to_records(fixtures.event_messages(spark, sf_dir), JSON_TO_DEAD)
    kept = routing.route(records, "all")
    return kept.select(*POSITION, "topic", F.try_variant_get("value_json", "$.k", "bigint").alias("k"))


def tolerate_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = IngestOptions(topic="talk", body_jms=True)
    records = to_records(fixtures.document_messages(spark, sf_dir), options)
    return routing.route_by(records, options).groupBy("topic", "value_type").agg(
        F.count(F.lit(1)).alias("records")
    )


def dlq_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = routing.only_topic(routed_events(spark, sf_dir), DEAD)
    return routed.select(
        *POSITION,
        "topic",
        "value_type",
        "key_text",
        "ts_ms",
        F.md5("value_bytes").alias("payload_md5"),
        F.length("value_bytes").cast("long").alias("n_bytes"),
    )


def dlq_context_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = to_records(fixtures.event_messages(spark, sf_dir), JSON_WITH_HEADERS)
    routed = routing.route(
        records, "all", DEAD, with_context=True, queue="Q", error_time_ms=F.lit(0)
    )
    routed = routing.only_topic(routed, DEAD)
    exploded = headers.explode_headers(routed.select("arrival_seq", "headers"))
    return exploded.select("arrival_seq", "position", "key", "type", "text")


def error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = to_records(fixtures.event_messages(spark, sf_dir), JSON_TO_DEAD)
    report = routing.error_report(records, include_messages=True)
    return report.withColumn("sample", F.md5("sample"))


def error_reasons_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = to_records(fixtures.event_messages(spark, sf_dir), JSON_TO_DEAD)
    return routing.report_by(records, JSON_TO_DEAD)


def error_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    def refuse(messages: DataFrame) -> DataFrame:
        told = (
            F.when(F.col("body_kind") == "text", F.concat(F.lit("no handler for "), "message_id", F.lit(" at "), "destination"))
            .when(F.col("body_kind") == "bytes", F.concat(F.lit("message "), "message_id", F.lit(" of "), "jms_timestamp", F.lit(" is late")))
            .when(F.col("body_kind") == "map", F.concat(F.lit("no reader for "), "message_id", F.lit(" at hand: ")))
            .otherwise("nothing to read")
        )
        given = {"class": F.lit("Refused"), "message": told}
        fields = [given.get(field.name, F.lit(None).cast("string")).alias(field.name) for field in ERROR.fields]
        return messages.withColumn("value_error", F.struct(*fields))

    options = IngestOptions(topic=MAIN, builder=refuse, tolerance="all")
    return routing.error_templates(to_records(fixtures.event_messages(spark, sf_dir), options))


def error_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = fixtures.table(spark, sf_dir, "conversations")
    ending = F.when(F.col("turn") % 2 == 0, " : \n").otherwise("")
    message = F.when(F.col("role") == "user", F.concat("text", ending)).when(
        F.col("role") == "assistant", F.lit(" \t ")
    )
    return turns.select("conv_id", "turn", F.md5(failures.error_reason(message)).alias("reason_md5"))


def error_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fixtures.table(spark, sf_dir, "documents")
    trace = failures.truncate_trace(F.col("text"))
    return documents.select("doc_id", F.length(trace).cast("long").alias("length"), F.md5(trace).alias("trace_md5"))


def triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events")
    code = F.expr(
        """element_at(array(2003, 2009, 2016, 2035, 2059, 2161, 2162, 2195, 2537, 2538, 1, null),
        cast(event_id % 12 + 1 AS int))"""
    )
    causes = F.array(
        F.struct(F.lit("ClientError").alias("class"), F.lit(None).cast("int").alias("reason")),
        F.struct(F.col("event_type").alias("class"), code.alias("reason")),
        F.struct(F.lit("BrokerError").alias("class"), F.lit(2003).alias("reason")),
    )
    failed = events.select("event_id", causes.alias("causes"))
    return failures.triage_failures(failed).select("event_id", "reason", "retriable", "closable")


def batches_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.batched_events(spark, sf_dir).select(*POSITION, "batch_no")


def batches_without_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = fixtures.dialogue_messages(spark, sf_dir)
    return batch_by_count(turns, 3).select(
        *POSITION, "batch_no", F.md5("body_text").alias("body_md5")
    )


def batches_by_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.event_messages(spark, sf_dir).select(*POSITION, "jms_timestamp")
    return batch_by_limits(messages, LIMIT_SIZE, LIMIT_MS, GAP_MS).select(*POSITION, "batch_no")


def _sequenced(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    batched = fixtures.batched_events(spark, sf_dir)
    batched = batched.select(*POSITION, "message_id", "batch_no", *more)
    return delivery.assign_sequence(batched, *fixtures.delivery_tables(batched))


def sequence_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sequenced(spark, sf_dir).select(*POSITION, "batch_no", "sequence_id")


def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = delivery.state_snapshot(_sequenced(spark, sf_dir))
    return state.select(
        "source",
        "sequence_id",
        F.size("message_ids").cast("long").alias("n_ids"),
        F.md5(F.array_join("message_ids", ",")).alias("ids_md5"),
        "last_known_state",
    )


def state_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = delivery.encode_state(delivery.state_snapshot(_sequenced(spark, sf_dir)))
    return texts.select("source", F.md5("state_json").alias("json_md5"))


def state_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = delivery.encode_state(delivery.state_snapshot(_sequenced(spark, sf_dir)))
    return delivery.decode_state(texts).select(
        "source", "sequence_id", F.size("message_ids").cast("long").alias("n_ids"), "last_known_state"
    )


def state_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.state_conflicts(delivery.state_snapshot(_sequenced(spark, sf_dir)))


def latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery.latest_offset(_sequenced(spark, sf_dir))


def _plan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    messages = fixtures.event_messages(spark, sf_dir)
    state, offsets = fixtures.delivery_tables(fixtures.batched_events(spark, sf_dir))
    return messages, state, delivery.recovery_plan(delivery.validate_state(state), offsets)


def recovery_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, plan = _plan(spark, sf_dir)
    return plan.select(
        "source", "state_id", "offset_id", "last_known_state", "action", "base_sequence_id"
    )


def promote_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, state, plan = _plan(spark, sf_dir)
    return delivery.promote_state(state, plan).select("source", "sequence_id", "last_known_state")


def recovery_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, _, plan = _plan(spark, sf_dir)
    return delivery.recovery_ready(messages, plan)


def recovered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.event_messages(spark, sf_dir)
    state, offsets = fixtures.delivery_tables(fixtures.batched_events(spark, sf_dir))
    sink = new_folder(spark, "topics")
    publish_table(messages, NUMBERED, state, offsets, sink)
    return (
        read_published(spark, sink)
        .groupBy("source", "sequence_id")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.col("topic") == DEAD).alias("dead"),
            F.min("arrival_seq").alias("first_seq"),
            F.max("arrival_seq").alias("last_seq"),
        )
    )


def published_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the arrivals, then the rest by a run that is lost before its records are seen, then all again."""
    messages = fixtures.event_messages(spark, sf_dir)
    none = spark.createDataFrame([], STATE), spark.createDataFrame([], OFFSETS)
    sink = new_folder(spark, "topics")
    middle = messages.agg(F.max("arrival_seq")).first()[0] // 2
    publish_table(messages.where(F.col("arrival_seq") <= middle), NUMBERED, *none, sink)
    lost = LostLedger(spark, sink)
    try:
        publish_waiting(lost, messages, NUMBERED)
    except LostRun:
        pass
    publish_table(messages, NUMBERED, *none, sink)
    publish_table(messages, NUMBERED, *none, sink)
    return _published_batches(read_published(spark, sink))


def _published_batches(published: DataFrame) -> DataFrame:
    return published.groupBy("unit", "source", "sequence_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("message_id").alias("ids"),
        F.min("arrival_seq").alias("first_seq"),
        F.max("arrival_seq").alias("last_seq"),
    ).withColumn("unit", F.col("unit").cast("long"))


class LostRun(RuntimeError):
    """Stands for the end of a process."""


class LostLedger(Ledger):
    """A ledger whose run ends when its records are written, before readers may see them."""

    def write_manifest(self, unit: int) -> None:
        raise LostRun


def strict_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without tolerance sources stop before the batch of their first grave message; a tolerant run then goes on."""

    def grave_errors(messages: DataFrame) -> DataFrame:
        built = values.build_typed(messages)
        value = headers.header("value", "double", headers=headers.property_headers())
        grave = value > GRAVE_VALUE
        return built.withColumn("value_error", F.when(grave, F.col("value_error")))

    messages = fixtures.event_messages(spark, sf_dir)
    none = spark.createDataFrame([], STATE), spark.createDataFrame([], OFFSETS)
    sink = new_folder(spark, "topics")
    strict = IngestOptions(topic=MAIN, builder=grave_errors, state_queue="STATE")
    publish_table(messages, strict, *none, sink)
    publish_table(messages, strict, *none, sink)
    publish_table(messages, replace(strict, tolerance="all"), *none, sink)
    return _published_batches(read_published(spark, sink))


def redeliver(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, _, plan = _plan(spark, sf_dir)
    return delivery.redeliver(messages, plan).select(*POSITION, "message_id", "sequence_id")


def drop_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages, _, plan = _plan(spark, sf_dir)
    return delivery.drop_delivered(messages, plan).select(*POSITION, "message_id")


def committed_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = fixtures.batched_events(spark, sf_dir)
    options = IngestOptions(topic=MAIN, body_jms=True, copy_properties=True)
    records = to_records(batched, options)
    grave = headers.header("value", "double") > GRAVE_VALUE
    records = records.withColumn("error", F.when(grave, F.col("error")))
    return delivery.committed_prefix(records).select(*POSITION, "batch_no", "committed")


def delivery_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequenced = _sequenced(spark, sf_dir, "group_id")
    lost = F.col("group_id").isNull() & (F.col("source") == "QM1/Q1")
    acks = sequenced.where(~lost)
    return delivery.delivery_audit(sequenced, acks.unionByName(acks))


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.event_messages(spark, sf_dir)
    again = messages.where(F.col("properties")[0]["text"] == "purchase")
    doubled = messages.unionByName(again).unionByName(
        again.withColumn("arrival_seq", F.col("arrival_seq") + 1_000_000_000)
    )
    return delivery.dedupe(doubled).select(*POSITION, "message_id", "body_kind")


def peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = envelopes.peek(fixtures.event_messages(spark, sf_dir))
    return heads.select(*POSITION, "message_id", "body_kind", "body_text")


def more_than_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = fixtures.event_messages(spark, sf_dir)
    return envelopes.holds_more_than_one(messages, "group_id")


def one_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = envelopes.for_source(fixtures.event_messages(spark, sf_dir), "QM1/Q2")
    return chosen.select(*POSITION, "destination", "jms_timestamp", "body_kind")


def _topic_rows(encoding: str, options: IngestOptions, load: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        records = routing.route_by(to_records(load(spark, sf_dir), options), options)
        rows = to_topic_rows(records, encoding)
        return rows.select(
            "topic",
            F.decode("key", "UTF-8").alias("key"),
            F.md5("value").alias("value_md5"),
            F.array_join(F.transform("headers", lambda h: h["key"]), ",").alias("header_keys"),
        )

    return query


def topic_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "topics")
    write_topics(routed_events(spark, sf_dir), path)
    both = read_topic(spark, path, MAIN).unionByName(read_topic(spark, path, DEAD))
    return _topic_summary(both)


def message_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = envelopes.read_messages(spark, fixtures.landed_events(spark, sf_dir).path)
    return landed.groupBy("source", "body_kind").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("arrival_seq").alias("first_seq"),
        F.max("jms_timestamp").alias("last_ms"),
    )


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fixtures.landed_events(spark, sf_dir)
    stream = envelopes.stream_messages(spark, landed.path, max_files=2 * landed.files)
    sink = new_folder(spark, "sink")
    run_ingest(stream, NUMBERED, sink, new_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(sink)


def stream_effectively_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("source", "message_id").alias("ids"),
        F.sum(F.try_variant_get("value_json", "$.k", "bigint")).alias("sum_k"),
        F.count("sequence_id").alias("numbered"),
    )


def stream_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _ingested(spark, sf_dir).groupBy("source", "sequence_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return units.groupBy("source").agg(
        F.sum("n").alias("records"),
        (F.max("n") <= JSON_TO_DEAD.batch_size).alias("units_fit"),
        (F.count(F.lit(1)) == F.max("sequence_id")).alias("no_number_missing"),
    )


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that stay open over micro-batches: those of the whole table, however it arrives."""
    landed = fixtures.landed_in_turn(spark, sf_dir)
    stream = envelopes.stream_messages(spark, landed.path, max_files=landed.files)
    options = replace(NUMBERED, batch_size=LIMIT_SIZE, max_poll_ms=LIMIT_MS, gap_ms=GAP_MS)
    sink = new_folder(spark, "sink")
    run_ingest(stream, options, sink, new_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(sink).select(*POSITION, F.col("sequence_id").alias("batch_no"))


def _delivered_in_order(
    spark: SparkSession, landed: fixtures.Landed, in_order: InOrder, options: IngestOptions = JSON_TO_DEAD
) -> tuple[DataFrame, str]:
    """The records of a stream put in order, each with its place in its queue as published, and the checkpoint."""
    stream = envelopes.stream_messages(spark, landed.path, max_files=landed.files)
    sink, checkpoint = new_folder(spark, "sink"), new_folder(spark, "checkpoint")
    run_ingest(stream, options, sink, checkpoint, in_order=in_order).awaitTermination()
    published = spark.read.parquet(sink).select(
        *POSITION, (F.col("batch_id").cast("long") * (1 << 40) + F.col("arrival_seq")).alias("published")
    )
    placed = number_in_order(settle(published, "published"), order="published")
    return placed.select(*POSITION, F.col("ordinal").alias("place")), checkpoint


def stream_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that lands out of order: each queue's messages come in order, up to a number that never comes."""
    landed = fixtures.landed_out_of_order(spark, sf_dir, "arrival_seq = held * 9 div 10")
    return _delivered_in_order(spark, landed, InOrder(), NUMBERED)[0]


def stream_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One that gives numbers up at once: the holes, and how many messages came all the same."""
    landed = fixtures.landed_out_of_order(spark, sf_dir, "arrival_seq % 100 IN (0, 1, 50)", parts=1)
    placed, checkpoint = _delivered_in_order(spark, landed, InOrder(delay_ms=0))
    came = placed.groupBy("source").agg(F.count(F.lit(1)).alias("came"), F.max("arrival_seq").alias("last_came"))
    holes = IngestLog(spark, f"{checkpoint}-log").holes()
    return came.join(holes, "source").select("source", "came", "last_came", "first_seq", "last_seq")


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = fixtures.landed_events(spark, sf_dir)
    stream = envelopes.stream_messages(spark, landed.path)
    copies = F.when(F.col("properties")[0]["text"] == "purchase", 3).otherwise(1)
    doubled = stream.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    out = new_folder(spark, "deduped")
    query = (
        dedupe_stream(doubled, "1 hour")
        .select(*POSITION, "message_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", new_folder(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    return spark.read.parquet(out)


JSON_KEYED = IngestOptions(
    topic=MAIN,
    builder="json",
    key_header="JMSMessageID",
    copy_properties=True,
    tolerance="all",
)
RAW = IngestOptions(topic="raw", key_header="JMSDestination")
TEXT_KEYED = IngestOptions(topic="text", body_jms=True, key_header="JMSMessageID")


def all_queries() -> dict[str, Query]:
    return {
        "flagship_route_counts": flagship_route_counts,
        "key_none": _key_query(None),
        "key_message_id": _key_query("JMSMessageID"),
        "key_correlation_id": _key_query("JMSCorrelationID"),
        "key_correlation_id_bytes": _key_query("JMSCorrelationIDAsBytes"),
        "key_destination": _key_query("JMSDestination"),
        "key_group_id": _key_query("JMSXGroupID"),
        "key_group_turns": key_group_turns,
        "partitions_by_key": partitions_by_key,
        "partition_order": partition_order,
        "value_raw": value_raw,
        "value_typed": value_typed,
        "value_raw_documents": value_raw_documents,
        "value_typed_documents": value_typed_documents,
        "value_json": value_json,
        "value_json_schema": value_json_schema,
        "value_json_embedded": value_json_embedded,
        "value_json_many_schemas": value_json_many_schemas,
        "value_xml": value_xml,
        "value_custom": value_custom,
        "headers_typed": headers_typed,
        "headers_last": headers_last,
        "headers_encoded_simple": _encoded_headers("simple"),
        "headers_encoded_json": _encoded_headers("json"),
        "headers_encoded_json_schema": _encoded_headers("json_schema"),
        "records_typed": records_typed,
        "tolerate_none": tolerate_none,
        "dlq_skip": dlq_skip,
        "dlq_payload": dlq_payload,
        "dlq_context_headers": dlq_context_headers,
        "error_report": error_report,
        "error_reasons_only": error_reasons_only,
        "error_templates": error_templates,
        "error_reason": error_reason,
        "error_trace": error_trace,
        "triage": triage,
        "batch_by_count": batches_by_count,
        "batch_without_holes": batches_without_holes,
        "batch_by_limits": batches_by_limits,
        "sequence_ids": sequence_ids,
        "state_snapshot": state_snapshot,
        "state_json": state_json,
        "state_round_trip": state_round_trip,
        "state_conflicts": state_conflicts,
        "latest_offsets": latest_offsets,
        "recovery_plan": recovery_plan,
        "promote_state": promote_state,
        "recovery_ready": recovery_ready,
        "redeliver": redeliver,
        "recovered_table": recovered_table,
        "published_twice": published_twice,
        "strict_prefix": strict_prefix,
        "drop_delivered": drop_delivered,
        "committed_prefix": committed_prefix,
        "delivery_audit": delivery_audit,
        "dedupe": dedupe,
        "peek": peek,
        "more_than_one": more_than_one,
        "one_source": one_source,
        "topic_rows_bytes": _topic_rows("bytes", RAW, fixtures.document_messages),
        "topic_rows_string": _topic_rows("string", TEXT_KEYED, fixtures.conversation_messages),
        "topic_rows_json": _topic_rows("json", JSON_KEYED, fixtures.event_messages),
        "topic_tables": topic_tables,
        "message_table": message_table,
        "stream_effectively_once": stream_effectively_once,
        "stream_units": stream_units,
        "stream_batches": stream_batches,
        "stream_in_order": stream_in_order,
        "stream_holes": stream_holes,
        "stream_dedupe": stream_dedupe,
    }
