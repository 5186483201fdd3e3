"""The given tables seen as queues: the inputs of the catalogue's queries."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlane.operators.batching import batch_by_count, number_in_order
from postlane.operators.delivery import DELIVERED, IN_FLIGHT, state_snapshot
from postlane.shared import new_folder, prepare, settle
from postlane.sources.messages import MessageSpec, Property, as_messages, queue_id

STATE_ID = 23
ROWS_PER_FILE = 200_000

ORDER_SCHEMA = """{"type":"struct","fields":[
{"field":"order_key","type":"int32"},{"field":"status","type":"string"},
{"field":"even","type":"boolean"},{"field":"marks","type":"array","items":{"type":"string"}},
{"field":"placed_by","type":"struct","fields":[
{"field":"customer","type":"int64"},{"field":"priority","type":"string"}]}]}"""

URGENT_SCHEMA = (
    '{"type":"struct","fields":[{"field":"order_key","type":"int64"},'
    '{"field":"priority","type":"string"}]}'
)
PLAIN_SCHEMA = (
    '{"type":"struct","fields":[{"field":"order_key","type":"int64"},'
    '{"field":"customer","type":"int32"},{"field":"status","type":"string","optional":true}]}'
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of four queues, some with unreadable bodies or odd kinds."""
    events = table(spark, sf_dir, "events")
    event_id, user = F.col("event_id"), F.col("user_id").cast("string")
    digit = event_id % 10
    kind = F.when(digit == 7, "bytes").when(digit == 8, "map").when(digit == 9, "none")
    broken = (F.col("event_type") == "error") & (event_id % 2 == 0)
    body = F.when(broken, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props"))
    correlation = F.when(event_id % 2 == 0, queue_id(event_id)).otherwise(
        F.concat(F.lit("corr-"), user)
    )
    return as_messages(
        events,
        MessageSpec(
            source=F.concat(F.lit("QM1/Q"), (event_id % 4).cast("string")),
            arrival_seq=event_id,
            message_id=queue_id(event_id),
            correlation_id=F.when(event_id % 20 != 0, correlation),
            destination=F.concat(F.lit("queue:///Q"), (event_id % 4).cast("string")),
            group_id=F.when(F.col("event_type") != "view", F.concat(F.lit("GROUP-"), user)),
            time=F.col("ts"),
            body_kind=kind.otherwise("text"),
            body_text=F.when(digit < 7, body),
            body_bytes=F.when(digit == 7, F.encode(body, "UTF-8")),
            properties=(
                Property("event_type", "STRING", F.col("event_type")),
                Property("user_id", "INT64", F.col("user_id")),
                Property("value", "FLOAT64", F.col("value")),
                Property("flag", "BOOLEAN", event_id % 2 == 0),
                Property("small", "INT16", event_id % 1000),
                Property(
                    "JMS_IBM_MQMD_MsgId", "BYTES", F.unhex(F.lpad(F.hex(event_id), 48, "0"))
                ),
                Property("event_type", "STRING", F.lit("dup"), event_id % 5 == 0),
            ),
        ),
    )


def conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as grouped text messages of one queue."""
    turns = table(spark, sf_dir, "conversations")
    seq = F.col("conv_id") * 1000 + F.col("turn")
    return as_messages(
        turns,
        MessageSpec(
            source=F.lit("QM1/TALK"),
            arrival_seq=seq,
            message_id=queue_id(seq),
            group_id=F.concat(F.lit("conv-"), F.col("conv_id").cast("string")),
            body_kind=F.lit("text"),
            body_text=F.col("text"),
            properties=(
                Property("role", "STRING", F.col("role")),
                Property("JMSXGroupSeq", "INT32", F.col("turn")),
            ),
        ),
    )


def dialogue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a queue of its own, its turns in order."""
    turns = table(spark, sf_dir, "conversations")
    conversation = F.col("conv_id").cast("string")
    return as_messages(
        turns,
        MessageSpec(
            source=F.concat(F.lit("QM1/TALK-"), conversation),
            arrival_seq=F.col("turn"),
            message_id=queue_id(F.col("conv_id") * 1000 + F.col("turn")),
            body_kind=F.lit("text"),
            body_text=F.col("text"),
        ),
    )


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as large bodies: English ones as bytes, the others as text."""
    documents = table(spark, sf_dir, "documents")
    english = F.col("lang") == "en"
    return as_messages(
        documents,
        MessageSpec(
            source=F.concat(F.lit("QM1/"), F.col("source")),
            arrival_seq=F.col("doc_id"),
            message_id=queue_id(F.col("doc_id")),
            destination=F.concat(F.lit("queue:///"), F.col("lang")),
            body_kind=F.when(english, "bytes").otherwise("text"),
            body_text=F.when(~english, F.col("text")),
            body_bytes=F.when(english, F.encode("text", "UTF-8")),
        ),
    )


def _order_messages(spark: SparkSession, sf_dir: str, body) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return as_messages(
        orders,
        MessageSpec(
            source=F.lit("QM1/ORDERS"),
            arrival_seq=key,
            message_id=queue_id(key),
            body_kind=F.lit("text"),
            body_text=body,
            time=F.col("o_orderdate"),
        ),
    )


def order_json_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON; some lack a field, some carry a number as text."""
    body = F.expr(
        """concat('{"order_key":', CASE WHEN o_orderkey % 70 = 1
                  THEN concat('"', o_orderkey, '"') ELSE cast(o_orderkey AS string) END,
        CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE concat(',"status":"', o_orderstatus, '"') END,
        ',"even":', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
        ',"marks":["', o_orderstatus, '","', o_orderpriority, '"],"placed_by":{"priority":"',
        o_orderpriority, '","customer":', o_custkey, '}}')"""
    )
    return _order_messages(spark, sf_dir, body)


def order_envelope_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON that carries its schema; some lack the payload or break the schema."""
    urgent = F.col("o_orderpriority") == "1-URGENT"
    schema = F.when(urgent, URGENT_SCHEMA).otherwise(PLAIN_SCHEMA)
    payload = F.expr(
        """CASE WHEN o_orderpriority = '1-URGENT' THEN
        concat('{"order_key":', o_orderkey, ',"priority":"', o_orderpriority, '"}')
        WHEN o_orderstatus = 'P' THEN concat('{"order_key":', o_orderkey, ',"customer":', o_custkey, '}')
        WHEN o_orderkey % 40 = 3 THEN concat('{"order_key":', o_orderkey, ',"status":"late"}')
        ELSE concat('{"order_key":', o_orderkey, ',"customer":', o_custkey, ',"status":"',
                    o_orderstatus, '"}') END"""
    )
    complete = F.concat(
        F.lit('{"schema":'), schema, F.lit(',"payload":'), payload, F.lit("}")
    )
    bare = F.concat(F.lit('{"schema":'), schema, F.lit("}"))
    return _order_messages(
        spark, sf_dir, F.when(F.col("o_orderkey") % 30 == 7, bare).otherwise(complete)
    )


def order_version_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON that carries its schema, one of 150 by customer."""
    version = F.expr("o_custkey % 150").cast("string")
    schema = F.concat(
        F.lit('{"type":"struct","fields":[{"field":"order_key","type":"int64"},{"field":"total","type":"double"},'
              '{"field":"version","type":"int32","default":'),
        version,
        F.lit("}]}"),
    )
    payload = F.expr("""concat('{"order_key":', CASE WHEN o_orderkey % 25 = 4 THEN 'true' ELSE CAST(o_orderkey AS STRING) END,
        ',"total":', o_orderkey % 8, '.5}')""")
    body = F.concat(F.lit('{"schema":'), schema, F.lit(',"payload":'), payload, F.lit("}"))
    return _order_messages(spark, sf_dir, body)


def order_xml_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as XML; some lack the closing tag, some have another root element."""
    body = F.expr(
        """concat(CASE WHEN o_orderkey % 45 = 4 THEN '<Purchase>' ELSE '<Order>' END,
        '<Key>', o_orderkey, '</Key><Status>', o_orderstatus, '</Status><Priority>',
        o_orderpriority, '</Priority>',
        CASE WHEN o_orderkey % 60 = 0 THEN '' WHEN o_orderkey % 45 = 4 THEN '</Purchase>'
        ELSE '</Order>' END)"""
    )
    return _order_messages(spark, sf_dir, body)


def batched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event messages with their batch numbers."""
    return batch_by_count(event_messages(spark, sf_dir))


def delivery_tables(batched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A state and an offset for three of the four event queues.

    Each state holds its queue's first batch: Q1 proven delivered by its offset, Q2 not, Q3
    marked delivered; Q0 has neither state nor offset.
    """
    first = batched.where((F.col("batch_no") == 1) & (F.col("source") != "QM1/Q0"))
    marked = F.when(F.col("source") == "QM1/Q3", DELIVERED).otherwise(IN_FLIGHT)
    state = state_snapshot(first.withColumn("sequence_id", F.lit(STATE_ID).cast("long")))
    state = settle(state.withColumn("last_known_state", marked), "state")
    proven = F.when(F.col("source") == "QM1/Q1", STATE_ID).otherwise(STATE_ID - 1)
    return state, state.select("source", proven.cast("long").alias("sequence_id"))


@dataclass(frozen=True)
class Landed:
    """Message files below ``path``, written in several parts of ``files`` files each."""

    path: str
    files: int


def _files(messages: DataFrame, parts: int) -> int:
    """How many files each of the parts takes, so that none is a large one."""
    return max(1, math.ceil(messages.count() / (parts * ROWS_PER_FILE)))


def landed_events(spark: SparkSession, sf_dir: str, parts: int = 4) -> Landed:
    """The event messages written out as several files, ready to be streamed."""
    path = new_folder(spark, "landed")
    messages = event_messages(spark, sf_dir)
    files = _files(messages, parts)
    messages.repartitionByRange(parts * files, "arrival_seq").write.parquet(path)
    return Landed(path, files)


def _land(messages: DataFrame, path: str, files: int) -> None:
    """Add one part to a landing folder."""
    dealt = messages.coalesce(1) if files == 1 else messages.repartition(files)
    dealt.write.mode("append").parquet(path)


def landed_in_turn(spark: SparkSession, sf_dir: str, parts: int = 4) -> Landed:
    """The event messages written out in order of arrival, one part after the other."""
    path = new_folder(spark, "landed")
    messages = event_messages(spark, sf_dir)
    files = _files(messages, parts)
    first, last = messages.agg(F.min("arrival_seq"), F.max("arrival_seq")).first()
    part = F.floor((F.col("arrival_seq") - first) * parts / (last - first + 1))
    for number in range(parts):
        _land(messages.where(part == number), path, files)
    return Landed(path, files)


def landed_out_of_order(spark: SparkSession, sf_dir: str, missing: str, parts: int = 3) -> Landed:
    """The event messages, numbered 1 to ``held`` in their queues, in parts that each hold some from everywhere.

    Those that fulfil ``missing`` come in no file.
    """
    path = new_folder(spark, "landed")
    messages = number_in_order(event_messages(spark, sf_dir))
    messages = settle(messages.withColumn("arrival_seq", F.col("ordinal")).drop("ordinal"), "numbered")
    files = _files(messages, parts)
    sizes = messages.groupBy("source").agg(F.count(F.lit(1)).alias("held"))
    there = messages.join(sizes, "source").where(~F.expr(missing)).select(*messages.columns)
    part = F.pmod(F.crc32(F.col("message_id").cast("binary")), F.lit(parts))
    for number in range(parts):
        _land(there.where(part == number), path, files)
    return Landed(path, files)
