"""Reading message envelopes and looking at them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.schemas import MESSAGES, PROPERTY
from postlane.shared import settle


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A landed message table; ``arrival_seq`` gives the order within a source."""
    return spark.read.schema(MESSAGES).parquet(path)


def stream_messages(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: str | None = None
) -> DataFrame:
    """The same table as a stream, bounded per micro-batch by files or by bytes."""
    reader = spark.readStream.schema(MESSAGES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Messages that landed on a broker topic, as a stream; needs Spark's Kafka package."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("includeHeaders", "true")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return topic_messages(reader.load())


def topic_messages(rows: DataFrame) -> DataFrame:
    """Rows of a broker topic as messages: a partition is a source, the offset its order."""
    place = F.concat_ws("/", "topic", F.col("partition").cast("string"))
    none_text = F.lit(None).cast("string")
    properties = F.transform(
        F.coalesce("headers", F.array().cast(rows.schema["headers"].dataType)),
        lambda entry: F.struct(
            entry["key"].alias("name"),
            F.lit("BYTES").alias("type"),
            none_text.alias("text"),
            entry["value"].alias("bytes"),
        ),
    )
    spec = MessageSpec(
        source=place,
        arrival_seq=F.col("offset"),
        message_id=F.concat_ws("/", place, F.col("offset").cast("string")),
        body_kind=F.lit("bytes"),
        body_bytes=F.col("value"),
        correlation_id=F.col("key").cast("string"),
        destination=F.col("topic"),
        time=F.col("timestamp"),
    )
    return as_messages(rows, spec, properties)


@dataclass(frozen=True)
class Property:
    """A message property made from a column; ``present`` limits it to some rows."""

    name: str
    type: str
    value: Column
    present: Column | None = None

    def as_struct(self) -> Column:
        none_text, none_bytes = F.lit(None).cast("string"), F.lit(None).cast("binary")
        is_bytes = self.type == "BYTES"
        entry = F.struct(
            F.lit(self.name).alias("name"),
            F.lit(self.type).alias("type"),
            (none_text if is_bytes else self.value.cast("string")).alias("text"),
            (self.value.cast("binary") if is_bytes else none_bytes).alias("bytes"),
        )
        return entry if self.present is None else F.when(self.present, entry)


@dataclass(frozen=True)
class MessageSpec:
    """Which columns of a table play which part of an envelope."""

    source: Column
    arrival_seq: Column
    message_id: Column
    body_kind: Column
    body_text: Column | None = None
    body_bytes: Column | None = None
    correlation_id: Column | None = None
    destination: Column | None = None
    group_id: Column | None = None
    time: Column | None = None
    properties: tuple[Property, ...] = field(default=())


def queue_id(number: Column) -> Column:
    """A 24-byte id in its text form: ``ID:`` and 48 lowercase hex digits."""
    return F.concat(F.lit("ID:"), F.lpad(F.lower(F.hex(number)), 48, "0"))


def _or_null(column: Column | None, kind: str) -> Column:
    return F.lit(None).cast(kind) if column is None else column


def as_messages(
    df: DataFrame, spec: MessageSpec, properties: Column | None = None
) -> DataFrame:
    """View any table as message envelopes; ``properties`` may be given as a whole array."""
    correlation = _or_null(spec.correlation_id, "string")
    if spec.time is None:
        millis = F.lit(None).cast("long")
    else:
        millis = F.unix_millis(spec.time.cast("timestamp"))
    if properties is None:
        properties = F.array().cast(T.ArrayType(PROPERTY))
    if spec.properties:
        properties = F.array_compact(F.array(*[entry.as_struct() for entry in spec.properties]))
    return df.select(
        spec.source.alias("source"),
        spec.arrival_seq.cast("long").alias("arrival_seq"),
        spec.message_id.alias("message_id"),
        correlation.alias("correlation_id"),
        F.encode(correlation, "UTF-8").alias("correlation_id_bytes"),
        _or_null(spec.destination, "string").alias("destination"),
        _or_null(spec.group_id, "string").alias("group_id"),
        millis.alias("jms_timestamp"),
        spec.body_kind.alias("body_kind"),
        _or_null(spec.body_bytes, "binary").alias("body_bytes"),
        _or_null(spec.body_text, "string").alias("body_text"),
        properties.alias("properties"),
    )


def for_source(messages: DataFrame, name: str) -> DataFrame:
    """Only one source's messages; the filter reaches the scan."""
    return messages.where(F.col("source") == name)


def peek(messages: DataFrame) -> DataFrame:
    """The first waiting message of each source, taken from nowhere.

    The heads are found from two narrow columns, and the few rows of that table then pick the
    whole messages.
    """
    heads = messages.groupBy("source").agg(F.min("arrival_seq").alias("arrival_seq"))
    heads = settle(heads, "heads").toDF("__source", "__seq")
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("arrival_seq") == F.col("__seq"))
    return messages.join(heads, same, "left_semi")


def holds_more_than_one(df: DataFrame, by: str = "source") -> DataFrame:
    """Whether there is more than one row per ``by``."""
    return df.groupBy(by).agg((F.count(F.lit(1)) > 1).alias("more_than_one"))
