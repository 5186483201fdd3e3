"""Messages to records: value, key, timestamp and headers in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.functions.headers import with_headers
from postlane.functions.keys import with_key
from postlane.functions.values import build_values
from postlane.options import IngestOptions

# What a dead letter may need of the original message, kept until routing.
ORIGIN = ("destination", "jms_timestamp", "body_kind", "body_text", "body_bytes")
POSITION = ("source", "arrival_seq", "message_id")
CARRIED = ("batch_no", "sequence_id", "event_time")
VALUES = ("value_type", "value_text", "value_bytes", "value_json", "value_schema", "value")


def to_records(
    messages: DataFrame, options: IngestOptions, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One record per message, in the fixed record shape plus ``origin``.

    The value is built before the key, and the first failure is the record's ``error``; a
    failed record has neither key nor value. Batch and sequence columns already on the
    messages, and those in ``keep``, travel along.
    """
    built = build_values(messages, options)
    built = with_key(built, options.key_header)
    built = with_headers(built, options.copy_properties, options.descriptor_fields)
    built = built.withColumn("error", F.coalesce("value_error", "key_error"))
    good = F.col("error").isNull()
    columns = built.columns
    carried = [name for name in (*CARRIED, *keep) if name in columns]
    values = [name for name in VALUES if name in columns]
    return built.select(
        *POSITION,
        *carried,
        F.lit(options.topic).alias("topic"),
        *[F.when(good, F.col(name)).alias(name) for name in ("key_type", "key_text", "key_bytes")],
        *[F.when(good, F.col(name)).alias(name) for name in values],
        (F.col("jms_timestamp") if options.body_jms else F.lit(None).cast("long")).alias("ts_ms"),
        "headers",
        "error",
        F.struct(
            *ORIGIN, *[F.col(f"key_{part}") for part in ("type", "text", "bytes")]
        ).alias("origin"),
    )


def with_position(
    records: DataFrame, topic: str, source: str | None = None, sequence_id: int | None = None
) -> DataFrame:
    """Attach topic, source and offset to records that lack them."""
    placed = records.withColumn("topic", F.lit(topic))
    if source is not None:
        placed = placed.withColumn("source", F.lit(source))
    if sequence_id is not None or "sequence_id" not in records.columns:
        placed = placed.withColumn("sequence_id", F.lit(sequence_id).cast("long"))
    return placed
