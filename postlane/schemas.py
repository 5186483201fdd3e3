"""Fixed table shapes: message envelopes, record headers, delivery state, offsets."""

from pyspark.sql import types as T

PROPERTY = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("bytes", T.BinaryType()),
    ]
)

HEADER = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("bytes", T.BinaryType()),
    ]
)

ERROR = T.StructType(
    [
        T.StructField("class", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("cause_class", T.StringType()),
        T.StructField("cause_message", T.StringType()),
        T.StructField("stacktrace", T.StringType()),
    ]
)

# arrival_seq is unique within a source and gives the delivery order.
MESSAGES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("arrival_seq", T.LongType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("correlation_id", T.StringType()),
        T.StructField("correlation_id_bytes", T.BinaryType()),
        T.StructField("destination", T.StringType()),
        T.StructField("group_id", T.StringType()),
        T.StructField("jms_timestamp", T.LongType()),
        T.StructField("body_kind", T.StringType()),
        T.StructField("body_bytes", T.BinaryType()),
        T.StructField("body_text", T.StringType()),
        T.StructField("properties", T.ArrayType(PROPERTY)),
    ]
)

STATE = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("message_ids", T.ArrayType(T.StringType())),
        T.StructField("last_known_state", T.StringType()),
    ]
)

OFFSETS = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("sequence_id", T.LongType()),
    ]
)
