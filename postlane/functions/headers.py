"""Typed message properties as record headers, and their encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.schemas import HEADER

# Property names and the type names of headers on the wire.
DESCRIPTOR_PREFIX = "JMS_IBM_MQMD_"
MESSAGE_ID_PROPERTY = "JMS_IBM_MQMD_MsgId"
CORRELATION_ID_PROPERTY = "JMS_IBM_MQMD_CorrelId"
WIRE_TYPES = {
    "STRING": "string",
    "BOOLEAN": "boolean",
    "INT8": "int8",
    "INT16": "int16",
    "INT32": "int32",
    "INT64": "int64",
    "FLOAT32": "float",
    "FLOAT64": "double",
    "BYTES": "bytes",
}
SPARK_TYPES = {
    "BOOLEAN": "boolean",
    "INT8": "tinyint",
    "INT16": "smallint",
    "INT32": "int",
    "INT64": "bigint",
    "FLOAT32": "float",
    "FLOAT64": "double",
}


def header_struct(key: Column, kind: Column, text: Column, raw: Column) -> Column:
    return F.struct(
        key.cast("string").alias("key"),
        kind.cast("string").alias("type"),
        text.cast("string").alias("text"),
        raw.cast("binary").alias("bytes"),
    )


def text_header(key: str, text: Column) -> Column:
    return header_struct(F.lit(key), F.lit("STRING"), text, F.lit(None))


def long_header(key: str, number: Column) -> Column:
    return header_struct(F.lit(key), F.lit("INT64"), number, F.lit(None))


def _readable(prop: Column) -> Column:
    """False for a typed property whose text does not hold a value of that type."""
    kind, text = prop["type"], prop["text"]
    fits = F.when(text.isNull() | kind.isin("STRING", "BYTES"), F.lit(True))
    for name, spark_type in SPARK_TYPES.items():
        fits = fits.when(kind == name, text.try_cast(spark_type).isNotNull())
    return fits.otherwise(F.lit(True))


def _as_header(prop: Column, descriptor_fields: bool) -> Column:
    empty = prop["text"].isNull() & prop["bytes"].isNull()
    kind = F.when(empty | ~F.coalesce(prop["type"].isin(*WIRE_TYPES), F.lit(False)), "STRING")
    kind, text, raw = kind.otherwise(prop["type"]), prop["text"], prop["bytes"]
    if descriptor_fields:
        # The two ids are written as the text form the message itself gives.
        by_message_id = prop["name"] == MESSAGE_ID_PROPERTY
        by_correlation_id = prop["name"] == CORRELATION_ID_PROPERTY
        is_id = by_message_id | by_correlation_id
        ids = F.when(by_message_id, F.col("message_id")).when(
            by_correlation_id, F.col("correlation_id")
        )
        kind, text = F.when(is_id, "STRING").otherwise(kind), ids.otherwise(text)
        raw = F.when(~is_id, raw)
    return header_struct(prop["name"], kind, text, raw)


def property_headers(descriptor_fields: bool = False) -> Column:
    """All properties as typed headers, in their order, as one array column."""

    def wanted(prop: Column) -> Column:
        if descriptor_fields:
            return _readable(prop)
        return ~prop["name"].startswith(DESCRIPTOR_PREFIX) & _readable(prop)

    copied = F.transform(
        F.filter("properties", wanted), lambda prop: _as_header(prop, descriptor_fields)
    )
    return F.coalesce(copied, F.array().cast(T.ArrayType(HEADER)))


def with_headers(
    messages: DataFrame, copy: bool = False, descriptor_fields: bool = False
) -> DataFrame:
    """Add ``headers``: the copied properties, or null when copying is off."""
    off = F.lit(None).cast(T.ArrayType(HEADER))
    return messages.withColumn("headers", property_headers(descriptor_fields) if copy else off)


def header(name: str, spark_type: str = "string", headers: str | Column = "headers") -> Column:
    """The last header of that name, as the asked type; null when there is none."""
    named = F.filter(headers, lambda entry: entry["key"] == name)
    last = F.try_element_at(named, F.lit(-1))
    return last["bytes"] if spark_type == "binary" else last["text"].try_cast(spark_type)


def explode_headers(records: DataFrame) -> DataFrame:
    """One row per header with its position; records without headers keep one row."""
    kept = [name for name in records.columns if name != "headers"]
    return records.select(*kept, F.posexplode_outer("headers").alias("position", "header")).select(
        *kept, "position", "header.*"
    )


def json_text(text: Column) -> Column:
    """A string as a JSON string literal, ``null`` for no string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def base64_text(raw: Column) -> Column:
    """Base64 on one line, whatever the session says about chunking."""
    return F.translate(F.base64(raw), "\r\n", "")


def encode_header(entry: Column, mode: str = "simple") -> Column:
    """A header as text: ``simple``, ``json``, or ``json_schema`` with its type alongside."""
    in_base64 = base64_text(entry["bytes"])
    if mode == "simple":
        return F.when(entry["type"] == "BYTES", in_base64).otherwise(entry["text"])
    payload = (
        F.when(entry["type"] == "BYTES", F.concat(F.lit('"'), in_base64, F.lit('"')))
        .when(entry["type"] == "STRING", json_text(entry["text"]))
        .otherwise(entry["text"])
    )
    payload = F.coalesce(payload, F.lit("null"))
    if mode == "json":
        return payload
    if mode != "json_schema":
        raise ValueError(f"unknown header encoding: {mode!r}")
    wire = F.lit(None).cast("string")
    for name, written in WIRE_TYPES.items():
        wire = F.when(entry["type"] == name, written).otherwise(wire)
    optional = F.when(entry["text"].isNull() & entry["bytes"].isNull(), "true").otherwise("false")
    return F.concat(
        F.lit('{"schema":{"type":"'),
        wire,
        F.lit('","optional":'),
        optional,
        F.lit('},"payload":'),
        payload,
        F.lit("}"),
    )
