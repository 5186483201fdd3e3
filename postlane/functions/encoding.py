"""Record values and keys as the bytes a topic stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.functions.headers import base64_text, encode_header, json_text
from postlane.shared import gate

ENCODINGS = ("bytes", "string", "json")


def _structured(records: DataFrame) -> Column:
    """The structured value of a record as JSON text, where the builder made one."""
    forms = []
    if "value_json" in records.columns:
        forms.append(F.when(~F.is_variant_null("value_json"), F.to_json("value_json")))
    if "value" in records.columns:
        forms.append(F.to_json("value", {"ignoreNullFields": "false"}))
    return F.coalesce(*forms) if forms else F.lit(None).cast("string")


def encode_value(records: DataFrame, encoding: str) -> DataFrame:
    """Add ``encoded`` with the value's bytes in one of three encodings.

    ``bytes`` passes bytes on and fails on anything else, ``string`` writes text as UTF-8,
    ``json`` writes structures as JSON, text quoted and bytes as a base64 string.
    """
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown value encoding: {encoding!r}")
    kind = F.col("value_type")
    if encoding == "bytes":
        acceptable = F.coalesce(kind == "BYTES", F.lit(True))
        refused = F.raise_error(
            F.concat(F.lit("only bytes can be written as they are, found "), kind)
        )
        return gate(records, acceptable, refused).withColumn("encoded", F.col("value_bytes"))
    structured = _structured(records)
    if encoding == "string":
        text = F.when(kind == "STRING", F.col("value_text")).otherwise(structured)
        encoded = F.coalesce(F.encode(text, "UTF-8"), F.col("value_bytes"))
        return records.withColumn("encoded", encoded)
    text = (
        F.when(kind == "STRING", json_text(F.col("value_text")))
        .when(
            (kind == "BYTES") & F.col("value_bytes").isNotNull(),
            F.concat(F.lit('"'), base64_text(F.col("value_bytes")), F.lit('"')),
        )
        .otherwise(F.coalesce(structured, F.when(kind.isNotNull(), "null")))
    )
    return records.withColumn("encoded", F.encode(text, "UTF-8"))


def to_topic_rows(
    records: DataFrame, encoding: str = "json", header_encoding: str = "simple"
) -> DataFrame:
    """``topic``, ``key``, ``value``, ``headers`` as a broker sink expects them.

    Records laid out by ``partition_by_key`` also name their ``partition``.
    """
    headers = F.transform(
        "headers",
        lambda entry: F.struct(
            entry["key"].alias("key"),
            F.encode(encode_header(entry, header_encoding), "UTF-8").alias("value"),
        ),
    )
    columns = [
        F.col("topic"),
        F.coalesce(F.encode("key_text", "UTF-8"), F.col("key_bytes")).alias("key"),
        F.col("encoded").alias("value"),
        headers.alias("headers"),
    ]
    if "topic_partition" in records.columns:
        columns.append(F.col("topic_partition").alias("partition"))
    return encode_value(records, encoding).select(*columns)
