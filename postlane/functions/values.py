"""Message bodies as record values.

Every builder adds ``value_type``, ``value_text``, ``value_bytes`` and ``value_error``; the JSON
builders add ``value_json`` (VARIANT) or ``value`` (STRUCT).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.connect_schema import (
    Node,
    SchemaError,
    breaks_schema,
    conform,
    fill_defaults,
    read_schema,
)
from postlane.functions.failures import (
    UNREADABLE_JSON,
    UNSUPPORTED_BODY,
    failure,
    no_failure,
)
from postlane.options import IngestOptions, OptionError

CORRUPT = "__corrupt"
PARSED = "__parsed"
ENVELOPE = "__envelope"


def _no_text() -> Column:
    return F.lit(None).cast("string")


def _no_bytes() -> Column:
    return F.lit(None).cast("binary")


def _unsupported() -> Column:
    return failure("UnsupportedBody", UNSUPPORTED_BODY)


def _with_value(
    messages: DataFrame,
    value_type: Column,
    text: Column | None = None,
    raw: Column | None = None,
    error: Column | None = None,
    **more: Column,
) -> DataFrame:
    return messages.withColumns(
        {
            "value_type": value_type,
            "value_text": _no_text() if text is None else text,
            "value_bytes": _no_bytes() if raw is None else raw,
            **more,
            "value_error": no_failure() if error is None else error,
        }
    )


def build_raw(messages: DataFrame) -> DataFrame:
    """The body's bytes, whatever it is; no body gives a null value."""
    raw = F.coalesce("body_bytes", F.encode("body_text", "UTF-8"))
    return _with_value(messages, F.lit("BYTES"), raw=raw)


def build_typed(messages: DataFrame) -> DataFrame:
    """Bytes stay bytes, text stays text, an empty message is null, the rest is an error."""
    kind = F.col("body_kind")
    supported = kind.isin("bytes", "text", "none")
    return _with_value(
        messages,
        F.when((kind == "bytes") & F.col("body_bytes").isNotNull(), "BYTES").when(
            (kind == "text") & F.col("body_text").isNotNull(), "STRING"
        ),
        text=F.when(kind == "text", F.col("body_text")),
        raw=F.when(kind == "bytes", F.col("body_bytes")),
        error=F.when(~F.coalesce(supported, F.lit(False)), _unsupported()),
    )


def body_as_text() -> Column:
    """The body as text where it can be read as text; bytes must be valid UTF-8."""
    decoded = F.try_validate_utf8(F.col("body_bytes").cast("string"))
    kind = F.col("body_kind")
    return F.when(kind == "text", F.col("body_text")).when(kind == "bytes", decoded)


def _structured_error(readable: Column, misfit: Column | None = None) -> Column:
    """The error of a structured body: wrong kind, no text, unreadable, or against its schema."""
    kind = F.col("body_kind")
    error = (
        F.when(~F.coalesce(kind.isin("bytes", "text"), F.lit(False)), _unsupported())
        .when(_is_tombstone(), no_failure())
        .when(
            (kind == "text") & F.col("body_text").isNull(),
            failure("EmptyBody", "the text message has no text"),
        )
        .when(
            ~readable,
            failure("MalformedBody", UNREADABLE_JSON, "ParseError", "the body is not valid JSON"),
        )
    )
    if misfit is not None:
        error = error.when(
            misfit, failure("SchemaMismatch", "the body does not fit its record schema")
        )
    return error


def _is_tombstone() -> Column:
    return F.coalesce(
        (F.col("body_kind") == "bytes") & F.col("body_bytes").isNull(), F.lit(False)
    )


def build_json(
    messages: DataFrame,
    schema: str | None = None,
    schemas_enable: bool = False,
) -> DataFrame:
    """The body parsed as JSON.

    Without a schema the value is a VARIANT. ``schema`` fixes one schema for all messages and
    gives a typed column. ``schemas_enable`` alone expects a schema inside each message.
    """
    if schema is not None and schema.strip():
        return _build_json_fixed(messages, read_schema(schema))
    if schemas_enable:
        return _build_json_embedded(messages)
    parsed = messages.withColumn(PARSED, F.try_parse_json(body_as_text()))
    value = F.col(PARSED)
    present = value.isNotNull() & ~F.is_variant_null(value)
    return _with_value(
        parsed,
        F.when(present, "JSON"),
        value_json=value,
        error=_structured_error(value.isNotNull()),
    ).drop(PARSED)


def _wrapper(node: Node) -> T.StructType:
    return T.StructType(
        [T.StructField("payload", node.type), T.StructField(CORRUPT, T.StringType())]
    )


def _parse_payload(text: Column, node: Node) -> Column:
    return F.from_json(text, _wrapper(node), {"columnNameOfCorruptRecord": CORRUPT})


def _build_json_fixed(messages: DataFrame, node: Node) -> DataFrame:
    body = body_as_text()
    if node.kind == "struct":
        schema = T.StructType([*node.type.fields, T.StructField(CORRUPT, T.StringType())])
        parsed = F.from_json(body, schema, {"columnNameOfCorruptRecord": CORRUPT})
        found = F.col(PARSED)
        is_null = F.trim(body) == "null"
        fields = F.struct(*[found[name].alias(name) for name, _ in node.fields])
        payload = F.when(~is_null, fields)
        corrupt = found[CORRUPT].isNotNull() & ~is_null
    else:
        # Only objects can be parsed on their own, so other types get an object around them.
        parsed = _parse_payload(F.concat(F.lit('{"payload":'), body, F.lit("}")), node)
        found = F.col(PARSED)
        payload = found["payload"]
        corrupt = found[CORRUPT].isNotNull()
    misfit = corrupt | breaks_schema(payload, node)
    ready = messages.withColumn(PARSED, parsed).withColumn(
        "value_error", _structured_error(found.isNotNull(), misfit)
    )
    good = F.col("value_error").isNull() & ~_is_tombstone()
    return _with_value(
        ready,
        F.when(good, "STRUCT"),
        value=F.when(good, fill_defaults(payload, node)),
        error=F.col("value_error"),
    ).drop(PARSED)


ENVELOPE_PARTS = T.StructType(
    [T.StructField("schema", T.StringType()), T.StructField(CORRUPT, T.StringType())]
)
CHECKED = T.StructType(
    [T.StructField("fits", T.BooleanType()), T.StructField("payload", T.StringType())]
)


def _open_envelope(body: Column) -> Column:
    """The schema text of a self-describing message, read past its payload."""
    return F.from_json(body, ENVELOPE_PARTS, {"columnNameOfCorruptRecord": CORRUPT})


def _build_json_embedded(messages: DataFrame) -> DataFrame:
    """Values typed by the schema each message carries.

    Schemas are met only while reading, so bodies are checked in Arrow batches: one way for any
    number of schemas, and no pass that looks for them.
    """
    body = body_as_text()
    envelope = F.col(ENVELOPE)
    keys = F.json_object_keys(body)
    complete = (
        envelope[CORRUPT].isNull()
        & envelope["schema"].isNotNull()
        & (F.size(keys) == 2)
        & F.array_contains(keys, "payload")
    )
    opened = messages.withColumn(ENVELOPE, _open_envelope(body)).withColumn(
        "value_schema", F.when(complete, envelope["schema"])
    )
    checked = opened.withColumn(
        "__checked", _check_envelope("value_schema", F.when(F.col("value_schema").isNotNull(), body))
    )
    parsed = checked.withColumn(PARSED, F.try_parse_json(F.col("__checked")["payload"]))
    fits = F.col("__checked")["fits"] & F.col(PARSED).isNotNull()
    # Only bodies that did not open as an envelope need the question whether they are JSON.
    readable = (envelope.isNotNull() & envelope[CORRUPT].isNull()) | F.try_parse_json(
        body
    ).isNotNull()
    error = _structured_error(readable, ~F.coalesce(fits, F.lit(False)))
    judged = parsed.withColumn("value_error", error)
    good = F.col("value_error").isNull() & ~_is_tombstone()
    return _with_value(
        judged,
        F.when(good, "STRUCT"),
        value_json=F.when(good, F.col(PARSED)),
        error=F.col("value_error"),
    ).drop(PARSED, ENVELOPE, "__checked")


def _node_or_none(schema_text: str) -> Node | None:
    try:
        return read_schema(schema_text)
    except SchemaError:
        return None


@F.pandas_udf(CHECKED)
def _check_envelope(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    known: dict[str, Node | None] = {}

    def judge(schema_text: str | None, body: str | None) -> tuple[bool, str | None]:
        if schema_text is None or body is None:
            return False, None
        if schema_text not in known:
            known[schema_text] = _node_or_none(schema_text)
        node = known[schema_text]
        try:
            envelope = json.loads(body)
            if node is None or not isinstance(envelope["schema"], dict):
                return False, None
            return True, conform(envelope["payload"], node)
        except (SchemaError, ValueError, RecursionError):
            return False, None

    for schema_texts, bodies in batches:
        judged = [judge(*pair) for pair in zip(schema_texts, bodies)]
        yield pd.DataFrame(judged, columns=["fits", "payload"])


def xsd_schema(spark: SparkSession, path: str, root: str | None = None) -> T.StructType:
    """The Spark type of a document described by an XSD file, by its root element."""
    jvm = spark._jvm
    reader = jvm.org.apache.spark.sql.execution.datasources.xml.XSDToSchema
    described = T.StructType.fromJson(json.loads(reader.read(jvm.org.apache.hadoop.fs.Path(path)).json()))
    roots = [field for field in described.fields if root in (None, field.name)]
    if len(roots) != 1 or not isinstance(roots[0].dataType, T.StructType):
        raise OptionError(f"{path} does not describe one root element {root or ''}".rstrip())
    return roots[0].dataType


def build_xml(
    messages: DataFrame,
    schema: T.StructType | str,
    root: str | None = None,
    xsd_path: str | None = None,
) -> DataFrame:
    """The body parsed as XML into ``schema``; ``root`` names the element it must start with.

    With ``xsd_path``, a file every executor can read, each body is also validated against it.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    settings = {"columnNameOfCorruptRecord": CORRUPT}
    if xsd_path is not None:
        settings["rowValidationXSDPath"] = xsd_path
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    body = body_as_text()
    parsed = messages.withColumn(PARSED, F.from_xml(body, wanted, settings))
    found = F.col(PARSED)
    missing = F.lit(False)
    for field in schema.fields:
        if not field.nullable:
            missing = missing | found[field.name].isNull()
    readable = found.isNotNull() & found[CORRUPT].isNull()
    if root is not None:
        # Declarations, comments and a document type may come before the root element.
        opening = rf"(?s)\A\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<{root}[\s/>]"
        missing = missing | ~body.rlike(opening)
    kind = F.col("body_kind")
    error = (
        F.when(~F.coalesce(kind.isin("bytes", "text"), F.lit(False)), _unsupported())
        .when(
            ~F.coalesce(readable, F.lit(False)),
            failure("MalformedBody", "the body is not readable XML", "ParseError", "bad XML"),
        )
        .when(missing, failure("SchemaMismatch", "the body does not fit its record schema"))
    )
    parsed = parsed.withColumn("value_error", error)
    good = F.col("value_error").isNull()
    fields = F.struct(*[found[field.name].alias(field.name) for field in schema.fields])
    return _with_value(
        parsed, F.when(good, "STRUCT"), value=F.when(good, fields), error=F.col("value_error")
    ).drop(PARSED)


def build_with(messages: DataFrame, builder: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A builder of the user's own: gets the messages, adds the value columns it knows."""
    if not callable(builder):
        raise OptionError("a record builder must be a function from DataFrame to DataFrame")
    built = builder(messages)
    defaults = {
        "value_type": _no_text(),
        "value_text": _no_text(),
        "value_bytes": _no_bytes(),
        "value_error": no_failure(),
    }
    absent = {name: column for name, column in defaults.items() if name not in built.columns}
    return built.withColumns(absent) if absent else built


def build_values(messages: DataFrame, options: IngestOptions) -> DataFrame:
    """The builder the options name."""
    if callable(options.builder):
        return build_with(messages, options.builder)
    if options.builder == "json":
        return build_json(messages, options.json_schema, options.json_schemas)
    if options.builder == "xml":
        schema = options.xml_schema
        if schema is None:
            if options.xml_xsd is None:
                raise OptionError("the XML builder needs a schema")
            schema = xsd_schema(messages.sparkSession, options.xml_xsd, options.xml_root)
        return build_xml(messages, schema, options.xml_root, options.xml_xsd)
    return build_typed(messages) if options.body_jms else build_raw(messages)
