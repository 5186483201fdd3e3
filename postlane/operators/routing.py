"""What happens to records that could not be built."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.functions.failures import error_reason
from postlane.functions.headers import long_header, text_header
from postlane.options import IngestOptions, check_tolerance
from postlane.shared import gate, settle

# Names of the context headers on dead letters.
CONTEXT_PREFIX = "__connect.errors."
CONTEXT_TOPIC = CONTEXT_PREFIX + "topic"
CONTEXT_CLASS = CONTEXT_PREFIX + "exception.class.name"
CONTEXT_MESSAGE = CONTEXT_PREFIX + "exception.message"
CONTEXT_TRACE = CONTEXT_PREFIX + "exception.stacktrace"
CONTEXT_TIMESTAMP = CONTEXT_PREFIX + "timestamp"
CONTEXT_CAUSE_CLASS = CONTEXT_PREFIX + "cause.class"
CONTEXT_CAUSE_MESSAGE = CONTEXT_PREFIX + "cause.message"
CONTEXT_MESSAGE_ID = CONTEXT_PREFIX + "jms.message.id"
CONTEXT_MESSAGE_TIME = CONTEXT_PREFIX + "jms.timestamp"
CONTEXT_QUEUE = CONTEXT_PREFIX + "mq.queue"


def dlq_payload(origin: str = "origin") -> Column:
    """A message's body as bytes: as it is, as UTF-8, or a rendering of other kinds.

    Null when a bytes or text message has no body: such a message cannot be kept.
    """
    body = F.col(origin)
    rendering = F.to_json(
        F.struct(
            body["body_kind"].alias("body_kind"),
            F.col("message_id"),
            body["destination"].alias("destination"),
            body["body_text"].alias("body_text"),
            body["body_bytes"].alias("body_bytes"),
        )
    )
    return (
        F.when(body["body_kind"] == "bytes", body["body_bytes"])
        .when(body["body_kind"] == "text", F.encode(body["body_text"], "UTF-8"))
        .otherwise(F.encode(rendering, "UTF-8"))
    )


def context_headers(queue: str, error_time_ms: Column | None = None) -> Column:
    """Headers that tell where a dead letter came from and why it is one."""
    error = F.col("error")
    if error_time_ms is None:
        error_time_ms = F.unix_millis(F.current_timestamp())
    caused = error["cause_class"].isNotNull()
    always = [
        text_header(CONTEXT_TOPIC, F.col("topic")),
        text_header(CONTEXT_CLASS, error["class"]),
        text_header(CONTEXT_MESSAGE, error["message"]),
        text_header(CONTEXT_MESSAGE_ID, F.col("message_id")),
        long_header(CONTEXT_MESSAGE_TIME, F.col("origin")["jms_timestamp"]),
        text_header(CONTEXT_QUEUE, F.lit(queue)),
        long_header(CONTEXT_TIMESTAMP, error_time_ms),
    ]
    sometimes = [
        F.when(caused, text_header(CONTEXT_CAUSE_CLASS, error["cause_class"])),
        F.when(caused, text_header(CONTEXT_CAUSE_MESSAGE, error["cause_message"])),
        F.when(error["stacktrace"].isNotNull(), text_header(CONTEXT_TRACE, error["stacktrace"])),
    ]
    return F.array_compact(F.array(*always, *sometimes))


def route(
    records: DataFrame,
    tolerance: str = "none",
    dlq_topic: str | None = None,
    with_context: bool = False,
    queue: str = "",
    dlq_key: str = "code",
    error_time_ms: Column | None = None,
) -> DataFrame:
    """Fail on, drop or re-address the records that have an error.

    ``none`` fails the job at the first one. ``all`` drops them, or sends them to ``dlq_topic``
    in the same pass with the original body as value; those without any body are lost there.
    Their key is null because the failure came before the key was set; ``dlq_key='always'``
    keeps the configured key.
    """
    error = F.col("error")
    good = error.isNull()
    if check_tolerance(tolerance) == "none":
        where = F.concat_ws(" ", F.col("source"), F.col("arrival_seq").cast("string"))
        text = F.concat_ws(" ", error["class"], F.concat(error["message"], F.lit(" at")), where)
        return gate(records, good, F.raise_error(text)).drop("origin")
    dlq_topic = (dlq_topic or "").strip()
    if not dlq_topic:
        return gate(records, good).drop("origin")

    payload = F.col("__payload")
    kept = gate(
        records.withColumn("__payload", F.when(~good, dlq_payload())), good | payload.isNotNull()
    )
    changed = {
        "topic": F.when(good, F.col("topic")).otherwise(F.lit(dlq_topic)),
        "value_type": F.when(good, F.col("value_type")).otherwise(F.lit("BYTES")),
        "value_bytes": F.when(good, F.col("value_bytes")).otherwise(payload),
        "ts_ms": F.when(good, F.col("ts_ms")).otherwise(F.col("origin")["jms_timestamp"]),
    }
    if with_context:
        own = F.coalesce("headers", F.array().cast(records.schema["headers"].dataType))
        added = F.concat(own, context_headers(queue, error_time_ms))
        changed["headers"] = F.when(good, F.col("headers")).otherwise(added)
    if dlq_key == "always":
        for part in ("type", "text", "bytes"):
            name = f"key_{part}"
            changed[name] = F.when(good, F.col(name)).otherwise(F.col("origin")[name])
    return kept.withColumns(changed).drop("origin", "__payload")


def only_topic(records: DataFrame, topic: str) -> DataFrame:
    """The records routed to one topic, without building any record twice."""
    return gate(records, F.col("topic") == topic)


def route_by(records: DataFrame, options: IngestOptions) -> DataFrame:
    """``route`` with everything the options say."""
    return route(
        records,
        options.tolerance,
        options.dlq_topic,
        options.dlq_context_headers,
        options.queue,
    )


def error_report(
    records: DataFrame, include_messages: bool = False, by_class: bool = True
) -> DataFrame:
    """How often each error occurred, from when to when, optionally with its earliest body.

    Takes records before routing. Counts are combined before the shuffle, so one frequent
    error is no burden to one task.
    """
    error = F.col("error")
    measures = [
        F.count(F.lit(1)).alias("errors"),
        F.min(F.col("origin")["jms_timestamp"]).alias("first_ms"),
        F.max(F.col("origin")["jms_timestamp"]).alias("last_ms"),
    ]
    if include_messages:
        earliest = F.struct(F.col("source"), F.col("arrival_seq"))
        measures.append(F.min_by(dlq_payload(), earliest).alias("sample"))
    keys = [F.col("topic"), error_reason(error["message"]).alias("reason")]
    if by_class:
        keys.insert(1, error["class"].alias("class"))
    return gate(records, error.isNotNull()).groupBy(*keys).agg(*measures)


def error_templates(records: DataFrame, least: int = 20, one_in: int = 100) -> DataFrame:
    """``error_report`` over free-text reasons: those that differ in a few words only are counted together.

    Reasons of one topic, class and number of words are compared word by word. A word stays in the template if
    at least ``least`` of these errors, and one in ``one_in`` of them, have it at that place; others become ``*``.
    So an id or a time is a wildcard, and a shape too rare for words of its own is counted among wildcards. Fewer
    than ``least`` errors of such a kind keep their reasons as they are.

    Returns topic, class, template, errors, reasons (different ones), first_ms, last_ms and example (the smallest
    reason). Equal reasons are merged before anything else, words are counted by partial sums, and of the frequent
    words there are at most ``one_in`` for a place.
    """
    kind = ("topic", "class", "words")
    error = F.col("error")
    reasons = (
        gate(records, error.isNotNull())
        .groupBy("topic", error["class"].alias("class"), error_reason(error["message"]).alias("reason"))
        .agg(
            F.count(F.lit(1)).alias("errors"),
            F.min(F.col("origin")["jms_timestamp"]).alias("first_ms"),
            F.max(F.col("origin")["jms_timestamp"]).alias("last_ms"),
        )
        .withColumn("words", F.size(F.split("reason", " ")))
    )
    reasons = settle(reasons, "error-reasons")
    counted = (
        reasons.select(*kind, "errors", F.posexplode(F.split("reason", " ")).alias("at", "word"))
        .groupBy(*kind, "at", "word")
        .agg(F.sum("errors").alias("n"))
    )
    totals = settle(reasons.groupBy(*kind).agg(F.sum("errors").alias("total")), "error-kinds")

    def alike(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        renamed = right.withColumnsRenamed({name: f"__{name}" for name in kind})
        same = [F.col(name).eqNullSafe(F.col(f"__{name}")) for name in kind]
        return left.join(renamed, same, how).drop(*[f"__{name}" for name in kind])

    often = alike(counted, totals, "inner").where((F.col("n") >= least) & (F.col("n") * one_in >= F.col("total")))
    often = often.groupBy(*kind, "at").agg(F.collect_list("word").alias("here"))
    often = often.groupBy(*kind).agg(F.map_from_entries(F.collect_list(F.struct("at", "here"))).alias("often"))
    often = settle(alike(totals, often, "left"), "frequent-words")
    kept = lambda word, at: F.array_contains(F.col("often")[at], word)
    masked = F.transform(F.split("reason", " "), lambda word, at: F.when(kept(word, at), word).otherwise("*"))
    template = F.when(F.col("total") < least, F.col("reason")).otherwise(F.array_join(masked, " "))
    return (
        alike(reasons, often, "inner")
        .groupBy("topic", "class", template.alias("template"))
        .agg(
            F.sum("errors").alias("errors"),
            F.count(F.lit(1)).alias("reasons"),
            F.min("first_ms").alias("first_ms"),
            F.max("last_ms").alias("last_ms"),
            F.min("reason").alias("example"),
        )
    )


def report_by(records: DataFrame, options: IngestOptions) -> DataFrame:
    """``error_report`` as detailed as the options ask: reasons, classes, or with bodies.

    The log options count only where errors are tolerated.
    """
    logged = options.log_errors and options.tolerance == "all"
    return error_report(records, include_messages=logged and options.log_messages, by_class=logged)
