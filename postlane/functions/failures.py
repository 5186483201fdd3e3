"""Error structs and the clean-up of their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.schemas import ERROR

# Message texts consumers of dead letters may look for.
UNSUPPORTED_BODY = "Unsupported JMS message type"
UNREADABLE_JSON = "Converting byte[] to Kafka Connect data failed due to serialization error: "
UNKNOWN_ERROR = "Unknown error"
TRACE_LIMIT = 500
TRUNCATED = "... [truncated]"

# Broker reason codes after which a retry may succeed, by name.
RETRIABLE_REASONS = {
    "backed out": 2003,
    "channel not available": 2537,
    "connection broken": 2009,
    "host not available": 2538,
    "not authorized": 2035,
    "queue manager not available": 2059,
    "queue manager quiescing": 2161,
    "queue manager stopping": 2162,
    "unexpected error": 2195,
    "get inhibited": 2016,
}
NO_REASON = -1


def failure(
    kind: str, message: str, cause: str | None = None, cause_message: str | None = None
) -> Column:
    """A constant error struct."""
    trace = f"{kind}: {message}"
    if cause is not None:
        trace += f"\nCaused by: {cause}: {cause_message}"
    texts = (kind, message, cause, cause_message)
    values = [F.lit(text).cast("string") for text in texts] + [truncate_trace(F.lit(trace))]
    named = [value.alias(field.name) for value, field in zip(values, ERROR.fields)]
    return F.struct(*named)


def no_failure() -> Column:
    return F.lit(None).cast(ERROR)


def truncate_trace(trace: Column) -> Column:
    """The first 500 characters, marked when there was more."""
    cut = F.concat(F.left(trace, F.lit(TRACE_LIMIT)), F.lit(TRUNCATED))
    return F.when(F.length(trace) > TRACE_LIMIT, cut).otherwise(trace)


def error_reason(message: Column) -> Column:
    """An error message without trailing colons and blanks; no text reads as unknown."""
    blank = message.isNull() | message.rlike(r"^\s*$")
    return F.when(blank, F.lit(UNKNOWN_ERROR)).otherwise(
        F.regexp_replace(message, r"[:\s]+$", "")
    )


def triage_failures(failures: DataFrame) -> DataFrame:
    """Say whether each failure is worth a retry and whether connections should be closed.

    ``causes`` lists the chain below the top exception, outermost first; only broker errors
    carry a ``reason``. The first one found decides.
    """
    reasons = F.filter("causes", lambda cause: cause["reason"].isNotNull())
    reason = F.coalesce(F.try_element_at(reasons, F.lit(1))["reason"], F.lit(NO_REASON))
    return (
        failures.withColumn("reason", reason)
        .withColumn("retriable", F.col("reason").isin(*RETRIABLE_REASONS.values()))
        .withColumn("closable", F.col("reason") != RETRIABLE_REASONS["get inhibited"])
    )
