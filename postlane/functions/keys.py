"""Record keys taken from message headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.functions.failures import failure, no_failure
from postlane.options import OptionError

STRING = "STRING"
BYTES = "BYTES"


def _without_prefix(identifier: Column) -> Column:
    return F.regexp_replace(identifier, "^ID:", "")


def with_key(messages: DataFrame, key_header: str | None) -> DataFrame:
    """Add ``key_type``, ``key_text``, ``key_bytes`` and ``key_error``.

    The two ids and the destination must be there; the byte form and the group may be null.
    """
    text, raw, error = F.lit(None).cast("string"), F.lit(None).cast("binary"), no_failure()
    key_type: str | None = STRING
    needed = None
    if key_header is None:
        key_type = None
    elif key_header == "JMSMessageID":
        needed = "message_id"
        text = _without_prefix(F.col(needed))
    elif key_header == "JMSCorrelationID":
        needed = "correlation_id"
        text = _without_prefix(F.col(needed))
    elif key_header == "JMSCorrelationIDAsBytes":
        key_type = BYTES
        raw = F.col("correlation_id_bytes")
    elif key_header == "JMSDestination":
        needed = "destination"
        text = F.col(needed)
    elif key_header == "JMSXGroupID":
        text = F.col("group_id")
    else:
        raise OptionError(f"unsupported key header: {key_header!r}")
    if needed is not None:
        missing = failure("MissingKeyField", f"the message has no {key_header}")
        error = F.when(F.col(needed).isNull(), missing)
    return messages.withColumns(
        {
            "key_type": F.lit(key_type).cast("string"),
            "key_text": text,
            "key_bytes": raw,
            "key_error": error,
        }
    )
