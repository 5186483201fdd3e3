"""The options that decide what records look like, checked on the driver before any job."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from postlane.connect_schema import SchemaError, read_schema

# Property names and their accepted values, as users already have them in files.
KEY_HEADERS = (
    "JMSMessageID",
    "JMSCorrelationID",
    "JMSCorrelationIDAsBytes",
    "JMSDestination",
    "JMSXGroupID",
)
TOPIC = "topic"
QUEUE = "mq.queue"
QUEUE_MANAGER = "mq.queue.manager"
BUILDER = "mq.record.builder"
BODY_JMS = "mq.message.body.jms"
KEY_HEADER = "mq.record.builder.key.header"
COPY_PROPERTIES = "mq.jms.properties.copy.to.kafka.headers"
DESCRIPTOR_READ = "mq.message.mqmd.read"
BATCH_SIZE = "mq.batch.size"
MAX_POLL_TIME = "mq.receive.max.poll.time.ms"
SUBSEQUENT_TIMEOUT = "mq.receive.subsequent.timeout.ms"
STATE_QUEUE = "mq.exactly.once.state.queue"
TASKS_MAX = "tasks.max"
JSON_SCHEMAS_ENABLE = "mq.record.builder.json.schemas.enable"
JSON_SCHEMA_CONTENT = "mq.record.builder.json.schema.content"
XML_ROOT = "mq.record.builder.root.element.name"
XML_XSD = "mq.record.builder.xsd.schema.path"
TOLERANCE = "errors.tolerance"
LOG_ENABLE = "errors.log.enable"
LOG_MESSAGES = "errors.log.include.messages"
DLQ_TOPIC = "errors.deadletterqueue.topic.name"
DLQ_CONTEXT = "errors.deadletterqueue.context.headers.enable"
DEFAULT_BATCH_SIZE = 250

# Builders may be named shortly or by a class name, of which the last part counts.
BUILDERS = {
    "default": "default",
    "json": "json",
    "xml": "xml",
    "DefaultRecordBuilder": "default",
    "JsonRecordBuilder": "json",
    "XmlMQRecordBuilder": "xml",
}

Builder = Callable[[DataFrame], DataFrame]


class OptionError(ValueError):
    """An option has a value the engine cannot work with."""


@dataclass(frozen=True)
class IngestOptions:
    """How messages become records. Field defaults are the documented ones."""

    topic: str
    queue: str = ""
    queue_manager: str = ""
    builder: str | Builder = "default"
    body_jms: bool = False
    key_header: str | None = None
    copy_properties: bool = False
    descriptor_fields: bool = False
    batch_size: int = DEFAULT_BATCH_SIZE
    max_poll_ms: int = 0
    gap_ms: int | None = None
    state_queue: str | None = None
    tasks_max: str | None = None
    tolerance: str = "none"
    log_errors: bool = False
    log_messages: bool = False
    dlq_topic: str | None = None
    dlq_context_headers: bool = False
    json_schemas: bool = False
    json_schema: str | None = None
    xml_schema: str | None = None
    xml_root: str | None = None
    xml_xsd: str | None = None

    def __post_init__(self) -> None:
        def set_field(name: str, value: object) -> None:
            object.__setattr__(self, name, value)

        if not self.topic or not self.topic.strip():
            raise OptionError(f"{TOPIC} must not be empty")
        if not callable(self.builder):
            known = BUILDERS.get(str(self.builder).rsplit(".", 1)[-1])
            if known is None:
                raise OptionError(f"unsupported record builder: {self.builder!r}")
            set_field("builder", known)
        if self.key_header is not None and self.key_header not in KEY_HEADERS:
            raise OptionError(f"unsupported key header: {self.key_header!r}")
        if self.batch_size < 1:
            raise OptionError(f"{BATCH_SIZE} must be at least 1")
        if self.max_poll_ms < 0:
            raise OptionError(f"{MAX_POLL_TIME} must not be negative")
        if self.gap_ms is not None and self.gap_ms < 0:
            raise OptionError(f"{SUBSEQUENT_TIMEOUT} must not be negative")
        set_field("tolerance", check_tolerance(self.tolerance))
        set_field("dlq_topic", (self.dlq_topic or "").strip() or None)
        set_field("queue", (self.queue or "").strip())
        if self.json_schema is not None and self.json_schema.strip():
            try:
                read_schema(self.json_schema)
            except SchemaError as problem:
                raise OptionError(f"{JSON_SCHEMA_CONTENT}: {problem}") from problem
        # Schema content counts only when schemas are switched on; blank text is no schema.
        usable = self.json_schemas and (self.json_schema or "").strip()
        set_field("json_schema", usable or None)

    @property
    def source(self) -> str:
        return f"{self.queue_manager}/{self.queue}"

    @classmethod
    def from_properties(cls, props: Mapping[str, str], **more) -> "IngestOptions":
        """Read the options from a property map, as kept in existing configuration files."""
        for name in (TOPIC, QUEUE, QUEUE_MANAGER, BUILDER):
            if not (props.get(name) or "").strip():
                raise OptionError(f"{name} must not be empty")
        return cls(
            topic=props[TOPIC],
            queue=props[QUEUE],
            queue_manager=props[QUEUE_MANAGER],
            builder=props[BUILDER],
            body_jms=_flag(props, BODY_JMS),
            key_header=props.get(KEY_HEADER),
            copy_properties=_flag(props, COPY_PROPERTIES),
            descriptor_fields=_flag(props, DESCRIPTOR_READ),
            batch_size=_number(props, BATCH_SIZE, DEFAULT_BATCH_SIZE),
            max_poll_ms=_number(props, MAX_POLL_TIME, 0),
            gap_ms=_number(props, SUBSEQUENT_TIMEOUT, None),
            state_queue=props.get(STATE_QUEUE),
            tasks_max=props.get(TASKS_MAX),
            tolerance=props.get(TOLERANCE, "none"),
            log_errors=_flag(props, LOG_ENABLE),
            log_messages=_flag(props, LOG_MESSAGES),
            dlq_topic=props.get(DLQ_TOPIC),
            dlq_context_headers=_flag(props, DLQ_CONTEXT),
            json_schemas=_flag(props, JSON_SCHEMAS_ENABLE),
            json_schema=props.get(JSON_SCHEMA_CONTENT),
            xml_root=props.get(XML_ROOT),
            xml_xsd=props.get(XML_XSD),
            **more,
        )


def check_tolerance(value: str) -> str:
    """``none`` or ``all`` in any case; anything else is an error."""
    lowered = value.lower()
    if lowered not in ("none", "all"):
        raise OptionError(f"{TOLERANCE} must be none or all, not {value!r}")
    return lowered


def delivery_mode(options: IngestOptions) -> str:
    """Exactly once needs a place for state and a single reader; otherwise at least once."""
    if options.state_queue and options.tasks_max in (None, "1"):
        return "exactly-once"
    return "at-least-once"


def _flag(props: Mapping[str, str], name: str) -> bool:
    return str(props.get(name, "false")).strip().lower() == "true"


def _number(props: Mapping[str, str], name: str, default: int | None) -> int | None:
    text = props.get(name)
    if text is None:
        return default
    try:
        return int(str(text).strip())
    except ValueError as problem:
        raise OptionError(f"{name} must be a whole number, not {text!r}") from problem
