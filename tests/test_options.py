import pytest
from pyspark.sql import types as T

from postlane.connect_schema import SchemaError, connect_schema, read_schema
from postlane.options import IngestOptions, OptionError, delivery_mode

NEEDED = {
    "topic": "mytopic",
    "mq.queue": "DEV.QUEUE.1",
    "mq.queue.manager": "QM1",
    "mq.record.builder": "some.package.DefaultRecordBuilder",
}
PROBLEM = {"mq.record.builder.json.schemas.enable": "true"}
SCHEMA = "mq.record.builder.json.schema.content"


def options(**more):
    return IngestOptions.from_properties({**NEEDED, **more})


def test_defaults():
    read = options()
    assert (read.builder, read.body_jms, read.key_header) == ("default", False, None)
    assert (read.batch_size, read.max_poll_ms, read.gap_ms) == (250, 0, None)
    assert (read.tolerance, read.dlq_topic, read.copy_properties) == ("none", None, False)
    assert read.source == "QM1/DEV.QUEUE.1"


@pytest.mark.parametrize("name", NEEDED)
@pytest.mark.parametrize("value", [None, "", "  "])
def test_needed_options_must_not_be_empty(name, value):
    props = {**NEEDED, name: value}
    with pytest.raises(OptionError):
        IngestOptions.from_properties({k: v for k, v in props.items() if v is not None})


@pytest.mark.parametrize(
    "name,value",
    [
        ("mq.batch.size", "0"),
        ("mq.batch.size", "many"),
        ("mq.receive.max.poll.time.ms", "-1"),
        ("mq.receive.subsequent.timeout.ms", "-1"),
        ("errors.tolerance", "some"),
        ("mq.record.builder.key.header", "JMSType"),
        ("mq.record.builder", "some.package.Unknown"),
    ],
)
def test_bad_values_are_refused(name, value):
    with pytest.raises(OptionError):
        options(**{name: value})


def test_numbers_at_their_bounds():
    read = options(
        **{
            "mq.batch.size": "1",
            "mq.receive.max.poll.time.ms": "0",
            "mq.receive.subsequent.timeout.ms": "0",
        }
    )
    assert (read.batch_size, read.max_poll_ms, read.gap_ms) == (1, 0, 0)


@pytest.mark.parametrize("value", ["ALL", "all", "All"])
def test_tolerance_ignores_case(value):
    assert options(**{"errors.tolerance": value}).tolerance == "all"


def test_dead_letter_topic_is_trimmed_and_blank_is_none():
    name = "errors.deadletterqueue.topic.name"
    assert options(**{name: "  dead "}).dlq_topic == "dead"
    assert options(**{name: "   "}).dlq_topic is None


def test_builder_names():
    for given, meant in [
        ("a.b.JsonRecordBuilder", "json"),
        ("json", "json"),
        ("a.XmlMQRecordBuilder", "xml"),
    ]:
        assert options(**{"mq.record.builder": given}).builder == meant


@pytest.mark.parametrize(
    "text",
    [
        "Hello world",
        "/some/file.json",
        "{",
        "{}",
        '{"type":"thing"}',
        '{"type":"struct"}',
        '{"type":"struct","fields":[{"type":"string"}]}',
        '{"type":"array"}',
        '{"type":"struct","fields":[{"field":"a","type":"string"},{"field":"a","type":"int8"}]}',
    ],
)
def test_bad_schema_content_is_refused(text):
    with pytest.raises(OptionError):
        options(**PROBLEM, **{SCHEMA: text})


def test_schema_content_counts_only_when_enabled_and_not_blank():
    schema = '{"type":"struct","fields":[{"field":"a","type":"string"}]}'
    assert options(**{SCHEMA: schema}).json_schema is None
    assert options(**PROBLEM, **{SCHEMA: f"  {schema} "}).json_schema == schema
    assert options(**PROBLEM, **{SCHEMA: "   "}).json_schema is None


def test_schema_types():
    text = """{"type":"struct","fields":[
      {"field":"seat","type":"int32"},{"field":"a","type":"string"},{"field":"b","type":"int64"},
      {"field":"c","type":"double"},{"field":"d","type":"boolean"},{"field":"e","type":"float"},
      {"field":"f","type":"array","items":{"type":"string"}},
      {"field":"g","type":"array","items":{"type":"int32"}},
      {"field":"h","type":"struct","fields":[{"field":"note","type":"string"},
        {"field":"amount","type":"int64"}]},
      {"field":"i","type":"map","keys":{"type":"string"},"values":{"type":"int16"}},
      {"field":"j","type":"bytes","optional":true},{"field":"k","type":"int8"}]}"""
    assert connect_schema(text) == T.StructType.fromDDL(
        "seat int, a string, b bigint, c double, d boolean, e float, f array<string>, g array<int>,"
        "h struct<note: string, amount: bigint>, i map<string, smallint>, j binary, k tinyint"
    )
    assert read_schema('{"type":"int32","optional":true}').optional
    with pytest.raises(SchemaError):
        connect_schema('{"type":"map","keys":{"type":"int32"},"values":{"type":"string"}}')


@pytest.mark.parametrize(
    "state_queue,tasks,mode",
    [
        ("STATE", None, "exactly-once"),
        ("STATE", "1", "exactly-once"),
        ("STATE", "2", "at-least-once"),
        ("", "1", "at-least-once"),
        (None, None, "at-least-once"),
    ],
)
def test_delivery_mode(state_queue, tasks, mode):
    more = {"mq.exactly.once.state.queue": state_queue, "tasks.max": tasks}
    read = options(**{name: value for name, value in more.items() if value is not None})
    assert delivery_mode(read) == mode
