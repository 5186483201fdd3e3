import pytest
from pyspark.errors import PySparkException

from conftest import prop
from postlane.functions.encoding import encode_value, to_topic_rows
from postlane.operators.batching import partition_by_key
from postlane.operators.records import to_records
from postlane.operators.routing import route_by
from postlane.options import IngestOptions

BYTES = {"body_kind": "bytes", "body_bytes": b"\x01\x02"}
TEXT = {"body_text": 'say "hi"'}


def records(df, **more):
    chosen = IngestOptions(**{"topic": "t", "body_jms": True, **more})
    return route_by(to_records(df, chosen), chosen)


def encoded(df, encoding):
    found = encode_value(df, encoding).orderBy("arrival_seq").collect()
    return [None if r.encoded is None else bytes(r.encoded) for r in found]


def test_bytes(make):
    assert encoded(records(make(BYTES, {"body_kind": "none"})), "bytes") == [b"\x01\x02", None]
    with pytest.raises(PySparkException, match="only bytes"):
        encode_value(records(make(BYTES, TEXT)), "bytes").count()


def test_string(make):
    assert encoded(records(make(TEXT, {"body_kind": "none"})), "string") == [b'say "hi"', None]


def test_json(make):
    found = encoded(records(make(TEXT, BYTES, {"body_kind": "none"})), "json")
    assert found == [b'"say \\"hi\\""', b'"AQI="', None]
    raw = records(make({"body_kind": "none"}), body_jms=False)
    assert encoded(raw, "json") == [b"null"]


def test_json_of_structures(make):
    free = records(make({"body_text": '{"b": [1, 2.5], "a": null}'}), builder="json")
    assert encoded(free, "json") == [b'{"a":null,"b":[1,2.5]}']
    schema = (
        '{"type":"struct","fields":[{"field":"b","type":"int32"},'
        '{"field":"a","type":"string","optional":true}]}'
    )
    typed = records(
        make({"body_text": '{"b": 1}'}), builder="json", json_schemas=True, json_schema=schema
    )
    assert encoded(typed, "json") == [b'{"b":1,"a":null}']


def test_dead_letters_are_base64_in_json(make):
    df = records(make({"body_text": "{"}), builder="json", tolerance="all", dlq_topic="dead")
    assert encoded(df, "json") == [b'"ew=="']


def test_topic_rows(make):
    message = {**TEXT, "properties": [prop("n", "INT32", "5"), prop("b", "BYTES", None, b"x")]}
    df = records(make(message), key_header="JMSMessageID", copy_properties=True)
    out = to_topic_rows(df, "string", "json")
    assert out.columns == ["topic", "key", "value", "headers"]
    row = out.first()
    assert (row.topic, bytes(row.key)) == ("t", f"{1:048x}".encode())
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("n", b"5"), ("b", b'"eA=="')]


def test_topic_rows_name_their_partition(make):
    laid = partition_by_key(records(make(TEXT), key_header="JMSMessageID"), 3)
    assert to_topic_rows(laid, "string").first().partition in (0, 1, 2)


def test_unknown_encoding(make):
    with pytest.raises(ValueError):
        encode_value(records(make(TEXT)), "avro")
