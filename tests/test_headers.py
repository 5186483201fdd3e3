import base64

import pytest
from pyspark.sql import functions as F

from conftest import prop
from postlane.functions import headers

CASES = [
    ("strProp", "STRING", "hello", None, "string", "hello", '"hello"'),
    ("intProp", "INT32", "42", None, "int32", "42", "42"),
    ("longProp", "INT64", "123456789012345", None, "int64", "123456789012345", "123456789012345"),
    ("floatProp", "FLOAT32", "1.5", None, "float", "1.5", "1.5"),
    ("doubleProp", "FLOAT64", "3.141592653589793", None, "double", "3.141592653589793", "3.141592653589793"),
    ("boolProp", "BOOLEAN", "true", None, "boolean", "true", "true"),
    ("byteProp", "INT8", "64", None, "int8", "64", "64"),
    ("shortProp", "INT16", "1000", None, "int16", "1000", "1000"),
    ("quoted", "STRING", 'a "b" \\ \n', None, "string", 'a "b" \\ \n', '"a \\"b\\" \\\\ \\n"'),
]


def copied(df, **options):
    return headers.with_headers(df, copy=True, **options).first().headers


def test_off_by_default(make):
    assert headers.with_headers(make({})).first().headers is None


def test_types_and_order_are_kept(make):
    df = make({"properties": [prop(n, t, x, b) for n, t, x, b, *_ in CASES]})
    found = copied(df)
    assert [tuple(h) for h in found] == [(n, t, x, b) for n, t, x, b, *_ in CASES]


def test_null_unknown_and_unreadable_properties(make):
    df = make(
        {
            "properties": [
                prop("testObject", "INT32"),
                prop("odd", "java.util.Date", "today"),
                prop("broken", "INT32", "abc"),
                prop("wide", "INT8", "300"),
                prop("fine", "INT8", "30"),
            ]
        }
    )
    assert [(h.key, h.type, h.text) for h in copied(df)] == [
        ("testObject", "STRING", None),
        ("odd", "STRING", "today"),
        ("fine", "INT8", "30"),
    ]


def test_descriptor_fields(make):
    ids = bytes(range(1, 25))
    df = make(
        {
            "message_id": "ID:aa",
            "correlation_id": "ID:" + ids.hex(),
            "properties": [
                prop("JMS_IBM_MQMD_MsgId", "BYTES", None, b"\xaa"),
                prop("JMS_IBM_MQMD_CorrelId", "BYTES", None, ids),
                prop("JMS_IBM_MQMD_AccountingToken", "BYTES", None, bytes(32)),
                prop("JMS_IBM_MQMD_Priority", "INT32", "4"),
                prop("volume", "INT32", "11"),
            ],
        }
    )
    assert [h.key for h in copied(df)] == ["volume"]
    found = copied(df, descriptor_fields=True)
    assert [(h.type, h.text) for h in found] == [
        ("STRING", "ID:aa"),
        ("STRING", "ID:0102030405060708090a0b0c0d0e0f101112131415161718"),
        ("BYTES", None),
        ("INT32", "4"),
        ("INT32", "11"),
    ]
    assert bytes(found[2].bytes) == bytes(32) and found[0].bytes is None


def test_lookup_takes_the_last_and_casts(make):
    df = make(
        {
            "properties": [
                prop("teststring", "STRING", "first"),
                prop("volume", "INT32", "11"),
                prop("decimalmeaning", "FLOAT64", "42.0"),
                prop("teststring", "STRING", "myvalue"),
                prop("token", "BYTES", None, b"xy"),
            ]
        }
    )
    row = headers.with_headers(df, copy=True).select(
        headers.header("teststring").alias("s"),
        headers.header("volume", "int").alias("i"),
        headers.header("decimalmeaning", "double").alias("d"),
        headers.header("token", "binary").alias("b"),
        headers.header("absent").alias("none"),
        headers.header("teststring", "int").alias("uncastable"),
    ).first()
    assert (row.s, row.i, row.d, bytes(row.b), row.none, row.uncastable) == (
        "myvalue",
        11,
        42.0,
        b"xy",
        None,
        None,
    )


def test_explode_keeps_records_without_headers(make):
    df = make({"properties": [prop("a", "STRING", "1"), prop("b", "STRING", "2")]}, {})
    found = headers.explode_headers(
        headers.with_headers(df, copy=True).select("arrival_seq", "headers")
    ).orderBy("arrival_seq", "position").collect()
    assert [(r.arrival_seq, r.position, r.key) for r in found] == [
        (1, 0, "a"),
        (1, 1, "b"),
        (2, None, None),
    ]


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_encodings(make, case):
    name, kind, text, raw, wire, simple, as_json = case
    df = headers.with_headers(make({"properties": [prop(name, kind, text, raw)]}), copy=True)
    entry = F.col("headers")[0]
    row = df.select(
        headers.encode_header(entry, "simple").alias("s"),
        headers.encode_header(entry, "json").alias("j"),
        headers.encode_header(entry, "json_schema").alias("js"),
    ).first()
    assert (row.s, row.j) == (simple, as_json)
    assert row.js == '{"schema":{"type":"%s","optional":false},"payload":%s}' % (wire, as_json)


def test_bytes_and_null_encodings(make):
    raw = bytes(range(200))
    df = make({"properties": [prop("t", "BYTES", None, raw), prop("n", "STRING")]})
    df = headers.with_headers(df, copy=True)
    encoded = {
        mode: df.select(
            F.transform("headers", lambda h: headers.encode_header(h, mode)).alias("e")
        ).first().e
        for mode in ("simple", "json", "json_schema")
    }
    text = base64.b64encode(raw).decode()
    assert encoded["simple"] == [text, None]
    assert encoded["json"] == [f'"{text}"', "null"]
    assert encoded["json_schema"] == [
        '{"schema":{"type":"bytes","optional":false},"payload":"%s"}' % text,
        '{"schema":{"type":"string","optional":true},"payload":null}',
    ]
    with pytest.raises(ValueError):
        headers.encode_header(F.col("headers")[0], "xml")
