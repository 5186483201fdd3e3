import json

import pytest
from pyspark.sql import functions as F

from postlane.functions import values
from postlane.options import IngestOptions, OptionError

# A parcel: a number too wide for a double, a list of structs, a struct two deep, a map, a default, an option.
PARCEL_SCHEMA = json.dumps(
    {
        "type": "struct",
        "fields": [
            {"field": "route", "type": "struct", "fields": [
                {"field": "carrier", "type": "struct", "fields": [{"field": "code", "type": "string"}]},
                {"field": "legs", "type": "array", "items": {
                    "type": "struct",
                    "fields": [{"field": "day", "type": "int16"}, {"field": "port", "type": "string"}],
                }},
            ]},
            {"field": "serial", "type": "int64"},
            {"field": "stamps", "type": "map", "keys": {"type": "string"}, "values": {"type": "int32"}},
            {"field": "scans", "type": "array", "items": {"type": "int64"}},
            {"field": "fragile", "type": "boolean", "default": False},
            {"field": "kilos", "type": "double"},
            {"field": "remark", "type": "string", "optional": True},
        ],
    }
)


def parcel(drop=(), **changed):
    """A body that fits, with some fields dropped or changed."""
    body = {
        "serial": 9007199254740993,
        "kilos": 0.375,
        "route": {"legs": [{"port": "Oslo", "day": 3}, {"port": "Gdynia", "day": 5}], "carrier": {"code": "NX"}},
        "scans": [],
        "stamps": {"red": 4, "blue": 0},
        **changed,
    }
    return json.dumps({name: value for name, value in body.items() if name not in drop})


def rows(df):
    return df.orderBy("arrival_seq").collect()


def test_raw_takes_any_body_as_bytes(make):
    df = make(
        {"body_text": "héllo"},
        {"body_kind": "bytes", "body_bytes": b"\x00\xff"},
        {"body_kind": "none"},
    )
    found = rows(values.build_raw(df))
    assert [r.value_type for r in found] == ["BYTES"] * 3
    assert [r.value_bytes and bytes(r.value_bytes) for r in found] == [
        "héllo".encode(),
        b"\x00\xff",
        None,
    ]
    assert all(r.value_error is None for r in found)


def test_typed_bodies(make):
    df = make(
        {"body_text": "text"},
        {"body_kind": "bytes", "body_bytes": b"raw"},
        {"body_kind": "none"},
        {"body_text": None},
        {"body_kind": "map"},
        {"body_kind": "object"},
        {"body_kind": "stream"},
    )
    found = rows(values.build_typed(df))
    assert [r.value_type for r in found] == ["STRING", "BYTES", None, None, None, None, None]
    assert found[0].value_text == "text" and bytes(found[1].value_bytes) == b"raw"
    assert [r.value_error is None for r in found] == [True] * 4 + [False] * 3
    assert found[4].value_error["message"] == "Unsupported JMS message type"


def json_outcome(make, *bodies, **options):
    df = values.build_json(make(*[{"body_text": body} for body in bodies]), **options)
    picked = rows(
        df.select("arrival_seq", "value_type", F.to_json("value_json").alias("j"), "value_error")
    )
    return [r.j if r.value_error is None else r.value_error["class"] for r in picked]


def test_schemaless_json(make):
    assert json_outcome(
        make,
        "Invalid JSON message",
        '{ "i": 0 }',
        "{ malformed json",
        '{ "i": 1, "text": "valid" }',
        "{}",
        "",
        None,
        "{'i':1}",
        '{"i":NaN}',
        '{"a":1,"a":2}',
        '"text"',
        "[1,2]",
    ) == [
        "MalformedBody",
        '{"i":0}',
        "MalformedBody",
        '{"i":1,"text":"valid"}',
        "{}",
        "MalformedBody",
        "EmptyBody",
        "MalformedBody",
        "MalformedBody",
        '{"a":2}',
        '"text"',
        "[1,2]",
    ]


def test_json_null_is_a_good_record_without_value(make):
    row = values.build_json(make({"body_text": "null"})).first()
    assert row.value_error is None and row.value_type is None


def test_schemaless_json_numbers(make):
    df = values.build_json(make({"body_text": '{"i": 5, "c": 8.25}'}))
    row = df.select(
        F.try_variant_get("value_json", "$.i", "bigint").alias("i"),
        F.try_variant_get("value_json", "$.c", "double").alias("c"),
    ).first()
    assert (row.i, row.c) == (5, 8.25)


def test_json_bytes_and_other_kinds(make):
    df = make(
        {"body_kind": "bytes", "body_bytes": b'{"i":0}'},
        {"body_kind": "bytes", "body_bytes": b'{"i":"\xff"}'},
        {"body_kind": "map"},
        {"body_kind": "none"},
        {"body_kind": "bytes", "body_bytes": None},
    )
    found = rows(values.build_json(df))
    assert [r.value_error and r.value_error["class"] for r in found] == [
        None,
        "MalformedBody",
        "UnsupportedBody",
        "UnsupportedBody",
        None,
    ]


def test_configured_schema(make):
    df = make(
        {"body_text": parcel()},
        {"body_text": parcel(remark="this side up", fragile=True, scans=[2**40, -1])},
        {"body_text": parcel(stamps={}, remark=None)},
    )
    found = [r.value for r in rows(values.build_json(df, schema=PARCEL_SCHEMA))]
    assert [value.serial for value in found] == [9007199254740993] * 3
    assert found[0].route.carrier.code == "NX"
    assert [(leg.port, leg.day) for leg in found[0].route.legs] == [("Oslo", 3), ("Gdynia", 5)]
    assert [value.stamps for value in found] == [{"red": 4, "blue": 0}] * 2 + [{}]
    assert [value.scans for value in found] == [[], [2**40, -1], []]
    assert [value.fragile for value in found] == [False, True, False]
    assert [value.remark for value in found] == [None, "this side up", None]


@pytest.mark.parametrize(
    "body",
    [
        parcel(drop=["serial"]),
        parcel(serial=None),
        parcel(serial="12"),
        parcel(serial=2**63),
        parcel(serial=1.5),
        parcel(scans=[1, None]),
        parcel(scans={}),
        parcel(stamps={"red": "four"}),
        parcel(fragile="yes"),
        parcel(route={"legs": []}),
        parcel(route={"legs": [{"port": "Oslo", "day": 40_000}], "carrier": {"code": "NX"}}),
        parcel(route={"legs": [{"port": "Oslo"}], "carrier": {"code": "NX"}}),
        parcel(route={"legs": [], "carrier": {"name": "NX"}}),
        f"[{parcel()}]",
        "null",
        "5",
        "{",
    ],
)
def test_configured_schema_refuses(make, body):
    row = values.build_json(make({"body_text": body}), schema=PARCEL_SCHEMA).first()
    assert row.value_error["class"] == "SchemaMismatch"
    assert row.value is None and row.value_type is None


def test_configured_schema_ignores_unknown_fields_and_fills_defaults(make):
    schema = """{"type":"struct","fields":[{"field":"a","type":"string"},
      {"field":"n","type":"int32","default":7},{"field":"o","type":"string","optional":true}]}"""
    row = values.build_json(make({"body_text": '{"a":"x","extra":1}'}), schema=schema).first()
    assert tuple(row.value) == ("x", 7, None)


def test_configured_schema_of_other_types(make):
    numbers = '{"type":"array","items":{"type":"int32"}}'
    assert values.build_json(make({"body_text": "[1,2]"}), schema=numbers).first().value == [1, 2]
    assert values.build_json(make({"body_text": "5"}), schema='{"type":"int8"}').first().value == 5
    optional = '{"type":"struct","optional":true,"fields":[]}'
    row = values.build_json(make({"body_text": "null"}), schema=optional).first()
    assert row.value is None and row.value_error is None


LEG = json.dumps(
    {
        "type": "struct",
        "fields": [
            {"field": "port", "type": "string"},
            {"field": "tonnes", "type": "array", "items": {"type": "int16"}},
        ],
    }
)


def enveloped(payload, schema=LEG, more=""):
    return f'{{"schema":{schema},"payload":{payload}{more}}}'


def test_embedded_schema(make):
    fitting = '{"port":"Turku","tonnes":[7,-2]}'
    cases = {
        enveloped(fitting): fitting,
        enveloped('{"tonnes":[],"port":""}'): '{"port":"","tonnes":[]}',
        enveloped('"abc"', '{"type":"string"}'): '"abc"',
        enveloped("[1,2]", '{"type":"array","items":{"type":"int32"}}'): "[1,2]",
        enveloped("null"): "SchemaMismatch",
        enveloped('{"port":"Turku","tonnes":7}'): "SchemaMismatch",
        enveloped('{"port":"Turku","tonnes":[40000]}'): "SchemaMismatch",
        enveloped('{"port":"Turku"}'): "SchemaMismatch",
        enveloped(fitting, more=',"note":1'): "SchemaMismatch",
        enveloped("1", '"{\\"type\\":\\"int32\\"}"'): "SchemaMismatch",
        enveloped("1", '{"type":"nothing"}'): "SchemaMismatch",
        f'{{"schema":{LEG}}}': "SchemaMismatch",
        f'{{"payload":{fitting}}}': "SchemaMismatch",
        "[]": "SchemaMismatch",
        "{ malformed": "MalformedBody",
    }
    assert json_outcome(make, *cases, schemas_enable=True) == list(cases.values())
    absent = json_outcome(make, enveloped("null", '{"type":"string","optional":true}'), schemas_enable=True)
    assert absent[0] in (None, "null")


def test_embedded_schema_types(make):
    cases = [
        ('{"type":"float"}', "0.1", "0.10000000149011612", "DOUBLE"),
        ('{"type":"float"}', "1e300", None, None),
        ('{"type":"double"}', "5.67", "5.67", "DOUBLE"),
        ('{"type":"double"}', "1e400", None, None),
        ('{"type":"double"}', '"NaN"', None, None),
        ('{"type":"double"}', "NaN", None, None),
        ('{"type":"bytes"}', '"aGk="', '"aGk="', "STRING"),
        ('{"type":"bytes"}', '"%%%"', None, None),
        ('{"type":"bytes"}', '"\u00e9"', None, None),
        ('{"type":"boolean"}', "true", "true", "BOOLEAN"),
        ('{"type":"boolean"}', "1", None, None),
        ('{"type":"int8"}', "128", None, None),
        ('{"type":"int64"}', "9223372036854775807", "9223372036854775807", "BIGINT"),
        ('{"type":"string"}', '{"a":"\u00e9"}', json.dumps('{"a":"\u00e9"}', ensure_ascii=False), "STRING"),
        ('{"type":"map","keys":{"type":"string"},"values":{"type":"int8"}}', '{"k":1}', '{"k":1}', "OBJECT<k: BIGINT>"),
        ('{"type":"array","optional":true,"items":{"type":"int8"},"default":[1,2]}', "null", "[1,2]", "ARRAY<BIGINT>"),
        ('{"type":"array","items":{"type":"int8"}}', "[1,null]", None, None),
    ]
    bodies = [{"body_text": f'{{"schema":{schema},"payload":{payload}}}'} for schema, payload, *_ in cases]
    found = values.build_json(make(*bodies), schemas_enable=True).orderBy("arrival_seq").select(
        "value_type",
        F.to_json("value_json").alias("text"),
        F.schema_of_variant("value_json").alias("kind"),
        F.col("value_error.class").alias("error"),
    )
    for (schema, payload, text, kind), row in zip(cases, found.collect(), strict=True):
        assert (row.text, row.kind) == (text, kind), (schema, payload, row)
        assert (row.value_type == "STRUCT") == (row.error is None) == (text is not None)


def test_defaults_of_composites(make):
    schema = (
        '{"type":"struct","fields":[{"field":"a","type":"array","items":{"type":"int32"},"default":[7]},'
        '{"field":"s","type":"struct","fields":[{"field":"x","type":"int32"}],"default":{"x":3}}]}'
    )
    row = values.build_json(make({"body_text": "{}"}), schema=schema).first()
    assert (row.value.a, row.value.s.x) == ([7], 3)
    row = values.build_json(make({"body_text": '{"a":[],"s":{"x":4}}'}), schema=schema).first()
    assert (row.value.a, row.value.s.x) == ([], 4)


# A voyage: an attribute, an element that repeats, one inside another.
VOYAGE = "_number long NOT NULL, call array<struct<_day: int, port: string>>, master struct<name: string> NOT NULL"
VOYAGE_XSD = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema">
  <xs:element name="voyage"><xs:complexType>
    <xs:sequence>
      <xs:element name="master"><xs:complexType><xs:sequence>
        <xs:element name="name" type="xs:string"/>
      </xs:sequence></xs:complexType></xs:element>
      <xs:element name="call" minOccurs="0" maxOccurs="unbounded"><xs:complexType>
        <xs:sequence><xs:element name="port" type="xs:string"/></xs:sequence>
        <xs:attribute name="day" type="xs:int"/>
      </xs:complexType></xs:element>
    </xs:sequence>
    <xs:attribute name="number" type="xs:long" use="required"/>
  </xs:complexType></xs:element>
</xs:schema>"""


def voyage(number="31", master="<master><name>Aino</name></master>", calls=(("4", "Turku"), ("6", "Visby"))):
    stops = "".join(f'<call day="{day}"><port>{port}</port></call>' for day, port in calls)
    return f'<voyage number="{number}">{master}{stops}</voyage>'


def test_xml(make, tmp_path):
    bodies = {
        f"<?xml version='1.0'?>\n<!-- first -->{voyage()}": None,
        voyage(calls=()): None,
        voyage().replace("voyage", "journey"): "SchemaMismatch",
        voyage(master=""): "SchemaMismatch",
        voyage().removesuffix("</voyage>"): "MalformedBody",
        voyage(number="many"): "MalformedBody",
    }
    df = make(*[{"body_text": body} for body in bodies], {"body_kind": "map"})
    found = rows(values.build_xml(df, VOYAGE, root="voyage"))
    assert [r.value_error and r.value_error["class"] for r in found] == [*bodies.values(), "UnsupportedBody"]
    first = found[0].value
    assert (first["_number"], first.master.name) == (31, "Aino")
    assert [(call["_day"], call.port) for call in first.call] == [(4, "Turku"), (6, "Visby")]
    xsd = tmp_path / "voyage.xsd"
    xsd.write_text(VOYAGE_XSD)
    checked = rows(values.build_xml(df, VOYAGE, xsd_path=str(xsd)))
    assert [r.value_error is None for r in checked] == [True, True] + [False] * 5


def test_xml_by_options_alone(make, tmp_path):
    xsd = tmp_path / "voyage.xsd"
    xsd.write_text(VOYAGE_XSD)
    props = {
        "topic": "voyages",
        "mq.queue": "Q",
        "mq.queue.manager": "QM1",
        "mq.record.builder": "xml",
        "mq.record.builder.root.element.name": "voyage",
        "mq.record.builder.xsd.schema.path": str(xsd),
    }
    df = values.build_values(make({"body_text": voyage("8")}), IngestOptions.from_properties(props))
    value = df.first().value
    assert (value["_number"], [call.port for call in value.call]) == (8, ["Turku", "Visby"])
    with pytest.raises(OptionError):
        other = {**props, "mq.record.builder.root.element.name": "journey"}
        values.build_values(make({}), IngestOptions.from_properties(other))
    with pytest.raises(OptionError):
        values.build_values(make({}), IngestOptions(topic="t", builder="xml"))


def test_custom_builder(make):
    def shout(messages):
        return messages.withColumns(
            {"value_type": F.lit("STRING"), "value_text": F.upper("body_text")}
        )

    row = values.build_with(make({"body_text": "hi"}), shout).first()
    assert (row.value_text, row.value_bytes, row.value_error) == ("HI", None, None)
    with pytest.raises(OptionError):
        values.build_with(make({}), "not a function")
