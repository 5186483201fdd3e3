import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import prop
from postlane.functions import failures
from postlane.functions.headers import header
from postlane.operators import routing
from postlane.operators.records import to_records, with_position
from postlane.options import IngestOptions, OptionError

TOPIC, DEAD = "mytopic", "__dlq"
BODIES = [
    "Invalid JSON message",
    '{ "i": 0 }',
    "{ malformed json",
    '{ "i": 1, "text": "valid" }',
    "{}",
]


def options(**more):
    base = dict(topic=TOPIC, queue="DEV.QUEUE.1", builder="json", body_jms=True, tolerance="all")
    return IngestOptions(**{**base, **more})


def routed(df, **more):
    chosen = options(**more)
    return routing.route_by(to_records(df, chosen), chosen)


def rows(df):
    return df.orderBy("arrival_seq").collect()


def bodies(make, **more):
    return make(*[{"body_text": body, **more} for body in BODIES])


def test_tolerance_none_fails_even_for_a_count(make):
    for action in ("count", "collect"):
        with pytest.raises(PySparkException, match="MalformedBody"):
            getattr(routed(bodies(make), tolerance="none"), action)()


def test_tolerance_none_passes_good_records(make):
    assert routed(make({"body_text": "{}"}), tolerance="none").count() == 1


def test_tolerance_all_without_topic_skips(make):
    assert [r.arrival_seq for r in rows(routed(bodies(make)))] == [2, 4, 5]
    assert [r.arrival_seq for r in rows(routed(bodies(make), dlq_topic="  "))] == [2, 4, 5]


def test_poison_goes_to_the_dead_letter_topic_in_order(make):
    found = rows(routed(bodies(make), dlq_topic=DEAD, key_header="JMSMessageID"))
    assert [r.topic for r in found] == [DEAD, TOPIC, DEAD, TOPIC, TOPIC]
    assert found[0].value_type == "BYTES"
    assert bytes(found[0].value_bytes) == b"Invalid JSON message"
    assert found[0].value_json is None and found[0].key_text is None
    assert found[1].key_text == f"{2:048x}" and found[1].value_type == "JSON"


def test_dead_letter_key_can_be_kept(make):
    chosen = options(key_header="JMSMessageID")
    records = to_records(bodies(make), chosen)
    found = rows(routing.route(records, "all", DEAD, dlq_key="always"))
    assert [r.key_text for r in found] == [f"{n:048x}" for n in range(1, 6)]


def test_dead_letter_payloads(make):
    df = make(
        {"body_kind": "bytes", "body_bytes": b"\x00bad"},
        {"body_text": "bad"},
        {"body_text": None},
        {"body_kind": "map"},
        {"body_kind": "none"},
    )
    found = rows(routed(df, dlq_topic=DEAD))
    assert [r.arrival_seq for r in found] == [1, 2, 4, 5]
    assert [bytes(r.value_bytes) for r in found[:2]] == [b"\x00bad", b"bad"]
    assert b'"body_kind":"map"' in bytes(found[2].value_bytes)


def test_dead_letter_time_is_the_message_time_even_in_raw_mode(make):
    found = rows(routed(bodies(make), dlq_topic=DEAD, body_jms=False))
    assert [r.ts_ms for r in found] == [1_700_000_000_001, None, 1_700_000_000_003, None, None]
    typed = rows(routed(bodies(make), dlq_topic=DEAD))
    assert all(r.ts_ms for r in typed)


def test_a_missing_key_is_poison_too(make):
    df = make({"body_text": "{}", "message_id": None}, {"body_text": "{}"})
    found = rows(routed(df, dlq_topic=DEAD, key_header="JMSMessageID"))
    assert [r.topic for r in found] == [DEAD, TOPIC]
    assert bytes(found[0].value_bytes) == b"{}"


PROPERTIES = [
    prop("teststring", "STRING", "myvalue"),
    prop("volume", "INT32", "11"),
    prop("decimalmeaning", "FLOAT64", "42.0"),
]


def test_dead_letters_keep_copied_properties(make):
    df = bodies(make, properties=PROPERTIES)
    found = rows(routed(df, dlq_topic=DEAD, copy_properties=True))
    assert [h.key for h in found[0].headers] == ["teststring", "volume", "decimalmeaning"]
    assert rows(routed(df, dlq_topic=DEAD))[0].headers is None


@pytest.mark.parametrize("copy", [False, True])
def test_context_headers(make, copy):
    df = bodies(make, properties=PROPERTIES)
    found = routed(df, dlq_topic=DEAD, dlq_context_headers=True, copy_properties=copy)
    row = found.where("arrival_seq = 1").first()
    prefix = "__connect.errors."
    names = [h.key for h in row.headers]
    assert names == (["teststring", "volume", "decimalmeaning"] if copy else []) + [
        prefix + name
        for name in (
            "topic",
            "exception.class.name",
            "exception.message",
            "jms.message.id",
            "jms.timestamp",
            "mq.queue",
            "timestamp",
            "cause.class",
            "cause.message",
            "exception.stacktrace",
        )
    ]
    values = {h.key.removeprefix(prefix): (h.type, h.text) for h in row.headers}
    assert values["topic"] == ("STRING", TOPIC)
    assert values["exception.message"][1].startswith("Converting byte[] to Kafka Connect data")
    assert values["jms.message.id"][1] == f"ID:{1:048x}"
    assert values["jms.timestamp"] == ("INT64", "1700000000001")
    assert values["mq.queue"] == ("STRING", "DEV.QUEUE.1")
    assert int(values["timestamp"][1]) > 1_700_000_000_000
    good = found.where("arrival_seq = 2").first()
    assert (good.headers is None) == (not copy)
    assert copy is False or len(good.headers) == 3


def test_no_cause_headers_without_cause(make):
    df = routed(make({"body_kind": "map"}), dlq_topic=DEAD, dlq_context_headers=True)
    names = [h.key for h in df.first().headers]
    assert not any("cause" in name for name in names)
    assert names[-1] == "__connect.errors.exception.stacktrace"


def test_trace_is_cut_at_500(spark):
    df = spark.createDataFrame([("a" * 500,), ("b" * 501,), (None,)], "t string")
    found = [r.x for r in df.select(failures.truncate_trace(F.col("t")).alias("x")).collect()]
    assert found == ["a" * 500, "b" * 500 + "... [truncated]", None]


def test_reasons(spark):
    texts = ["error:", "error : \n ", "a: b", "", "  ", None, " x "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [r.x for r in df.select(failures.error_reason(F.col("t")).alias("x")).collect()]
    assert found == ["error", "error", "a: b"] + ["Unknown error"] * 3 + [" x"]


def test_error_report(make):
    records = to_records(bodies(make), options())
    plain = routing.error_report(records).collect()
    assert len(plain) == 1 and plain[0].errors == 2
    assert plain[0].reason.endswith("serialization error")
    assert (plain[0].first_ms, plain[0].last_ms) == (1_700_000_000_001, 1_700_000_000_003)
    detailed = routing.error_report(records, include_messages=True).first()
    assert bytes(detailed.sample) == b"Invalid JSON message"


@pytest.mark.parametrize(
    "reason,retriable,closable",
    [(code, True, True) for code in (2003, 2537, 2009, 2538, 2035, 2059, 2161, 2162, 2195)]
    + [(2016, True, False), (1, False, True), (None, False, True)],
)
def test_triage(spark, reason, retriable, closable):
    causes = [("ClientError", None), ("BrokerError", reason), ("BrokerError", 1)]
    if reason is None:
        causes = causes[:2]
    df = spark.createDataFrame([(causes,)], "causes array<struct<class: string, reason: int>>")
    row = failures.triage_failures(df).first()
    assert (row.reason, row.retriable, row.closable) == (
        -1 if reason is None else reason,
        retriable,
        closable,
    )


def test_triage_without_causes(spark):
    df = spark.createDataFrame([(None,), ([],)], "causes array<struct<class: string, reason: int>>")
    assert [r.reason for r in failures.triage_failures(df).collect()] == [-1, -1]


def test_position(make):
    chosen = IngestOptions(topic="a")
    row = with_position(to_records(make({}), chosen), "b", "QM/Q", 7).first()
    assert (row.topic, row.source, row.sequence_id) == ("b", "QM/Q", 7)
    assert with_position(to_records(make({}), chosen), "b").first().sequence_id is None


def test_unknown_tolerance(make):
    with pytest.raises(OptionError):
        routing.route(to_records(make({}), options()), "some")


def failing(spark, reasons):
    """Records that failed, given (topic, reason, time) as columns."""
    return reasons.selectExpr(
        "topic",
        "named_struct('class', 'Refused', 'message', reason) AS error",
        "named_struct('jms_timestamp', at) AS origin",
    )


def test_error_templates_of_five_shapes(spark):
    shapes = ["no user %s", "user %s has no order %s", "late by %s ms", "%s", "disk %s of host %s is full"]
    told = " ".join(f"WHEN {at} THEN '{shape.replace('%s', '{}')}'" for at, shape in enumerate(shapes))
    reasons = spark.range(0, 50_000, 1, 8).selectExpr(
        "'a' AS topic", f"replace(CASE id % 5 {told} END, '{{}}', concat('x', id)) AS reason", "id AS at"
    )
    found = {row.template: row for row in routing.error_templates(failing(spark, reasons)).collect()}
    assert set(found) == {shape.replace("%s", "*") for shape in shapes}
    assert all(row.errors == row.reasons == 10_000 for row in found.values())
    assert (found["no user *"].first_ms, found["no user *"].last_ms) == (0, 49_995)


def test_error_templates_keep_what_is_rare_or_odd(spark):
    rows = [("a", "x 1", 1), ("a", "x 2", 2), (None, "x 1", 3), ("a", None, 4), ("a", "y: ", None), ("a", "y", 9)]
    rows += [("b", f"busy {at}", at) for at in range(30)] + [("b", "stray words", 5)]
    found = routing.error_templates(failing(spark, spark.createDataFrame(rows, "topic string, reason string, at long")))
    got = {(row.topic, row.template): (row.errors, row.reasons, row.first_ms, row.last_ms, row.example) for row in found.collect()}
    assert got == {
        ("a", "x 1"): (1, 1, 1, 1, "x 1"),
        ("a", "x 2"): (1, 1, 2, 2, "x 2"),
        (None, "x 1"): (1, 1, 3, 3, "x 1"),
        ("a", "Unknown error"): (1, 1, 4, 4, "Unknown error"),
        ("a", "y"): (2, 1, 9, 9, "y"),
        ("b", "busy *"): (30, 30, 0, 29, "busy 0"),
        ("b", "* *"): (1, 1, 5, 5, "stray words"),
    }
    assert routing.error_templates(failing(spark, found.limit(0).selectExpr("topic", "example AS reason", "errors AS at"))).count() == 0
