import datetime

from pyspark.sql import functions as F

from postlane.functions.headers import header, with_headers
from postlane.schemas import MESSAGES
from postlane.sources import messages as envelopes
from postlane.sources.messages import MessageSpec, Property

TOPIC_ROWS = (
    "key binary, value binary, topic string, partition int, offset long, timestamp timestamp,"
    "headers array<struct<key: string, value: binary>>"
)
NOON = datetime.datetime(2024, 1, 1, 12, 0, 0, 250_999)


def test_any_table_can_be_messages(spark):
    rows = [(255, NOON, "hi", None), (256, NOON, None, 5)]
    df = spark.createDataFrame(rows, "id long, at timestamp_ntz, t string, n int")
    spec = MessageSpec(
        source=F.lit("QM1/Q"),
        arrival_seq=F.col("id"),
        message_id=envelopes.queue_id(F.col("id")),
        body_kind=F.lit("text"),
        body_text=F.col("t"),
        correlation_id=F.lit("c"),
        time=F.col("at"),
        properties=(
            Property("n", "INT32", F.col("n")),
            Property("some", "STRING", F.lit("x"), F.col("id") == 256),
            Property("raw", "BYTES", F.unhex(F.lit("0a"))),
        ),
    )
    seen = envelopes.as_messages(df, spec)
    assert seen.schema.simpleString() == MESSAGES.simpleString()
    first, second = seen.orderBy("arrival_seq").collect()
    assert first.message_id == "ID:" + "ff".rjust(48, "0")
    assert first.jms_timestamp == 1_704_110_400_250
    assert bytes(first.correlation_id_bytes) == b"c"
    assert [p.name for p in first.properties] == ["n", "raw"]
    assert [(p.name, p.text) for p in second.properties] == [("n", "5"), ("some", "x"), ("raw", None)]


def test_tables_round_trip(spark, make, tmp_path):
    path = str(tmp_path / "landed")
    make({"body_text": "a"}, {"body_text": "b"}).write.parquet(path)
    read = envelopes.read_messages(spark, path)
    assert read.schema == MESSAGES and read.count() == 2


def test_rows_of_a_broker_topic(spark):
    landed = [
        (b"k", b"{}", "landing", 3, 42, NOON, [("h", b"1")]),
        (None, None, "landing", 0, 7, NOON, None),
    ]
    rows = spark.createDataFrame(landed, TOPIC_ROWS)
    seen = envelopes.topic_messages(rows)
    assert seen.columns == MESSAGES.names
    first = seen.where("arrival_seq = 42").first()
    assert (first.source, first.message_id) == ("landing/3", "landing/3/42")
    assert (first.body_kind, bytes(first.body_bytes), first.correlation_id) == ("bytes", b"{}", "k")
    value = with_headers(seen.where("arrival_seq = 42"), True).select(header("h", "binary"))
    assert bytes(value.first()[0]) == b"1"
    assert seen.where("arrival_seq = 7").first().properties == []
