import pathlib
import random
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import prop
from postlane.functions.headers import with_headers
from postlane.functions.keys import with_key
from postlane.functions.values import build_json, build_raw, build_typed
from postlane.operators.delivery import latest_offset, recovery_plan, validate_state
from postlane.operators.limits import batch_by_limits
from postlane.operators.records import to_records
from postlane.operators.routing import route_by
from postlane.options import IngestOptions
from postlane.shared import new_folder
from postlane.sources.messages import stream_messages
from postlane.sources.topics import read_topic, write_topics
from postlane.streaming import ingest, reorder

ONCE = IngestOptions(
    topic="main",
    queue="Q",
    builder="json",
    body_jms=True,
    key_header="JMSMessageID",
    copy_properties=True,
    tolerance="all",
    dlq_topic="dead",
    batch_size=10,
    state_queue="STATE",
)


def batch(make, first, last, **more):
    properties = [prop("n", "INT32", "1")]
    return make(
        *[
            {
                "source": f"QM1/Q{n % 2}",
                "arrival_seq": n,
                "message_id": f"ID:{n:048x}",
                "body_text": '{"k":%d}' % n if n % 7 else "{ malformed",
                "properties": properties,
                **more,
            }
            for n in range(first, last + 1)
        ]
    )


class Place:
    """Folders of one stream and the steps a test takes with it."""

    def __init__(self, spark, folder, options=ONCE):
        self.spark, self.options = spark, options
        self.landing, self.sink = f"{folder}/landing", f"{folder}/sink"
        self.checkpoint = f"{folder}/checkpoint"

    def land(self, df):
        df.coalesce(1).write.mode("append").parquet(self.landing)

    def run(self, offsets=None):
        stream = stream_messages(self.spark, self.landing, max_files=1)
        ingest.run_ingest(
            stream, self.options, self.sink, self.checkpoint, offsets
        ).awaitTermination()

    def written(self):
        return self.spark.read.parquet(self.sink)

    def numbers(self):
        found = self.written().groupBy("source").agg(F.collect_set("sequence_id").alias("s"))
        return {r.source: sorted(r.s) for r in found.collect()}

    def whole(self, count):
        rows = self.written()
        assert rows.count() == count
        assert rows.select("message_id").distinct().count() == count


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path)


def test_micro_batches_become_numbered_units(place, make):
    place.land(batch(make, 1, 44))
    place.run()
    place.whole(44)
    assert place.numbers() == {"QM1/Q0": [1, 2, 3], "QM1/Q1": [1, 2, 3]}
    units = place.written().groupBy("source", "sequence_id").count()
    assert units.agg(F.max("count")).first()[0] == 10
    place.land(batch(make, 45, 48))
    place.run()
    place.whole(48)
    assert place.numbers() == {"QM1/Q0": [1, 2, 3], "QM1/Q1": [1, 2, 3]}
    dead = place.written().where("topic = 'dead'")
    assert dead.count() == 48 // 7 and dead.where("key_text IS NOT NULL").isEmpty()


def test_nothing_new_takes_no_number(place, make):
    place.land(batch(make, 1, 4))
    place.run()
    place.run()
    assert place.numbers() == {"QM1/Q0": [1], "QM1/Q1": [1]}


@pytest.mark.parametrize("step", ["record_units", "_write", "commit"])
def test_a_crash_at_any_step_leaves_no_trace(place, make, monkeypatch, step):
    place.land(batch(make, 1, 25))
    place.run()
    place.land(batch(make, 26, 60))
    owner = ingest if step == "_write" else ingest.IngestLog
    original = getattr(owner, step)

    def fails_afterwards(*arguments):
        original(*arguments)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, fails_afterwards)
    with pytest.raises(StreamingQueryException):
        place.run()
    monkeypatch.setattr(owner, step, original)
    place.run()
    place.whole(60)
    assert place.numbers() == {"QM1/Q0": [1, 2, 3], "QM1/Q1": [1, 2, 3]}
    log = ingest.IngestLog(place.spark, f"{place.checkpoint}-log")
    last = {r.source: (r.sequence_id, len(r.message_ids), r.last_known_state) for r in log.delivered().collect()}
    assert last == {"QM1/Q0": (3, 10, "DELIVERED"), "QM1/Q1": (3, 10, "DELIVERED")}


def test_a_lost_commit_mark_repeats_the_batch_in_place(place, make):
    place.land(batch(make, 1, 25))
    place.run()
    before = place.written().orderBy("arrival_seq").select("message_id", "sequence_id").collect()
    for mark in pathlib.Path(place.checkpoint, "commits").glob("*0*"):
        mark.unlink()
    place.run()
    place.whole(25)
    after = place.written().orderBy("arrival_seq").select("message_id", "sequence_id").collect()
    assert after == before


def test_a_new_checkpoint_counts_on(place, make):
    place.land(batch(make, 1, 25))
    place.run()
    offsets = latest_offset(place.written())
    place.landing += "-2"
    place.checkpoint += "-2"
    place.land(batch(make, 26, 30))
    place.run(offsets)
    place.whole(30)
    assert place.numbers() == {"QM1/Q0": [1, 2, 3], "QM1/Q1": [1, 2, 3]}


def test_state_of_the_last_batch_is_proven_by_positions(place, make, spark):
    place.land(batch(make, 1, 8))
    place.run()
    log = ingest.IngestLog(spark, f"{place.checkpoint}-log")
    state = validate_state(log.in_flight())
    plan = recovery_plan(state, log.positions())
    assert {r.action for r in plan.collect()} == {"REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE"}
    assert sorted(len(r.message_ids) for r in plan.collect()) == [4, 4]


def test_poison_stops_the_stream_but_keeps_earlier_batches(spark, tmp_path, make):
    strict = replace(ONCE, tolerance="none")
    place = Place(spark, tmp_path, strict)
    place.land(batch(make, 1, 6))
    place.run()
    place.land(batch(make, 7, 9))
    with pytest.raises(StreamingQueryException):
        place.run()
    place.whole(6)


TIMES = [0, 10, 20, 500, 510, 2000, 2010, 2020, 2030, 2040, 2050, 4000, 4100, 4210, 4220, 4230, 9000, 9001]


@pytest.mark.parametrize(
    "limits, ends",
    [({"batch_size": 4}, (3, 9, 18)), ({"batch_size": 4, "max_poll_ms": 200, "gap_ms": 300}, (1, 4, 13, 18))],
)
def test_batches_do_not_depend_on_micro_batches(spark, tmp_path, make, ends, limits):
    place = Place(spark, tmp_path, replace(ONCE, **limits))
    rows = [
        {"source": source, "arrival_seq": n, "message_id": f"ID:{source}{n}", "body_text": "{}", "jms_timestamp": time}
        for source in ("a", "b")
        for n, time in enumerate(TIMES, 1)
        if source == "a" or n % 5
    ]
    whole = make(*rows)
    for begin, end in zip((0, *ends), ends):
        place.land(whole.where(f"arrival_seq > {begin} AND arrival_seq <= {end}"))
    place.run()
    expected = batch_by_limits(whole, limits["batch_size"], limits.get("max_poll_ms", 0), limits.get("gap_ms"))
    key = lambda row: (row[0], row[1])
    assert sorted(place.written().select("source", "arrival_seq", "sequence_id").collect(), key=key) == sorted(
        expected.select("source", "arrival_seq", "batch_no").collect(), key=key
    )


def test_folders_of_micro_batches_go(place, make):
    for first in (1, 3, 5):
        place.land(batch(make, first, first + 1))
    place.run()
    place.whole(6)
    settled = pathlib.Path(new_folder(place.spark, "x")).parent
    assert not list(settled.glob("micro-batch-*")) and not list(settled.glob("bases-*"))
    assert all(len(list(kind.glob("version=*"))) <= 2 for kind in pathlib.Path(f"{place.checkpoint}-log").iterdir())


def test_at_least_once_has_no_numbers(spark, tmp_path, make):
    place = Place(spark, tmp_path, replace(ONCE, tasks_max="2"))
    place.land(batch(make, 1, 25))
    place.run()
    place.whole(25)
    assert place.written().where("sequence_id IS NOT NULL").isEmpty()


def test_stream_dedupe(spark, tmp_path, make):
    place = Place(spark, tmp_path)
    place.land(batch(make, 1, 20))
    place.land(batch(make, 11, 30))
    place.land(batch(make, 31, 33, message_id=None))
    stream = stream_messages(spark, place.landing, max_files=1)
    query = (
        ingest.dedupe_stream(stream, "1 hour")
        .writeStream.format("parquet")
        .option("checkpointLocation", place.checkpoint)
        .trigger(availableNow=True)
        .start(place.sink)
    )
    query.awaitTermination()
    assert place.written().count() == 33


def test_stream_dedupe_keeps_old_messages(spark, tmp_path, make):
    place = Place(spark, tmp_path)
    march, january = 1_709_251_200_000, 1_704_067_200_000
    place.land(make({"message_id": "a", "jms_timestamp": march}))
    late = {"message_id": "b", "jms_timestamp": january}
    place.land(make(late, {"message_id": "c", "jms_timestamp": march + 3_600_000}, late))
    stream = stream_messages(spark, place.landing, max_files=1)
    query = (
        ingest.dedupe_stream(stream, "1 day")
        .writeStream.format("parquet")
        .option("checkpointLocation", place.checkpoint)
        .trigger(availableNow=True)
        .start(place.sink)
    )
    query.awaitTermination()
    assert sorted(row.message_id for row in place.written().collect()) == ["a", "b", "c"]


STATELESS = {
    "records": lambda df: to_records(df, ONCE).drop("value_json"),
    "routed": lambda df: route_by(to_records(df, ONCE), ONCE).drop("value_json"),
    "raw": build_raw,
    "typed": build_typed,
    "json": lambda df: build_json(df).withColumn("value_json", F.to_json("value_json")),
    "fixed": lambda df: build_json(
        df, schema='{"type":"struct","fields":[{"field":"k","type":"int32"}]}'
    ),
    "key": lambda df: with_key(df, "JMSMessageID"),
    "headers": lambda df: with_headers(df, True),
}


@pytest.mark.parametrize("name", STATELESS)
def test_row_level_operators_are_the_same_on_streams(spark, tmp_path, make, name):
    place = Place(spark, tmp_path)
    place.land(batch(make, 1, 20))
    operator = STATELESS[name]
    table = f"same_{name}"
    query = (
        operator(stream_messages(spark, place.landing))
        .writeStream.format("memory")
        .queryName(table)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    streamed = sorted(map(str, spark.table(table).collect()))
    assert streamed == sorted(map(str, operator(spark.read.parquet(place.landing)).collect()))


def test_topics_are_folders(spark, tmp_path, make):
    path = str(tmp_path / "topics")
    write_topics(route_by(to_records(batch(make, 1, 14), ONCE), ONCE), path)
    assert read_topic(spark, path, "dead").count() == 2
    plan = read_topic(spark, path, "main")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def in_order(spark, frontier, delay_ms, *rows):
    """What becomes of (source, number, milliseconds) rows."""
    messages = spark.createDataFrame(list(rows), "source string, arrival_seq long, jms_timestamp long")
    found = reorder.release_in_order(messages, spark.createDataFrame(frontier, reorder.FRONTIER), delay_ms)
    numbers = [sorted((r.source, r.arrival_seq) for r in df.collect()) for df in (found.ready, found.waiting)]
    return (*numbers, sorted(map(tuple, found.frontier.collect())), sorted(map(tuple, found.holes.collect())))


def test_messages_wait_for_earlier_ones(spark):
    ready, waiting, frontier, holes = in_order(
        spark, [("b", 7, 5)], None, ("a", 2, 9), ("a", 1, 8), ("a", 4, 9), ("a", 2, 9), ("b", 3, 1), ("b", 8, 2)
    )
    # Copies and messages from before the frontier do not wait.
    assert ready == [("a", 1), ("a", 2), ("a", 2), ("b", 3)] and waiting == [("a", 4), ("b", 8)]
    assert frontier == [("a", 3, 9), ("b", 7, 5)] and holes == []


def test_holes_are_given_up_after_a_delay(spark):
    rows = [("a", 3, 100), ("a", 4, 110), ("a", 7, 120), ("a", 8, 130), ("a", 10, 200), ("a", 13, 201)]
    ready, waiting, frontier, holes = in_order(spark, [], 80, *rows)
    assert [n for _, n in ready] == [3, 4, 7, 8] and [n for _, n in waiting] == [10, 13]
    assert frontier == [("a", 9, 201)] and holes == [("a", 1, 2), ("a", 5, 6)]
    # Far-apart numbers, and a source without new messages.
    ready, _, frontier, holes = in_order(spark, [("z", 4, 1)], 0, ("a", 10**12, 5), ("a", 5, 5))
    assert ready == [("a", 5), ("a", 10**12)] and frontier == [("a", 10**12 + 1, 5), ("z", 4, 1)]
    assert holes == [("a", 1, 4), ("a", 6, 10**12 - 1)]


def test_messages_without_a_place_cannot_be_ordered(spark):
    for row in ((None, 1, 1), ("a", None, 1)):
        with pytest.raises(ValueError, match="arrival number"):
            in_order(spark, [], None, ("a", 1, 1), row)


def test_an_empty_micro_batch_keeps_the_frontier(spark):
    assert in_order(spark, [("b", 7, 5)], 10) == ([], [], [("b", 7, 5)], [])


@pytest.mark.parametrize("split", [(30, 1), (7, 3), (3, 2)])
def test_streams_in_order_however_they_land(spark, tmp_path, make, split):
    size, seed = split
    numbers = [number for number in range(1, 31) if number != 25]
    random.Random(seed).shuffle(numbers)
    place = Place(spark, tmp_path)
    for at in range(0, len(numbers), size):
        rows = [{"arrival_seq": n, "message_id": f"m{n}", "body_text": '{"k":1}'} for n in numbers[at : at + size]]
        place.land(make(*rows).coalesce(1))
    stream = stream_messages(spark, place.landing, max_files=1)
    options = replace(ONCE, batch_size=4)
    query = ingest.run_ingest(stream, options, place.sink, place.checkpoint, in_order=ingest.InOrder())
    query.awaitTermination()
    rows = place.written().orderBy("batch_id", "arrival_seq").collect()
    # Numbers as they come out, and the batches, are those of the whole table up to the hole.
    assert [row.arrival_seq for row in rows] == list(range(1, 25))
    assert [row.sequence_id for row in rows] == [1 + (n - 1) // 4 for n in range(1, 25)]
    log = ingest.IngestLog(spark, f"{place.checkpoint}-log")
    assert sorted(r.arrival_seq for r in log.waiting(stream.schema).collect()) == list(range(26, 31))
    # The missing number comes after a restart, and all that waited with it.
    place.land(make({"arrival_seq": 25, "message_id": "m25", "body_text": '{"k":1}'}))
    stream = stream_messages(spark, place.landing, max_files=1)
    ingest.run_ingest(
        stream, options, place.sink, place.checkpoint, in_order=ingest.InOrder()
    ).awaitTermination()
    rows = place.written().orderBy("batch_id", "arrival_seq").collect()
    assert [row.arrival_seq for row in rows] == list(range(1, 31))


def test_a_micro_batch_put_in_order_may_run_again(spark, tmp_path, make):
    log, sink = ingest.IngestLog(spark, str(tmp_path / "log")), str(tmp_path / "sink")
    run = log.begin(None)
    rows = [{"arrival_seq": n, "message_id": f"m{n}", "body_text": '{"k":1}'} for n in (2, 1, 5, 4, 3, 7)]
    parts = [make(*rows[:2], rows[2]), make(*rows[3:])]
    for number, part in enumerate(parts):
        for _ in range(2):  # as after a crash
            ingest.publish_batch(part, number, ONCE, sink, log, run, ingest.InOrder())
    found = spark.read.parquet(sink).orderBy("batch_id", "arrival_seq").collect()
    assert [(r.batch_id, r.arrival_seq) for r in found] == [(0, 1), (0, 2), (1, 3), (1, 4), (1, 5)]
    assert [r.arrival_seq for r in log.waiting(parts[0].schema).collect()] == [7]
