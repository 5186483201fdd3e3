from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from postlane import shared
from postlane.operators.delivery import DeliveryStateError
from postlane.options import IngestOptions
from postlane.plans.ingest import begin_ledger, publish_table, recover, table_records
from postlane.schemas import OFFSETS, STATE
from postlane.shared import new_folder
from postlane.sources.ledger import Ledger, read_published

SOURCES = ("fresh", "unsent", "proven", "done")
OPTIONS = IngestOptions(topic="t", body_jms=True, batch_size=4, state_queue="STATE")


def ids(*numbers):
    return [f"ID:{n:048x}" for n in numbers]


@pytest.fixture
def tables(spark, make):
    messages = make(
        *[
            {"source": source, "arrival_seq": n, "message_id": f"ID:{n:048x}", "body_text": "x"}
            for source in SOURCES
            for n in range(1, 11)
        ]
    )
    state = spark.createDataFrame(
        [
            ("unsent", 23, ids(1, 2, 3), "IN_FLIGHT"),
            ("proven", 23, ids(1, 2, 3), "IN_FLIGHT"),
            ("done", 23, ids(1, 2, 3), "DELIVERED"),
        ],
        STATE,
    )
    offsets = spark.createDataFrame([("unsent", 22), ("proven", 23), ("done", 22)], OFFSETS)
    return messages, state, offsets


def test_recovery_splits_messages(tables):
    found = recover(*tables)
    count = lambda df: {r.source: r["count"] for r in df.groupBy("source").count().collect()}
    assert count(found.unsent) == {"unsent": 3}
    assert count(found.waiting) == {"fresh": 10, "unsent": 7, "proven": 7, "done": 7}
    assert {r.source: r.last_known_state for r in found.state.collect()} == {
        "unsent": "IN_FLIGHT",
        "proven": "DELIVERED",
        "done": "DELIVERED",
    }


def test_published_table(spark, tables):
    sink = new_folder(spark, "test")
    publish_table(tables[0], OPTIONS, tables[1], tables[2], sink)
    found = spark.read.parquet(sink).groupBy("source", "sequence_id").count().collect()
    sizes = {(r.source, r.sequence_id): r["count"] for r in found}
    assert sizes == {
        ("fresh", 1): 4,
        ("fresh", 2): 4,
        ("fresh", 3): 2,
        ("unsent", 23): 3,
        **{(source, 24): 4 for source in SOURCES[1:]},
        **{(source, 25): 3 for source in SOURCES[1:]},
    }


def test_foreign_messages_stop_the_run(spark, tables):
    messages, state, offsets = tables
    intruder = messages.where("arrival_seq = 1").withColumns(
        {"arrival_seq": F.lit(0).cast("long"), "message_id": F.lit("ID:other")}
    )
    with pytest.raises(DeliveryStateError):
        publish_table(
            messages.unionByName(intruder), OPTIONS, state, offsets, new_folder(spark, "test")
        )


def numbered(spark, make, count, **more):
    """Two sources with ``count`` messages each; more rows may be given by number."""
    return make(
        *[
            {"source": source, "arrival_seq": n, "message_id": f"ID:{n:048x}", "body_text": '{"k":%d}' % n, **more.get(f"m{n}", {})}
            for source in ("a", "b")
            for n in range(1, count + 1)
        ]
    )


def nothing(spark):
    return spark.createDataFrame([], STATE), spark.createDataFrame([], OFFSETS)


def published(spark, sink):
    rows = read_published(spark, sink).select("source", "sequence_id", "arrival_seq").collect()
    assert len(rows) == len({(r.source, r.arrival_seq) for r in rows})
    return sorted((r.source, r.sequence_id, r.arrival_seq) for r in rows)


@pytest.mark.parametrize(
    "step, done",
    [("write_state", True), ("write_records", False), ("write_records", True), ("write_manifest", True)],
)
def test_a_run_lost_at_any_point_is_finished_once(spark, make, monkeypatch, step, done):
    sink = new_folder(spark, "test")
    publish_table(numbered(spark, make, 7), OPTIONS, *nothing(spark), sink)
    original = getattr(Ledger, step)

    def lost(self, unit, *arguments):
        if done:
            original(self, unit, *arguments)
        elif step == "write_records":  # half-way: files without their end
            arguments[0].limit(2).write.partitionBy("topic").parquet(f"{self.sink}/unit={unit}")
        raise RuntimeError("lost")

    monkeypatch.setattr(Ledger, step, lost)
    with pytest.raises(RuntimeError, match="lost"):
        publish_table(numbered(spark, make, 15), OPTIONS, *nothing(spark), sink)
    assert len(published(spark, sink)) == (30 if step == "write_manifest" else 14)
    monkeypatch.undo()
    publish_table(numbered(spark, make, 18), OPTIONS, *nothing(spark), sink)
    rows = published(spark, sink)
    # What was in flight keeps its batches; messages that came later are cut on their own.
    firsts = {1: 1, 2: 5, 3: 8, 4: 12, 5: 16}
    for source in "ab":
        mine = [(unit, seq) for name, unit, seq in rows if name == source]
        assert [seq for _, seq in mine] == list(range(1, 19))
        assert {unit: min(seq for u, seq in mine if u == unit) for unit, _ in mine} == firsts
    state = {r.source: (r.sequence_id, r.last_known_state, r.arrival_seq) for r in Ledger(spark, sink).delivered().collect()}
    assert state == {"a": (5, "DELIVERED", 18), "b": (5, "DELIVERED", 18)}


def test_a_run_lost_at_the_beginning_keeps_the_unsent_batch(spark, tables, monkeypatch):
    sink = new_folder(spark, "test")
    monkeypatch.setattr("postlane.sources.ledger.replace_table", lambda df, path, version=None: 1 / 0 if "delivered" in path else original(df, path, version))
    from postlane.sources.state import replace_table as original

    with pytest.raises(ZeroDivisionError):
        begin_ledger(Ledger(spark, sink), *tables)
    monkeypatch.undo()
    publish_table(tables[0], OPTIONS, tables[1], tables[2], sink)
    rows = published(spark, sink)
    assert len(rows) == 40 - 6  # two sources had three messages delivered
    assert [(unit, seq) for name, unit, seq in rows if name == "unsent"][:4] == [(23, 1), (23, 2), (23, 3), (24, 4)]


def test_messages_of_an_unfinished_batch_must_be_there(spark, make, monkeypatch):
    sink = new_folder(spark, "test")
    monkeypatch.setattr(Ledger, "write_records", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        publish_table(numbered(spark, make, 5), OPTIONS, *nothing(spark), sink)
    monkeypatch.undo()
    with pytest.raises(DeliveryStateError, match="gone"):
        publish_table(numbered(spark, make, 5).where("arrival_seq <> 3"), OPTIONS, *nothing(spark), sink)


STRICT = IngestOptions(topic="t", builder="json", body_jms=True, batch_size=10, state_queue="STATE")


def test_a_source_stops_before_its_poisoned_batch(spark, make):
    sink = new_folder(spark, "test")
    poisoned = numbered(spark, make, 30, m16={"body_text": "{ bad"}).where("source = 'a' OR arrival_seq <> 16")
    stopped = publish_table(poisoned, STRICT, *nothing(spark), sink).collect()
    assert [(r.source, r.failed_batch, r.arrival_seq, r["class"]) for r in stopped] == [("a", 2, 16, "MalformedBody")]
    rows = published(spark, sink)
    assert [seq for name, _, seq in rows if name == "a"] == list(range(1, 11))
    assert len([1 for name, _, _ in rows if name == "b"]) == 29
    # Nothing mended: nothing goes on, and no number is used up.
    assert publish_table(poisoned, STRICT, *nothing(spark), sink).count() == 1
    assert published(spark, sink) == rows
    mended = numbered(spark, make, 30).where("source = 'a' OR arrival_seq <> 16")
    assert publish_table(mended, STRICT, *nothing(spark), sink).isEmpty()
    mine = [(unit, seq) for name, unit, seq in published(spark, sink) if name == "a"]
    assert mine == [((seq - 1) // 10 + 1, seq) for seq in range(1, 31)]


def test_poison_in_the_first_batch_publishes_nothing(spark, make):
    sink = new_folder(spark, "test")
    poisoned = numbered(spark, make, 12, m1={"body_text": "{ bad"})
    assert publish_table(poisoned, STRICT, *nothing(spark), sink).count() == 2
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, sink)
    publish_table(poisoned, replace(STRICT, tolerance="all"), *nothing(spark), sink)
    assert len(published(spark, sink)) == 22


def test_copies_of_a_delivered_message_are_not_sent_again(spark, make):
    sink = new_folder(spark, "test")
    publish_table(numbered(spark, make, 5), OPTIONS, *nothing(spark), sink)
    again = numbered(spark, make, 6).unionByName(numbered(spark, make, 5))
    publish_table(again, OPTIONS, *nothing(spark), sink)
    assert len(published(spark, sink)) == 12


def test_at_least_once_table(spark, tables):
    options = IngestOptions(topic="t", body_jms=True)
    found = table_records(tables[0], options, tables[1], tables[2])
    assert found.count() == 40 and found.where("sequence_id IS NOT NULL").isEmpty()
    sink = new_folder(spark, "test")
    publish_table(tables[0], options, tables[1], tables[2], sink)
    assert spark.read.parquet(sink).count() == 40


def test_limits_of_the_options_apply(spark, tables):
    messages, _, _ = tables
    options = replace(OPTIONS, batch_size=100, max_poll_ms=2)
    empty = spark.createDataFrame([], STATE), spark.createDataFrame([], OFFSETS)
    found = table_records(messages.where("source = 'fresh'"), options, *empty)
    rows = found.orderBy("arrival_seq").collect()
    assert [r.sequence_id for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4]


def test_the_shared_folder_is_the_sessions(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared.shared_folder(spark) == named.rstrip("/")
    monkeypatch.setattr(shared, "CHECKPOINT_DIR", "spark.postlane.not.set")
    own = shared.shared_folder(spark)
    assert own == shared.shared_folder(spark) != named
    cluster = SimpleNamespace(
        conf=spark.conf, sparkContext=SimpleNamespace(master="yarn", applicationId="a")
    )
    with pytest.raises(ValueError, match="every executor"):
        shared.shared_folder(cluster)
