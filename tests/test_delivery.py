import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postlane.operators import delivery
from postlane.operators.batching import batch_by_count
from postlane.operators.records import to_records
from postlane.options import IngestOptions
from postlane.schemas import OFFSETS, STATE
from postlane.sources.messages import for_source, holds_more_than_one, peek
from postlane.sources.state import complete_versions, forget_versions, read_table, replace_table

Q = "QM1/DEV.QUEUE.1"


def ids(*numbers):
    return [f"ID:{n:048x}" for n in numbers]


@pytest.fixture
def states(spark):
    return lambda *rows: spark.createDataFrame([(Q, *row) if len(row) == 3 else row for row in rows], STATE)


@pytest.fixture
def offsets(spark):
    return lambda *rows: spark.createDataFrame([(Q, row) if isinstance(row, int) else row for row in rows], OFFSETS)


def eight(make):
    return make(*[{"body_text": str(n)} for n in range(1, 9)])


def test_sequence_starts_after_state_then_offset_then_zero(make, states, offsets):
    batched = batch_by_count(eight(make), 3)

    def numbers(state, offset):
        found = delivery.assign_sequence(batched, state, offset).orderBy("arrival_seq").collect()
        return [r.sequence_id for r in found]

    assert numbers(states(), offsets()) == [1, 1, 1, 2, 2, 2, 3, 3]
    assert numbers(states(), offsets(5)) == [6, 6, 6, 7, 7, 7, 8, 8]
    assert numbers(states((23, ids(1), "DELIVERED")), offsets(5)) == [24] * 3 + [25] * 3 + [26] * 2


def test_snapshot_keeps_order(make, states, offsets):
    sequenced = delivery.assign_sequence(batch_by_count(eight(make), 5), states(), offsets())
    found = delivery.state_snapshot(sequenced).orderBy("sequence_id").collect()
    assert [r.message_ids for r in found] == [ids(*range(1, 6)), ids(6, 7, 8)]
    assert {r.last_known_state for r in found} == {"IN_FLIGHT"}


STATE_TEXT = (
    '{"sequenceId":314,"messageIds":["414d51204d59514d475220202020202033056b6401d51010",'
    '"414d51204d59514d475220202020202033056b6401d51011"],"lastKnownState":"IN_FLIGHT"}'
)


def test_state_text_round_trip(spark):
    texts = spark.createDataFrame([(Q, STATE_TEXT)], "source string, state_json string")
    state = delivery.decode_state(texts)
    row = state.first()
    assert (row.sequence_id, len(row.message_ids), row.last_known_state) == (314, 2, "IN_FLIGHT")
    assert delivery.encode_state(state).first().state_json == STATE_TEXT


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        STATE_TEXT.replace("IN_FLIGHT", "LOST"),
        STATE_TEXT.replace("314", '"a"'),
        STATE_TEXT.replace("}", ',"more":1}'),
        "[]",
        None,
    ],
)
def test_bad_state_texts(spark, text):
    texts = spark.createDataFrame([(Q, text)], "source string, state_json string")
    with pytest.raises(PySparkException, match="not a delivery state"):
        delivery.decode_state(texts).count()


def test_two_states_are_an_error(states):
    fine = states((1, ids(1), "IN_FLIGHT"), ("other", 2, ids(2), "DELIVERED"))
    assert delivery.validate_state(fine).count() == 2
    two = states((1, ids(1), "IN_FLIGHT"), (2, ids(2), "IN_FLIGHT"))
    with pytest.raises(delivery.DeliveryStateError, match=Q):
        delivery.validate_state(two)
    assert [r.source for r in delivery.state_conflicts(two).collect()] == [Q]


PLANS = [
    (None, None, None, None),
    (None, 5, "NORMAL_OPERATION", 5),
    (("IN_FLIGHT", 23), None, "REDELIVER_UNSENT_BATCH", 23),
    (("IN_FLIGHT", 23), 22, "REDELIVER_UNSENT_BATCH", 23),
    (("IN_FLIGHT", 23), 23, "REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE", 23),
    (("DELIVERED", 23), 22, "REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE", 23),
    (("DELIVERED", 23), None, "REMOVE_DELIVERED_MESSAGES_FROM_SOURCE_QUEUE", 23),
]


@pytest.mark.parametrize("state,offset,action,base", PLANS)
def test_recovery_decision(states, offsets, state, offset, action, base):
    plan = delivery.recovery_plan(
        states((state[1], ids(1), state[0])) if state else states(),
        offsets(offset) if offset is not None else offsets(),
    )
    row = plan.first()
    assert (row and row.action, row and row.base_sequence_id) == (action, base)


def test_promotion(states, offsets):
    state = states((23, ids(1), "IN_FLIGHT"), ("b", 7, ids(2), "IN_FLIGHT"))
    plan = delivery.recovery_plan(state, offsets(23, ("b", 6)))
    found = {r.source: r.last_known_state for r in delivery.promote_state(state, plan).collect()}
    assert found == {Q: "DELIVERED", "b": "IN_FLIGHT"}


def test_redelivery_reuses_the_sequence_id(make, states, offsets):
    plan = delivery.recovery_plan(states((23, ids(*range(1, 6)), "IN_FLIGHT")), offsets(22))
    found = delivery.redeliver(eight(make), plan).orderBy("arrival_seq").collect()
    assert [(r.body_text, r.sequence_id) for r in found] == [(str(n), 23) for n in range(1, 6)]
    assert delivery.drop_delivered(eight(make), plan).count() == 8


def test_removal_leaves_the_rest(make, states, offsets):
    plan = delivery.recovery_plan(states((23, ids(*range(1, 6)), "IN_FLIGHT")), offsets(23))
    found = delivery.drop_delivered(eight(make), plan).orderBy("arrival_seq").collect()
    assert [r.body_text for r in found] == ["6", "7", "8"]
    assert delivery.redeliver(eight(make), plan).isEmpty()


@pytest.mark.parametrize("known", [(1, 2, 4), (2, 3), (9,), (1, 2, 9)])
def test_foreign_messages_stop_the_removal(make, states, offsets, known):
    plan = delivery.recovery_plan(states((23, ids(*known), "DELIVERED")), offsets())
    with pytest.raises(delivery.DeliveryStateError, match="unexpected messages"):
        delivery.drop_delivered(eight(make), plan)


def test_all_messages_delivered(make, states, offsets):
    plan = delivery.recovery_plan(states((23, ids(*range(1, 9)), "DELIVERED")), offsets())
    assert delivery.drop_delivered(eight(make), plan).isEmpty()


def test_head_check(make, states, offsets):
    plan = delivery.recovery_plan(states((23, ids(3, 4), "IN_FLIGHT")), offsets())
    ready = lambda df: delivery.recovery_ready(df, plan).first().decision
    assert ready(eight(make)) == "wait"
    assert ready(eight(make).where("arrival_seq >= 3")) == "ready"
    assert ready(eight(make).where("false")) == "wait"


def test_failed_batch_holds_back_everything_after_it(make):
    df = make(*[{"body_kind": "map" if n == 16 else "text", "body_text": "x"} for n in range(1, 31)])
    records = to_records(batch_by_count(df, 10), IngestOptions(topic="t", body_jms=True))
    found = delivery.committed_prefix(records)
    assert found.where("committed").count() == 10
    assert found.where("NOT committed").count() == 20
    fine = to_records(batch_by_count(eight(make), 3), IngestOptions(topic="t", body_jms=True))
    assert delivery.committed_prefix(fine).where("committed").count() == 8


def test_audit(make, states, offsets):
    sequenced = delivery.assign_sequence(batch_by_count(eight(make), 5), states(), offsets())
    acks = sequenced.where("arrival_seq <> 7")
    found = delivery.delivery_audit(sequenced, acks.unionByName(acks)).orderBy("sequence_id")
    assert [(r.expected, r.acked, r.complete) for r in found.collect()] == [
        (5, 5, True),
        (3, 2, False),
    ]


def test_dedupe_keeps_the_earliest_and_all_without_id(make):
    df = make(
        {"message_id": "ID:a", "body_text": "first"},
        {"message_id": "ID:a", "body_text": "again"},
        {"message_id": None},
        {"message_id": None},
        {"message_id": "ID:a", "source": "other"},
        {"message_id": "ID:b"},
    )
    found = delivery.dedupe(df.unionByName(df.where("arrival_seq < 6")))
    rows = found.orderBy("arrival_seq").collect()
    assert [r.arrival_seq for r in rows] == [1, 3, 4, 5, 6]
    assert rows[0].body_text == "first"
    assert found.columns == df.columns


def test_dedupe_of_json_records(make):
    df = make({"body_text": '{"i":1}'}, {"body_text": "{"})
    options = IngestOptions(topic="t", builder="json", body_jms=True)
    records = to_records(df, options)
    found = delivery.dedupe(records.unionByName(records)).orderBy("arrival_seq")
    assert found.select(F.to_json("value_json").alias("j")).collect()[0].j == '{"i":1}'
    assert found.count() == 2


def test_dedupe_takes_a_missing_source_as_one(make):
    df = make({"message_id": "ID:a", "source": None}, {"message_id": "ID:a", "source": None}, {"message_id": "ID:b"})
    assert [row.arrival_seq for row in delivery.dedupe(df).orderBy("arrival_seq").collect()] == [1, 3]


def test_dedupe_merges_copies_before_the_shuffle(make):
    plan = delivery.merge_copies(make({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Aggregate(") >= 2 and "partial_min_by" in plan


def test_one_message_copied_very_often(spark):
    rows = spark.range(300_000).select(
        F.lit("q").alias("source"),
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") % 3 == 0, "ID:hot").otherwise(F.col("id").cast("string")).alias("message_id"),
    )
    found = delivery.dedupe(rows)
    assert found.count() == 200_001
    assert found.where("message_id = 'ID:hot'").first().arrival_seq == 0


def test_peek_and_counts(make):
    df = make({"arrival_seq": 9}, {"arrival_seq": 4}, {"source": "b", "arrival_seq": 70})
    heads = {r.source: r.arrival_seq for r in peek(df).collect()}
    assert heads == {Q: 4, "b": 70}
    more = {r.source: r.more_than_one for r in holds_more_than_one(df).collect()}
    assert more == {Q: True, "b": False}
    assert for_source(df, "b").count() == 1
    assert peek(df.where("false")).isEmpty()
    assert peek(make({"source": None}, {"source": None}, {})).count() == 2


def test_tables_are_replaced_as_a_whole(spark, states, tmp_path):
    path = str(tmp_path / "state")
    assert read_table(spark, path, STATE).isEmpty()
    assert replace_table(states((1, ids(1), "IN_FLIGHT")), path) == 0
    assert replace_table(states((1, ids(1), "DELIVERED")), path) == 1
    assert read_table(spark, path, STATE).first().last_known_state == "DELIVERED"
    assert read_table(spark, path, STATE, before=1).first().last_known_state == "IN_FLIGHT"
    # A version without its success mark was never finished.
    (tmp_path / "state" / "version=1" / "_SUCCESS").unlink()
    assert read_table(spark, path, STATE).first().last_known_state == "IN_FLIGHT"
    assert replace_table(states((2, ids(2), "IN_FLIGHT")), path) == 1
    forget_versions(spark, path, 1)
    assert complete_versions(spark, path) == [1]
