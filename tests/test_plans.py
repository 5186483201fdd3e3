"""What the physical plans must look like for the queries to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from postlane.functions.headers import with_headers
from postlane.operators import delivery, routing
from postlane.operators.batching import batch_by_count
from postlane.operators.limits import batch_by_limits
from postlane.operators.records import to_records
from postlane.plans import catalogue, fixtures
from postlane.shared import new_folder
from postlane.sources.messages import for_source, read_messages

SF_DIR = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The final adaptive plan, after running."""
    df.collect()
    return physical(df).split("== Initial Plan ==")[0]


@pytest.fixture
def no_broadcast(spark):
    names = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_flagship_reads_three_columns_and_parses_once(spark):
    df = catalogue.flagship_route_counts(spark, SF_DIR)
    assert optimized(df).count("VariantExpressionEvalUtils.parseJson") == 1
    plan = physical(df)
    assert "ReadSchema: struct<event_id:bigint,event_type:string,props:string>" in plan
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("tolerance,topic", [("none", None), ("all", None), ("all", "dead")])
def test_routing_parses_once_and_never_shuffles(spark, tolerance, topic):
    records = to_records(fixtures.event_messages(spark, SF_DIR), catalogue.JSON_TO_DEAD)
    df = routing.route(records, tolerance, topic)
    assert optimized(df).count("VariantExpressionEvalUtils.parseJson") == 1
    assert "Exchange" not in physical(df)


def test_reports_parse_once(spark):
    df = catalogue.error_report(spark, SF_DIR)
    assert optimized(df).count("VariantExpressionEvalUtils.parseJson") == 1


def test_unused_headers_are_not_built(spark):
    df = with_headers(fixtures.event_messages(spark, SF_DIR), True).select("arrival_seq")
    assert "ReadSchema: struct<event_id:bigint>" in physical(df)


def test_exploded_headers_are_built_once(spark):
    plan = optimized(catalogue.headers_typed(spark, SF_DIR))
    assert plan.count("unhex(") == 1


def test_source_filter_reaches_the_scan(spark):
    path = new_folder(spark, "test")
    fixtures.event_messages(spark, SF_DIR).write.parquet(path)
    df = for_source(read_messages(spark, path), "QM1/Q2").select("arrival_seq")
    plan = physical(df)
    assert "EqualTo(source,QM1/Q2)" in plan
    assert "ReadSchema: struct<source:string,arrival_seq:bigint>" in plan


def test_count_batches_shuffle_messages_once(spark, no_broadcast):
    messages = fixtures.event_messages(spark, SF_DIR).select("source", "arrival_seq", "body_text")
    plan = executed(batch_by_count(messages))
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert plan.count("events.parquet") == 1 and any("__bucket" in line for line in moved)
    windows = re.findall(r"row_number\(\) windowspecdefinition\((.*?), arrival_seq", plan)
    assert windows and all("__bucket" in keys for keys in windows)


def test_numbers_without_holes_need_no_shuffle(spark):
    plan = executed(catalogue.batches_without_holes(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


@pytest.mark.parametrize("name", catalogue.all_queries())
def test_no_query_joins_all_pairs_or_gathers_in_one_task(spark, name):
    if name.startswith("stream"):
        pytest.skip("the plan of a streaming query is that of its output table")
    plan = physical(catalogue.all_queries()[name](spark, SF_DIR))
    for operator in ("NestedLoop", "CartesianProduct", "SinglePartition", "BatchEvalPython"):
        assert operator not in plan


def test_limit_batches_run_each_step_once(spark, no_broadcast):
    messages = fixtures.event_messages(spark, SF_DIR).select(
        "source", "arrival_seq", "jms_timestamp"
    )
    plan = executed(batch_by_limits(messages, 10, 1000, 500))
    for step in ("chain", "fold", "enter_groups", "enter_segments", "assign"):
        assert plan.count(f"MapInPandas {step}(") == 1


JOINING = (
    "sequence_ids",
    "redeliver",
    "drop_delivered",
    "committed_prefix",
    "peek",
    "delivery_audit",
)


@pytest.mark.parametrize("name", JOINING)
def test_nothing_is_broadcast_without_a_size_check(spark, no_broadcast, name):
    assert "Broadcast" not in executed(catalogue.all_queries()[name](spark, SF_DIR))


def _bookkeeping(spark):
    messages = fixtures.event_messages(spark, SF_DIR)
    state, offsets = fixtures.delivery_tables(fixtures.batched_events(spark, SF_DIR))
    batched = messages.withColumn("batch_no", F.col("arrival_seq") + 1)
    plan = delivery.recovery_plan(state, offsets)
    return {
        "assign_sequence": delivery.assign_sequence(batched, state, offsets),
        "committed_prefix": delivery.committed_prefix(to_records(batched, catalogue.TYPED)),
        "redeliver": delivery.redeliver(messages, plan),
        "drop_delivered": delivery.drop_delivered(messages, plan),
    }


def test_small_tables_leave_the_messages_where_they_are(spark):
    for name, df in _bookkeeping(spark).items():
        plan = executed(df)
        assert "BroadcastHashJoin" in plan, name
        shuffled = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not any("arrival_seq" in line for line in shuffled), name
        # The only shuffle left is that of the few ids of unfinished batches.
        assert len(shuffled) <= (name in ("redeliver", "drop_delivered")), name


def test_snapshot_groups_are_batches(spark):
    sequenced = catalogue._sequenced(spark, SF_DIR)
    plan = physical(delivery.state_snapshot(sequenced))
    assert re.search(r"hashpartitioning\(source#\d+, sequence_id#\d+L", plan)


def test_error_structs_are_constants(spark):
    built = to_records(fixtures.event_messages(spark, SF_DIR), catalogue.JSON_TO_DEAD)
    df = built.select(F.col("error.class"))
    assert "named_struct" not in optimized(df)


def test_landed_files_stay_small(spark, tmp_path, monkeypatch):
    events = spark.range(1, 1201).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "'view' AS event_type", "cast(id AS double) AS value",
        "concat('{\"k\": ', id, '}') AS props", "timestamp_millis(1700000000000 + id) AS ts",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(fixtures, "ROWS_PER_FILE", 100)
    sf_dir = str(tmp_path)
    for landed, parts in (
        (fixtures.landed_events(spark, sf_dir), 4),
        (fixtures.landed_in_turn(spark, sf_dir), 4),
        (fixtures.landed_out_of_order(spark, sf_dir, "false"), 3),
        (fixtures.landed_out_of_order(spark, sf_dir, "false", parts=1), 1),
    ):
        rows = spark.read.parquet(landed.path).groupBy("_metadata.file_path").count().collect()
        assert sum(row["count"] for row in rows) == 1200 and landed.files == 12 // parts
        assert len(rows) >= 10 and max(row["count"] for row in rows) <= 200
