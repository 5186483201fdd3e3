import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlane.operators.batching import (
    batch_by_count,
    number_by_buckets,
    number_by_ranges,
    number_in_order,
    partition_by_key,
    partition_offsets,
    sorted_ranges,
)
from postlane.operators.limits import batch_by_limits, first_reaching, leave_segment, next_batch
from postlane.operators.records import to_records
from postlane.options import IngestOptions


def greedy(times, size, max_ms, gap_ms):
    """The rule message by message."""
    batch, out, start, held = 0, [], None, 0
    for at, now in enumerate(times):
        previous = times[at - 1] if at else None
        if (
            at == 0
            or held >= size
            or (max_ms > 0 and previous >= start + max_ms)
            or (gap_ms is not None and now - previous > gap_ms)
        ):
            batch, start, held = batch + 1, now, 0
        held += 1
        out.append(batch)
    return out


def table(spark, times_by_source):
    data = [
        (source, seq, time)
        for source, entries in times_by_source.items()
        for seq, time in entries
    ]
    return spark.createDataFrame(data, "source string, arrival_seq long, jms_timestamp long")


def test_35_messages_in_tens(make):
    df = batch_by_count(make(*[{"body_text": str(n)} for n in range(35)]), 10)
    found = df.orderBy("arrival_seq").collect()
    assert [r.batch_no for r in found] == [1] * 10 + [2] * 10 + [3] * 10 + [4] * 5
    assert [r.body_text for r in found] == [str(n) for n in range(35)]


def test_count_batches_follow_arrival_for_any_numbers(spark):
    seed = random.Random(7)
    sources = {
        "whole": [(n, 0) for n in range(-700, 2300)],
        "stride": [(n, 0) for n in range(0, 6000, 3)],
        "sparse": [(n, 0) for n in sorted(seed.sample(range(-(10**9), 10**9), 700))],
        "one": [(5, 0)],
    }
    found = batch_by_count(table(spark, sources), 7, bucket_width=50).collect()
    assert len(found) == 5701
    for source, entries in sources.items():
        expected = {seq: at // 7 + 1 for at, (seq, _) in enumerate(entries)}
        assert {r.arrival_seq: r.batch_no for r in found if r.source == source} == expected


def test_numbering_spreads_one_large_source(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("source"), F.col("id").alias("arrival_seq"))
    numbered = number_by_buckets(df, bucket_width=100)
    assert number_in_order(df).where("ordinal <> arrival_seq + 1").isEmpty()
    assert numbered.where("ordinal <> arrival_seq + 1").isEmpty()
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    ranked = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert ranked and all("__bucket" in line.split("], [")[1] for line in ranked)


REPEATED = {
    "twice": [(1, 0), (1, 5), (3, 9)],
    "gap": [(1, 0), (3, 5), (3, 9), (4, 9)],
    "hot": [(7, 0)] * 400 + [(n, 0) for n in range(8, 200)],
    "far": [(n * 10**9, n) for n in range(1500)],
    "plain": [(n, n) for n in range(1, 40)],
}


@pytest.mark.parametrize("cut", ["count", "limits"])
def test_repeated_and_distant_numbers_give_one_row_each(spark, cut):
    df = table(spark, REPEATED)
    if cut == "count":
        found = batch_by_count(df, 3, bucket_width=50).collect()
    else:
        found = batch_by_limits(df, 3, gap_ms=10**6, segment_rows=10, segments_per_group=3, bucket_width=50).collect()
    for source, entries in REPEATED.items():
        rows = sorted((r.arrival_seq, r.batch_no) for r in found if r.source == source)
        assert rows == [(seq, at // 3 + 1) for at, (seq, _) in enumerate(entries)]


def test_equal_rows_are_spread_over_ranges(spark):
    """One number in nearly all rows, and numbers far apart: no range has more than a few times the mean."""
    hot = spark.range(40_000).selectExpr("'hot' AS source", "CAST(5 AS LONG) AS arrival_seq", "'m' AS message_id")
    far = spark.range(20_000).selectExpr("'far' AS source", "id * 1000000000 AS arrival_seq", "'m' AS message_id")
    df = hot.unionByName(far)
    numbered = number_by_ranges(df)
    expected = {"hot": (1, 40_000, 40_000), "far": (1, 20_000, 20_000)}
    for row in (
        numbered.groupBy("source")
        .agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("b"), F.count_distinct("ordinal").alias("n"))
        .collect()
    ):
        assert (row.a, row.b, row.n) == expected[row.source]
    assert numbered.where("source = 'far' AND ordinal <> arrival_seq div 1000000000 + 1").isEmpty()
    small = "spark.sql.adaptive.coalescePartitions.enabled"  # or so few rows become one range
    spark.conf.set(small, "false")
    try:
        sizes = sorted_ranges(df, "source", "arrival_seq").groupBy("__range").count()
    finally:
        spark.conf.unset(small)
    most, mean, ranges = sizes.agg(F.max("count"), F.avg("count"), F.count("count")).first()
    assert most < 3 * mean and ranges > 1
    # The same by way of the counts, which send both sources there.
    assert number_in_order(df, bucket_width=1000).where("source = 'hot'").agg(F.count_distinct("ordinal")).first()[0] == 40_000


def test_batches_need_room(make):
    with pytest.raises(ValueError):
        batch_by_count(make({}), 0)
    with pytest.raises(ValueError):
        batch_by_limits(make({}), 0, 5)


def test_late_message_closes_the_batch(spark):
    df = table(spark, {"q": [(1, 0), (2, 50), (3, 210), (4, 215)]})
    found = batch_by_limits(df, 5000, max_ms=200).orderBy("arrival_seq").collect()
    assert [r.batch_no for r in found] == [1, 1, 1, 2]


def test_gap_and_zero_limits(spark):
    df = table(spark, {"q": [(1, 0), (2, 10), (3, 21), (4, 21)]})
    numbers = lambda **k: [
        r.batch_no for r in batch_by_limits(df, 100, **k).orderBy("arrival_seq").collect()
    ]
    assert numbers(gap_ms=10) == [1, 1, 2, 2]
    assert numbers(gap_ms=0) == [1, 2, 3, 3]
    assert numbers() == [1, 1, 1, 1]


@settings(max_examples=200, deadline=None)
@given(
    times=st.lists(st.integers(0, 60), min_size=1, max_size=60),
    size=st.integers(1, 8),
    max_ms=st.integers(0, 30),
    gap=st.none() | st.integers(0, 20),
    ordered=st.booleans(),
)
def test_jumps_equal_the_walk(times, size, max_ms, gap, ordered):
    times = np.array(sorted(times) if ordered else times, dtype=np.int64)
    following = next_batch(times, size, max_ms, gap)
    begins, at = [], 0
    while at < len(times):
        begins.append(at)
        at = int(following[at])
    batches = greedy(times.tolist(), size, max_ms, gap)
    assert begins == [n for n in range(len(times)) if n == 0 or batches[n] != batches[n - 1]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=30), st.integers(1, 25))
def test_first_reaching(times, wait):
    found = first_reaching(np.array(times, dtype=np.int64), wait)
    for at, now in enumerate(times):
        later = [n for n in range(at + 1, len(times)) if times[n] >= now + wait]
        assert found[at] == (later[0] if later else len(times))


def test_leaving_a_segment():
    leaves, cuts = leave_segment(np.array([3, 4, 5, 6, 7, 8, 9, 10]), 6, 3)
    assert (leaves.tolist(), cuts.tolist()) == ([0, 1, 2], [2, 2, 2])


@pytest.mark.parametrize(
    "size,max_ms,gap_ms", [(5, 40, None), (6, 0, 12), (4, 25, 9), (3, 1000, 1000), (7, 30, 0)]
)
def test_limits_over_many_small_segments(spark, size, max_ms, gap_ms):
    seed = random.Random(size)

    def series(count, step, back):
        now, out = 0, []
        for at in range(count):
            now += seed.randint(0, step) - (seed.randint(0, back) if seed.random() < 0.2 else 0)
            out.append((at * 3 - 50, now))
        return out

    sources = {
        "hot": series(2500, 15, 0),
        "jumpy": series(900, 15, 30),
        "short": series(size - 1, 15, 0),
        "one": series(1, 5, 0),
        "edge": series(2 * max(12, 2 * size), 9, 0),
    }
    found = batch_by_limits(
        table(spark, sources),
        size,
        max_ms,
        gap_ms,
        segment_rows=12,
        segments_per_group=5,
        bucket_width=200,
    ).collect()
    assert len(found) == sum(map(len, sources.values()))
    for source, entries in sources.items():
        numbers = greedy([time for _, time in entries], size, max_ms, gap_ms)
        expected = dict(zip([seq for seq, _ in entries], numbers))
        assert {r.arrival_seq: r.batch_no for r in found if r.source == source} == expected, source


def test_equal_keys_share_a_partition_in_order(make):
    df = make(*[{"body_text": "x", "group_id": f"g{n % 5}"} for n in range(200)])
    options = IngestOptions(topic="t", key_header="JMSXGroupID")
    laid = partition_by_key(to_records(df, options), 4, chunk_width=50)
    found = laid.withColumn("task", F.spark_partition_id()).collect()
    for group in range(5):
        places = {r.topic_partition for r in found if r.key_text == f"g{group}"}
        assert len(places) == 1 and places <= set(range(4))
    by_task, chunks = {}, {}
    for r in found:
        by_task.setdefault(r.task, []).append((r.topic_partition, r.arrival_seq))
        chunks.setdefault((r.topic_partition, r.arrival_seq // 50), set()).add(r.task)
    assert all(rows == sorted(rows) for rows in by_task.values())
    assert all(len(tasks) == 1 for tasks in chunks.values())


def test_many_sources_with_one_key_are_spread(spark):
    rows = spark.range(20_000).select(
        F.concat(F.lit("q"), (F.col("id") % 4_000).cast("string")).alias("source"),
        F.expr("id div 4000").alias("arrival_seq"),
        F.lit("hot").alias("key_text"),
        F.lit(None).cast("binary").alias("key_bytes"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        laid = partition_by_key(rows, 8).select(F.spark_partition_id().alias("t"))
        tasks = Counter(r.t for r in laid.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(tasks) > 2 and max(tasks.values()) < 20_000 * 2 / len(tasks)


def test_records_without_key_and_hot_keys_are_spread(spark, make):
    rows = spark.range(40_000).select(
        F.lit("q").alias("source"),
        F.col("id").alias("arrival_seq"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id"))).alias("key_text"),
        F.lit(None).cast("binary").alias("key_bytes"),
    )
    keyless = partition_by_key(rows, 8).groupBy("topic_partition").count().collect()
    assert len(keyless) == 8 and max(r["count"] for r in keyless) < 6_500
    hot = partition_by_key(rows.withColumn("key_text", F.lit("hot")), 8, chunk_width=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = Counter(r.t for r in hot.select(F.spark_partition_id().alias("t")).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(tasks.values()) < 20_000


def test_rows_without_a_place_are_refused(make):
    with pytest.raises(ValueError, match="no source"):
        batch_by_count(make({"source": None}, {}), 10)


def test_offsets_number_topic_partitions_in_arrival_order(spark):
    rows = spark.range(9_000).select(
        F.concat(F.lit("q"), (F.col("id") % 3).cast("string")).alias("source"),
        F.expr("id div 3 * 1000").alias("arrival_seq"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("k"), F.col("id") % 40)).alias("key_text"),
        F.lit(None).cast("binary").alias("key_bytes"),
    )
    found = partition_offsets(rows, 4, bucket_width=50_000).collect()
    by_partition, by_key = {}, {}
    for r in found:
        by_partition.setdefault(r.topic_partition, []).append((r.topic_offset, r.arrival_seq))
        by_key.setdefault(r.key_text, set()).add(r.topic_partition)
    assert len(found) == 9_000 and set(by_partition) == set(range(4))
    for places in by_partition.values():
        places.sort()
        assert [offset for offset, _ in places] == list(range(len(places)))
        assert [seq for _, seq in places] == sorted(seq for _, seq in places)
    assert all(len(where) == 1 for key, where in by_key.items() if key is not None)
    assert partition_offsets(rows.limit(0), 4).count() == 0
