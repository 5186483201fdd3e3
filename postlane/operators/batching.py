"""Batches by count, and records laid out by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlane.options import DEFAULT_BATCH_SIZE
from postlane.shared import settle

BUCKET_WIDTH = 100_000
BUCKETS_PER_BLOCK = 1_000
# A source may always have so many buckets; beyond that, so many rows are expected in each.
BUCKETS_FREELY = 1_000
ROWS_PER_BUCKET = 64


def number_in_order(
    df: DataFrame,
    by: str = "source",
    order: str = "arrival_seq",
    bucket_width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Add ``ordinal``: 1, 2, 3 … per ``by`` in the order of ``order``.

    Equal numbers are told apart by ``message_id`` where there is one, and every row gets an ordinal of its
    own all the same. One pass over two columns counts the rows of buckets of consecutive numbers, and these counts
    say how each ``by`` is numbered: where all numbers from the first to the last are there once, the
    ordinal is a subtraction and no row moves; where buckets hold a fair number of rows, rows are
    numbered inside them; where they do not, because numbers lie far apart or one is repeated very
    often, inside ranges of about equally many rows.
    """
    counts = _bucket_counts(df, by, order, bucket_width)
    sources = _sources_by_kind(df, counts, by, order, bucket_width)
    found = sources.groupBy("kind").agg(F.sum("unplaced").alias("unplaced")).collect()
    kinds = {row["kind"] for row in found}
    unplaced = sum(row["unplaced"] for row in found)
    if unplaced:
        raise ValueError(f"{unplaced} rows have no {by} or no {order}")

    def of_kind(kind: str) -> DataFrame:
        if kinds == {kind}:
            return df
        return df.join(sources.where(F.col("kind") == kind), by, "left_semi").select(*df.columns)

    parts = []
    if "whole" in kinds:
        whole = sources.where("kind = 'whole'").select(by, F.col("first").alias("__first"))
        ordinal = F.col(order) - F.col("__first") + 1
        parts.append(df.join(whole, by).select(*df.columns, ordinal.alias("ordinal")))
    if "ranges" in kinds:
        parts.append(number_by_ranges(of_kind("ranges"), by, order))
    if "buckets" in kinds or not parts:
        parts.append(number_by_buckets(of_kind("buckets") if kinds else df, by, order, bucket_width, counts))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _bucket(order: str, width: int) -> Column:
    # Never null, so that no join adds a filter that would keep the counts from being reused.
    return F.expr(f"coalesce(`{order}` div {width}, 0)")


def _bucket_counts(df: DataFrame, by: str, order: str, width: int) -> DataFrame:
    """Rows, and the first and last number, of every bucket that is not empty."""
    counts = df.groupBy(by, _bucket(order, width).alias("__bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(order).alias("first"),
        F.max(order).alias("last"),
        F.count_if(F.col(order).isNull() | F.col(by).isNull()).alias("unplaced"),
    )
    return settle(counts, "bucket-counts")


def _sources_by_kind(df: DataFrame, counts: DataFrame, by: str, order: str, width: int) -> DataFrame:
    """(by, first, unplaced, kind): how the rows of each ``by`` are to be numbered."""
    sources = counts.groupBy(by).agg(
        F.sum("n").alias("n"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("n").alias("most"),
        F.count(F.lit(1)).alias("buckets"),
        F.sum("unplaced").alias("unplaced"),
    )
    crowded = F.col("most") > width
    thin = F.col("buckets") > F.greatest(F.lit(BUCKETS_FREELY), F.col("n") / ROWS_PER_BUCKET)
    otherwise = F.when(crowded | thin, "ranges").otherwise("buckets")
    sources = settle(sources.withColumn("otherwise", otherwise), "sources")
    filled = sources.where("last - first + 1 = n").select(by)
    if filled.isEmpty():
        return sources.select(by, "first", "unplaced", F.col("otherwise").alias("kind"))
    # As many rows as numbers: whole if no number comes twice. These sources have no thin bitmaps.
    number = F.col(order)
    bitmaps = df.join(filled, by, "left_semi").groupBy(by, F.bitmap_bucket_number(number).alias("__map"))
    seen = bitmaps.agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(number))).alias("seen"))
    seen = seen.groupBy(by).agg(F.sum("seen").alias("seen"))
    kind = F.when(F.col("seen") == F.col("n"), "whole").otherwise(F.col("otherwise"))
    judged = sources.join(seen, by, "left").select(by, "first", "unplaced", kind.alias("kind"))
    return settle(judged, "numbering")


def _ties(df: DataFrame, order: str) -> list[str]:
    return [order, "message_id"] if "message_id" in df.columns else [order]


def number_by_buckets(
    df: DataFrame,
    by: str = "source",
    order: str = "arrival_seq",
    bucket_width: int = BUCKET_WIDTH,
    counts: DataFrame | None = None,
) -> DataFrame:
    """``number_in_order`` for numbers with holes, without one task per ``by``.

    A bucket of ``bucket_width`` consecutive numbers has no more rows than that, unless numbers are repeated,
    however many rows its source has. Rows are numbered inside their bucket; where a bucket starts comes from
    a running total over the bucket counts, taken in two steps so that this too is spread.
    """
    counts = _bucket_counts(df, by, order, bucket_width) if counts is None else counts
    block = F.expr(f"coalesce(__bucket div {BUCKETS_PER_BLOCK}, 0)")
    rows = df.withColumn("__bucket", _bucket(order, bucket_width))
    counts = counts.select(by, "__bucket", "n", block.alias("__block"))
    before = (Window.unboundedPreceding, -1)
    blocks = counts.groupBy(by, "__block").agg(F.sum("n").alias("n"))
    in_source = Window.partitionBy(by).orderBy("__block").rowsBetween(*before)
    blocks = blocks.select(
        by, "__block", F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("block_start")
    )
    in_block = Window.partitionBy(by, "__block").orderBy("__bucket").rowsBetween(*before)
    starts = (
        counts.withColumn("in_block", F.coalesce(F.sum("n").over(in_block), F.lit(0)))
        .join(blocks, [by, "__block"])
        .select(by, "__bucket", (F.col("block_start") + F.col("in_block")).alias("__start"))
    )
    in_bucket = Window.partitionBy(by, "__bucket").orderBy(*_ties(df, order))
    return (
        rows.withColumn("__place", F.row_number().over(in_bucket))
        .join(starts, [by, "__bucket"])
        .withColumn("ordinal", F.col("__start") + F.col("__place"))
        .select(*df.columns, "ordinal")
    )


def sorted_ranges(df: DataFrame, by: str, order: str) -> DataFrame:
    """``df`` sorted and written by ranges of about equally many rows, with ``__range`` and ``__place``.

    Spark takes the borders from a sample. The last key tells equal rows apart, so they too are spread over ranges.
    """
    keys = [by, *_ties(df, order), "__row"]
    ranged = df.withColumn("__row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The number of the range, and below it, in 33 bits, that of the row in its range.
    ranged = ranged.withColumn("__place", F.monotonically_increasing_id())
    return settle(ranged.withColumn("__range", F.shiftright("__place", 33)).drop("__row"), "ranges")


def number_by_ranges(df: DataFrame, by: str = "source", order: str = "arrival_seq") -> DataFrame:
    """``number_in_order`` for any numbers: far apart, or one of them in any share of the rows.

    A row's place in its range, and a small table of how many rows of its source the ranges before hold,
    make the ordinal.
    """
    ranged = sorted_ranges(df, by, order)
    sizes = ranged.groupBy(by, "__range").agg(F.min("__place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("n").over(before), F.lit(0))
    starts = settle(sizes.select(by, "__range", (earlier - F.col("first") + 1).alias("__start")), "range-starts")
    return ranged.join(starts, [by, "__range"]).select(
        *df.columns, (F.col("__place") + F.col("__start")).alias("ordinal")
    )


def batch_by_count(
    messages: DataFrame, size: int = DEFAULT_BATCH_SIZE, bucket_width: int = BUCKET_WIDTH
) -> DataFrame:
    """Add ``batch_no``: each source cut into batches of ``size`` in arrival order."""
    if size < 1:
        raise ValueError("a batch needs room for at least one message")
    numbered = number_in_order(messages, bucket_width=bucket_width)
    return numbered.withColumn("batch_no", F.expr(f"(ordinal - 1) div {size} + 1")).drop("ordinal")


def partition_by_key(
    records: DataFrame, partitions: int, chunk_width: int = BUCKET_WIDTH
) -> DataFrame:
    """Add ``topic_partition`` (see ``topic_partition``) and lay records out by it, in arrival order.

    Equal keys share a topic partition; records without a key are spread. A topic partition is
    laid out in chunks of consecutive arrival numbers of a source, each whole and ordered in one task, so a
    partition made large by one frequent key becomes many chunks instead of one large task, and so
    do many sources whose numbers all begin near 0. Order holds inside a chunk, and by ``arrival_seq``
    on reading.
    """
    chunk = F.expr(f"arrival_seq div {chunk_width}")
    return (
        records.withColumn("topic_partition", topic_partition(partitions))
        .repartition("topic_partition", "source", chunk)
        .sortWithinPartitions("topic_partition", "arrival_seq", "source")
    )


def topic_partition(partitions: int) -> Column:
    """The topic partition of a record: by its key; without a key, by its place."""
    if partitions < 1:
        raise ValueError("a topic has at least one partition")
    keyless = F.col("key_text").isNull() & F.col("key_bytes").isNull()
    place = F.when(keyless, F.xxhash64("source", "arrival_seq")).otherwise(
        F.xxhash64("key_text", "key_bytes")
    )
    return F.pmod(place, F.lit(partitions)).cast("int")


def partition_offsets(records: DataFrame, partitions: int, bucket_width: int = BUCKET_WIDTH) -> DataFrame:
    """Add ``topic_partition`` and ``topic_offset``: 0, 1, 2 … in each, in arrival order.

    Records of equal keys are in one partition, so its offsets give their order to any reader, however the
    records are laid out. A partition that one frequent key makes large is numbered by many tasks.
    """
    dealt = records.withColumn("topic_partition", topic_partition(partitions))
    numbered = number_in_order(dealt, by="topic_partition", bucket_width=bucket_width)
    return numbered.withColumn("topic_offset", F.col("ordinal") - 1).drop("ordinal")
