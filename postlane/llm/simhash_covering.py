"""SimHash fingerprints linked through covering locality-sensitive hashing.

A fingerprint takes, for each of 64 bits, the majority over the XXH64 hashes of all 3-word
shingles. Bit ``i`` is given a non-zero vector ``m(i)`` of three bits, and each of the seven
non-zero vectors ``v`` of three bits makes a mask of the bits with odd ``m(i) & v``. Two
differing bits span at most two of three dimensions, so some ``v`` is orthogonal to both: in that
table the pair's masked fingerprints are equal. Every pair within the radius therefore collides,
whatever its bits; candidates are then compared exactly.

Copies are one fingerprint from the start. Buckets of few fingerprints are compared inside, and
only a spanning star of each linked set leaves the task. A bucket of many is never compared in
pairs: each of its fingerprints goes to itself and to all fingerprints one flipped bit away. Those
that meet there differ by two bits at most, and every linked pair meets half-way, so linking each to
the smallest one met gives exactly the same components from a linear number of rows.

Null text has no words. A text without words has fingerprint zero and is linked like any other.
Repeated rows stay; a row without an id gets the component of its fingerprint, and a component
without any id has a null id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlane.llm.components import components
from postlane.llm.words import LOWER, bounded_batches, release, text_chunks
from postlane.shared import scratch, settle

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
SMALL_BUCKET = 64


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def masks() -> list[int]:
    """One mask for each non-zero vector of ``RADIUS + 1`` bits."""
    vectors = (1 << (RADIUS + 1)) - 1
    given = [bit % vectors + 1 for bit in range(BITS)]
    return [
        sum(1 << bit for bit in range(BITS) if (given[bit] & vector).bit_count() % 2)
        for vector in range(1, vectors + 1)
    ]


def fingerprints_of(texts: list[bytes]) -> np.ndarray:
    """Unsigned fingerprints of UTF-8 texts."""
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for at, text in enumerate(texts):
        words = text.translate(LOWER).split()
        n = len(words)
        if not n:
            continue
        joined = b" ".join(words)
        if n <= SHINGLE:
            hashes.append(digest(joined, SEED))
            counts[at] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        begins = [0, *ends[: n - SHINGLE].tolist()]
        hashes += [digest(joined[a:b], SEED) for a, b in zip(begins, (ends[SHINGLE - 1 :] - 1).tolist())]
        counts[at] = n - SHINGLE + 1
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        table = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        begin = np.cumsum(counts[some]) - counts[some]
        bits = np.unpackbits(table, axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
        major = 2 * ones > counts[some][:, None]
        out[some] = np.packbits(major, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash) per row; ``fp`` holds the 64 bits as a signed long."""
    rows = bounded_batches(docs).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprints_of(texts) for _, texts in text_chunks(batch.column(1), 2_000_000)]
            whole = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(whole), batch.column(2)], names=["doc_id", "fp", "text_hash"]
            )

    return rows.mapInArrow(work, "doc_id long, fp long, text_hash long")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Link the fingerprints of each small bucket that are within the radius."""
    for batch in batches:
        left, right = [], []
        for bucket in batch.column(0).to_pylist():
            values = np.array(sorted(bucket), np.int64)
            near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= RADIUS
            root = np.arange(len(values))
            while True:  # smallest label within reach; buckets are small
                new = np.where(near, root[None, :], len(values)).min(axis=1)
                if (new == root).all():
                    break
                root = new
            linked = np.flatnonzero(root != np.arange(len(values)))
            left.append(values[linked])
            right.append(values[root[linked]])
        none = np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([none, *left])), pa.array(np.concatenate([none, *right]))],
            names=["a", "b"],
        )
    release()


def links(classes: DataFrame, small: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``classes`` within the radius."""
    keyed = classes.select(
        "fp",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(number).alias("mask"),
                        F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("key"),
                    )
                    for number, mask in enumerate(masks())
                ]
            )
        ).alias("at"),
    ).select("fp", "at.mask", "at.key")
    sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = settle(keyed.join(sizes, ["mask", "key"]), "buckets")
    few = (
        shared.where(F.col("n") <= small)
        .groupBy("mask", "key")
        .agg(F.collect_list("fp").alias("fps"))
        .select("fps")
        .mapInArrow(_stars, "a long, b long")
    )
    flips = [F.lit(0).cast("long"), *[F.lit(signed(1 << bit)) for bit in range(BITS)]]
    met = (
        shared.where(F.col("n") > small)
        .select("fp")
        .distinct()
        .select("fp", F.explode(F.array(*flips)).alias("flip"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("meeting"))
    )
    least = met.groupBy("meeting").agg(F.min("fp").alias("b"), F.max("fp").alias("most"))
    least = least.where("b <> most").drop("most")
    many = met.join(least, "meeting").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return few.unionByName(many)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", small: int = SMALL_BUCKET
) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable."""
    prints, members = grouped_prints(docs, doc_id, text, small)
    return prints.join(members, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def grouped_prints(docs: DataFrame, doc_id: str, text: str, small: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and (fp, component_id, root) of every fingerprint, both settled."""
    with scratch() as scope:
        prints = scope.keep(settle(fingerprints(docs, doc_id, text), "fingerprints"))
        classes = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
        roots = components(links(classes, small))
        grouped = classes.join(roots, classes.fp == roots.node, "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        )
        firsts = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
        members = grouped.join(firsts, "root").select("fp", "component_id", "root")
        return prints, scope.keep(settle(members, "members"))


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", small: int = SMALL_BUCKET
) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows of one id with different texts are documents of their own: of two in one component, that with the
    smaller fingerprint stays, of two in different ones both. Of equal rows one stays. Rows without an id cannot be
    named and all stay.
    """
    prints, members = grouped_prints(docs, doc_id, text, small)
    with scratch() as scope:
        named = prints.where("doc_id is not null").join(members, "fp")
        best = F.min(F.struct("doc_id", "fp", "text_hash")).alias("best")
        kept = named.groupBy("root").agg(best).select("best.doc_id", "best.text_hash")
        # How often the text that stays is there with its id.
        kept = prints.join(kept, ["doc_id", "text_hash"], "left_semi").groupBy("doc_id", "text_hash").agg(
            F.count(F.lit(1)).alias("__times")
        )
        kept = kept.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__times")
        kept = scope.keep(settle(kept, "kept"))
    same = (F.col(doc_id).cast("long") == F.col("__id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("__hash"))
    once = docs.join(kept.where("__times = 1").drop("__times"), same, "left_semi")
    out = once.unionByName(docs.where(F.col(doc_id).isNull()))
    often = kept.where("__times > 1").drop("__times")
    if often.isEmpty():
        return out
    # Copies are merged within each task before they are shuffled.
    again = docs.join(often, same).dropDuplicates(["__id", "__hash"]).select(*docs.columns)
    return out.unionByName(again)
