"""Exact copies, with the most frequent texts split off before the shuffle.

Texts are equal when they are identical without ASCII white space; equal texts have equal SHA-256
digests of what is left. A Misra-Gries summary of the digests (``approx_top_k`` keeps the counters
of such a summary in every task and merges them) names candidates for frequent texts. A digest
with more than a ``GUARANTEE``-th of all rows is always among them: the summary is off by at most
1 / (0.75 * ``COUNTERS``) of the rows, so fewer than ``WINNERS`` digests can be put before it.
The candidates' rows are counted exactly, and of those that really are frequent the row that stays
is found, merged within each task first. That is a table of at most ``WINNERS`` rows, which is
broadcast: their copies are settled where they stand. The other digests, none of them frequent, are
shuffled, so no task gets a large group, however many copies one text has.

Everything is DataFrame functions. Of equal texts the row with the most code points in its original
text stays, then the smallest id, a row without an id last, then the first row read; so of
repeated rows one stays. Null text counts as empty, and all empty texts are equal. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlane.shared import settle

SPACES = " \t\n\x0b\x0c\r"
COUNTERS = 16_384
WINNERS = 4_096
GUARANTEE = 2_048


def without_spaces(text: Column) -> Column:
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, doc_id, n_chars, row) of every row; ``row`` tells repeated rows apart."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(
        F.sha2(without_spaces(whole), 256).alias("digest"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.length(whole).cast("long").alias("n_chars"),
        F.monotonically_increasing_id().alias("row"),
    )


def rank() -> Column:
    """The least one among equal texts stays."""
    return F.struct(
        (-F.col("n_chars")).alias("fewer"),
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("keep_id"),
        F.col("row").alias("keep_row"),
    )


def frequent_candidates(rows: DataFrame, counters: int = COUNTERS, winners: int = WINNERS) -> DataFrame:
    """At most ``winners`` digests, every one with many rows among them."""
    summary = rows.agg(F.expr(f"approx_top_k(digest, {winners}, {counters})").alias("top"))
    return summary.select(F.explode("top.item").alias("digest"))


def verified_winners(rows: DataFrame, candidates: DataFrame, least: int) -> DataFrame:
    """(digest, group_size, keep) of the candidates that at least ``least`` rows have."""
    return (
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.min(rank()).alias("keep"))
        .where(F.col("group_size") >= least)
    )


def frequent_texts(
    rows: DataFrame, counters: int = COUNTERS, winners: int = WINNERS, guarantee: int = GUARANTEE
) -> DataFrame:
    """(digest, group_size, keep) of all frequent digests of a settled table, small enough to broadcast."""
    if winners > WINNERS:
        raise ValueError(f"at most {WINNERS} frequent texts, as they are broadcast")
    candidates = settle(frequent_candidates(rows, counters, winners), "candidates")
    found = verified_winners(rows, candidates, max(2, rows.count() // guarantee))
    return F.broadcast(settle(found, "winners"))


def exact_copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    counters: int = COUNTERS,
    winners: int = WINNERS,
    guarantee: int = GUARANTEE,
) -> DataFrame:
    """Per row: doc_id, keep_id (the id of the row that stays), group_size, kept and text_sha256."""
    rows = settle(digests(docs, doc_id, text), "digests")
    frequent = frequent_texts(rows, counters, winners, guarantee)
    out = [
        "doc_id",
        F.col("keep.keep_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    ]
    common = rows.join(frequent, "digest").select(*out)
    alike = W.partitionBy("digest")
    others = (
        rows.join(frequent, "digest", "left_anti")
        .withColumn("group_size", F.count(F.lit(1)).over(alike))
        .withColumn("keep", F.first(rank()).over(alike.orderBy(rank())))
        .select(*out)
    )
    return common.unionByName(others)


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = settle(digests(docs, doc_id, text), "digests")
    frequent = frequent_texts(rows)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    marked = docs.withColumns(
        {
            "__digest": F.sha2(without_spaces(whole), 256),
            "__order": F.struct(
                (-F.length(whole).cast("long")).alias("fewer"),
                F.col(doc_id).isNull().alias("unnamed"),
                F.col(doc_id).cast("long").alias("keep_id"),
            ),
        }
    )
    best = frequent.select(
        F.col("digest").alias("__digest"),
        F.struct("keep.fewer", "keep.unnamed", "keep.keep_id").alias("__best"),
    )
    common = marked.join(F.broadcast(best), "__digest").where(F.col("__order").eqNullSafe(F.col("__best")))
    common = common.dropDuplicates(["__digest"])
    alike = W.partitionBy("__digest").orderBy("__order")
    others = marked.join(F.broadcast(best), "__digest", "left_anti")
    others = others.withColumn("__place", F.row_number().over(alike)).where("__place = 1")
    return common.select(*docs.columns).unionByName(others.select(*docs.columns))
