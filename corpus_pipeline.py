"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlane.llm.decontaminate import without_contaminated
from postlane.llm.packing import pack_documents
from postlane.llm.passages import without_repeats
from postlane.llm.simhash_covering import one_of_each
from postlane.llm.toxicity import without_toxic
from postlane.shared import Scratch, forget, scratch, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Tables of the stage before, which its result, not yet written, may still read.
_held: list[Scratch] = []


def _own_tables(work: Stage) -> Stage:
    """A stage's tables go when the next one begins: its result, which is the next one's input, is written then."""

    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _held:
            _held.pop().clear()
        with scratch(clear=False) as mine:
            result = work(spark, docs, sf_dir)
        _held.append(mine)
        return result

    return stage


@_own_tables
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_own_tables
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


@_own_tables
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeats(docs)


@_own_tables
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    while _held:
        _held.pop().clear()
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The first stage is a trained machine, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, settle(stage(spark, docs, sf_dir), name)
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
