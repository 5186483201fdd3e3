"""Helpers every operator may need: the cluster's shared folder, small settled tables, row gates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

_own_folders: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Session settings the results depend on: UTC times, and the last of two equal JSON keys."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a local session that names none gets a temporary folder of its own.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="postlane-")
    return _own_folders[context.applicationId]


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the application's part of the shared folder."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/postlane/{application}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an aggregate to the shared folder and read it back.

    It is then computed once, survives lost executors, and has a size the planner knows:
    a later join broadcasts it only when it really is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    if _open_scratches:
        _open_scratches[-1].paths.append((df.sparkSession, path))
    settled = df.sparkSession.read.schema(df.schema).parquet(path)
    settled._settled_at = path
    return settled


def forget(df: DataFrame) -> None:
    """Delete the folder of a settled table that nothing reads any more."""
    path = getattr(df, "_settled_at", None)
    if path is not None:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Tables settled inside ``with scratch() as …`` go at its end, but for those it is told to keep."""

    def __init__(self) -> None:
        self.paths: list[tuple[SparkSession, str]] = []
        self.kept: set[str] = set()

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(df._settled_at)
        return df

    def clear(self) -> None:
        for spark, path in self.paths:
            if path not in self.kept:
                _delete(spark, path)


_open_scratches: list[Scratch] = []


@contextmanager
def scratch(clear: bool = True) -> Iterator[Scratch]:
    """Delete what is settled inside, so that a long job holds only what is still to be read.

    Whatever leaves the block must be settled and kept; a plan that still reads a deleted table fails.
    A kept table belongs to the block around this one, if there is any. Without ``clear`` all stays until
    the caller clears it.
    """
    mine = Scratch()
    _open_scratches.append(mine)
    try:
        yield mine
    finally:
        _open_scratches.pop()
        if clear:
            mine.clear()
            if _open_scratches:
                _open_scratches[-1].paths += [one for one in mine.paths if one[1] in mine.kept]


def gate(df: DataFrame, keep: Column, otherwise: Column | None = None) -> DataFrame:
    """Keep the rows where ``keep`` holds, evaluating it after the columns it reads.

    A plain filter on a computed column is pushed below the projection, which would parse every
    body twice. A generator that yields one or no element filters just as well and stays above
    it. ``otherwise`` is evaluated for the rows that are not kept, e.g. to raise an error.
    """
    passed = F.when(keep, F.array(F.lit(True)))
    if otherwise is not None:
        passed = passed.otherwise(otherwise)
    return df.select("*", F.explode(passed).alias("__kept")).drop("__kept")
