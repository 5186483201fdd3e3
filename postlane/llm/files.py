"""Binary files that tasks write to and read from the shared folder.

Every attempt of a task writes files of its own name. A file counts only once the table of
written files, which Spark commits, lists it; what a lost attempt left behind is never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unique_name(folder: str, stem: str, ending: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}.{ending}"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_new(path: str):
    """An output stream; parent folders are made."""
    system, inner = _file_system(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def open_old(path: str):
    system, inner = _file_system(path)
    return system.open_input_file(inner)


def one_task_each(files: DataFrame) -> DataFrame:
    """Deal a settled table of files out, so that reading them runs in parallel."""
    return files.repartition(max(1, files.count()))


def with_starts(files: DataFrame, amount: str, start: str) -> DataFrame:
    """Running total of ``amount`` before each file, files being ordered by (part, file_no).

    Parts are summed first, so the window without partitioning sees one row per part.
    """
    from pyspark.sql import Window as W

    parts = files.groupBy("part").agg(F.sum(amount).alias("__amount"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("__amount").over(before), F.lit(0)).alias("__before"))
    within = W.partitionBy("part").orderBy("file_no").rowsBetween(W.unboundedPreceding, -1)
    return (
        files.join(parts, "part")
        .withColumn(start, F.col("__before") + F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .drop("__before")
    )
