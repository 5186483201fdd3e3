"""Small tables that are replaced as a whole: delivery state and positions.

Each replacement is a new numbered version; readers take the newest complete one, so a writer
that dies half-way leaves the previous version in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

VERSION = "version="


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the finished versions below ``path``, ascending."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [status.getPath().getParent().getName() for status in files or []]
    return sorted(int(name.removeprefix(VERSION)) for name in names)


def forget_versions(spark: SparkSession, path: str, before: int) -> None:
    """Drop the versions below ``before``, which nothing reads any more."""
    jvm = spark._jvm
    for version in complete_versions(spark, path):
        if version < before:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path}/{VERSION}{version}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_table(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write ``df`` as the next version, or again as the given one."""
    if version is None:
        done = complete_versions(df.sparkSession, path)
        version = done[-1] + 1 if done else 0
    df.write.mode("overwrite").parquet(f"{path}/{VERSION}{version}")
    return version


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """The newest complete version, optionally the newest below ``before``; empty when none."""
    done = [n for n in complete_versions(spark, path) if before is None or n < before]
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{VERSION}{done[-1]}")
