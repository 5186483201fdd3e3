"""Topics as partitioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_topics(
    records: DataFrame, path: str, mode: str = "append", max_rows_per_file: int = 5_000_000
) -> None:
    """Write records below one folder per topic; dead letters are a topic like any other."""
    (
        records.write.mode(mode)
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy("topic")
        .parquet(path)
    )


def read_topic(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """One topic's records; other topics' folders are not read."""
    return spark.read.parquet(path).where(F.col("topic") == topic)
