"""What a sink has published, in numbered units that become visible whole or not at all.

A unit is some batches of any number of sources. Its records lie in ``<sink>/unit=<n>/topic=…``; what is
known about it lies beside them in ``<sink>/_ledger``, as versions with the unit's number:

* ``state``: the batches in flight, with their messages, written before any record;
* ``manifest``: the units that readers may see; this write is what publishes a unit;
* ``delivered``: per source the last batch, as delivered, and its last message, written at the end.

Each step overwrites what a lost run may have left of it, so a step can be taken again. A unit that has
a state but is not among the delivered is open: whoever comes next finishes it from its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlane.operators.delivery import DELIVERED, IN_FLIGHT, DeliveryStateError
from postlane.schemas import STATE
from postlane.sources.state import complete_versions, forget_versions, read_table, replace_table

UNITS = T.StructType(
    [*STATE.fields, T.StructField("arrivals", T.ArrayType(T.LongType()))]
)
# The last message a source has delivered, in delivery order: its number, then its id.
FRONTIER = T.StructType(
    [*STATE.fields, T.StructField("arrival_seq", T.LongType()), T.StructField("message_id", T.StringType())]
)
MANIFEST = T.StructType([T.StructField("unit", T.LongType())])


def batches_in_flight(sequenced: DataFrame) -> DataFrame:
    """One row per batch with its messages in delivery order; a list is no longer than a batch."""
    listed = F.sort_array(F.collect_list(F.struct("arrival_seq", "message_id")))
    return sequenced.groupBy("source", "sequence_id").agg(listed.alias("listed")).select(
        "source",
        "sequence_id",
        F.col("listed.message_id").alias("message_ids"),
        F.lit(IN_FLIGHT).alias("last_known_state"),
        F.col("listed.arrival_seq").alias("arrivals"),
    )


class Ledger:
    def __init__(self, spark: SparkSession, sink: str) -> None:
        self.spark, self.sink = spark, sink
        self.path = f"{sink}/_ledger"

    def _versions(self, kind: str) -> list[int]:
        return complete_versions(self.spark, f"{self.path}/{kind}")

    def begun(self) -> bool:
        return bool(self._versions("delivered"))

    def open_unit(self) -> int | None:
        """The unit that was begun and not finished, if any."""
        begun, done = self._versions("state"), self._versions("delivered")
        return begun[-1] if begun and begun[-1] not in done else None

    def next_unit(self) -> int:
        return self._versions("delivered")[-1] + 1

    def state(self, unit: int | None = None) -> DataFrame:
        """The batches of a unit, else of the newest."""
        return read_table(self.spark, f"{self.path}/state", UNITS, None if unit is None else unit + 1)

    def delivered(self) -> DataFrame:
        """One row per source: its last batch, and where its next one begins."""
        return read_table(self.spark, f"{self.path}/delivered", FRONTIER)

    def visible(self) -> list[int]:
        rows = read_table(self.spark, f"{self.path}/manifest", MANIFEST).collect()
        return sorted(row["unit"] for row in rows)

    def begin(self, delivered: DataFrame, unsent: DataFrame | None) -> None:
        """Where a new sink starts, with the batches that an earlier engine had in flight as its first unit."""
        if unsent is not None:
            self.write_state(1, unsent)
        replace_table(delivered.select(*FRONTIER.names), f"{self.path}/delivered", 0)

    def write_state(self, unit: int, batches: DataFrame) -> None:
        replace_table(batches.select(*UNITS.names), f"{self.path}/state", unit)

    def write_records(self, unit: int, records: DataFrame) -> None:
        records.write.mode("overwrite").partitionBy("topic").parquet(f"{self.sink}/unit={unit}")

    def write_manifest(self, unit: int) -> None:
        units = sorted({*self.visible(), unit})
        rows = self.spark.createDataFrame([(number,) for number in units], MANIFEST).coalesce(1)
        replace_table(rows, f"{self.path}/manifest", unit)

    def write_delivered(self, unit: int) -> None:
        """The unit's batches are delivered; per source the last one, and its last message, are kept."""
        last = F.max_by(F.struct("message_ids", "arrivals"), "sequence_id")
        moved = self.state(unit).groupBy("source").agg(F.max("sequence_id").alias("sequence_id"), last.alias("last"))
        moved = moved.select(
            "source",
            "sequence_id",
            F.col("last.message_ids").alias("message_ids"),
            F.lit(DELIVERED).alias("last_known_state"),
            F.element_at("last.arrivals", -1).alias("arrival_seq"),
            F.element_at("last.message_ids", -1).alias("message_id"),
        )
        before = read_table(self.spark, f"{self.path}/delivered", FRONTIER, unit)
        others = before.join(moved, "source", "left_anti").select(*FRONTIER.names)
        replace_table(others.unionByName(moved), f"{self.path}/delivered", unit)
        for kind in ("state", "manifest", "delivered"):
            forget_versions(self.spark, f"{self.path}/{kind}", unit)

    def messages_of(self, messages: DataFrame, unit: int) -> DataFrame:
        """The messages of a unit, with the sequence ids its state gives them; all of them must still be there."""
        keys = ["source", "arrival_seq", "message_id"]
        listed = self.state(unit).select(
            "source", "sequence_id", F.explode(F.arrays_zip("arrivals", "message_ids")).alias("at")
        )
        listed = listed.select(
            F.col("source").alias("__source"),
            F.col("at.arrivals").alias("__seq"),
            F.col("at.message_ids").alias("__id"),
            "sequence_id",
        )
        listed = listed.groupBy("__source", "__seq", "__id").agg(F.min("sequence_id").alias("sequence_id"))
        same = (F.col("source") == F.col("__source")) & (F.col("arrival_seq") == F.col("__seq"))
        same = same & F.col("message_id").eqNullSafe(F.col("__id"))
        lost = listed.join(messages.select(*keys), same, "left_anti").select("__source").limit(1).collect()
        if lost:
            raise DeliveryStateError(f"messages of an unfinished batch are gone from {lost[0][0]}")
        return messages.join(listed, same).select(*messages.columns, "sequence_id")


def beyond(messages: DataFrame, delivered: DataFrame) -> DataFrame:
    """The messages after the last one delivered of their source, in delivery order."""
    last = delivered.select(
        F.col("source").alias("__source"),
        F.struct(F.col("arrival_seq"), F.coalesce("message_id", F.lit(""))).alias("__last"),
    )
    place = F.struct(F.col("arrival_seq"), F.coalesce("message_id", F.lit("")))
    after = F.col("__last").isNull() | F.col("__last.arrival_seq").isNull() | (place > F.col("__last"))
    return messages.join(last, F.col("source") == F.col("__source"), "left").where(after).select(*messages.columns)


def read_published(spark: SparkSession, sink: str) -> DataFrame:
    """The records of all published units, and of no other."""
    units = Ledger(spark, sink).visible()
    if not units:
        raise ValueError(f"nothing is published below {sink}")
    return spark.read.option("basePath", sink).parquet(*[f"{sink}/unit={unit}" for unit in units])
