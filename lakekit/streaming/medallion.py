"""Bronze, silver and gold as three streams run one after the other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.snapshots import SnapshotTable
from lakekit.streaming.runs import append_to, file_stream, replace_table


@dataclass
class EventMedallion:
    """JSON events to typed bronze rows, cleaned and enriched silver rows, daily gold totals.

    ``lookup`` is the static side joined in silver; it is read again by every batch. Running ``refresh`` twice without new
    files changes nothing.
    """

    spark: SparkSession
    source: str
    base: str
    schema: str
    lookup: DataFrame
    lookup_key: str
    delay: str = "1 day"

    def bronze(self) -> None:
        raw = file_stream(self.spark, self.source, self.schema, "json", recursiveFileLookup="true")
        append_to(
            raw.select("*", F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("ingested_at")),
            f"{self.base}/bronze", f"{self.base}/checkpoints/bronze",
        )

    def silver(self) -> None:
        bronze = file_stream(self.spark, f"{self.base}/bronze", f"{self.schema}, source_file STRING, ingested_at TIMESTAMP")
        clean = (
            bronze.where("event_type <> 'error' AND ts IS NOT NULL")
            .withWatermark("ts", self.delay)
            .dropDuplicatesWithinWatermark(["event_id"])
            .join(self.lookup, self.lookup_key, "left")
        )
        append_to(clean, f"{self.base}/silver", f"{self.base}/checkpoints/silver")

    def gold(self) -> None:
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.lookup.schema.fields if f.name != self.lookup_key)
        schema = f"{self.schema}, source_file STRING, ingested_at TIMESTAMP, {columns}"
        daily = (
            file_stream(self.spark, f"{self.base}/silver", schema)
            .groupBy(F.to_date("ts").alias("day"), "segment")
            .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
        )
        replace_table(daily, SnapshotTable(self.spark, f"{self.base}/gold"), f"{self.base}/checkpoints/gold")

    def refresh(self) -> DataFrame:
        self.bronze()
        self.silver()
        self.gold()
        return SnapshotTable(self.spark, f"{self.base}/gold").read()
