"""File streams whose schema is stored, versioned and may grow."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DoubleType, IntegerType, LongType, ShortType, StringType, StructField,
    StructType,
)

from lakekit.operators.snapshots import SnapshotTable
from lakekit.session import small_rows
from lakekit.sources.files import RESCUED, apply_hints, infer_schema, one_case, parse_json_rescued
from lakekit.streaming.runs import batch_key, run_to_end

MODES = ("addNewColumns", "rescue", "failOnNewColumns", "none")
#: New columns that one batch may bring.
MOST_COLUMNS = 1000
_WIDER = [ByteType(), ShortType(), IntegerType(), LongType(), DoubleType()]


class SchemaChanged(RuntimeError):
    """New columns arrived. In mode addNewColumns they are stored by now and the next run goes on."""


class SchemaRegistry:
    """Versions 0, 1, 2, … of a stream's schema, one small JSON row each."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> DataFrame:
        try:
            return self.spark.read.schema("version INT, schema STRING").json(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], "version INT, schema STRING")
            raise

    def current(self) -> tuple[int, StructType] | None:
        last = self.versions().orderBy(F.desc("version")).limit(1).collect()
        if not last:
            return None
        return last[0]["version"], StructType.fromJson(json.loads(last[0]["schema"]))

    def add(self, schema: StructType) -> int:
        known = self.current()
        number = known[0] + 1 if known else 0
        rows = small_rows(self.spark, [{"version": number, "schema": schema.json()}], "version INT, schema STRING")
        rows.write.mode("append").json(self.path)
        return number


class JsonStream:
    """Incremental load of JSON lines with a stored schema.

    The schema is inferred once from the files present at the first run, with ``hints`` overriding columns and
    ``column_types=False`` taking everything as text. Later runs reuse it. What happens when a file brings a new column:

    * ``addNewColumns``: the column is stored as the next schema version and the run fails with ``SchemaChanged``; started
      again it continues with the new schema. Nothing of the failed batch was written. With ``widen`` a number that
      outgrows its column's type (int, long, double) is handled in the same way.
    * ``rescue``: it never stops, unknown columns go to ``_rescued_data``.
    * ``failOnNewColumns``: fails until the schema is changed by hand.
    * ``none``: new columns are ignored.
    """

    def __init__(
        self, spark: SparkSession, source: str, table: SnapshotTable, checkpoint: str, registry: SchemaRegistry, *,
        mode: str = "addNewColumns", hints: str | None = None, column_types: bool = True, widen: bool = False,
        sampling_ratio: float = 1.0, **options,
    ):
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        self.spark, self.source, self.table, self.checkpoint, self.registry = spark, source, table, checkpoint, registry
        self.mode, self.hints, self.column_types, self.widen = mode, hints, column_types, widen
        self.sampling_ratio, self.options = sampling_ratio, options

    def schema(self) -> StructType:
        known = self.registry.current()
        if known is None:
            first = infer_schema(
                self.spark, self.source, "json", self.hints, self.column_types, self.sampling_ratio,
                recursiveFileLookup="true",
            )
            first = one_case(first)
            self.registry.add(first)
            return first
        return apply_hints(known[1], self.hints)

    def run(self) -> None:
        """Process all files not processed yet."""
        schema = self.schema()
        lines = self.spark.readStream.format("text").options(recursiveFileLookup="true", **self.options).load(self.source)
        lines = lines.select("value", F.col("_metadata.file_path").alias("_file"))

        def step(batch: DataFrame, number: int) -> None:
            name = batch_key(batch, number)
            if self.table.has_batch(name):
                return
            if self.mode in ("addNewColumns", "failOnNewColumns"):
                grown = self._grown(batch, schema)
                if grown != schema:
                    if self.mode == "addNewColumns":
                        self.registry.add(grown)
                    raise SchemaChanged(f"schema of {self.source} changes to {grown.simpleString()}")
            rows = parse_json_rescued(batch, schema, "value", "_file")
            if self.mode == "none":
                rows = rows.drop(RESCUED)
            self.table.append(rows, merge_schema=True, batch=name)

        run_to_end(lines.writeStream.option("checkpointLocation", self.checkpoint).foreachBatch(step))

    def _grown(self, batch: DataFrame, schema: StructType) -> StructType:
        """The schema with the batch's new columns. A name that differs from a known one in case only is no new column: tables do not
        tell them apart, so its values are rescued. More than ``MOST_COLUMNS`` names are refused, as they are data and not columns."""
        raw = F.from_json("value", "map<string,string>")
        pairs = batch.select(F.explode(raw).alias("name", "text")).where("text IS NOT NULL")
        known = {f.name: f for f in schema.fields}
        lower = {n.lower() for n in known}
        if not self.widen:
            pairs = pairs.where(~F.lower("name").isin(list(lower))) if lower else pairs
        # one row per column name; whether all its texts read as a type is combined map-side
        facts = pairs.groupBy("name").agg(
            F.bool_and(F.col("text").try_cast("bigint").isNotNull()).alias("long"),
            F.bool_and(F.col("text").try_cast("int").isNotNull()).alias("int"),
            F.bool_and(F.col("text").try_cast("double").isNotNull()).alias("double"),
            F.bool_and(F.lower("text").isin("true", "false")).alias("boolean"),
        )
        rows = facts.limit(len(known) + MOST_COLUMNS + 1).collect()  # a row per column, not per record
        grown = dict(known)
        for r in sorted(rows, key=lambda r: r["name"]):
            if r["name"].lower() not in lower:
                grown[r["name"]] = StructField(r["name"], self._type(r), True)
                lower.add(r["name"].lower())
            elif self.widen and r["name"] in known and known[r["name"]].dataType in _WIDER:
                grown[r["name"]] = StructField(r["name"], self._widened(known[r["name"]].dataType, r), True)
        if len(grown) > len(known) + MOST_COLUMNS:
            raise ValueError(f"{self.source} has over {MOST_COLUMNS} new names in one batch")
        return StructType(list(grown.values()))

    def _type(self, r) -> DataType:
        if not self.column_types:
            return StringType()
        if r["long"]:
            return LongType()
        if r["double"]:
            return DoubleType()
        return BooleanType() if r["boolean"] else StringType()

    @staticmethod
    def _widened(old: DataType, r) -> DataType:
        for wider, fits in ((IntegerType(), r["int"]), (LongType(), r["long"]), (DoubleType(), r["double"])):
            if _WIDER.index(wider) >= _WIDER.index(old) and fits:
                return wider if _WIDER.index(wider) > _WIDER.index(old) else old
        return old
