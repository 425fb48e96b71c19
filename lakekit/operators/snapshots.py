"""Versioned tables on plain Parquet: data folders that never change and a log with one row per version.

Publishing writes a new data folder first and the log row last, so readers see a version wholly or not at all. One
writer at a time. The log is tiny (a row per publish) and only its newest rows reach the driver.
"""

from __future__ import annotations

import datetime
import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.tables import conform, enforce_schema, evolve_schema
from lakekit.session import small_rows

_LOG = "version BIGINT, published_at STRING, operation STRING, metrics STRING, batch STRING, schema STRING, paths ARRAY<STRING>"


class SnapshotTable:
    """A table of versions 0, 1, 2, … below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- log

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        return self._log().drop("schema", "paths").orderBy(F.desc("version"))

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(_LOG).json(f"{self.path}/log")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], _LOG)
            raise

    def _entry(self, version: int | None = None, timestamp: str | None = None) -> Row | None:
        log = self._log()
        if version is not None:
            log = log.where(F.col("version") == version)
        if timestamp is not None:
            log = log.where(F.to_timestamp("published_at") <= F.to_timestamp(F.lit(timestamp)))
        found = log.orderBy(F.desc("version")).limit(1).collect()
        return found[0] if found else None

    def version(self) -> int | None:
        entry = self._entry()
        return entry["version"] if entry else None

    def has_batch(self, batch: str) -> bool:
        return not self._log().where(F.col("batch") == batch).isEmpty()

    def _record(
        self, operation: str, schema: StructType, paths: list[str], metrics: dict, batch: str | None, last: Row | None
    ) -> int:
        number = 0 if last is None else last["version"] + 1
        now = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%S.%f")
        row = {
            "version": number, "published_at": now, "operation": operation, "metrics": json.dumps(metrics),
            "batch": batch, "schema": schema.json(), "paths": paths,
        }
        small_rows(self.spark, [row], _LOG).write.mode("append").json(f"{self.path}/log")
        return number

    # ---- reads

    def exists(self) -> bool:
        return self._entry() is not None

    def read(self, version: int | None = None, timestamp: str | None = None) -> DataFrame:
        """Newest content, or that of a version, or that at a time (ISO text, UTC)."""
        entry = self._entry(version, timestamp)
        if entry is None:
            raise ValueError(f"no version for version={version} timestamp={timestamp} in {self.path}")
        schema = StructType.fromJson(json.loads(entry["schema"]))
        if not entry["paths"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*entry["paths"])

    def schema(self) -> StructType | None:
        entry = self._entry()
        return StructType.fromJson(json.loads(entry["schema"])) if entry else None

    # ---- writes

    def _write(self, df: DataFrame, mark: str = "") -> list[str]:
        """Write a new data folder; ``mark`` begins its name."""
        path = f"{self.path}/data/{mark}{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        return [path]

    def publish(
        self, df: DataFrame, operation: str = "overwrite", metrics: dict | None = None, batch: str | None = None,
        overwrite_schema: bool = False,
    ) -> int | None:
        """Make ``df`` the whole content of the next version; a ``batch`` seen before changes nothing."""
        if batch is not None and self.has_batch(batch):
            return None
        last = self._entry()
        if last is not None and not overwrite_schema:
            df = enforce_schema(df, StructType.fromJson(json.loads(last["schema"])))
        return self._record(operation, df.schema, self._write(df), metrics or {}, batch, last)

    def append(self, df: DataFrame, merge_schema: bool = False, batch: str | None = None) -> int | None:
        """Add rows: the next version lists the old folders and one new folder, nothing is rewritten."""
        if batch is not None and self.has_batch(batch):
            return None
        entry = self._entry()
        if entry is None:
            return self._record("append", df.schema, self._write(df), {}, batch, None)
        current = StructType.fromJson(json.loads(entry["schema"]))
        schema = evolve_schema(current, df.schema) if merge_schema else current
        rows = conform(df, schema) if merge_schema else enforce_schema(df, schema)
        return self._record("append", schema, [*entry["paths"], *self._write(rows)], {}, batch, entry)

    def alter(self, schema: StructType, columns: dict[str, str], operation: str = "alter") -> int:
        """Publish with changed columns: ``columns`` maps each new name to an expression over the old row."""
        df = self.read().select(*[F.expr(columns[f.name]).cast(f.dataType).alias(f.name) for f in schema.fields])
        return self.publish(df, operation, overwrite_schema=True)

    def restore(self, version: int) -> int:
        """New version with the content of an old one; no data is copied."""
        entry = self._entry(version)
        if entry is None:
            raise ValueError(f"no version {version}")
        schema = StructType.fromJson(json.loads(entry["schema"]))
        return self._record(f"restore {version}", schema, entry["paths"], {}, None, self._entry())
