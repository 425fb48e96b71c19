"""Idempotent file loading: every file is loaded once, also after crashes and re-runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators.snapshots import SnapshotTable
from lakekit.session import stored
from lakekit.sources.files import list_files

_LEDGER = "path STRING, batch STRING"


#: Files of one version: what the driver holds of a listing at a time, and a crash can lose. Names that one call may list.
FILES_AT_ONCE, NAMED_FILES = 10_000, 1000


class Loader:
    """Loads the files of a folder into a versioned table.

    The names of loaded files are kept in a ledger beside the table. They are written before the version and count only
    once the table's log has the batch, so a crash between the two leaves no trace. A file counts by its
    path: changing it later does not load it again.

    The listing stays a frame: it is compared with the ledger, and written to it, by Spark. A load takes it in steps of
    ``FILES_AT_ONCE`` files, each a version of its own, so the driver has the paths of one step only.
    """

    def __init__(self, table: SnapshotTable, fmt: str, schema: StructType | str | None = None, **options):
        self.table, self.fmt, self.options = table, fmt, options
        self.spark: SparkSession = table.spark
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    @property
    def _ledger_path(self) -> str:
        return f"{self.table.path}/ledger"

    def loaded(self) -> DataFrame:
        """Files loaded so far with their batch."""
        try:
            ledger = self.spark.read.schema(_LEDGER).parquet(self._ledger_path)
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], _LEDGER)
            raise
        return ledger.join(self.table.history().select("batch"), "batch", "left_semi")

    def _listed(self, path: str | list[str], pattern: str | None, files: list[str] | None, selection: dict) -> DataFrame:
        found = list_files(self.spark, path, pattern, **selection)
        if files is None:
            return found
        if len(files) > NAMED_FILES:
            raise ValueError(f"at most {NAMED_FILES} files can be named; use a pattern")
        named = found.where(F.lit(False) if not files else reduce(Column.__or__, [F.endswith("path", F.lit(f"/{f.lstrip('/')}")) for f in files]))
        absent = [f for f in files if named.where(F.endswith("path", F.lit(f"/{f.lstrip('/')}"))).isEmpty()]
        if absent:
            raise FileNotFoundError(f"not below {path}: {absent}")
        return named

    def pending(self, path: str | list[str], pattern: str | None = None, files: list[str] | None = None, **selection) -> DataFrame:
        """Files that a load would take now."""
        return self._listed(path, pattern, files, selection).join(self.loaded(), "path", "left_anti")

    def _read(self, files: list[str]) -> DataFrame:
        reader = self.spark.read.format(self.fmt).options(**self.options)
        if self.schema is not None:
            reader = reader.schema(self.schema)
        return reader.load(files)

    def preview(self, path: str | list[str], n: int, pattern: str | None = None, files: list[str] | None = None) -> DataFrame:
        """The first rows as they would be loaded; nothing is written. One file is opened, then twice as many, until they have ``n`` rows."""
        names = self.pending(path, pattern, files).select("path").orderBy("path")
        taken, step = [], 1
        for r in names.toLocalIterator():
            taken.append(r["path"])
            if len(taken) == step:
                if self._read(taken).limit(n).count() >= n:
                    break
                step *= 2
        if not taken:
            return self.spark.createDataFrame([], self.schema or self.table.schema())
        return self._read(taken).limit(n)

    def load(
        self,
        path: str | list[str],
        pattern: str | None = None,
        *,
        files: list[str] | None = None,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        force: bool = False,
        merge_schema: bool = False,
        max_files: int | None = None,
        lineage: bool = False,
        number_batches: bool = False,
        **selection,
    ) -> dict:
        """Load new files and return ``files``, ``skipped`` and ``rows``. With ``force`` files are loaded again.

        ``files`` names the files to take (paths below ``path``; an absent one fails the load). ``max_files`` takes the first files
        only; the rest stays pending for the next call. ``lineage`` adds ``source_file`` and ``ingested_at``, ``number_batches`` an
        increasing ``batch_id``, one per call. ``transform`` runs between read and append.
        """
        listed = self._listed(path, pattern, files, selection)
        todo = (listed if force else listed.join(self.loaded(), "path", "left_anti")).select("path")
        names = stored(todo.orderBy("path").limit(max_files) if max_files else todo, "load-files")
        taken = names.count()
        result = {"files": taken, "skipped": listed.count() - taken, "rows": 0, "version": self.table.version()}
        number = None
        if number_batches and taken:
            known = self.table.read().agg(F.max("batch_id")).first()[0] if self.table.exists() else None
            number = (known or 0) + 1
        step: list[str] = []
        for r in names.orderBy("path").toLocalIterator():
            step.append(r["path"])
            if len(step) == FILES_AT_ONCE:
                self._load_step(step, names, result, transform, merge_schema, lineage, number)
                step = []
        if step:
            self._load_step(step, names, result, transform, merge_schema, lineage, number)
        return result

    def _load_step(self, paths: list[str], names: DataFrame, result: dict, transform, merge_schema: bool, lineage: bool, number: int | None) -> None:
        df = self._read(paths)
        if lineage:
            df = df.select("*", F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("ingested_at"))
        if number is not None:
            df = df.withColumn("batch_id", F.lit(number))
        if transform:
            df = transform(df)
        seen = Observation(f"load-{uuid.uuid4().hex}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        batch = uuid.uuid4().hex
        self._note(names.where(F.col("path").between(paths[0], paths[-1])), batch)
        result["version"] = self.table.append(df, merge_schema=merge_schema, batch=batch)
        result["rows"] += seen.get["rows"]

    def _note(self, names: DataFrame, batch: str) -> None:
        names.select("path", F.lit(batch).alias("batch")).write.mode("append").parquet(self._ledger_path)

    def ignore_existing(self, path: str | list[str], pattern: str | None = None) -> None:
        """Start from now on: the files already there count as loaded. Needs a known schema for the empty table."""
        batch = uuid.uuid4().hex
        self._note(self.pending(path, pattern), batch)
        self.table.append(self.spark.createDataFrame([], self.schema), batch=batch)


def rows_per_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
