"""Changes that rewrite only the partitions they touch.

A partitioned table keeps one folder per partition and write. A change finds the partitions it touches, reads those folders alone,
and publishes a version that lists the rewritten folders beside the old folders of all other partitions: their files keep
their names and are neither read nor copied. Readers of older versions see the old folders.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators import tables
from lakekit.operators.quality import holds
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import When

_PART = "_part"
_FOLDER = re.compile(rf"/{_PART}=([^/]*)")
#: Label of rows whose expression is NULL, as the writer names their folder.
NULL_LABEL = "__HIVE_DEFAULT_PARTITION__"


class PartitionedTable(SnapshotTable):
    """A versioned table with a folder for every value of ``label``, an SQL expression over ``columns``.

    The label is text or is taken as text; its values are folders, so there should be thousands of them, not millions.
    A hot label is spread over files by its size; it has no task of its own.
    """

    def __init__(self, spark: SparkSession, path: str, label: str, columns: list[str]):
        super().__init__(spark, path)
        self.label, self.columns = label, columns

    def _labelled(self, df: DataFrame) -> Column:
        return F.expr(self.label).cast("string")

    def _write(self, df: DataFrame, mark: str = "") -> list[str]:
        path = f"{self.path}/data/{mark}{uuid.uuid4().hex}"
        rows = df.withColumn(_PART, self._labelled(df)).hint("rebalance", _PART)
        rows.write.mode("errorifexists").partitionBy(_PART).parquet(path)
        root = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        found = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).listStatus(root)
        return sorted(f"{path}/{s.getPath().getName()}" for s in found if s.getPath().getName().startswith(f"{_PART}="))

    @staticmethod
    def label_of(path: str) -> str:
        """The partition that a folder or file belongs to."""
        return unquote(_FOLDER.search(path)[1])

    def partitions(self) -> dict[str, list[str]]:
        """Folders of the newest version by label."""
        entry, out = self._entry(), {}
        for path in entry["paths"] if entry else []:
            out.setdefault(self.label_of(path), []).append(path)
        return out

    def read_partitions(self, labels: list[str]) -> DataFrame:
        """The rows of some partitions; no other folder is opened or listed."""
        folders = self.partitions()
        paths = [p for x in labels for p in folders.get(x, [])]
        schema = self.schema()
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _labels(self, rows: DataFrame) -> list[str]:
        """The labels of rows; at most one row per partition reaches the driver, as the version's list of folders does."""
        found = rows.select(F.coalesce(self._labelled(rows), F.lit(NULL_LABEL)).alias(_PART)).distinct().collect()
        return sorted(r[_PART] for r in found)

    def _holding(self, rows: DataFrame) -> list[str]:
        """The partitions of this table that some of its rows are in, ``rows`` having their files as ``_file``."""
        label = F.regexp_extract("_file", rf"/{_PART}=([^/]*)", 1)
        # the folder's name escapes the label, and the file's address escapes the folder's name
        return sorted(unquote(unquote(r[0])) for r in rows.select(label.alias(_PART)).distinct().collect())

    def _with_file(self, columns: list[str]) -> DataFrame:
        return self.read().select(*(F.col(f"`{c}`") for c in columns), F.col("_metadata.file_path").alias("_file"))

    def change(self, touched: DataFrame | list[str], apply: Callable[[DataFrame], DataFrame], operation: str = "change",
               batch: str | None = None) -> int | None:
        """Replace the touched partitions by what ``apply`` makes of their rows; the next version keeps all other folders.

        ``touched`` is labels, or rows with the label's columns. Rows that ``apply`` moves to another partition are added to
        it without rewriting it. A ``batch`` seen before changes nothing.
        """
        if batch is not None and self.has_batch(batch):
            return None
        entry, labels = self._entry(), touched if isinstance(touched, list) else self._labels(touched)
        schema = self.schema()
        rows = tables.enforce_schema(apply(self.read_partitions(labels)), schema)
        written = self._write(rows)
        kept = [p for p in entry["paths"] if self.label_of(p) not in set(labels)]
        metrics = {"partitions_rewritten": len(set(labels)), "folders_kept": len(kept), "folders_written": len(written)}
        return self._record(operation, schema, [*kept, *written], metrics, batch, entry)

    def touched_by(self, source: DataFrame, on: list[str]) -> list[str]:
        """Partitions that may hold a row with a key of the source.

        Where the label is a function of the key, these are the labels of the source's rows. Otherwise the key columns of the table
        are scanned, and joined to the source's keys, for the partitions that hold one.
        """
        if set(self.columns) <= set(on):
            return self._labels(source)
        keys = source.select(*on).distinct()
        return self._holding(self._with_file(on).join(keys, on, "left_semi"))

    def merge(self, source: DataFrame, on: list[str], clauses: list[When], batch: str | None = None) -> int | None:
        """``tables.merge`` within the touched partitions. Clauses for rows absent from the source touch every partition."""
        if any(c.match == "not_matched_by_source" for c in clauses):
            labels = sorted(self.partitions())
        else:
            labels = self.touched_by(source, on)
        return self.change(labels, lambda rows: tables.merge(rows, source, on, clauses), "merge", batch)

    def update(self, predicate: str, values: dict[str, str]) -> int | None:
        """Set columns where the predicate is true; partitions without such a row stay as they are."""
        return self.change(self._meeting(predicate), lambda rows: tables.update(rows, predicate, values), "update")

    def delete(self, predicate: str) -> int | None:
        """Remove rows for which the predicate is true; partitions without such a row stay as they are."""
        return self.change(self._meeting(predicate), lambda rows: tables.delete(rows, predicate), "delete")

    def _meeting(self, predicate: str) -> list[str]:
        # the filter is pushed down, and only its columns are read
        return self._holding(self.read().where(holds(predicate)).select(F.col("_metadata.file_path").alias("_file")))

    def files(self, version: int | None = None) -> DataFrame:
        """(file, part): the data files of a version, and the partition of each as it stands in the file's address."""
        read = self.read(version).select(F.col("_metadata.file_path").alias("file")).distinct()
        return read.withColumn("part", F.regexp_extract("file", rf"/{_PART}=([^/]*)", 1))
