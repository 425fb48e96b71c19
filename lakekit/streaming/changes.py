"""Streams over versioned tables and folders: what to do with changes that are no appends, and where to start."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lakekit.operators.snapshots import SnapshotTable
from lakekit.session import small_rows
from lakekit.streaming.runs import batch_key, run_to_end

#: Operations that add rows and change none.
ADDING = ("append", "overwrite")


class SourceChanged(RuntimeError):
    """The source of a stream was updated, deleted from or rewritten, which a stream of its rows cannot tell."""


def _operations(table: SnapshotTable) -> DataFrame:
    """(folder, operation, version): the change that brought each data folder; the first write of a table counts as an append."""
    log = table._log().select("version", "operation", F.explode("paths").alias("path"))
    folder = F.regexp_extract("path", r"/data/([^/]+)", 1).alias("folder")
    first = log.groupBy(folder).agg(F.min(F.struct("version", "operation")).alias("at"))
    kind = F.when((F.col("at.operation") == "overwrite") & (F.col("at.version") > 0), "replace").otherwise(F.col("at.operation"))
    return first.select("folder", kind.alias("operation"), F.col("at.version").alias("version"))


def follow_table(table: SnapshotTable, checkpoint: str, apply: Callable[[DataFrame, str], None], *, skip_changes: bool = False, **options) -> StreamingQuery:
    """Process the rows of a table's new data folders once; ``apply`` gets each batch and its key, and must take a key once only.

    The data of a version that rewrites rows (update, merge, delete, a second overwrite, compaction) is not new rows. Such a version
    stops the stream with ``SourceChanged``, and every later run as well, until it is told to ``skip_changes``: then its
    data is left out and the stream goes on with the appends. A folder that no version names yet fails the batch, to be tried again.
    """
    schema = table.schema()
    stream = table.spark.readStream.schema(schema).options(recursiveFileLookup="true", **options).parquet(f"{table.path}/data")
    rows = stream.select("*", F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+)", 1).alias("_folder"))

    def step(batch: DataFrame, number: int) -> None:
        key = batch_key(batch, number)
        seen = batch.select(F.col("_folder").alias("folder")).distinct().join(_operations(table), "folder", "left")
        # a row per kind of change, not per folder
        kinds = {r["operation"]: r["version"] for r in seen.groupBy("operation").agg(F.min("version").alias("version")).collect()}
        if None in kinds:
            raise RuntimeError(f"{table.path} has data that no version names yet")
        changed = {k: v for k, v in kinds.items() if k not in ADDING}
        if changed and not skip_changes:
            raise SourceChanged(f"{table.path}: " + ", ".join(f"{k} in version {v}" for k, v in sorted(changed.items(), key=lambda x: x[1])))
        if changed:
            batch = batch.join(seen.where(F.col("operation").isin(*ADDING)).select(F.col("folder").alias("_folder")), "_folder", "left_semi")
        apply(batch.drop("_folder"), key)

    return run_to_end(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(step))


def stream_from_now_on(spark: SparkSession, path: str, schema: StructType | str, checkpoint: str, fmt: str = "parquet", archive: str | None = None,
                       **options) -> DataFrame:
    """Stream over the files that come after its first start; those already there are never opened.

    The newest time of the files present at the first start is kept beside the checkpoint, so that a restart has the same cut-off. It is
    compared with each file's own time, which Spark does while it plans the batch. ``archive`` moves files there once they
    are processed (with the batch after theirs), for folders that should not grow; it must lie outside ``path``.
    """
    place = f"{checkpoint}-start"
    try:
        start = spark.read.schema("modified STRING").json(place).first()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        start = None
    if start is None:
        from lakekit.sources.files import list_files

        newest = list_files(spark, path).agg(F.max("modificationTime").cast("string")).first()[0]
        small_rows(spark, [{"modified": newest or "1970-01-01 00:00:00"}], "modified STRING").write.json(place)
        start = spark.read.schema("modified STRING").json(place).first()
    if archive:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive}
    stream = spark.readStream.format(fmt).schema(schema).options(recursiveFileLookup="true", **options).load(path)
    return stream.where(F.col("_metadata.file_modification_time") > F.to_timestamp(F.lit(start["modified"])))
