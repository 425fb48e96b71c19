"""Running streams to completion and sinks that survive replays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakekit.operators.partitions import PartitionedTable
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import When, merge


def run_to_end(writer, timeout: int | None = None) -> StreamingQuery:
    """Start with ``availableNow``, wait until all present input is processed, raise what made it fail."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination(timeout) if timeout else query.awaitTermination()
    return query


def rows_read(query: StreamingQuery) -> int:
    return sum(p["numInputRows"] for p in query.recentProgress)


def batches_with_data(query: StreamingQuery) -> int:
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)


def append_to(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None) -> StreamingQuery:
    """Append a stream to a Parquet folder; Spark's file sink makes each batch appear once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run_to_end(writer.option("path", path))


def batch_key(batch: DataFrame, number: int) -> str:
    """Name of a micro-batch that only its replay has too: the query's id, which its checkpoint keeps and a new checkpoint
    does not have, and the batch number. For use inside ``foreachBatch``."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("a batch key exists only inside foreachBatch")
    return f"{query} {number}"


def _each(df: DataFrame, mode: str, checkpoint: str, table: SnapshotTable, apply: Callable[[DataFrame, str], None]):
    def step(batch: DataFrame, number: int) -> None:
        key = batch_key(batch, number)
        if not table.has_batch(key):
            apply(batch, key)

    return run_to_end(df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(step))


def replace_table(df: DataFrame, table: SnapshotTable, checkpoint: str) -> StreamingQuery:
    """Complete-mode aggregation: every batch publishes the whole result as the table's next version."""
    return _each(df, "complete", checkpoint, table, lambda b, name: table.publish(b, "complete", batch=name))


def upsert_table(
    df: DataFrame, table: SnapshotTable, checkpoint: str, keys: list[str], clauses: list[When],
    prepare: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append",
) -> StreamingQuery:
    """Merge every batch into the table, each exactly once. ``prepare`` makes a batch unique per key (totals, last
    values) before the merge. In a ``PartitionedTable`` only the partitions that a batch touches are read and rewritten."""

    def apply(batch: DataFrame, name: str) -> None:
        source = prepare(batch) if prepare else batch
        if isinstance(table, PartitionedTable) and table.exists():
            table.merge(source, keys, clauses, batch=name)
        elif table.exists():
            table.publish(merge(table.read(), source, keys, clauses), "merge", batch=name)
        else:
            table.publish(source, "merge", batch=name)

    return _each(df, mode, checkpoint, table, apply)


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """Stream over the files of a folder with a fixed schema."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
