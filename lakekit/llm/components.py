"""Connected components of a link table, with alternating star contractions.

Every round replaces links by links to the smallest neighbour, first towards larger nodes, then towards smaller ones, until
nothing changes; chains shrink by a constant factor a round. The smallest neighbour is an aggregate (combined before the
shuffle) joined back, so a node with very many links is never gathered in one task. Each round is written to the shared folder.
Before a round each task turns the links that it reads, so many at a time, into a forest with the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.hamming import forest
from lakekit.session import drop_stored, settings, stored

#: Links that a task makes a forest of at a time, and links for each shuffle partition, of which there are no more than the session has.
HELD, FULL = 1 << 18, 1 << 15


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a > b) of forests with the components of the links that a task reads."""
    held_a, held_b, size = [], [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(np.concatenate(held_a), np.concatenate(held_b))], names=["a", "b"])

    for batch in batches:
        held_a.append(batch.column("a").to_numpy(zero_copy_only=False))
        held_b.append(batch.column("b").to_numpy(zero_copy_only=False))
        size += batch.num_rows
        if size >= HELD:
            yield out()
            held_a, held_b, size = [], [], 0
    if size:
        yield out()


def _toward_smallest(links: DataFrame, larger: bool) -> DataFrame:
    """Links (b, m) of every node's neighbours to the node's smallest neighbour m; ``links`` has a > b."""
    if larger:
        near = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = near.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node that it reaches.

    Links may repeat, point either way, and join a node to itself (which says nothing); links with a null end are ignored.
    No links give no rows: nodes without links are not listed.
    """
    x, y = F.col(a), F.col(b)
    spark = links.sparkSession
    now = stored(links.where(x != y).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct(), "links")
    state = F.struct(F.count("*"), F.expr("sum(CAST(xxhash64(a, b) AS DECIMAL(38, 0)))"))
    before = now.select(state).first()[0]
    whole = now.schema["a"].dataType.simpleString() == "bigint"
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while before[0]:
        with settings(spark, spark__sql__shuffle__partitions=str(min(most, before[0] // FULL + 1))):
            fewer = now.mapInArrow(_forests, "a long, b long") if whole else now
            past, now = now, stored(_toward_smallest(_toward_smallest(fewer, larger=True), larger=False), "links")
        drop_stored(past)
        after = now.select(state).first()[0]
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
