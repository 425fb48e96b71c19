"""Comparing two frames as multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``side`` (left or right) and the surplus ``copies``.

    One shuffle of both inputs: copies are counted with opposite signs and summed, which also handles NULLs.
    """
    cols = left.columns
    if sorted(cols) != sorted(right.columns):
        raise ValueError(f"columns differ: {sorted(cols)} and {sorted(right.columns)}")
    signed = left.withColumn("_d", F.lit(1)).unionByName(right.withColumn("_d", F.lit(-1)))
    counts = signed.groupBy(*cols).agg(F.sum("_d").alias("_d")).where("_d <> 0")
    return counts.select(
        F.when(F.col("_d") > 0, "left").otherwise("right").alias("side"), *cols, F.abs("_d").alias("copies")
    )


def assert_same(left: DataFrame, right: DataFrame) -> None:
    """Raise with a few differing rows unless both frames hold the same rows the same number of times."""
    sample = diff(left, right).limit(5).collect()
    if sample:
        raise AssertionError(f"frames differ, e.g. {sample}")
