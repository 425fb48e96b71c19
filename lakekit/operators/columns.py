"""Derived columns that a table computes itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.windows import with_ranks


def with_generated(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """Add columns computed from others; a value already supplied for one has to agree with its expression."""
    for name, text in expressions.items():
        value = F.expr(text)
        if name in df.columns:
            agree = F.col(name).eqNullSafe(value)
            message = F.lit(f"value of generated column {name} differs from {text}")
            df = df.where(F.when(agree, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        else:
            df = df.withColumn(name, value)
    return df


def surrogate_key(df: DataFrame, order: list[str], bucket: Column, name: str, start: int = 0) -> DataFrame:
    """Unique increasing keys ``start + 1, start + 2, …`` in the given order.

    Rows are numbered inside the slices that ``bucket`` (never decreasing along ``order``) makes; only one count per
    slice is ordered globally. Use a bucket with a bounded number of values, none of them with most of the rows.
    """
    if name in df.columns:
        raise ValueError(f"values for {name} are assigned here and may not be supplied")
    out = with_ranks(df, [], order, bucket, row_number=name)
    return out.withColumn(name, (F.col(name) + F.lit(start)).cast("bigint"))


def next_keys(df: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Unique, not consecutive keys above ``start`` without any shuffle."""
    if name in df.columns:
        raise ValueError(f"values for {name} are assigned here and may not be supplied")
    return df.withColumn(name, F.monotonically_increasing_id() + F.lit(start + 1))
