"""Aggregations that stay small per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def salted_aggregate(
    df: DataFrame,
    keys: list[str],
    *,
    count: str | None = None,
    sums: dict[str, str] | None = None,
    distinct: dict[str, str] | None = None,
    n: int = 16,
    salt_by: list[str] | None = None,
) -> DataFrame:
    """Group in two stages, first per key and salt, then per key.

    Distinct counts are kept exact by making ``(key, value)`` pairs unique before counting, which spreads a hot key
    over its values and holds no set in memory. ``sums`` and ``distinct`` map new names to columns.
    """
    sums, distinct = sums or {}, distinct or {}
    salt = F.pmod(F.xxhash64(*(salt_by or df.columns)), F.lit(n))
    first = [F.count(F.lit(1)).alias("_n")] + [F.sum(c).alias(name) for name, c in sums.items()]
    partial = df.withColumn("_salt", salt).groupBy(*keys, "_salt").agg(*first)
    second = ([F.sum("_n").alias(count)] if count else []) + [F.sum(name).alias(name) for name in sums]
    out = partial.groupBy(*keys).agg(*(second or [F.sum("_n").alias("_n")]))
    if not second:
        out = out.drop("_n")
    for name, c in distinct.items():
        pairs = df.select(*keys, c).distinct()
        counts = pairs.groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys]).agg(F.count(c).alias(name))
        cond = None
        for k in keys:
            same = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
            cond = same if cond is None else cond & same
        out = out.join(counts, cond, "left").drop(*[f"_r_{k}" for k in keys])
    return out


def share_of_total(df: DataFrame, keys: list[str], count: str, share: str, scale: int = 6) -> DataFrame:
    """Rows per key and their share of all rows; the total is a scalar subquery, not a one-task window."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))
    return counts.withColumn(share, F.round(F.col(count) / total, scale))


def distinct_list(df: DataFrame, keys: list[str], value: Column, name: str) -> DataFrame:
    """Sorted distinct values per key. Values are made unique before they are collected, so memory follows the number
    of different values of a key, not its number of rows: meant for values from a limited domain."""
    pairs = df.select(*keys, value.alias(name)).where(F.col(name).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.sort_array(F.collect_list(name)).alias(name))
