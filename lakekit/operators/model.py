"""Dimensional modelling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.operators.joins import unique_on


def calendar(spark: SparkSession, first: str, last: str, weekend: tuple[int, ...] = (1, 7)) -> DataFrame:
    """One row per day. ``weekend`` lists day-of-week numbers (1 = Sunday), as weekends differ by country."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("day"))
    return days.select(
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        "day",
        F.year("day").alias("year"),
        F.month("day").alias("month"),
        F.date_format("day", "EEEE").alias("day_name"),
        F.dayofweek("day").isin(*weekend).alias("is_weekend"),
    )


def band(c: Column | str, edges: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper edge that the value stays below; NULL stays NULL."""
    value = F.col(c) if isinstance(c, str) else c
    out = F.lit(otherwise)
    for edge, label in reversed(edges):
        out = F.when(value < edge, F.lit(label)).otherwise(out)
    return F.when(value.isNull(), F.lit(None)).otherwise(out)


def scd2_start(df: DataFrame, ts: Column) -> DataFrame:
    """First load of a versioned dimension."""
    return df.withColumns(
        {"valid_from": ts, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )


def scd2_apply(dim: DataFrame, updates: DataFrame, keys: list[str], track: list[str], ts: str) -> DataFrame:
    """Close changed current versions and open new ones; unchanged rows are ignored, new keys are added.

    ``updates`` has one row per key, the dimension's attributes and the change time ``ts``. The comparison is NULL-safe. An
    update older than the current version fails the query: out-of-order feeds belong to ``apply_changes_scd2``.
    """
    attributes = [c for c in dim.columns if c not in ("valid_from", "valid_to", "is_current")]
    u = unique_on(updates, keys).select(
        F.struct(*attributes).alias("u"), F.col(ts).cast("timestamp").alias("_ts"),
        *[F.col(k).alias(f"_u_{k}") for k in keys],
    )
    cond = F.col("is_current")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_u_{k}"))
    same = F.lit(True)
    for c in track:
        same = same & F.col(c).eqNullSafe(F.col("u").getField(c))
    changed = F.col("u").isNotNull() & ~same

    def version(source: Column | None, start: Column, end: Column, current: bool) -> Column:
        values = [(F.col(c) if source is None else source.getField(c)).alias(c) for c in attributes]
        return F.struct(*values, start.alias("valid_from"), end.alias("valid_to"), F.lit(current).alias("is_current"))

    open_end = F.lit(None).cast("timestamp")
    late = F.raise_error(F.concat(F.lit("update older than the current version: "), F.to_json("u"))).cast("timestamp")
    at = F.when(F.col("_ts") > F.col("valid_from"), F.col("_ts")).otherwise(late)
    keep = F.struct(*[F.col(c) for c in (*attributes, "valid_from", "valid_to", "is_current")])
    pair = F.array(version(None, F.col("valid_from"), at, False), version(F.col("u"), at, open_end, True))
    out = dim.join(u, cond, "left").select(F.explode(F.when(changed, pair).otherwise(F.array(keep))).alias("v")).select("v.*")
    known = dim.where("is_current").select(*keys)
    added = updates.join(known, keys, "left_anti").select(
        *attributes, F.col(ts).cast("timestamp").alias("valid_from"), open_end.alias("valid_to"), F.lit(True).alias("is_current")
    )
    return out.unionByName(added)
