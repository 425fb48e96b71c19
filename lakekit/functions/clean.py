"""Column expressions for cleaning messy text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from lakekit.operators.windows import exact_quantiles
from lakekit.session import stored


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def standardise(c: Column | str) -> Column:
    """Lower-case snake form of a label: white space, dashes and underscores around it go, inside they become one underscore."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(c)), r"^[\s_-]+|[\s_-]+$", ""), r"[\s_-]+", "_")


def code(c: Column | str) -> Column:
    """Upper-case, trimmed code."""
    return F.upper(F.trim(_col(c)))


def parse_amount(c: Column | str, type_: str = "decimal(10,2)") -> Column:
    """Number inside a text such as ``USD 12.50``; text without a readable number gives NULL."""
    number = F.regexp_extract(_col(c), r"^[^0-9+-]*([+-]?\d+(?:\.\d+)?)[^0-9]*$", 1)  # a sign counts only in front
    return F.nullif(number, F.lit("")).try_cast(type_)


def parse_ts(c: Column | str, *formats: str) -> Column:
    """Timestamp by the first format that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)) for f in formats])


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of rows and of NULLs, from a single pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    return counted.unpivot("_rows", df.columns, "column", "nulls").withColumnRenamed("_rows", "rows")


def profile(df: DataFrame, columns: list[str], rsd: float = 0.05) -> DataFrame:
    """Rows, NULLs, exact and approximate distinct values per column.

    Each column is laid out as (column, value) pairs once, so exact distinct counting is one shuffle of already
    combined pairs instead of one expansion per column.
    """
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("p")
    ).select("p.*")
    per_value = pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return per_value.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct"),
        F.approx_count_distinct("value", rsd).alias("approx_distinct"),
    )


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def describe(df: DataFrame, percents: tuple[int, ...] = (25, 50, 75)) -> DataFrame:
    """One row per column: count, min, max (as text), mean, stddev and exact percentiles of numeric columns, distinct values.

    All columns are laid out as (column, value, number) pairs and counted once, map-side, so the rest works on distinct values
    with their counts; percentiles come from ranks of counted values, sliced where a column has many, and no column is
    gathered. NULLs count in no figure, as usual. Columns are compared as their own types: text as text, numbers as numbers.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"),
                               (F.col(f"`{c}`").cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in df.columns])
    counted = df.select(F.explode(pairs).alias("p")).select("p.*").where("value IS NOT NULL").groupBy("column", "value", "number").agg(F.count("*").alias("n"))
    counted = stored(counted, "describe")
    n, x = F.col("n"), F.col("number")
    low = lambda f: F.when(F.max(x).isNotNull(), f("value", x)).otherwise({F.min_by: F.min, F.max_by: F.max}[f]("value"))
    mean = F.sum(x * n) / F.sum(n)
    facts = counted.groupBy("column").agg(
        F.sum("n").alias("count"), low(F.min_by).alias("min"), low(F.max_by).alias("max"), mean.alias("mean"), F.count("*").alias("distinct"))
    about = counted.where("number IS NOT NULL").join(facts.select("column", "mean"), "column")  # squares about the mean keep their digits
    spread = about.groupBy("column").agg(F.sqrt(F.sum(n * (x - F.col("mean")) ** 2) / F.nullif(F.sum(n) - 1, F.lit(0))).alias("stddev"))
    placed = exact_quantiles(counted.where("number IS NOT NULL").select("column", "number", "n"), ["column"], "number", {f"p{p}": p / 100 for p in percents}, counts="n")
    every = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column STRING")
    out = every.join(facts, "column", "left").join(spread, "column", "left").join(placed, "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).alias("count"), "min", "max", "mean", "stddev", *[f"p{p}" for p in percents],
                      F.coalesce("distinct", F.lit(0)).alias("distinct"))
