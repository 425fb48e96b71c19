"""Functions defined by users, in the three ways Spark offers, and their registration for SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# fixed values: reduction by customer segment
SEGMENT_DISCOUNT = {"BUILDING": 10, "MACHINERY": 5}


def discounted(price: Column, segment: Column) -> Column:
    """The built-in form, which Spark compiles; the others exist to show they agree."""
    percent = F.coalesce(F.create_map(*[F.lit(x) for pair in SEGMENT_DISCOUNT.items() for x in pair])[segment], F.lit(0))
    return price * (F.lit(100) - percent) / F.lit(100)


@F.udf(DoubleType())
def discounted_python(price, segment):
    if price is None:
        return None
    return price * (100 - SEGMENT_DISCOUNT.get(segment, 0)) / 100


@F.pandas_udf(DoubleType())
def discounted_pandas(price: pd.Series, segment: pd.Series) -> pd.Series:
    return price * (100 - segment.map(SEGMENT_DISCOUNT).fillna(0)) / 100


def register(spark: SparkSession) -> None:
    """``discounted_sql`` (inlined SQL), ``discounted_py`` and ``discounted_vec`` for use in SQL text."""
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SEGMENT_DISCOUNT.items())
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION discounted_sql(price DOUBLE, segment STRING) RETURNS DOUBLE
            RETURN price * (100 - CASE segment {cases} ELSE 0 END) / 100"""
    )
    spark.udf.register("discounted_py", discounted_python)
    spark.udf.register("discounted_vec", discounted_pandas)
