"""User-defined functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.udfs import discounted, discounted_pandas, discounted_python, register
from lakekit.plans.registry import plan
from lakekit.session import Tables

_PRICE = """
SELECT c_custkey, round(c_acctbal * (100 - CASE c_mktsegment WHEN 'BUILDING' THEN 10 WHEN 'MACHINERY' THEN 5 ELSE 0 END) / 100, 6) AS price FROM customer
"""


def _rounded(t: Tables, value) -> DataFrame:
    return t.customer.select("c_custkey", F.round(value, 6).alias("price"))


@plan(_PRICE)
def u1_sql_function(t: Tables) -> DataFrame:
    register(t.spark)
    return t.sql("SELECT c_custkey, round(discounted_sql(c_acctbal, c_mktsegment), 6) AS price FROM {customer}")


@plan(_PRICE)
def u2_python_function(t: Tables) -> DataFrame:
    return _rounded(t, discounted_python("c_acctbal", "c_mktsegment"))


@plan(_PRICE)
def u3_pandas_function(t: Tables) -> DataFrame:
    return _rounded(t, discounted_pandas("c_acctbal", "c_mktsegment"))


@plan(_PRICE)
def u4_python_function_in_sql(t: Tables) -> DataFrame:
    register(t.spark)
    return t.sql("SELECT c_custkey, round(discounted_py(c_acctbal, c_mktsegment), 6) AS price FROM {customer}")


@plan("SELECT count(*) AS rows, count(*) AS agree FROM customer")
def u5_functions_agree(t: Tables) -> DataFrame:
    register(t.spark)
    c = t.customer.withColumns(
        {
            "a": discounted(F.col("c_acctbal"), F.col("c_mktsegment")),
            "b": discounted_python("c_acctbal", "c_mktsegment"),
            "c": F.expr("discounted_sql(c_acctbal, c_mktsegment)"),
            "d": F.expr("discounted_vec(c_acctbal, c_mktsegment)"),
        }
    )
    same = F.col("a").eqNullSafe(F.col("b")) & F.col("b").eqNullSafe(F.col("c")) & F.col("c").eqNullSafe(F.col("d"))
    return c.agg(F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("agree"))
