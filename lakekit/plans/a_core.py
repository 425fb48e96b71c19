"""Flagship query."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.windows import top_k
from lakekit.plans.registry import plan
from lakekit.session import Tables


@plan("""
WITH daily AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, n_name AS nation, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_orderstatus <> 'P' GROUP BY ALL)
SELECT day, nation, CAST(revenue AS DOUBLE) AS revenue,
       round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY day) AS DOUBLE), 6) AS share_of_day
FROM daily QUALIFY row_number() OVER (PARTITION BY day ORDER BY revenue DESC, nation) <= 3
""")
def a00_flagship_daily_revenue(t: Tables) -> DataFrame:
    daily = (
        t.orders.where("o_orderstatus <> 'P'")
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.to_date("o_orderdate").alias("day"), F.col("n_name").alias("nation"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    )
    # at most 25 nations a day are left, so whole days fit a window, and the ranking reuses its partitioning
    shared = daily.withColumn("day_total", F.sum("revenue").over(Window.partitionBy("day")))
    return top_k(shared, ["day"], ["-revenue", "nation"], 3).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        "nation",
        F.col("revenue").cast("double").alias("revenue"),
        F.round(F.col("revenue").cast("double") / F.col("day_total").cast("double"), 6).alias("share_of_day"),
    )
