"""Window queries; slices keep a busy customer or user from landing in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.windows import (
    SAMPLED, latest_per_key, qualify, top_k, with_neighbours, with_ranks, with_running_sum,
)
from lakekit.plans.registry import plan
from lakekit.session import Tables

D = "decimal(18,2)"


@plan("""
SELECT event_id, row_number() OVER w AS rn, rank() OVER (PARTITION BY event_type ORDER BY v DESC) AS rk,
  dense_rank() OVER (PARTITION BY event_type ORDER BY v DESC) AS dr
FROM (SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS v FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY v DESC, event_id)
""")
def w1_ranking_with_ties(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "event_type", F.floor("value").cast("bigint").alias("v"))
    # numbered inside slices of equal size; ranks come from counted values
    numbered = with_ranks(rows, ["event_type"], ["-v", "event_id"], SAMPLED, row_number="rn")
    tied = with_ranks(numbered, ["event_type"], ["-v"], SAMPLED, rank="rk", dense_rank="dr")
    return tied.select("event_id", *[F.col(c).cast("bigint").alias(c) for c in ("rn", "rk", "dr")])


@plan("""
SELECT o_orderkey, coalesce(lag(o_orderkey) OVER w, -1) AS previous, coalesce(lead(o_orderkey) OVER w, -1) AS following,
  CAST(coalesce(date_diff('day', CAST(lag(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)), -1) AS BIGINT) AS days_since
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def w2_lag_lead(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    out = with_neighbours(
        rows, ["o_custkey"], ["o_orderdate", "o_orderkey"],
        previous={"previous": "o_orderkey", "previous_date": "o_orderdate"}, following={"following": "o_orderkey"},
        bucket=SAMPLED,
    )
    none = F.lit(-1)
    return out.select(
        "o_orderkey",
        F.coalesce("previous", none).alias("previous"),
        F.coalesce("following", none).alias("following"),
        F.coalesce(F.datediff("o_orderdate", "previous_date"), none).cast("bigint").alias("days_since"),
    )


@plan("""
SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total FROM orders
""")
def w3_running_total(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").cast(D).alias("price"))
    out = with_running_sum(
        rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"running_total": "price"}, SAMPLED
    )
    return out.select("o_orderkey", F.col("running_total").cast("double").alias("running_total"))


@plan("""
SELECT c_custkey, ntile(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS quartile,
  round(percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal), 8) AS pct FROM customer
""")
def w5_ntile_percent_rank(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    tiles = with_ranks(rows, ["c_mktsegment"], ["c_acctbal", "c_custkey"], SAMPLED, ntile=(4, "quartile"))
    out = with_ranks(tiles, ["c_mktsegment"], ["c_acctbal"], SAMPLED, percent_rank="pct")
    return out.select("c_custkey", F.col("quartile").cast("bigint").alias("quartile"), F.round("pct", 8).alias("pct"))


@plan("""
WITH g AS (SELECT n_name AS nation, strftime(o_orderdate, '%Y') AS order_year, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue, count(*) AS n
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT nation, order_year, CAST(revenue AS DOUBLE) AS revenue, rank() OVER (PARTITION BY order_year ORDER BY revenue DESC) AS by_sum,
  rank() OVER (PARTITION BY order_year ORDER BY n DESC) AS by_count FROM g
""")
def w6_rank_of_aggregate(t: Tables) -> DataFrame:
    groups = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"), F.date_format("o_orderdate", "yyyy").alias("order_year"))
        .agg(F.sum(F.col("o_totalprice").cast(D)).alias("revenue"), F.count(F.lit(1)).alias("n"))
    )
    # 25 nations a year are left, so the plain window is small
    year = Window.partitionBy("order_year")
    return groups.select(
        "nation", "order_year", F.col("revenue").cast("double").alias("revenue"),
        F.rank().over(year.orderBy(F.desc("revenue"))).cast("bigint").alias("by_sum"),
        F.rank().over(year.orderBy(F.desc("n"))).cast("bigint").alias("by_count"),
    )


@plan("""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def w7_qualify(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return qualify(t.orders, F.row_number().over(w), "_q = 1").select("o_custkey", "o_orderkey", "o_totalprice")


@plan("""
SELECT p_brand, p_partkey, p_retailprice FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 3
""")
def o2_top_k_per_group(t: Tables) -> DataFrame:
    return top_k(t.part, ["p_brand"], ["-p_retailprice", "p_partkey"], 3).select("p_brand", "p_partkey", "p_retailprice")


@plan("""
SELECT p_type, p_partkey, CAST(p_size AS BIGINT) AS p_size FROM part QUALIFY dense_rank() OVER (PARTITION BY p_type ORDER BY p_size DESC) <= 2
""")
def o2_top_k_with_ties(t: Tables) -> DataFrame:
    return top_k(t.part, ["p_type"], ["-p_size"], 2, ties="dense_rank").select(
        "p_type", "p_partkey", F.col("p_size").cast("bigint").alias("p_size")
    )


@plan("""
SELECT event_type, user_id, n FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY n DESC, user_id) = 1
""")
def o3_top_1_tie_break(t: Tables) -> DataFrame:
    counts = t.events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    # the smaller user wins a tie, hence the negated key
    best = latest_per_key(counts.withColumn("_u", -F.col("user_id")), ["event_type"], ["n", "_u"])
    return best.select("event_type", "user_id", "n")
