"""Aggregation queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.aggregates import distinct_list, salted_aggregate, share_of_total
from lakekit.operators.windows import exact_quantiles, with_group_total
from lakekit.plans.joins import skewed_events
from lakekit.plans.registry import plan
from lakekit.session import Tables

D = "decimal(18,2)"


@plan("""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(CASE WHEN l_discount > 0 THEN l_discount END) AS discounted,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS average,
  min(l_quantity) AS least, max(l_quantity) AS most FROM lineitem GROUP BY ALL
""")
def a1_group_aggregates(t: Tables) -> DataFrame:
    total = F.sum(F.col("l_extendedprice").cast(D)).cast("double")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("l_discount") > 0, F.col("l_discount"))).alias("discounted"),
        total.alias("total"),
        F.round(total / F.count(F.lit(1)), 2).alias("average"),
        F.min("l_quantity").alias("least"),
        F.max("l_quantity").alias("most"),
    )


@plan("""
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, true AS estimate_within_15_percent
FROM lineitem GROUP BY 1
""")
def a2_distinct_exact_and_approximate(t: Tables) -> DataFrame:
    out = t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.approx_count_distinct("l_partkey", 0.05).alias("estimate"),
    )
    close = F.abs(F.col("estimate") - F.col("parts")) <= 0.15 * F.col("parts")
    return out.withColumn("estimate_within_15_percent", close).drop("estimate")


@plan("""
SELECT o_orderstatus, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, count(*) FILTER (WHERE o_totalprice > 400000) AS large,
  CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS low_total
FROM orders GROUP BY 1
""")
def a3_conditional_aggregates(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT o_orderstatus, count_if(o_orderpriority = '1-URGENT') AS urgent,
               count(*) FILTER (WHERE o_totalprice > 400000) AS large,
               CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS low_total
        FROM {orders} GROUP BY 1
    """)


@plan("""
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) >= 5 AND max(o_totalprice) > 1000
""")
def a4_having_group_by_all(t: Tables) -> DataFrame:
    return t.sql("""
        SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM {orders}
        GROUP BY ALL HAVING count(*) >= 5 AND max(o_totalprice) > 1000
    """)


def _subtotals(grouping: str) -> str:
    return f"""
SELECT coalesce(r_name, 'all') AS region, coalesce(c_mktsegment, 'all') AS segment, count(*) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance, CAST(grouping(r_name) * 2 + grouping(c_mktsegment) AS BIGINT) AS level
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY {grouping}
"""


def _located_customers(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _subtotal_result(grouped) -> DataFrame:
    out = grouped.agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("c_acctbal").cast(D)).cast("double").alias("balance"),
        F.grouping_id().cast("bigint").alias("level"),
    )
    return out.select(
        F.coalesce("r_name", F.lit("all")).alias("region"),
        F.coalesce("c_mktsegment", F.lit("all")).alias("segment"),
        "customers", "balance", "level",
    )


@plan(_subtotals("ROLLUP (r_name, c_mktsegment)"))
def a5_rollup(t: Tables) -> DataFrame:
    return _subtotal_result(_located_customers(t).rollup("r_name", "c_mktsegment"))


@plan(_subtotals("CUBE (r_name, c_mktsegment)"))
def a5_cube(t: Tables) -> DataFrame:
    return _subtotal_result(_located_customers(t).cube("r_name", "c_mktsegment"))


@plan(_subtotals("GROUPING SETS ((r_name), (c_mktsegment), ())"))
def a5_grouping_sets(t: Tables) -> DataFrame:
    c = _located_customers(t)
    return _subtotal_result(c.groupingSets([[F.col("r_name")], [F.col("c_mktsegment")], []], "r_name", "c_mktsegment"))


@plan("""
SELECT year(o_orderdate) AS order_year, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'F'), 0) AS DOUBLE) AS f_total,
  CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'O'), 0) AS DOUBLE) AS o_total,
  CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderstatus = 'P'), 0) AS DOUBLE) AS p_total FROM orders GROUP BY 1
""")
def a6_pivot(t: Tables) -> DataFrame:
    # naming the values saves the extra pass that would look for them
    wide = t.orders.groupBy(F.year("o_orderdate").cast("bigint").alias("order_year")).pivot(
        "o_orderstatus", ["F", "O", "P"]
    ).agg(F.sum(F.col("o_totalprice").cast(D)))
    return wide.select(
        "order_year",
        *[F.coalesce(F.col(s), F.lit(0)).cast("double").alias(f"{s.lower()}_total") for s in ("F", "O", "P")],
    )


@plan("""
SELECT l_returnflag, 'discount' AS measure, CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'tax', CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem GROUP BY 1
UNION ALL SELECT l_returnflag, 'quantity', CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) FROM lineitem GROUP BY 1
""")
def a7_unpivot(t: Tables) -> DataFrame:
    wide = t.lineitem.groupBy("l_returnflag").agg(
        *[F.sum(F.col(f"l_{m}").cast(D)).cast("double").alias(m) for m in ("discount", "tax", "quantity")]
    )
    return wide.unpivot("l_returnflag", ["discount", "tax", "quantity"], "measure", "total")


@plan("""
SELECT user_id, list_sort(list(DISTINCT event_type)).array_to_string(',') AS types, len(list(DISTINCT event_type)) AS n_types FROM events GROUP BY 1
""")
def a8_collect_distinct(t: Tables) -> DataFrame:
    return distinct_list(t.events, ["user_id"], F.col("event_type"), "types").select(
        "user_id", F.array_join("types", ",").alias("types"), F.size("types").cast("bigint").alias("n_types")
    )


@plan("""
SELECT event_type, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.9), 4) AS p90 FROM events GROUP BY 1
""")
def a9_exact_percentiles(t: Tables) -> DataFrame:
    """Exact quantiles from counted values, sliced where a type has many different ones."""
    out = exact_quantiles(t.events, ["event_type"], "value", {"median": 0.5, "p90": 0.9})
    return out.select("event_type", F.round("median", 4).alias("median"), F.round("p90", 4).alias("p90"))


@plan("""
SELECT strftime(ts, '%Y-%m-%d') AS day, round(quantile_cont(value, 0.5) FILTER (WHERE event_type = 'click'), 4) AS click_median
FROM events GROUP BY 1
""")
def a9_filtered_median(t: Tables) -> DataFrame:
    clicks = t.events.where("event_type = 'click'").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    medians = exact_quantiles(clicks, ["day"], "value", {"click_median": 0.5})
    days = t.events.select(F.date_format("ts", "yyyy-MM-dd").alias("day")).distinct()
    return days.join(medians, "day", "left").withColumn("click_median", F.round("click_median", 4))


@plan("""
SELECT o_custkey, max_by(o_orderkey, (o_totalprice, o_orderkey)) AS biggest_order,
  coalesce(max(o_orderkey) FILTER (WHERE o_orderstatus = 'P'), -1) AS last_pending FROM orders GROUP BY 1
""")
def a10_max_by(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("biggest_order"),
        F.coalesce(F.max(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))), F.lit(-1)).alias("last_pending"),
    )


@plan("""
SELECT o_orderpriority, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1
""")
def a11_share_of_total(t: Tables) -> DataFrame:
    return share_of_total(t.orders, ["o_orderpriority"], "n", "share")


@plan("""
SELECT CASE WHEN event_id % 10 < 3 THEN 0 ELSE user_id END AS user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total,
  count(DISTINCT event_type) AS types, count(DISTINCT props) AS payloads FROM events GROUP BY 1
""")
def a12_salted_aggregate(t: Tables) -> DataFrame:
    rows = skewed_events(t).withColumn("value", F.col("value").cast(D))
    out = salted_aggregate(
        rows, ["user_id"], count="n", sums={"total": "value"},
        distinct={"types": "event_type", "payloads": "props"}, salt_by=["event_id"],
    )
    return out.withColumn("total", F.col("total").cast("double"))


@plan("""
SELECT r_name AS region, p_type, strftime(l_shipdate, '%Y') AS ship_year, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY ALL
""")
def a13_star_aggregate(t: Tables) -> DataFrame:
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select("s_suppkey", "r_name")
    return (
        t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("r_name").alias("region"), "p_type", F.year("l_shipdate").alias("ship_year"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
        .withColumn("ship_year", F.col("ship_year").cast("string"))
    )


@plan("""
SELECT c_mktsegment AS segment, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS average_order_value,
  round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS completion_pct,
  round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT o_custkey), 0), 4) AS orders_per_customer
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def a14_ratios(t: Tables) -> DataFrame:
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("o_orderstatus") == "F").alias("done"),
        F.sum(F.col("o_totalprice").cast(D)).alias("total"),
    )
    joined = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    n = F.sum("n")
    return joined.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.round(F.sum("total").cast("double") / n, 2).alias("average_order_value"),
        F.round(F.lit(100.0) * F.sum("done") / n, 4).alias("completion_pct"),
        F.round(F.try_divide(n.cast("double"), F.count(F.lit(1))), 4).alias("orders_per_customer"),
    )


# kept next to the aggregates: share of a group through pre-aggregation instead of a whole-partition window
@plan("""
SELECT o_orderkey, o_custkey, round(o_totalprice / CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey) AS DOUBLE), 8) AS share
FROM orders
""")
def w4_share_of_group(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    out = with_group_total(rows, ["o_custkey"], {"total": F.sum(F.col("o_totalprice").cast(D))})
    return out.select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") / F.col("total").cast("double"), 8).alias("share")
    )
