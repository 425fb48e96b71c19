"""Served results: views, stored aggregates, metric views, marts and alerts."""

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakekit.operators.quality import Expectation, apply_expectations, expect_all
from lakekit.operators.serving import MaterialisedAggregate, MetricView, StoredCube, alert, publish_kpis
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.windows import top_k, with_ranks
from lakekit.plans.registry import plan
from lakekit.session import Tables, work_path
from lakekit.streaming.runs import append_to, file_stream

D = "decimal(18,2)"


def _revenue(c: str = "o_totalprice"):
    return F.sum(F.col(c).cast(D))


@plan("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def v1_views(t: Tables) -> DataFrame:
    """A temporary view on a global one; both are recomputed when read."""
    name = f"lakekit_v1_{uuid.uuid4().hex[:8]}"
    t.orders.createOrReplaceGlobalTempView(name)
    t.spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM global_temp.{name} GROUP BY 1").createOrReplaceTempView(name)
    return t.spark.table(name)


_MV = "SELECT '{}' AS state, o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders WHERE {} GROUP BY ALL"


@plan(" UNION ALL ".join([
    _MV.format("first", "o_orderkey % 5 <> 0"), _MV.format("stale", "o_orderkey % 5 <> 0"), _MV.format("refreshed", "true"),
    _MV.format("incremental", "NOT (o_orderstatus = 'P' AND o_orderkey % 3 = 0)"),
]))
def v2_materialised_aggregate(t: Tables) -> DataFrame:
    """Stored, stale after new rows, refreshed in full, then refreshed for the touched groups only."""

    def query(orders: DataFrame) -> DataFrame:
        return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), _revenue().alias("total"))

    view = MaterialisedAggregate(SnapshotTable(t.spark, work_path(t.spark, "mv")), query, {"o_orderstatus": "o_orderstatus"})
    states = {}
    view.refresh(t.orders.where("o_orderkey % 5 <> 0"))
    states["first"] = states["stale"] = view.read()
    view.refresh(t.orders)
    states["refreshed"] = view.read()
    gone = "o_orderstatus = 'P' AND o_orderkey % 3 = 0"
    view.refresh_touched(t.orders.where(f"NOT ({gone})"), t.orders.where(gone))
    states["incremental"] = view.read()
    out = None
    for state, df in states.items():
        part = df.select(F.lit(state).alias("state"), "o_orderstatus", "n", F.col("total").cast("double").alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT o_orderkey, CAST(o_orderkey % 2 + 1 AS BIGINT) AS refreshed_by FROM orders WHERE o_totalprice > 1000")
def v3_incremental_table(t: Tables) -> DataFrame:
    """Each refresh processes only rows that arrived since the last one."""
    base = work_path(t.spark, "incremental")
    for refresh in (1, 2):
        t.orders.where(f"o_orderkey % 2 = {refresh - 1}").select("o_orderkey", "o_totalprice").write.parquet(f"{base}/in/{refresh}")
        rows = file_stream(t.spark, f"{base}/in", "o_orderkey BIGINT, o_totalprice DOUBLE", recursiveFileLookup="true")
        append_to(rows.where("o_totalprice > 1000").withColumn("refreshed_by", F.lit(refresh).cast("bigint")), f"{base}/out", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/out").select("o_orderkey", "refreshed_by")


@plan("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, n_name AS nation, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_totalprice > 20000 GROUP BY ALL
""")
def v4_bronze_silver_gold(t: Tables) -> DataFrame:
    """Bronze stream with re-sent rows, silver with expectations, gold from distinct silver rows."""
    base = work_path(t.spark, "layers")
    columns = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP, o_totalprice DOUBLE"
    rows = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_totalprice")
    rows.unionAll(rows.where("o_orderkey % 6 = 0")).write.json(f"{base}/landing/1")
    append_to(file_stream(t.spark, f"{base}/landing", columns, "json", recursiveFileLookup="true"), f"{base}/bronze", f"{base}/c-bronze")
    checks = [*expect_all({"has_key": "o_orderkey IS NOT NULL", "known_date": "o_orderdate >= timestamp'1990-01-01'"}, "fail"),
              Expectation("worth_it", "o_totalprice > 20000", "drop"), Expectation("has_customer", "o_custkey IS NOT NULL", "warn")]
    append_to(apply_expectations(file_stream(t.spark, f"{base}/bronze", columns), checks), f"{base}/silver", f"{base}/c-silver")
    silver = t.spark.read.schema(columns).parquet(f"{base}/silver").distinct()
    return (
        silver.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("n_name").alias("nation"))
        .agg(F.count(F.lit(1)).alias("orders"), _revenue().cast("double").alias("revenue"))
    )


_METRICS = """
SELECT '{grain}' AS grain, {key} AS "key", count(*) AS orders, count(DISTINCT o_custkey) AS customers, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS average_value
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY ALL
"""


@plan(" UNION ALL ".join([
    _METRICS.format(grain="year", key="strftime(o_orderdate, '%Y')"), _METRICS.format(grain="status", key="o_orderstatus"), _METRICS.format(grain="all", key="'all'"),
]))
def v5_metric_view(t: Tables) -> DataFrame:
    """The same measures at three grains; customers are counted from the source each time, never summed."""
    view = MetricView(
        t.orders,
        {"year": "date_format(o_orderdate, 'yyyy')", "status": "o_orderstatus", "everything": "'all'"},
        {"orders": "count(*)", "customers": "count(DISTINCT o_custkey)",
         "average_value": "round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2)"},
        where="o_orderdate >= timestamp_ntz'1996-01-01'",
    )
    out = None
    for grain, by in (("year", "year"), ("status", "status"), ("all", "everything")):
        part = view.query([by]).select(F.lit(grain).alias("grain"), F.col(by).alias("key"), "orders", "customers", "average_value")
        out = part if out is None else out.unionByName(part)
    return out


_DISTINCT = """
SELECT '{grain}' AS grain, {key} AS "key", count(*) AS orders, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(0 AS BIGINT) AS sketch_off_by_tenths FROM orders GROUP BY ALL
"""


@plan(" UNION ALL ".join([
    _DISTINCT.format(grain="month", key="strftime(o_orderdate, '%Y-%m')"), _DISTINCT.format(grain="year", key="strftime(o_orderdate, '%Y')"),
    _DISTINCT.format(grain="status", key="o_orderstatus"), _DISTINCT.format(grain="all", key="'all'"),
]))
def v5_distinct_counts_from_stored(t: Tables) -> DataFrame:
    """Customers at four grains from a stored aggregate by month and status, which came in two batches: exact from stored pairs, and by sketches
    within a tenth. The orders are not read again."""
    rows = t.orders.withColumns({"month": F.date_format("o_orderdate", "yyyy-MM"), "year": F.date_format("o_orderdate", "yyyy"), "everything": F.lit("all")})
    cube = StoredCube(t.spark, work_path(t.spark, "cube"), ["month", "year", "o_orderstatus", "everything"], sums={"orders": "1L", "revenue": "CAST(o_totalprice AS DECIMAL(18,2))"},
                      distinct={"customers": "o_custkey"})
    for half in (0, 1):
        cube.add(rows.where(F.col("o_orderkey") % 2 == half))
    out = None
    for grain, by in (("month", "month"), ("year", "year"), ("status", "o_orderstatus"), ("all", "everything")):
        near = cube.query([by], exact=False).select(by, F.col("customers").alias("near"))
        part = cube.query([by]).join(near, by).select(
            F.lit(grain).alias("grain"), F.col(by).alias("key"), "orders", "customers", F.col("revenue").cast("double").alias("revenue"),
            F.floor(F.abs(F.col("near") - F.col("customers")) / F.col("customers") * 10).alias("sketch_off_by_tenths"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT c_mktsegment AS segment, count(*) AS orders FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE n_name = 'NATION_3' AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31' GROUP BY 1
""")
def v6_parameterised_query(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT c_mktsegment AS segment, count(*) AS orders FROM {orders} JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey
           WHERE n_name = :nation AND o_orderdate BETWEEN to_timestamp_ntz(:first) AND to_timestamp_ntz(:last) GROUP BY 1""",
        args={"nation": "NATION_3", "first": "1996-01-01", "last": "1998-12-31"}, orders=t.orders, customer=t.customer, nation=t.nation,
    )


@plan("""
WITH v AS (SELECT CAST(100 AS DOUBLE) * count(*) FILTER (WHERE o_orderstatus = 'P') / count(*) AS value FROM orders)
SELECT round(value, 6) AS value, '>' AS operator, CAST(30 AS DOUBLE) AS threshold, CASE WHEN value > 30 THEN 'TRIGGERED' ELSE 'OK' END AS status FROM v
""")
def v7_alert(t: Tables) -> DataFrame:
    pending = t.orders.agg((F.lit(100.0) * F.count_if(F.col("o_orderstatus") == "P") / F.count(F.lit(1))).alias("value"))
    return alert(pending, ">", 30).withColumn("value", F.round("value", 6))


@plan("""
WITH m AS (SELECT strftime(l_shipdate, '%Y-%m') AS month, p_type AS category, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT month, category, CAST(revenue AS DOUBLE) AS revenue, round(CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY month) AS DOUBLE), 8) AS share FROM m
""")
def v8_monthly_share_mart(t: Tables) -> DataFrame:
    monthly = (
        t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
        .groupBy(F.trunc("l_shipdate", "month").alias("month"), F.col("p_type").alias("category"))
        .agg(_revenue("l_extendedprice").alias("revenue"))
        .withColumn("month", F.date_format("month", "yyyy-MM"))
    )
    # a month has one row per category left
    share = F.col("revenue").cast("double") / F.sum("revenue").over(Window.partitionBy("month")).cast("double")
    return monthly.select("month", "category", F.col("revenue").cast("double").alias("revenue"), F.round(share, 8).alias("share"))


@plan("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, n_name AS nation, p_type AS category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL
""")
def v8_daily_mart(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("p_partkey") == F.col("l_partkey"))
        .join(orders, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"))
        .groupBy(F.to_date("o_orderdate").alias("day"), F.col("n_name").alias("nation"), F.col("p_type").alias("category"))
        .agg(_revenue("l_extendedprice").cast("double").alias("revenue"), F.sum(F.col("l_quantity").cast("bigint")).alias("units"))
        .withColumn("day", F.date_format("day", "yyyy-MM-dd"))
    )


@plan("""
SELECT p_partkey, p_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, p_partkey LIMIT 10
""")
def v8_top_products(t: Tables) -> DataFrame:
    best = t.lineitem.groupBy("l_partkey").agg(_revenue("l_extendedprice").alias("r")).orderBy(F.desc("r"), "l_partkey").limit(10)
    return best.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select("p_partkey", "p_name", F.col("r").cast("double").alias("revenue"))


@plan("""
WITH g AS (SELECT p_brand, p_partkey, count(*) AS lines, count(*) FILTER (WHERE l_discount > 0) AS with_coupon, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
SELECT p_brand, p_partkey, lines, with_coupon, round(100.0 * with_coupon / lines, 4) AS coupon_pct, rank() OVER (PARTITION BY p_brand ORDER BY revenue DESC) AS place FROM g QUALIFY place <= 3
""")
def v9_leaderboard_and_coupons(t: Tables) -> DataFrame:
    per_part = t.lineitem.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_discount") > 0).alias("with_coupon"), _revenue("l_extendedprice").alias("revenue")
    )
    rows = per_part.join(t.part.select("p_partkey", "p_brand"), F.col("p_partkey") == F.col("l_partkey"))
    best = top_k(rows, ["p_brand"], ["-revenue"], 3, ties="rank")
    ranked = with_ranks(best, ["p_brand"], ["-revenue"], rank="place")  # three rows per brand are left
    return ranked.select(
        "p_brand", "p_partkey", "lines", "with_coupon", F.round(F.lit(100.0) * F.col("with_coupon") / F.col("lines"), 4).alias("coupon_pct"),
        F.col("place").cast("bigint").alias("place"),
    )


@plan("""
SELECT kind, published_at, CASE WHEN published_at = 'monday' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) ELSE (SELECT count(*) FROM orders) END AS orders
FROM (VALUES ('history', 'monday'), ('history', 'tuesday'), ('snapshot', 'tuesday'), ('switched', 'monday')) AS v(kind, published_at)
""")
def v10_kpi_snapshots(t: Tables) -> DataFrame:
    tables = {k: SnapshotTable(t.spark, work_path(t.spark, f"kpi-{k}")) for k in ("history", "snapshot", "switched")}
    for day, rows in (("monday", t.orders.where("o_orderkey % 2 = 0")), ("tuesday", t.orders)):
        totals = rows.agg(F.count(F.lit(1)).alias("orders"))
        for kind, table in tables.items():
            publish_kpis(table, totals, day, keep_history=kind != "snapshot", enabled=kind != "switched" or day == "monday")
    out = None
    for kind, table in tables.items():
        part = table.read().select(F.lit(kind).alias("kind"), "published_at", "orders")
        out = part if out is None else out.unionByName(part)
    return out
