"""Projection, filter and subquery queries."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.columns import surrogate_key, with_generated
from lakekit.operators.windows import even_slices
from lakekit.plans.registry import plan
from lakekit.session import Tables, stored


@plan("SELECT o_orderkey AS id, o_totalprice * 2 AS doubled, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def p1_select(t: Tables) -> DataFrame:
    o = t.orders
    return o.select(F.col("o_orderkey").alias("id"), F.expr("o_totalprice * 2 AS doubled"), o["o_orderstatus"].alias("status"),
                    o.o_orderpriority.alias("priority"))


@plan("SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS nation, c_acctbal * 1.1 AS balance, 'eu' AS zone FROM customer")
def p2_columns(t: Tables) -> DataFrame:
    return (
        t.customer.withColumnRenamed("c_custkey", "id")
        .withColumnsRenamed({"c_nationkey": "nation", "c_acctbal": "balance"})
        .withColumns({"nation": F.col("nation").cast("string"), "balance": F.col("balance") * 1.1})
        .withColumn("zone", F.lit("eu"))
        .drop("c_name", "c_mktsegment")
    )


@plan("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS nationkey, c_acctbal AS balance FROM customer")
def p3_star_except_and_struct(t: Tables) -> DataFrame:
    nested = t.customer.select(
        "c_custkey", "c_name", "c_mktsegment",
        F.struct(F.col("c_nationkey").cast("bigint").alias("nationkey"), F.col("c_acctbal").alias("balance")).alias("s"),
    )
    return t.spark.sql("SELECT * EXCEPT (c_mktsegment, s), s.* FROM {n}", n=nested)


@plan("""
SELECT o_orderkey FROM orders WHERE (o_orderstatus IN ('F', 'O') AND NOT o_totalprice BETWEEN 100000 AND 200000 AND o_orderpriority LIKE '%-%')
  OR (regexp_matches(o_orderpriority, '^[12]') AND o_custkey IS NULL) OR o_orderkey < 3
""")
def p4_filters(t: Tables) -> DataFrame:
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    first = F.col("o_orderstatus").isin("F", "O") & ~price.between(100000, 200000) & priority.like("%-%")
    second = priority.rlike("^[12]") & F.col("o_custkey").isNull()
    return t.orders.where(first | second | F.expr("o_orderkey < 3")).select("o_orderkey")


_CHANGES = """
WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
     b AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS seg FROM customer)
"""


@plan(_CHANGES + """
SELECT count(*) FILTER (WHERE a.seg IS DISTINCT FROM b.seg) AS changed, count(*) FILTER (WHERE a.seg <> b.seg) AS seen_by_plain_comparison
FROM a JOIN b USING (c_custkey)
""")
def p5_null_safe_change(t: Tables) -> DataFrame:
    a = t.customer.selectExpr("c_custkey", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS old_seg")
    b = t.customer.selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS new_seg"
    )
    return a.join(b, "c_custkey").agg(
        F.count_if(~F.col("old_seg").eqNullSafe(F.col("new_seg"))).alias("changed"),
        F.count_if(F.col("old_seg") != F.col("new_seg")).alias("seen_by_plain_comparison"),
    )


@plan("""
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS band,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'b' END AS only_building FROM customer
""")
def p6_case_when(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.when(b < 0, "debt").when(b < 5000, "low").otherwise("high").alias("band"),
        F.when(F.col("c_mktsegment") == "BUILDING", "b").alias("only_building"),
    )


@plan("SELECT event_id, strftime(ts, '%Y-%m-%d') AS event_date, event_id % 10 AS digit FROM events")
def p7_generated_columns(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts")
    out = with_generated(rows, {"event_date": "CAST(CAST(ts AS DATE) AS STRING)", "digit": "event_id % 10"})
    return out.drop("ts")


@plan("SELECT c_custkey, 1000 + row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS sk FROM customer")
def p8_surrogate_key(t: Tables) -> DataFrame:
    """Consecutive keys after 1000 without a one-task sort: numbered inside slices, offsets from slice counts."""
    rows = t.customer.select("c_custkey", "c_mktsegment")
    slices = F.struct("c_mktsegment", even_slices(rows, "c_custkey", 2000))
    return surrogate_key(rows, ["c_mktsegment", "c_custkey"], slices, "sk", 1000).select("c_custkey", "sk")


@plan("""
WITH big AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12)
SELECT c_custkey, (SELECT max(o_totalprice) FROM orders) AS highest FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM big) AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""")
def p10_subqueries(t: Tables) -> DataFrame:
    return t.sql("""
        WITH big AS (SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY 1 HAVING count(*) > 12)
        SELECT c_custkey, (SELECT max(o_totalprice) FROM {orders}) AS highest FROM {customer}
        WHERE c_custkey IN (SELECT o_custkey FROM big) AND EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
    """)


@plan("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= 250000 AND o_orderdate >= TIMESTAMP '1997-01-01' GROUP BY 1")
def p11_parameters(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("lakekit_p11_orders")
    return t.spark.sql(
        "SELECT o_orderstatus, count(*) AS n FROM IDENTIFIER(:source) WHERE o_totalprice >= :least AND o_orderdate >= :since GROUP BY 1",
        args={"source": "lakekit_p11_orders", "least": 250000, "since": "1997-01-01"},
    )


@plan("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice >= (SELECT avg(o_totalprice) FROM orders) GROUP BY 1")
def p11_session_variable(t: Tables) -> DataFrame:
    """A session variable set from a query, used in another, and dropped."""
    name = f"lakekit_p11_{uuid.uuid4().hex[:8]}"
    t.spark.sql(f"DECLARE VARIABLE {name} DOUBLE DEFAULT 0")
    t.spark.sql(f"SET VARIABLE {name} = (SELECT avg(o_totalprice) FROM {{orders}})", orders=t.orders)
    out = stored(t.spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {{orders}} WHERE o_totalprice >= {name} GROUP BY 1", orders=t.orders), "variable")
    t.spark.sql(f"DROP TEMPORARY VARIABLE {name}")
    return out
