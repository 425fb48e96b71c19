"""Sorting, limits and set operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.compare import diff
from lakekit.plans.registry import plan
from lakekit.session import Tables


@plan("""
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer
ORDER BY balance DESC NULLS LAST, c_custkey LIMIT 50
""")
def o1_order_and_limit(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_custkey", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance")
    return rows.orderBy(F.desc_nulls_last("balance"), "c_custkey").limit(50)


@plan("""
SELECT 'union_all' AS kind, count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier)
UNION ALL SELECT 'union', count(*) FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)
""")
def o4_union_all_and_distinct(t: Tables) -> DataFrame:
    both = t.customer.select(F.col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey"))
    n = F.count(F.lit(1)).alias("n")
    return both.agg(F.lit("union_all").alias("kind"), n).union(both.distinct().agg(F.lit("union").alias("kind"), n))


@plan("""
SELECT 'customer' AS kind, c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
""")
def o5_union_by_name(t: Tables) -> DataFrame:
    c = t.customer.selectExpr("'customer' AS kind", "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    s = t.supplier.selectExpr("s_name AS name", "'supplier' AS kind", "s_suppkey AS id")
    return c.unionByName(s, allowMissingColumns=True)


_SETS = """
WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A'),
     c AS (SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R'), d AS (SELECT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'A')
"""


@plan(_SETS + """
SELECT 'intersect' AS kind, count(*) AS n, CAST(sum(k) AS BIGINT) AS total FROM (SELECT k FROM a INTERSECT SELECT k FROM b)
UNION ALL SELECT 'except', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT k FROM a EXCEPT SELECT k FROM b)
UNION ALL SELECT 'intersect_all', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT k FROM c INTERSECT ALL SELECT k FROM d)
UNION ALL SELECT 'except_all', count(*), CAST(sum(k) AS BIGINT) FROM (SELECT k FROM c EXCEPT ALL SELECT k FROM d)
""")
def o6_intersect_except(t: Tables) -> DataFrame:
    def keys(flag: str, column: str) -> DataFrame:
        return t.lineitem.where(F.col("l_returnflag") == flag).select(F.col(column).alias("k"))

    a, b = keys("R", "l_partkey"), keys("A", "l_partkey")
    c, d = keys("R", "l_suppkey"), keys("A", "l_suppkey")
    out = None
    for kind, rows in (
        ("intersect", a.intersect(b)), ("except", a.subtract(b)),
        ("intersect_all", c.intersectAll(d)), ("except_all", c.exceptAll(d)),
    ):
        part = rows.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


_BEFORE_AFTER = """
WITH before AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey % 13 <> 0),
     after AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 17 <> 0)
"""


def _before_after(t: Tables) -> tuple[DataFrame, DataFrame]:
    before = t.customer.where("c_custkey % 13 <> 0").select("c_custkey", "c_mktsegment")
    after = t.customer.where("c_custkey % 17 <> 0").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment"
    )
    return before, after


@plan(_BEFORE_AFTER + """
SELECT 'same' AS comparison, 0 AS only_left, 0 AS only_right
UNION ALL SELECT 'changed', (SELECT count(*) FROM (SELECT * FROM before EXCEPT ALL SELECT * FROM after)), (SELECT count(*) FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM before))
""")
def o7_table_equality(t: Tables) -> DataFrame:
    before, after = _before_after(t)
    same = diff(t.customer, t.customer.orderBy("c_name"))
    out = None
    for name, rows in (("same", same), ("changed", diff(before, after))):
        part = rows.agg(
            F.lit(name).alias("comparison"),
            F.coalesce(F.sum(F.when(F.col("side") == "left", F.col("copies"))), F.lit(0)).alias("only_left"),
            F.coalesce(F.sum(F.when(F.col("side") == "right", F.col("copies"))), F.lit(0)).alias("only_right"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@plan(_BEFORE_AFTER + """
SELECT 'left' AS side, * FROM (SELECT * FROM before EXCEPT SELECT * FROM after)
UNION ALL SELECT 'right', * FROM (SELECT * FROM after EXCEPT SELECT * FROM before)
""")
def o8_version_difference(t: Tables) -> DataFrame:
    return diff(*_before_after(t)).select("side", "c_custkey", "c_mktsegment")
