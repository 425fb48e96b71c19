"""Changes by partition: the rows, and which partitions kept their files."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.model import scd2_apply, scd2_start
from lakekit.operators.partitions import PartitionedTable
from lakekit.operators.serving import MaterialisedAggregate
from lakekit.operators.tables import matched_delete, matched_update, not_matched_insert
from lakekit.plans.registry import plan
from lakekit.plans.streams import _Deliveries, _events
from lakekit.session import Tables, work_path
from lakekit.streaming.runs import upsert_table


def _kept(table: PartitionedTable, version: int = 0) -> DataFrame:
    """(part, kept): per partition of the newest version, whether its files are those of an older version."""
    old = table.files(version).select("file", F.lit(True).alias("old"))
    return table.files().join(old, "file", "left").groupBy("part").agg(F.bool_and(F.coalesce("old", F.lit(False))).alias("kept"))


def _with_kept(rows: DataFrame, label: str, table: PartitionedTable, version: int = 0) -> DataFrame:
    return rows.withColumn("part", F.expr(label).cast("string")).join(_kept(table, version), "part", "left").drop("part")


_SOURCE = """
WITH t AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
     last AS (SELECT DISTINCT month FROM t ORDER BY 1 DESC LIMIT 2),
     s AS (SELECT CASE WHEN id % 10 = 1 THEN -id ELSE id END AS id, month, price + 1 AS price, id % 10 = 2 AS gone FROM t SEMI JOIN last USING (month) WHERE id % 10 < 3)
"""


@plan(_SOURCE + """
SELECT coalesce(t.id, s.id) AS id, coalesce(s.month, t.month) AS month, CAST(coalesce(s.price, t.price) AS DOUBLE) AS price,
  coalesce(s.month, t.month) NOT IN (SELECT month FROM last) AS kept FROM t FULL JOIN s ON t.id = s.id WHERE t.id IS NULL OR NOT coalesce(s.gone, false)
""")
def t3_merge_by_partition(t: Tables) -> DataFrame:
    """Updates, deletes and inserts for the last two months: no other month's files are rewritten, though the key does not tell the month."""
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    table = PartitionedTable(t.spark, work_path(t.spark, "by-month"), "month", ["month"])
    table.publish(rows)
    last = rows.select("month").distinct().orderBy(F.desc("month")).limit(2)
    source = rows.where("id % 10 < 3").join(last, "month", "left_semi").select(
        F.when(F.col("id") % 10 == 1, -F.col("id")).otherwise(F.col("id")).alias("id"), "month", (F.col("price") + 1).cast("decimal(18,2)").alias("price"),
        (F.col("id") % 10 == 2).alias("gone"))
    table.merge(source, ["id"], [matched_delete("s.gone"), matched_update("*"), not_matched_insert("*", "NOT s.gone")])
    return _with_kept(table.read(), "month", table).select("id", "month", F.col("price").cast("double").alias("price"), "kept")


@plan("""
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 7 = 0 THEN 'late' ELSE o_orderpriority END AS priority, o_orderstatus <> 'P' AND o_orderstatus <> 'F' AS kept
FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderkey % 11 = 0)
""")
def t1_update_and_delete_by_partition(t: Tables) -> DataFrame:
    """An update that meets rows of one partition, then a delete that meets rows of another."""
    table = PartitionedTable(t.spark, work_path(t.spark, "by-status"), "status", ["status"])
    table.publish(t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")))
    table.update("status = 'P' AND id % 7 = 0", {"priority": "'late'"})
    table.delete("status = 'F' AND id % 11 = 0")
    return _with_kept(table.read(), "status", table).select("id", "priority", "kept")


@plan("""
WITH base AS (SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment FROM customer), u AS (SELECT id, nation, CASE WHEN id % 3 = 0 THEN 'MOVED' ELSE segment END AS segment FROM base WHERE nation < 5)
SELECT base.id, base.segment, coalesce(u.segment <> base.segment, false) AS closed, base.nation >= 5 AS kept FROM base LEFT JOIN u ON base.id = u.id
UNION ALL SELECT u.id, u.segment, false, false FROM u JOIN base ON u.id = base.id WHERE u.segment <> base.segment
""")
def d7_scd2_by_partition(t: Tables) -> DataFrame:
    """A dimension with history in one partition per nation: a feed of five nations leaves the others' files alone."""
    rows = t.customer.selectExpr("c_custkey AS id", "c_nationkey AS nation", "c_mktsegment AS segment")
    table = PartitionedTable(t.spark, work_path(t.spark, "dimension"), "nation", ["nation"])
    table.publish(scd2_start(rows, F.to_timestamp(F.lit("2024-01-01"))))
    updates = rows.where("nation < 5").withColumn("segment", F.expr("CASE WHEN id % 3 = 0 THEN 'MOVED' ELSE segment END")).withColumn("ts", F.to_timestamp(F.lit("2024-06-01")))
    table.change(updates, lambda dim: scd2_apply(dim, updates, ["id", "nation"], ["segment"], "ts"), "scd2")
    return _with_kept(table.read(), "nation", table).select("id", "segment", F.col("valid_to").isNotNull().alias("closed"), "kept")


@plan("""
WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2)
SELECT day, event_type, n, total, day < (SELECT max(day) FROM e) AS kept FROM e
""")
def r12_upsert_by_partition(t: Tables) -> DataFrame:
    """Totals per day and type, merged batch by batch; the second delivery has the last day only, and rewrites that alone."""
    d = _Deliveries(t)
    table = PartitionedTable(t.spark, d.place("days"), "day", ["day"])
    clauses = [matched_update({"n": "t.n + s.n", "total": "t.total + s.total"}), not_matched_insert("*")]

    def totals(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(28,2)").alias("total"))

    events = _events(t)
    newest = events.agg(F.date_trunc("day", F.max("ts"))).first()[0]
    first = (F.col("ts") < F.lit(newest)) | (F.col("event_id") % 2 == 0)
    for part in (events.where(first), events.where(~first)):
        d.land(part)
        upsert_table(d.stream(), table, d.place("checkpoint"), ["day", "event_type"], clauses, totals)
    return _with_kept(table.read(), "day", table).select("day", "event_type", "n", F.col("total").cast("double").alias("total"), "kept")


@plan("""
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS month, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
     y AS (SELECT max(year) AS year FROM o)
SELECT o.month, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total, o.year < any_value(y.year) AS kept FROM o, y WHERE NOT (o.year = y.year AND o_orderkey % 3 = 0) GROUP BY o.month, o.year
""")
def v2_refresh_by_partition(t: Tables) -> DataFrame:
    """A stored aggregate by month, in one partition per year; rows deleted in the last year refresh its groups only."""
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    query = lambda df: df.groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"))
    table = PartitionedTable(t.spark, work_path(t.spark, "mv-years"), "substr(month, 1, 4)", ["month"])
    view = MaterialisedAggregate(table, query, {"month": "month"})
    view.refresh(rows)
    last = rows.agg(F.max("month")).first()[0][:4]
    gone = (F.substring("month", 1, 4) == last) & (F.col("o_orderkey") % 3 == 0)
    view.refresh_touched(rows.where(~gone), rows.where(gone))
    return _with_kept(view.read(), "substr(month, 1, 4)", table).select("month", "n", F.col("total").cast("double").alias("total"), "kept")
