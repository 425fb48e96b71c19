"""Row-level changes, versions and change feeds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators import tables as tb
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.windows import latest_per_key
from lakekit.plans.registry import plan
from lakekit.session import Tables, work_path

T = """
WITH t AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_custkey % 10 AS updated, true AS active FROM customer),
     s AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS id, 'new ' || c_name AS name, c_acctbal + 100 AS balance,
                  c_custkey % 7 + 3 AS updated, true AS active, CASE WHEN c_custkey % 15 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 50 = 0)
"""


def target(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_custkey % 10 AS updated", "true AS active"
    )


def source(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 3 = 0 OR c_custkey % 50 = 0").selectExpr(
        "CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS id", "concat('new ', c_name) AS name",
        "c_acctbal + 100 AS balance", "c_custkey % 7 + 3 AS updated", "true AS active",
        "CASE WHEN c_custkey % 15 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS op",
    )


@plan(T + "SELECT id, CASE WHEN updated > 5 THEN 'x' || name ELSE name END AS name, CASE WHEN updated > 5 THEN balance + updated ELSE balance END AS balance, updated, active FROM t")
def t1_update(t: Tables) -> DataFrame:
    return tb.update(target(t), "updated > 5", {"name": "concat('x', name)", "balance": "balance + updated"})


@plan("""
SELECT id, seg FROM (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer) WHERE NOT coalesce(seg = 'BUILDING', false)
""")
def t2_delete(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("c_custkey AS id", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS seg")
    return tb.delete(rows, "seg = 'BUILDING'")


_MERGED = T + """
, m AS (SELECT CASE WHEN s.id IS NULL THEN CASE WHEN t.updated = 9 THEN 'deleted' ELSE 'updated' END
               WHEN t.id IS NULL THEN 'inserted' WHEN s.op = 'DELETE' THEN 'deleted' WHEN s.updated > t.updated THEN 'updated' ELSE 'kept' END AS action,
        coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL OR (s.op <> 'DELETE' AND s.updated > t.updated) THEN s.name ELSE t.name END AS name,
        CASE WHEN t.id IS NULL OR (s.op <> 'DELETE' AND s.updated > t.updated) THEN s.balance ELSE t.balance END AS balance,
        CASE WHEN t.id IS NULL OR (s.op <> 'DELETE' AND s.updated > t.updated) THEN s.updated ELSE t.updated END AS updated,
        CASE WHEN s.id IS NULL THEN false ELSE true END AS active
        FROM t FULL JOIN s ON t.id = s.id WHERE t.id IS NOT NULL OR s.op <> 'DELETE')
"""


def _merge(t: Tables) -> DataFrame:
    return tb.merge_actions(
        target(t), source(t), ["id"],
        [
            tb.matched_delete("s.op = 'DELETE'"),
            tb.matched_update("*", "s.updated > t.updated"),
            tb.not_matched_insert("*", "s.op <> 'DELETE'"),
            tb.missing_delete("t.updated = 9"),
            tb.missing_update({"active": "false"}),
        ],
    )


@plan(_MERGED + "SELECT id, name, balance, updated, active FROM m WHERE action <> 'deleted'")
def t3_merge(t: Tables) -> DataFrame:
    return _merge(t).where("_action <> 'deleted'").drop("_action")


@plan("""
WITH s AS (SELECT o_custkey AS id, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS last_order FROM orders GROUP BY 1)
SELECT c_custkey AS id, coalesce(last_order, -1) AS last_order, (SELECT count(*) > count(DISTINCT o_custkey) FROM orders) AS refused FROM customer LEFT JOIN s ON id = c_custkey
""")
def t4_merge_deduplicated_source(t: Tables) -> DataFrame:
    """Many orders per customer are refused as a source; the newest one per key is merged."""
    newest = latest_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    src = newest.selectExpr("o_custkey AS id", "o_orderkey AS last_order")
    tgt = t.customer.selectExpr("c_custkey AS id", "-1L AS last_order")
    clauses = [tb.matched_update("*"), tb.not_matched_insert("*")]
    refused = False
    try:
        tb.merge(tgt, t.orders.selectExpr("o_custkey AS id", "o_orderkey AS last_order"), ["id"], clauses).write.format("noop").mode("overwrite").save()
    except Exception as e:
        if "several source rows match one target row" not in str(e):
            raise
        refused = True
    return tb.merge(tgt, src, ["id"], clauses).withColumn("refused", F.lit(refused))


@plan(T + """
SELECT coalesce(t.id, s.id) AS id, CASE WHEN t.id IS NULL OR s.updated > t.updated THEN s.name ELSE t.name END AS name,
  CASE WHEN t.id IS NULL OR s.updated > t.updated THEN s.updated ELSE t.updated END AS updated FROM t FULL JOIN s ON t.id = s.id
""")
def t5_upsert_if_newer_twice(t: Tables) -> DataFrame:
    """Applied twice: the second run changes nothing."""
    once = tb.upsert_newer(target(t), source(t), ["id"], "updated")
    return tb.upsert_newer(once, source(t), ["id"], "updated").select("id", "name", "updated")


@plan("""
SELECT p_partkey AS id, CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity = 50) THEN true ELSE false END AS returned,
  CAST(p_size + coalesce(q, 0) AS BIGINT) AS stock FROM part LEFT JOIN (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey
""")
def t5b_additive_upsert(t: Tables) -> DataFrame:
    stock = t.part.selectExpr("p_partkey AS id", "false AS returned", "CAST(p_size AS BIGINT) AS stock")
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("stock"), F.lit(False).alias("returned")
    )
    added = tb.upsert_adding(stock, sold, ["id"], ["stock"])
    returned = t.lineitem.where("l_returnflag = 'R' AND l_quantity = 50").select(F.col("l_partkey").alias("id"))
    return tb.update_where_in(added, ["id"], returned, {"returned": "true"})


@plan(_MERGED + """
SELECT count(*) FILTER (WHERE action = 'updated') AS updated, count(*) FILTER (WHERE action = 'inserted') AS inserted, count(*) FILTER (WHERE action = 'deleted') AS deleted,
  count(*) FILTER (WHERE action = 'kept') AS kept FROM m
""")
def t6_merge_metrics(t: Tables) -> DataFrame:
    return tb.merge_metrics(_merge(t))


def _versions(t: Tables) -> SnapshotTable:
    """Four versions: load, update, append, delete."""
    table = SnapshotTable(t.spark, work_path(t.spark, "versions"))
    table.publish(target(t), "load")
    table.publish(tb.update(table.read(), "id % 4 = 0", {"balance": "balance + 1000"}), "update")
    table.append(source(t).where("id > 1000000").drop("op"))
    table.publish(tb.delete(table.read(), "id % 6 = 0"), "delete")
    return table


@plan("SELECT c_custkey AS id, c_acctbal AS old_balance, c_acctbal + 1000 AS balance FROM customer WHERE c_custkey % 4 = 0 AND c_custkey % 6 <> 0")
def t6b_changed_since_version(t: Tables) -> DataFrame:
    table = _versions(t)
    old = table.read(0).select("id", F.col("balance").alias("old_balance"))
    return table.read().join(old, "id").where("balance <> old_balance").select("id", "old_balance", "balance")


@plan(T + """
, v0 AS (SELECT * FROM t), v1 AS (SELECT id, CASE WHEN id % 4 = 0 THEN balance + 1000 ELSE balance END AS balance FROM t),
v2 AS (SELECT * FROM v1 UNION ALL SELECT id, balance FROM s WHERE id > 1000000)
SELECT 'v0' AS version, count(*) AS n, CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) AS total FROM v0
UNION ALL SELECT 'v1', count(*), CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) FROM v1
UNION ALL SELECT 'v2', count(*), CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) FROM v2
UNION ALL SELECT 'v3', count(*), CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) FROM v2 WHERE id % 6 <> 0
UNION ALL SELECT 'restored v1', count(*), CAST(sum(CAST(balance AS DECIMAL(18,2))) AS DOUBLE) FROM v1
""")
def t8_time_travel_and_restore(t: Tables) -> DataFrame:
    table = _versions(t)
    reads = {f"v{n}": table.read(n) for n in range(4)}
    table.restore(1)
    reads["restored v1"] = table.read()
    out = None
    for name, df in reads.items():
        part = df.agg(
            F.lit(name).alias("version"), F.count(F.lit(1)).alias("n"),
            F.sum(F.col("balance").cast("decimal(18,2)")).cast("double").alias("total"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier")
def t9_schema_enforcement(t: Tables) -> DataFrame:
    """A missing nullable column becomes NULL; unknown columns or other types would be refused."""
    schema = StructType.fromDDL("s_suppkey BIGINT, s_name STRING, s_acctbal DOUBLE")
    return tb.enforce_schema(t.supplier.select("s_name", "s_suppkey"), schema)


@plan("""
SELECT s_suppkey AS supplier, s_name, CAST(NULL AS VARCHAR) AS zone FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, s_name, 'z' || s_nationkey FROM supplier WHERE s_suppkey % 2 = 1
""")
def t10_schema_evolution(t: Tables) -> DataFrame:
    """Add a column on append, then rename one and drop another."""
    table = SnapshotTable(t.spark, work_path(t.spark, "evolving"))
    table.append(t.supplier.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name", "s_acctbal"))
    more = t.supplier.where("s_suppkey % 2 = 1").selectExpr("s_suppkey", "s_name", "s_acctbal", "concat('z', s_nationkey) AS zone")
    table.append(more, merge_schema=True)
    schema = StructType.fromDDL("supplier BIGINT, s_name STRING, zone STRING")
    table.alter(schema, {"supplier": "s_suppkey", "s_name": "s_name", "zone": "zone"})
    return table.read()


@plan(_MERGED + """
, after AS (SELECT id, name, balance, updated, active FROM m WHERE action <> 'deleted'),
d AS (SELECT t.id IS NULL AS ins, a.id IS NULL AS del, coalesce(t.id, a.id) AS id, t.balance AS b0, a.balance AS b1 FROM t FULL JOIN after a ON t.id = a.id
      WHERE t.id IS NULL OR a.id IS NULL OR (t.name, t.balance, t.updated, t.active) IS DISTINCT FROM (a.name, a.balance, a.updated, a.active))
SELECT 'insert' AS _change_type, id, b1 AS balance FROM d WHERE ins UNION ALL SELECT 'delete', id, b0 FROM d WHERE del
UNION ALL SELECT 'update_preimage', id, b0 FROM d WHERE NOT ins AND NOT del UNION ALL SELECT 'update_postimage', id, b1 FROM d WHERE NOT ins AND NOT del
""")
def t12_change_feed(t: Tables) -> DataFrame:
    after = _merge(t).where("_action <> 'deleted'").drop("_action")
    return tb.change_feed(target(t), after, ["id"]).select("_change_type", "id", "balance")


@plan("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
UNION ALL SELECT o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderkey % 2 = 0
""")
def k5_replace_where(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    since = "o_orderdate >= timestamp_ntz'2000-01-01'"
    new = rows.where(f"{since} AND o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return tb.replace_where(rows, new, since).select("o_orderkey", "o_totalprice")


@plan(T + "SELECT id, name FROM t UNION ALL SELECT id, name FROM s WHERE id NOT IN (SELECT id FROM t)")
def i13_insert_only_upsert(t: Tables) -> DataFrame:
    """The source has every row twice, and some without a key; loading it again adds nothing."""
    doubled = source(t).unionAll(source(t)).unionAll(source(t).where("id % 7 = 0").withColumn("id", F.lit(None).cast("bigint"))).drop("op")
    once = tb.insert_missing(target(t), doubled, ["id"])
    return tb.insert_missing(once, doubled, ["id"]).select("id", "name")
