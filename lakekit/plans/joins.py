"""Join queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.joins import (
    asof_join, isolated_join, lookup, salted_join, self_pair_count, unique_on,
)
from lakekit.operators.windows import SAMPLED
from lakekit.plans.registry import plan
from lakekit.session import Tables

D = "decimal(18,2)"


def known_customers(t: Tables) -> DataFrame:
    """Dimension with every tenth member missing, so that outer and anti joins have work."""
    return t.customer.where("c_custkey % 10 <> 0")


@plan("""
WITH o AS (SELECT * FROM orders),
     c AS (SELECT * FROM customer WHERE c_custkey % 10 <> 0)
SELECT 'inner' AS kind, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM o JOIN c ON o_custkey = c_custkey
UNION ALL SELECT 'left', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM o LEFT JOIN c ON o_custkey = c_custkey
UNION ALL SELECT 'right', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM o RIGHT JOIN c ON o_custkey = c_custkey
UNION ALL SELECT 'full', count(*), CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) FROM o FULL JOIN c ON o_custkey = c_custkey
""")
def j1_join_kinds(t: Tables) -> DataFrame:
    o = t.orders.select("o_custkey", "o_totalprice")
    c = known_customers(t).select("c_custkey")
    out = None
    for kind in ("inner", "left", "right", "full"):
        part = o.join(c, o.o_custkey == c.c_custkey, kind).agg(
            F.lit(kind).alias("kind"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("o_totalprice").cast(D)).cast("double").alias("total"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT o_orderkey, o_custkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS has_return
FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 0)
""")
def j2_semi_and_anti(t: Tables) -> DataFrame:
    c = known_customers(t)
    orphans = t.orders.select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    # lineitem once, one row per order, instead of a semi and an anti join
    returns = t.lineitem.where("l_returnflag = 'R'").select("l_orderkey").distinct()
    flagged = orphans.join(returns, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return flagged.select("o_orderkey", "o_custkey", F.col("l_orderkey").isNotNull().alias("has_return"))


_GRID = """
WITH actual AS (SELECT n_name AS nation, strftime(o_orderdate, '%Y-%m') AS month, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
                FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
     months AS (SELECT unnest(generate_series((SELECT date_trunc('month', min(o_orderdate)) FROM orders), (SELECT max(o_orderdate) + INTERVAL 3 MONTH FROM orders), INTERVAL 1 MONTH)) AS m),
     grid AS (SELECT n_name AS nation, n_nationkey, strftime(m, '%Y-%m') AS month, month(m) AS month_no
              FROM nation, months),
     targets AS (SELECT nation, month, 100000.0 + 10000 * n_nationkey + 1000 * month_no AS target FROM grid WHERE (n_nationkey + month_no) % 11 <> 0)
"""


@plan(_GRID + """
SELECT nation, month, CAST(coalesce(revenue, 0) AS DOUBLE) AS revenue FROM grid LEFT JOIN actual USING (nation, month)
""")
def j3_complete_grid(t: Tables) -> DataFrame:
    """Every nation and month up to three months after the last order, sales or not. The month axis is a sequence per nation, not a cross join."""
    return _grid(t).join(_actual(t), ["nation", "month"], "left").select(
        "nation", "month", F.coalesce("revenue", F.lit(0)).cast("double").alias("revenue")
    )


def _actual(t: Tables) -> DataFrame:
    c = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    months = t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy(
        F.col("n_name").alias("nation"), F.trunc("o_orderdate", "month").alias("first")
    ).agg(F.sum(F.col("o_totalprice").cast(D)).alias("revenue"))
    return months.select("nation", F.date_format("first", "yyyy-MM").alias("month"), "revenue")


def _grid(t: Tables) -> DataFrame:
    first, last = t.orders.agg(F.trunc(F.min("o_orderdate"), "month"), F.add_months(F.max("o_orderdate"), 3)).first()
    months = F.expr(f"explode(sequence(date'{first}', date'{last}', interval 1 month))")
    return t.nation.select(F.col("n_name").alias("nation"), "n_nationkey", months.alias("m")).select(
        "nation", "n_nationkey", F.date_format("m", "yyyy-MM").alias("month"), F.month("m").alias("month_no")
    )


@plan(_GRID + """
SELECT nation, month, CAST(coalesce(revenue, 0) AS DOUBLE) AS revenue, CAST(target AS DOUBLE) AS target,
       round(CAST(coalesce(revenue, 0) AS DOUBLE) / CAST(target AS DOUBLE) * 100, 1) AS attainment_pct
FROM grid LEFT JOIN actual USING (nation, month) LEFT JOIN targets USING (nation, month)
""")
def j4_multi_key_attainment(t: Tables) -> DataFrame:
    targets = _grid(t).where("(n_nationkey + month_no) % 11 <> 0").select(
        "nation", "month", F.expr("100000.0D + 10000 * n_nationkey + 1000 * month_no").alias("target")
    )
    out = _grid(t).join(_actual(t), ["nation", "month"], "left").join(targets, ["nation", "month"], "left")
    revenue = F.coalesce("revenue", F.lit(0)).cast("double")
    return out.select(
        "nation", "month", revenue.alias("revenue"), "target",
        F.round(revenue / F.col("target") * 100, 1).alias("attainment_pct"),
    )


@plan("""
SELECT s.n_name AS supplier_nation, c.n_name AS customer_nation, count(*) AS lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey GROUP BY ALL
""")
def j5_aliased_same_table_twice(t: Tables) -> DataFrame:
    """The same dimension joined twice: aliases keep its columns apart."""
    s, c = t.nation.alias("s"), t.nation.alias("c")
    return (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(s, F.col("s_nationkey") == F.col("s.n_nationkey"))
        .join(c, F.col("c_nationkey") == F.col("c.n_nationkey"))
        .groupBy(F.col("s.n_name").alias("supplier_nation"), F.col("c.n_name").alias("customer_nation"))
        .agg(F.count(F.lit(1)).alias("lines"))
    )


@plan("""
SELECT a.user_id AS user_id, CAST(count(*) AS BIGINT) AS pairs
FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type <> b.event_type GROUP BY a.user_id
""")
def j6_theta_self_join_pairs(t: Tables) -> DataFrame:
    """Size of the self join ``same user, other type`` from counts: no pair is ever made."""
    return self_pair_count(t.events, ["user_id"], "event_type").withColumn("pairs", F.col("pairs").cast("bigint"))


@plan("""
WITH a AS (SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END AS k FROM orders),
     b AS (SELECT CASE WHEN c_custkey % 500 = 0 THEN NULL ELSE c_custkey END AS k, max(c_name) AS c_name FROM customer GROUP BY 1)
SELECT 'equal' AS comparison, count(*) AS matches, count(c_name) AS named FROM a JOIN b ON a.k = b.k
UNION ALL SELECT 'null_safe', count(*), count(c_name) FROM a JOIN b ON a.k IS NOT DISTINCT FROM b.k
""")
def j7_null_keys(t: Tables) -> DataFrame:
    a = t.orders.select(F.expr("CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey END").alias("k"))
    # counted per key first: the NULL group may be the biggest of all
    a = a.groupBy("k").agg(F.count(F.lit(1)).alias("n")).alias("a")
    b = t.customer.groupBy(F.expr("CASE WHEN c_custkey % 500 = 0 THEN NULL ELSE c_custkey END").alias("k"))
    b = b.agg(F.max("c_name").alias("c_name")).alias("b")
    out = None
    for kind, cond in (
        ("equal", F.col("a.k") == F.col("b.k")),
        ("null_safe", F.col("a.k").eqNullSafe(F.col("b.k"))),
    ):
        part = a.join(b, cond).agg(
            F.lit(kind).alias("comparison"),
            F.sum("n").alias("matches"),
            F.sum(F.when(F.col("c_name").isNotNull(), F.col("n")).otherwise(0)).alias("named"),
        )
        out = part if out is None else out.unionByName(part)
    return out


_BRAND = """
SELECT p_brand AS brand, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
"""


def _brand_quantity(t: Tables, hint: str | None) -> DataFrame:
    lines = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    parts = t.part.select("p_partkey", "p_brand")
    if hint:
        parts = parts.hint(hint)
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy(F.col("p_brand").alias("brand")).agg(F.sum("q").alias("quantity"))


@plan("""
SELECT r_name AS region, CAST(count(*) AS BIGINT) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def j8_broadcast_join(t: Tables) -> DataFrame:
    """Nations and regions are fixed lists of 25 and 5 rows, the only sides hinted for broadcast."""
    places = F.broadcast(t.nation.join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey")))
    counts = t.customer.groupBy("c_nationkey").count()
    return (
        counts.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("region"))
        .agg(F.sum("count").alias("customers"))
    )


@plan(_BRAND)
def j9_merge_join_hint(t: Tables) -> DataFrame:
    return _brand_quantity(t, "merge")


@plan(_BRAND)
def j9_shuffle_hash_join_hint(t: Tables) -> DataFrame:
    return _brand_quantity(t, "shuffle_hash")


def skewed_events(t: Tables) -> DataFrame:
    """Events with 30 % of the rows moved onto user 0."""
    return t.events.withColumn("user_id", F.expr("CASE WHEN event_id % 10 < 3 THEN 0 ELSE user_id END"))


def user_dim(t: Tables) -> DataFrame:
    """One attribute row per user, the hot user included."""
    users = t.events.select("user_id").union(skewed_events(t).select("user_id")).distinct()
    return users.withColumn("segment", F.expr("concat('seg', user_id % 4)"))


_SKEWED = """
WITH e AS (SELECT event_id, event_type, value, CASE WHEN event_id % 10 < 3 THEN 0 ELSE user_id END AS user_id FROM events),
     u AS (SELECT DISTINCT user_id, 'seg' || (user_id % 4) AS segment FROM (SELECT user_id FROM events UNION ALL SELECT user_id FROM e))
SELECT segment, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM e JOIN u USING (user_id) GROUP BY ALL
"""


def _segment_totals(joined: DataFrame) -> DataFrame:
    return joined.groupBy("segment", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(D)).cast("double").alias("total")
    )


@plan(_SKEWED)
def j10_salted_join(t: Tables) -> DataFrame:
    return _segment_totals(salted_join(skewed_events(t), user_dim(t), ["user_id"], 16, salt_by=["event_id"]))


@plan(_SKEWED)
def j11_isolated_hot_key_join(t: Tables) -> DataFrame:
    return _segment_totals(isolated_join(skewed_events(t), user_dim(t), ["user_id"], 0.05, salt_by=["event_id"]))


_VERSIONS = """
WITH v AS (
  SELECT c_custkey AS custkey, 'v' || i AS tier, TIMESTAMP '1995-06-01' + to_months(CAST(18 * i AS INTEGER)) AS valid_from,
         CASE WHEN i < c_custkey % 4 THEN TIMESTAMP '1995-06-01' + to_months(CAST(18 * (i + 1) AS INTEGER)) END AS valid_to
  FROM customer, generate_series(0, 3) AS s(i) WHERE i <= c_custkey % 4)
"""


def tier_versions(t: Tables) -> DataFrame:
    """One to four validity periods of 18 months per customer."""
    rows = t.customer.select(
        F.col("c_custkey").alias("custkey"), F.expr("explode(sequence(0, cast(c_custkey % 4 as int)))").alias("i")
    )
    return rows.select(
        "custkey",
        F.expr("concat('v', i)").alias("tier"),
        F.expr("timestamp_ntz'1995-06-01' + make_ym_interval(0, 18 * i)").alias("valid_from"),
        F.expr(
            "CASE WHEN i < custkey % 4 THEN timestamp_ntz'1995-06-01' + make_ym_interval(0, 18 * (i + 1)) END"
        ).alias("valid_to"),
    )


_ASOF = _VERSIONS + """
SELECT coalesce(tier, 'none') AS tier, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders LEFT JOIN v ON o_custkey = custkey AND o_orderdate >= valid_from AND (valid_to IS NULL OR o_orderdate < valid_to) GROUP BY 1
"""


def _tier_totals(t: Tables, bucket: str | None) -> DataFrame:
    facts = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderdate", "o_totalprice")
    joined = asof_join(facts, tier_versions(t), ["custkey"], "o_orderdate", "valid_from", "valid_to", ["tier"], bucket)
    return joined.groupBy(F.coalesce("tier", F.lit("none")).alias("tier")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast(D)).cast("double").alias("total")
    )


@plan(_ASOF)
def j12_point_in_time_join(t: Tables) -> DataFrame:
    return _tier_totals(t, None)


@plan(_ASOF)
def j12_point_in_time_join_sliced(t: Tables) -> DataFrame:
    return _tier_totals(t, SAMPLED)


@plan("""
SELECT o_orderkey, c_custkey IS NOT NULL AS customer_exists, coalesce(c_mktsegment, 'Unknown') AS segment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 10 <> 0) ON o_custkey = c_custkey
""")
def j13_lookup_unknown_member(t: Tables) -> DataFrame:
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    dim = known_customers(t).select(F.col("c_custkey").alias("custkey"), F.col("c_mktsegment").alias("segment"))
    return lookup(facts, dim, ["custkey"], {"segment": "Unknown"}, "customer_exists").drop("custkey")


@plan("""
SELECT n_name AS nation, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def j14_fan_out_guard(t: Tables) -> DataFrame:
    """The dimension is checked to be unique inside the same query; a duplicate would fail it."""
    per_customer = t.orders.groupBy("o_custkey").count()
    dim = unique_on(t.customer.select("c_custkey", "c_nationkey"), ["c_custkey"])
    return (
        per_customer.join(dim, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("nation"))
        .agg(F.sum("count").alias("orders"))
    )
