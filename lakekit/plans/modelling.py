"""Dimensional modelling and change data capture queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import cdc
from lakekit.operators.model import band, calendar, scd2_apply, scd2_start
from lakekit.operators.quality import Expectation, apply_expectations
from lakekit.operators.tables import matched_update, merge, not_matched_insert
from lakekit.operators.windows import SAMPLED
from lakekit.plans.registry import plan
from lakekit.session import Tables, stored

D = "decimal(18,2)"


@plan("""
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS day, dayname(d) AS day_name, dayofweek(d) IN (5, 6) AS is_weekend,
  (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = CAST(d AS DATE)) AS orders
FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS s(d)
""")
def d1_calendar(t: Tables) -> DataFrame:
    """Calendar with a Friday and Saturday weekend, and the orders of each day."""
    days = calendar(t.spark, "1995-01-01", "2001-12-31", weekend=(6, 7))
    counts = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(counts, "day", "left").select(
        F.col("date_key").cast("bigint").alias("date_key"), F.date_format("day", "yyyy-MM-dd").alias("day"),
        "day_name", "is_weekend", F.coalesce("n", F.lit(0)).alias("orders"),
    )


def customer_dim(t: Tables) -> DataFrame:
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "c_custkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"),
            band("c_acctbal", [(0, "debt"), (2500, "low"), (7500, "mid")], "high").alias("balance_band"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


_DIM = """
dim AS (SELECT c_custkey, n_name AS nation, r_name AS region, c_mktsegment AS segment,
        CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 2500 THEN 'low' WHEN c_acctbal < 7500 THEN 'mid' ELSE 'high' END AS balance_band
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@plan("WITH " + _DIM + "SELECT * FROM dim")
def d2_denormalised_dimension(t: Tables) -> DataFrame:
    return customer_dim(t)


@plan("""
SELECT l_orderkey, l_partkey, o_custkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, l_quantity,
  round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
""")
def d3_order_line_fact(t: Tables) -> DataFrame:
    orders = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey", "o_orderdate")
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_partkey", "o_custkey", F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("date_key"),
        "l_quantity", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"),
    )


@plan("WITH " + _DIM + """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, p_brand, coalesce(d.nation, 'Unknown') AS nation, coalesce(d.balance_band, 'Unknown') AS balance_band, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM dim WHERE c_custkey % 10 <> 0) d ON d.c_custkey = o_custkey
""")
def d4_one_big_table(t: Tables) -> DataFrame:
    dim = customer_dim(t).where("c_custkey % 10 <> 0")
    wide = (
        t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(dim, F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    unknown = F.lit("Unknown")
    return wide.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "p_brand",
        F.coalesce("nation", unknown).alias("nation"), F.coalesce("balance_band", unknown).alias("balance_band"), "l_quantity",
    )


@plan("WITH " + _DIM + """
SELECT d.c_custkey, nation, count(o_orderkey) AS orders, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS lifetime_value,
  coalesce(strftime(max(o_orderdate), '%Y-%m-%d'), 'never') AS last_order
FROM dim d LEFT JOIN orders ON o_custkey = d.c_custkey GROUP BY ALL
""")
def d5_customer_360(t: Tables) -> DataFrame:
    totals = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast(D)).alias("v"), F.max("o_orderdate").alias("last")
    )
    return customer_dim(t).join(totals, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "nation", F.coalesce("n", F.lit(0)).alias("orders"),
        F.coalesce("v", F.lit(0)).cast("double").alias("lifetime_value"),
        F.coalesce(F.date_format("last", "yyyy-MM-dd"), F.lit("never")).alias("last_order"),
    )


_UPDATES = """
WITH base AS (SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer),
     u AS (SELECT CASE WHEN c_custkey % 100 = 4 THEN c_custkey + 5000000 ELSE c_custkey END AS id, c_name AS name,
                  CASE WHEN c_custkey % 12 = 0 THEN 'MOVED' WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 16 = 0 THEN NULL ELSE c_mktsegment END AS segment FROM customer WHERE c_custkey % 4 = 0)
"""


def _base(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey AS id", "c_name AS name", "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_mktsegment END AS segment"
    )


def _updates(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 4 = 0").selectExpr(
        "CASE WHEN c_custkey % 100 = 4 THEN c_custkey + 5000000 ELSE c_custkey END AS id", "c_name AS name",
        """CASE WHEN c_custkey % 12 = 0 THEN 'MOVED' WHEN c_custkey % 20 = 0 THEN NULL WHEN c_custkey % 16 = 0 THEN NULL
           ELSE c_mktsegment END AS segment""",
    )


@plan(_UPDATES + "SELECT id, name, segment FROM u UNION ALL SELECT id, name, segment FROM base WHERE id NOT IN (SELECT id FROM u)")
def d6_scd1_upsert(t: Tables) -> DataFrame:
    return merge(_base(t), _updates(t), ["id"], [matched_update("*"), not_matched_insert("*")])


@plan(_UPDATES + """
, c AS (SELECT base.id, base.name, base.segment AS old_segment, u.segment AS new_segment, u.id IS NOT NULL AND base.segment IS DISTINCT FROM u.segment AS changed FROM base LEFT JOIN u ON base.id = u.id)
SELECT id, old_segment AS segment, '2024-01-01' AS valid_from, CASE WHEN changed THEN '2024-06-01' ELSE 'open' END AS valid_to, NOT changed AS is_current FROM c
UNION ALL SELECT id, new_segment, '2024-06-01', 'open', true FROM c WHERE changed
UNION ALL SELECT id, segment, '2024-06-01', 'open', true FROM u WHERE id NOT IN (SELECT id FROM base)
""")
def d7_scd2_merge(t: Tables) -> DataFrame:
    dim = scd2_start(_base(t), F.to_timestamp(F.lit("2024-01-01")))
    updates = _updates(t).withColumn("ts", F.to_timestamp(F.lit("2024-06-01")))
    once = scd2_apply(dim, updates, ["id"], ["segment"], "ts")
    # the same batch again changes nothing
    out = scd2_apply(once, updates, ["id"], ["segment"], "ts")
    return out.select(
        "id", "segment", F.date_format("valid_from", "yyyy-MM-dd").alias("valid_from"),
        F.coalesce(F.date_format("valid_to", "yyyy-MM-dd"), F.lit("open")).alias("valid_to"), "is_current",
    )


# Change events: every customer is inserted; some get updates, late updates, deletes and invalid operations. One third
# of all events belongs to customer 1.
_EVENTS = """
ev AS (
  SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal AS balance, 'INSERT' AS operation, 1000 + c_custkey AS seq, 1 AS feed FROM {customer}
  UNION ALL SELECT c_custkey, 'S2', c_acctbal + 1, 'UPDATE', 200000 + c_custkey, 2 FROM {customer} WHERE c_custkey % 3 = 0
  UNION ALL SELECT c_custkey, 'S2', c_acctbal + 2, 'UPDATE', 300000 + c_custkey, 2 FROM {customer} WHERE c_custkey % 9 = 0
  UNION ALL SELECT c_custkey, NULL, NULL, 'DELETE', 400000 + c_custkey, 2 FROM {customer} WHERE c_custkey % 10 = 0
  UNION ALL SELECT c_custkey, 'LATE', c_acctbal + 3, 'UPDATE', 100000 + c_custkey, 3 FROM {customer} WHERE c_custkey % 6 = 0
  UNION ALL SELECT c_custkey, 'BAD', 0.0, 'MERGE', 500000 + c_custkey, 3 FROM {customer} WHERE c_custkey % 40 = 0
  UNION ALL SELECT 1, 'H' || (o_orderkey % 5), o_totalprice, 'UPDATE', 600000 + o_orderkey, 3 FROM {orders} WHERE o_orderkey % 7 = 0)
"""
_VALID = "valid AS (SELECT * FROM ev WHERE operation IN ('INSERT', 'UPDATE', 'DELETE'))"
_E = "WITH " + _EVENTS.format(customer="customer", orders="orders") + ", " + _VALID
# versions by a different road than the implementation: run numbers over the ordered events
_HISTORY = _E + """
, o AS (SELECT *, lag(segment) OVER w AS ps, lag(operation) OVER w AS po, lead(seq) OVER w AS nx FROM valid WINDOW w AS (PARTITION BY id ORDER BY seq)),
r AS (SELECT *, sum(CASE WHEN po IS NULL OR po = 'DELETE' OR operation = 'DELETE' OR ps IS DISTINCT FROM segment THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY seq) AS run FROM o),
h AS (SELECT id, run, arg_max(segment, seq) AS segment, max_by(balance, seq) AS balance, min(seq) AS start_at, coalesce(max_by(coalesce(nx, -1), seq), -1) AS end_at FROM r WHERE operation <> 'DELETE' GROUP BY id, run)
"""


def change_events(t: Tables) -> DataFrame:
    return t.sql("WITH " + _EVENTS + " SELECT * FROM ev", customer=t.customer, orders=t.orders)


def valid_events(t: Tables) -> DataFrame:
    """Events with an unknown operation are dropped, one without a key stops the feed."""
    return apply_expectations(
        change_events(t),
        [
            Expectation("has_key", "id IS NOT NULL", "fail"),
            Expectation("valid_operation", "operation IN ('INSERT', 'UPDATE', 'DELETE')", "drop"),
        ],
    )


OPTIONS = {"deletes": "operation = 'DELETE'", "leave_out": ["operation", "feed"]}


@plan(_E + "SELECT id, segment, balance FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1 AND operation <> 'DELETE'")
def d8_apply_changes_scd1(t: Tables) -> DataFrame:
    return cdc.apply_changes_scd1(valid_events(t), ["id"], "seq", **OPTIONS)


@plan(_E + "SELECT id, segment, balance FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY seq DESC) = 1 AND operation <> 'DELETE'")
def d8_scd1_in_three_batches(t: Tables) -> DataFrame:
    """The same feed in three batches, the last one with late events: tombstones keep deleted keys deleted."""
    ev = valid_events(t)
    state = cdc.apply_changes_scd1(ev.where("feed = 1"), ["id"], "seq", tombstones=True, **OPTIONS)
    for n in (2, 3):
        state = cdc.continue_scd1(state, ev.where(f"feed = {n}"), ["id"], "seq", deletes=OPTIONS["deletes"])
    return state.where("NOT _deleted").select("id", "segment", "balance")


@plan(_E + """
, live AS (SELECT *, max(CASE WHEN operation = 'DELETE' THEN seq ELSE -1 END) OVER (PARTITION BY id) AS d FROM (SELECT id, CASE WHEN feed = 3 THEN NULL ELSE segment END AS segment, balance, operation, seq FROM valid WHERE seq > 100500))
SELECT id, coalesce(arg_max(segment, seq) FILTER (WHERE segment IS NOT NULL), 'none') AS segment, max_by(balance, seq) AS balance FROM live WHERE seq > d AND operation <> 'DELETE' GROUP BY id
""")
def d8_scd1_partial_updates_and_truncate(t: Tables) -> DataFrame:
    """NULL means unchanged, and a truncate event at 100500 empties everything before it."""
    ev = valid_events(t).withColumn("segment", F.expr("CASE WHEN feed = 3 THEN NULL ELSE segment END"))
    cut = t.spark.range(1).selectExpr("-1L AS id", "CAST(NULL AS STRING) AS segment", "CAST(NULL AS DOUBLE) AS balance", "'TRUNCATE' AS operation", "100500L AS seq", "3 AS feed")
    out = cdc.apply_changes_scd1(
        ev.unionByName(cut), ["id"], "seq", truncates="operation = 'TRUNCATE'", ignore_null_updates=True, **OPTIONS
    )
    return out.select("id", F.coalesce("segment", F.lit("none")).alias("segment"), "balance")


def _history(t: Tables, bucket=None) -> DataFrame:
    return cdc.apply_changes_scd2(valid_events(t), ["id"], "seq", track=["segment"], bucket=bucket, **OPTIONS)


def _plain(history: DataFrame) -> DataFrame:
    return history.select(
        "id", "segment", "balance", F.col(cdc.START).alias("start_at"), F.coalesce(cdc.END, F.lit(-1)).alias("end_at")
    )


@plan(_HISTORY + "SELECT id, segment, balance, start_at, end_at FROM h")
def d9_apply_changes_scd2(t: Tables) -> DataFrame:
    """Late events find their place; only segment opens versions, balance is updated in place. Histories are cut into
    slices of equal size, since one customer has a third of the events."""
    return _plain(_history(t, SAMPLED))


@plan(_HISTORY + "SELECT id, segment, balance, start_at, end_at FROM h")
def d9_scd2_refresh_touched_keys(t: Tables) -> DataFrame:
    ev = stored(valid_events(t), "event-log")
    options = {**OPTIONS, "track": ["segment"], "bucket": SAMPLED}
    old = cdc.apply_changes_scd2(ev.where("feed < 3"), ["id"], "seq", **options)
    return _plain(cdc.refresh_scd2(old, ev, ev.where("feed = 3"), ["id"], "seq", **options))


@plan(_UPDATES + """
SELECT coalesce(base.id, u.id) AS id, CASE WHEN u.id IS NULL THEN 'DELETE' WHEN base.id IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS operation,
  CASE WHEN u.id IS NULL THEN base.segment ELSE u.segment END AS segment FROM (SELECT * FROM base WHERE id % 4 = 0 OR id % 7 = 0) base FULL JOIN u ON base.id = u.id
WHERE u.id IS NULL OR base.id IS NULL OR (base.name, base.segment) IS DISTINCT FROM (u.name, u.segment)
""")
def d10_changes_from_snapshots(t: Tables) -> DataFrame:
    before = _base(t).where("id % 4 = 0 OR id % 7 = 0")
    return cdc.changes_from_snapshots(before, _updates(t), ["id"], 2).select("id", "operation", "segment")


@plan(_HISTORY + "SELECT id, segment FROM h WHERE start_at <= 250000 AND (end_at = -1 OR end_at > 250000)")
def d11_as_of_history(t: Tables) -> DataFrame:
    return cdc.as_of(_history(t, SAMPLED), 250000).select("id", "segment")


@plan(_E + "SELECT id, operation, seq FROM valid")
def d12_event_validation(t: Tables) -> DataFrame:
    return valid_events(t).select("id", "operation", "seq")


@plan("""
WITH silver AS (SELECT DISTINCT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders WHERE o_orderstatus <> 'P')
SELECT strftime(day, '%Y-%m-%d') AS day, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM silver GROUP BY 1
""")
def d13_medallion_batch(t: Tables) -> DataFrame:
    """Full rebuild bronze, silver, gold: re-sent rows in bronze leave gold unchanged."""
    bronze = t.orders.unionAll(t.orders.where("o_orderkey % 9 = 0"))
    silver = bronze.where("o_orderstatus <> 'P'").dropDuplicates(["o_orderkey"])
    return silver.groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast(D)).cast("double").alias("revenue")
    )
