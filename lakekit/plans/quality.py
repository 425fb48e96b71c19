"""Data-quality queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import quality as dq
from lakekit.plans.inputs import CLEAN_SQL, clean_readings, stored_readings
from lakekit.plans.registry import plan
from lakekit.session import Tables

C = "WITH " + CLEAN_SQL
# fixed values: rule names and what good rows meet
RULES = {
    "volume_readable": "volume IS NOT NULL",
    "volume_positive": "volume > 0",
    "time_known": "taken_at IS NOT NULL",
    "meter_known": "meter >= 0",
}
_TAGS = """
 tagged AS (SELECT *, CASE WHEN volume IS NULL THEN 'volume_readable' END AS e1, CASE WHEN NOT coalesce(volume > 0, false) THEN 'volume_positive' END AS e2,
   CASE WHEN taken_at IS NULL THEN 'time_known' END AS e3, CASE WHEN NOT coalesce(meter >= 0, false) THEN 'meter_known' END AS e4 FROM clean)
"""


@plan(C + "," + _TAGS + "SELECT reading_no, concat_ws(',', e1, e2, e3, e4) AS errors FROM tagged")
def q9_rule_errors(t: Tables) -> DataFrame:
    return dq.tag_errors(clean_readings(t), RULES).select("reading_no", F.array_join("dq_errors", ",").alias("errors"))


@plan(C + "," + _TAGS + "SELECT reading_no, coalesce(e1, e2, e3, e4) AS reason FROM tagged WHERE coalesce(e1, e2, e3, e4) IS NOT NULL")
def q10_first_failing_rule(t: Tables) -> DataFrame:
    out = dq.first_error(clean_readings(t), RULES, "reason")
    return out.where("reason IS NOT NULL").select("reading_no", "reason")


@plan(C + "," + _TAGS + """
SELECT CASE WHEN concat_ws(',', e1, e2, e3, e4) = '' THEN 'valid' ELSE 'quarantine' END AS part, count(*) AS n,
  CAST(coalesce(sum(volume), 0) AS DOUBLE) AS total FROM tagged GROUP BY 1
""")
def q11_valid_and_quarantine(t: Tables) -> DataFrame:
    valid, bad = dq.split(stored_readings(t), RULES)
    total = F.coalesce(F.sum("volume"), F.lit(0)).cast("double").alias("total")
    n = F.count(F.lit(1)).alias("n")
    return valid.agg(F.lit("valid").alias("part"), n, total).unionByName(
        bad.agg(F.lit("quarantine").alias("part"), n, total)
    )


@plan(C + "," + _TAGS + """
SELECT 'volume_readable' AS rule, count(*) - count(e1) AS passed, count(e1) AS failed FROM tagged
UNION ALL SELECT 'volume_positive', count(*) - count(e2), count(e2) FROM tagged
UNION ALL SELECT 'time_known', count(*) - count(e3), count(e3) FROM tagged
UNION ALL SELECT 'meter_known', count(*) - count(e4), count(e4) FROM tagged
UNION ALL SELECT 'state_known', count(*), 0 FROM tagged
""")
def q12_rule_report(t: Tables) -> DataFrame:
    return dq.rule_report(clean_readings(t), {**RULES, "state_known": "state IN ('read', 'estimated', 'corrected')"})


EXPECTATIONS = [
    dq.Expectation("has_time", "taken_at IS NOT NULL", "warn"),
    dq.Expectation("positive_volume", "volume > 0", "drop"),
    dq.Expectation("has_key", "reading_no IS NOT NULL", "fail"),
]


@plan(C + "SELECT reading_no, state FROM clean WHERE coalesce(volume > 0, false)")
def q13_expectations(t: Tables) -> DataFrame:
    return dq.apply_expectations(clean_readings(t), EXPECTATIONS).select("reading_no", "state")


@plan(C + """
SELECT 'readings' AS dataset, 'has_time' AS rule, 'warn' AS action, count(taken_at) AS passed, count(*) - count(taken_at) AS failed FROM clean
UNION ALL SELECT 'readings', 'positive_volume', 'drop', count(*) FILTER (WHERE volume > 0), count(*) - count(*) FILTER (WHERE volume > 0) FROM clean
UNION ALL SELECT 'readings', 'has_key', 'fail', count(reading_no), 0 FROM clean
""")
def q13_expectation_metrics(t: Tables) -> DataFrame:
    return dq.expectation_metrics(clean_readings(t), EXPECTATIONS, "readings")


@plan(C + """
SELECT count(*) AS rows_in, count(*) FILTER (WHERE volume > 0) AS kept, count(*) FILTER (WHERE NOT (volume > 0)) AS inverted,
  count(*) FILTER (WHERE volume IS NULL) AS lost_by_inversion, count(*) FILTER (WHERE NOT coalesce(volume > 0, false)) AS quarantined FROM clean
""")
def q14_null_rule_results(t: Tables) -> DataFrame:
    """Why ``NOT rule`` is no quarantine: rows whose rule is NULL would be in neither part."""
    rule = F.expr("volume > 0")
    return clean_readings(t).agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(rule).alias("kept"),
        F.count_if(~rule).alias("inverted"),
        F.count_if(rule.isNull()).alias("lost_by_inversion"),
        F.count_if(~dq.holds(rule)).alias("quarantined"),
    )


@plan("""
SELECT o_orderkey, o_totalprice FROM orders
""")
def q15_checked_write(t: Tables) -> DataFrame:
    """Every row passes the table's checks while it flows; one bad row would fail the whole write."""
    checks = {"total_positive": "o_totalprice > 0", "status_known": "o_orderstatus IN ('F', 'O', 'P')"}
    return dq.checked(t.orders, checks).select("o_orderkey", "o_totalprice")


@plan("""
SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 10 <> 0)
""")
def q16_foreign_key_orphans(t: Tables) -> DataFrame:
    known = t.customer.where("c_custkey % 10 <> 0")
    return dq.orphans(t.orders, known, {"o_custkey": "c_custkey"}).select("o_orderkey", "o_custkey")


@plan(C + """
, r AS (
SELECT 'missing_vs_source' AS "check", count(*) AS bad_rows FROM events WHERE event_id NOT IN (SELECT reading_no FROM clean)
UNION ALL SELECT 'orphans', count(*) FROM clean WHERE meter NOT IN (SELECT user_id FROM events)
UNION ALL SELECT 'duplicate_ids', count(*) FROM (SELECT reading_no FROM clean GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'negative_volumes', count(*) FROM clean WHERE volume < 0)
SELECT *, CASE WHEN bad_rows = 0 THEN 'OK' ELSE 'FAILED' END AS status FROM r
""")
def q17_reconciliation(t: Tables) -> DataFrame:
    clean = stored_readings(t)  # cleaned once, read by four checks
    return dq.checklist(
        {
            "missing_vs_source": dq.orphans(t.events.select("event_id"), clean, {"event_id": "reading_no"}),
            "orphans": dq.orphans(clean, t.events.select("user_id"), {"meter": "user_id"}),
            "duplicate_ids": dq.duplicates(clean, ["reading_no"]),
            "negative_volumes": clean.where("volume < 0"),
        }
    )


_BATCHES = """
WITH b AS (SELECT CAST(o_orderkey % 12 AS BIGINT) AS batch_id, CASE WHEN o_orderkey % 12 = 5 AND o_orderkey % 7 < 2 THEN o_orderkey - o_orderkey % 84 + 5 ELSE o_orderkey END AS order_id,
                  CASE WHEN o_orderkey % 12 = 3 AND o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS quantity,
                  CASE WHEN o_orderkey % 12 = 8 AND o_orderkey % 3 = 2 THEN -1 ELSE o_custkey END AS custkey, o_totalprice FROM orders),
     p AS (SELECT batch_id, order_id, 'duplicate' AS problem FROM b QUALIFY row_number() OVER (PARTITION BY batch_id, order_id) > 1
           UNION ALL SELECT batch_id, order_id, 'cancelled' FROM b WHERE quantity = 0
           UNION ALL SELECT batch_id, order_id, 'unknown_customer' FROM b WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = custkey)),
     g AS (SELECT batch_id, count(problem) AS bad_rows FROM (SELECT DISTINCT batch_id FROM b) LEFT JOIN p USING (batch_id) GROUP BY 1)
"""


def batched_orders(t: Tables) -> DataFrame:
    """Twelve delivery batches: one re-sends orders, one has cancelled rows, one has unknown customers."""
    return t.orders.selectExpr(
        "CAST(o_orderkey % 12 AS BIGINT) AS batch_id",
        "CASE WHEN o_orderkey % 12 = 5 AND o_orderkey % 7 < 2 THEN o_orderkey - o_orderkey % 84 + 5 ELSE o_orderkey END AS order_id",
        "CASE WHEN o_orderkey % 12 = 3 AND o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS quantity",
        "CASE WHEN o_orderkey % 12 = 8 AND o_orderkey % 3 = 2 THEN -1 ELSE o_custkey END AS custkey",
        "o_totalprice",
    )


def batch_problems(t: Tables) -> DataFrame:
    b = batched_orders(t)
    keys = ["batch_id", "order_id"]
    found = {
        # one row for every copy after the first
        "duplicate": dq.duplicates(b, keys).withColumn("extra", F.explode(F.sequence(F.lit(2), F.col("copies")))),
        "cancelled": b.where("quantity = 0"),
        "unknown_customer": dq.orphans(b, t.customer, {"custkey": "c_custkey"}),
    }
    out = None
    for problem, rows in found.items():
        part = rows.select(*keys, F.lit(problem).alias("problem"))
        out = part if out is None else out.unionByName(part)
    return out


@plan(_BATCHES + "SELECT * FROM p")
def q18_batch_problems(t: Tables) -> DataFrame:
    return batch_problems(t)


@plan(_BATCHES + "SELECT batch_id, bad_rows, CASE WHEN bad_rows > 100 THEN 'held' ELSE 'released' END AS decision FROM g")
def q19_quality_gate(t: Tables) -> DataFrame:
    return dq.gate(batch_problems(t), batched_orders(t), "batch_id", 100)


@plan(_BATCHES + """
SELECT batch_id, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM b
WHERE batch_id NOT IN (SELECT batch_id FROM g WHERE bad_rows > 100) GROUP BY 1
""")
def q19_rebuild_without_held(t: Tables) -> DataFrame:
    decisions = dq.gate(batch_problems(t), batched_orders(t), "batch_id", 100)
    return dq.released(batched_orders(t), decisions, "batch_id").groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@plan("""
WITH lines AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS items_total, max(CAST(l_extendedprice AS DECIMAL(18,2))) AS biggest FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(items_total AS DOUBLE) AS items_total, o_totalprice AS total FROM orders JOIN lines ON o_orderkey = l_orderkey
WHERE abs(items_total - CAST(o_totalprice AS DECIMAL(18,2))) > 300000
""")
def q20_items_versus_total(t: Tables) -> DataFrame:
    """Sum of the lines of an order against its total; the sum is built map-side, no item list is gathered."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("items_total"))
    joined = t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    off = F.abs(F.col("items_total") - F.col("o_totalprice").cast("decimal(18,2)")) > 300000
    return joined.where(off).select(
        "o_orderkey", F.col("items_total").cast("double").alias("items_total"), F.col("o_totalprice").alias("total")
    )


@plan(C + """
SELECT 'reading_no_present' AS rule, count(*) AS passed, 0 AS failed FROM clean
UNION ALL SELECT 'unit_allowed', count(*) FILTER (WHERE unit IN ('M3', 'KWH')), count(*) FILTER (WHERE unit NOT IN ('M3', 'KWH')) FROM clean
UNION ALL SELECT 'volume_in_range', count(*) FILTER (WHERE volume BETWEEN 0 AND 400), count(*) - count(*) FILTER (WHERE volume BETWEEN 0 AND 400) FROM clean
UNION ALL SELECT 'correction_has_volume', count(*) FILTER (WHERE state <> 'corrected' OR volume IS NOT NULL), count(*) FILTER (WHERE state = 'corrected' AND volume IS NULL) FROM clean
""")
def q21_rule_families(t: Tables) -> DataFrame:
    rules = {
        **dq.complete("reading_no"),
        **dq.one_of("unit", ["M3", "KWH"]),
        **dq.between("volume", 0, 400),
        **dq.consistent("correction_has_volume", "state <> 'corrected' OR volume IS NOT NULL"),
    }
    return dq.rule_report(clean_readings(t), rules)


@plan("""
SELECT strftime(max(ts), '%Y-%m-%d') AS newest_day, CAST(epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
  epoch(TIMESTAMP '2024-01-31 12:00:00') - floor(epoch(max(ts))) <= 86400 AS fresh FROM events
""")
def q21_freshness(t: Tables) -> DataFrame:
    out = dq.freshness(t.events, "ts", F.lit("2024-01-31 12:00:00"), 86400)
    return out.select(F.date_format("newest", "yyyy-MM-dd").alias("newest_day"), "age_seconds", "fresh")
