"""Reports over run, event, query and audit logs, all derived from the given tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import observe as ob
from lakekit.plans.registry import plan
from lakekit.session import Tables

# Each order is one step of a run of five. A step that breaks keeps the later ones from starting; price steps of some runs crawl.
_RUNS = """
runs AS (
  SELECT run_id, step AS task_no, CASE step WHEN 0 THEN 'land' WHEN 1 THEN 'dedupe' WHEN 2 THEN 'price' WHEN 3 THEN 'report' ELSE 'notify' END AS task_key,
    CASE WHEN broken < 5 AND step = broken THEN 'FAILED' WHEN broken < 5 AND step > broken THEN 'UPSTREAM_FAILED' ELSE 'SUCCEEDED' END AS state,
    (25 + o_custkey % 31 + 12 * step * step) * CASE WHEN step = 2 AND run_id % 8 = 5 THEN 3 ELSE 1 END AS seconds,
    CASE WHEN run_id % 23 = 11 THEN 400 ELSE 15 + run_id % 9 END AS setup_seconds
  FROM (SELECT o_orderkey, o_custkey, {div} AS run_id, o_orderkey % 5 AS step, {div} % 37 AS broken FROM {orders}))
"""
R = "WITH " + _RUNS.format(div="o_orderkey // 5", orders="orders")


def task_runs(t: Tables) -> DataFrame:
    return t.sql("WITH " + _RUNS.replace("{div}", "o_orderkey DIV 5") + " SELECT * FROM runs")


_BASE = ", base AS (SELECT task_key, quantile_cont(seconds, 0.5) AS baseline FROM runs WHERE state = 'SUCCEEDED' AND run_id % 8 <> 5 GROUP BY 1)"


@plan(R + _BASE + "SELECT task_key, round(baseline, 4) AS baseline FROM base")
def m1_baselines(t: Tables) -> DataFrame:
    return ob.baselines(task_runs(t), F.expr("run_id % 8 <> 5")).withColumn("baseline", F.round("baseline", 4))


@plan(R + _BASE + "SELECT run_id, task_key, seconds, round(seconds / baseline, 4) AS ratio FROM runs JOIN base USING (task_key) WHERE seconds / baseline > 1.5")
def m2_regressions(t: Tables) -> DataFrame:
    runs = task_runs(t)
    base = ob.baselines(runs, F.expr("run_id % 8 <> 5"))
    return ob.regressions(runs, base).select("run_id", "task_key", "seconds", "ratio")


@plan(R + "SELECT run_id, max(task_key) FILTER (WHERE state = 'FAILED') AS blocker, count(*) FILTER (WHERE state = 'UPSTREAM_FAILED') AS victims FROM runs GROUP BY 1 HAVING count(*) FILTER (WHERE state = 'FAILED') > 0")
def m3_blockers_and_victims(t: Tables) -> DataFrame:
    return ob.blockers(task_runs(t))


@plan(R + """
, r AS (SELECT run_id, bool_or(state = 'FAILED') AS bad, max(setup_seconds) AS setup FROM runs GROUP BY 1)
SELECT count(*) AS runs, count(*) FILTER (WHERE bad) AS failed, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE bad) / count(*), 4) AS failure_pct, count(*) FILTER (WHERE setup > 300) AS slow_starts FROM r
""")
def m4_failure_rate_and_slow_starts(t: Tables) -> DataFrame:
    runs = task_runs(t).groupBy("run_id").agg(
        F.when(F.bool_or(F.col("state") == "FAILED"), "FAILED").otherwise("SUCCEEDED").alias("state"), F.max("setup_seconds").alias("setup")
    )
    slow = runs.where("setup > 300").agg(F.count(F.lit(1)).alias("n")).scalar()
    return ob.failure_rate(runs).withColumn("slow_starts", slow)


@plan(R + """
SELECT task_key, count(*) AS executions, count(*) FILTER (WHERE state <> 'SUCCEEDED') AS not_succeeded, max(seconds) FILTER (WHERE state = 'SUCCEEDED') AS longest,
  round(quantile_cont(seconds, 0.5) FILTER (WHERE state = 'SUCCEEDED'), 4) AS median FROM runs GROUP BY 1
""")
def m5_timeline_summary(t: Tables) -> DataFrame:
    return ob.timeline_summary(task_runs(t)).withColumn("median", F.round("median", 4))


_NAMES = "names AS (SELECT c_custkey % 40 AS job_id, c_custkey AS changed_at, 'job ' || c_custkey AS name FROM customer)"


@plan(R + ", " + _NAMES + """
, latest AS (SELECT job_id, name FROM names QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY changed_at DESC) = 1)
SELECT name, count(*) AS executions FROM runs JOIN latest ON job_id = run_id % 40 GROUP BY 1
""")
def m5b_timeline_with_latest_names(t: Tables) -> DataFrame:
    names = t.customer.selectExpr("c_custkey % 40 AS job_id", "c_custkey AS changed_at", "concat('job ', c_custkey) AS name")
    timeline = task_runs(t).selectExpr("run_id % 40 AS job_id").groupBy("job_id").agg(F.count(F.lit(1)).alias("n"))
    named = ob.with_latest_names(timeline, names, "job_id", "changed_at")
    return named.where("name IS NOT NULL").groupBy("name").agg(F.sum("n").alias("executions"))


@plan("""
SELECT event_type AS sku, strftime(ts, '%Y-%m-%d') AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS units FROM events
WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL
""")
def m5c_usage_last_seven_days(t: Tables) -> DataFrame:
    rows = t.events.where("ts >= timestamp_ntz'2024-01-31' - INTERVAL 7 DAYS AND ts < timestamp_ntz'2024-01-31'")
    return rows.groupBy(F.col("event_type").alias("sku"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("units")
    )


@plan("""
WITH s AS (SELECT event_id // 200 % 5 AS job_id, event_id // 4 AS run_id, ts AS start_at, ts + to_seconds(60 + event_id % 90) AS end_at, CASE WHEN event_id % 4 < 3 OR event_id // 4 % 11 = 0 THEN 'none' WHEN event_id // 4 % 9 = 0 THEN 'FAILED' WHEN event_id // 4 % 9 = 1 THEN 'CANCELED' ELSE 'SUCCEEDED' END AS state FROM events),
r AS (SELECT * FROM (SELECT job_id, run_id, arg_max(state, end_at) AS state, CAST(floor(epoch(max(end_at))) - floor(epoch(min(start_at))) AS BIGINT) AS seconds FROM s WHERE start_at >= TIMESTAMP '2024-01-10' GROUP BY ALL) WHERE state <> 'none')
SELECT job_id, count(*) AS runs, round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE state <> 'SUCCEEDED') / count(*), 4) AS failure_pct, round(quantile_cont(seconds, 0.5), 4) AS p50, round(quantile_cont(seconds, 0.9), 4) AS p90 FROM r GROUP BY 1
""")
def m5d_job_health(t: Tables) -> DataFrame:
    slices = t.events.selectExpr(
        "event_id DIV 200 % 5 AS job_id", "event_id DIV 4 AS run_id", "CAST(ts AS TIMESTAMP) AS start_at",
        "CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, 60 + event_id % 90) AS end_at",
        """CASE WHEN event_id % 4 < 3 OR event_id DIV 4 % 11 = 0 THEN NULL WHEN event_id DIV 4 % 9 = 0 THEN 'FAILED'
           WHEN event_id DIV 4 % 9 = 1 THEN 'CANCELED' ELSE 'SUCCEEDED' END AS state""",
    )
    out = ob.job_health(slices, F.lit("2024-01-10").cast("timestamp"))
    return out.select("job_id", "runs", "failure_pct", F.round("p50", 4).alias("p50"), F.round("p90", 4).alias("p90"))


@plan("""
SELECT dataset, rule, CAST(sum(passed) AS BIGINT) AS passed, CAST(sum(failed) AS BIGINT) AS failed FROM
 (SELECT event_type AS dataset, 'has_user' AS rule, event_id % 100 AS passed, event_id % 7 AS failed FROM events UNION ALL SELECT event_type, 'in_range', event_id % 50, event_id % 3 FROM events) GROUP BY ALL
""")
def m6_expectation_totals_from_log(t: Tables) -> DataFrame:
    """Event-log rows whose details are nested JSON text with a list of rule results."""
    log = t.events.selectExpr("""to_json(named_struct('flow_progress', named_struct('data_quality', named_struct('expectations', array(
        named_struct('dataset', event_type, 'name', 'has_user', 'passed_records', event_id % 100, 'failed_records', event_id % 7),
        named_struct('dataset', event_type, 'name', 'in_range', 'passed_records', event_id % 50, 'failed_records', event_id % 3)))))) AS details""")
    return ob.expectation_totals(log)


@plan("""
WITH l AS (SELECT event_id // 500 AS update_id, ts AS happened_at, event_type AS flow, user_id AS rows FROM events)
SELECT update_id, flow, CAST(sum(rows) AS BIGINT) AS rows FROM l WHERE update_id = (SELECT max_by(update_id, happened_at) FROM l) GROUP BY ALL
""")
def m7_latest_update_rows(t: Tables) -> DataFrame:
    log = t.events.selectExpr("event_id DIV 500 AS update_id", "ts AS happened_at", "event_type AS flow", "user_id AS rows")
    return ob.latest_update_rows(log, at="happened_at")


@plan("""
WITH q AS (SELECT o_orderkey AS query_id, o_orderkey * 13 % 9000 AS millis, o_orderkey % 40 AS files_read, o_orderkey % 70 AS files_pruned, CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey * 1000 ELSE 0 END AS spilled, o_orderpriority AS statement FROM orders)
SELECT query_id, millis, round(CAST(100 AS DOUBLE) * files_pruned / nullif(files_pruned + files_read, 0), 2) AS pruned_pct, spilled FROM q WHERE (millis > 8000 OR spilled > 0) AND statement NOT LIKE '%LOW%'
""")
def m8_query_history(t: Tables) -> DataFrame:
    """All slow or spilling statements of a query log."""
    q = t.orders.selectExpr(
        "o_orderkey AS query_id", "o_orderkey * 13 % 9000 AS millis", "o_orderkey % 40 AS files_read", "o_orderkey % 70 AS files_pruned",
        "CASE WHEN o_orderkey % 11 = 0 THEN o_orderkey * 1000 ELSE 0 END AS spilled", "o_orderpriority AS statement",
    )
    slow = q.where("(millis > 8000 OR spilled > 0) AND statement NOT LIKE '%LOW%'")
    return slow.selectExpr("query_id", "millis", "round(100.0D * files_pruned / nullif(files_pruned + files_read, 0), 2) AS pruned_pct", "spilled")


@plan("""
WITH a AS (SELECT event_id, event_type AS action, 'table' || (user_id % 6) AS source, 'table' || (event_id % 6) AS target FROM events)
SELECT source, target, count(*) AS times, max(event_id) AS last_event FROM a WHERE source <> target AND action IN ('view', 'purchase') GROUP BY ALL
""")
def m9_lineage_and_audit(t: Tables) -> DataFrame:
    """Pairs of tables that data moved between, out of the audit rows of some actions."""
    audit = t.events.selectExpr("event_id", "event_type AS action", "concat('table', user_id % 6) AS source", "concat('table', event_id % 6) AS target")
    rows = audit.where("source <> target AND action IN ('view', 'purchase')")
    return rows.groupBy("source", "target").agg(F.count(F.lit(1)).alias("times"), F.max("event_id").alias("last_event"))
