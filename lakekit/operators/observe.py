"""Reports over run, event and audit logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.operators.windows import exact_quantiles, latest_per_key


def baselines(runs: DataFrame, before: Column, task: str = "task_key", seconds: str = "seconds", state: str = "state",
              bucket: Column | None = None) -> DataFrame:
    """Median duration of each task's earlier successful runs."""
    good = runs.where(before & (F.col(state) == "SUCCEEDED"))
    return exact_quantiles(good, [task], seconds, {"baseline": 0.5}, bucket)


def regressions(runs: DataFrame, base: DataFrame, task: str = "task_key", seconds: str = "seconds", factor: float = 1.5) -> DataFrame:
    """Runs slower than ``factor`` times their task's baseline; the baseline has one row per task."""
    joined = runs.join(base, task)
    ratio = F.col(seconds) / F.col("baseline")
    return joined.withColumn("ratio", F.round(ratio, 4)).where(ratio > factor)


def blockers(tasks: DataFrame, run: str = "run_id", task: str = "task_key", state: str = "state") -> DataFrame:
    """For each failed run the task that failed and how many tasks it kept from running."""
    failed = F.col(state) == "FAILED"
    return (
        tasks.groupBy(run)
        .agg(
            F.max_by(task, F.struct(failed, task)).alias("blocker"), F.count_if(failed).alias("failures"),
            F.count_if(F.col(state) == "UPSTREAM_FAILED").alias("victims"),
        )
        .where("failures > 0")
        .select(run, "blocker", "victims")
    )


def failure_rate(runs: DataFrame, state: str = "state") -> DataFrame:
    return runs.agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(F.col(state) == "FAILED").alias("failed"),
        F.round(F.lit(100.0) * F.count_if(F.col(state) == "FAILED") / F.count(F.lit(1)), 4).alias("failure_pct"),
    )


def timeline_summary(tasks: DataFrame, task: str = "task_key", seconds: str = "seconds", state: str = "state") -> DataFrame:
    """Executions, unsuccessful ones, median and longest successful duration per task."""
    counts = tasks.groupBy(task).agg(
        F.count(F.lit(1)).alias("executions"), F.count_if(F.col(state) != "SUCCEEDED").alias("not_succeeded"),
        F.max(F.when(F.col(state) == "SUCCEEDED", F.col(seconds))).alias("longest"),
    )
    median = exact_quantiles(tasks.where(F.col(state) == "SUCCEEDED"), [task], seconds, {"median": 0.5})
    return counts.join(median, task, "left")


def with_latest_names(timeline: DataFrame, names: DataFrame, key: str, changed_at: str) -> DataFrame:
    """Timeline with each job's newest name; the log of names has a row per change."""
    return timeline.join(latest_per_key(names, [key], [changed_at]).drop(changed_at), key, "left")


def job_health(slices: DataFrame, since: Column, job: str = "job_id", run: str = "run_id") -> DataFrame:
    """Share of unsuccessful runs and duration quantiles per job, from timeline slices that are first collapsed to runs.

    A slice's state is NULL while its run goes on; runs whose last slice has none are not finished and left out.
    """
    runs = (
        slices.where(F.col("start_at") >= since)
        .groupBy(job, run)
        .agg(F.max_by("state", "end_at").alias("state"), F.min("start_at").alias("first"), F.max("end_at").alias("last"))
        .where("state IS NOT NULL")
        .withColumn("seconds", F.unix_timestamp("last") - F.unix_timestamp("first"))
    )
    shares = runs.groupBy(job).agg(
        F.count(F.lit(1)).alias("runs"),
        F.round(F.lit(100.0) * F.count_if(F.col("state") != "SUCCEEDED") / F.count(F.lit(1)), 4).alias("failure_pct"),
    )
    quantiles = exact_quantiles(runs, [job], "seconds", {"p50": 0.5, "p90": 0.9})
    return shares.join(quantiles, job)


EXPECTATIONS = "ARRAY<STRUCT<dataset: STRING, name: STRING, passed_records: BIGINT, failed_records: BIGINT>>"


def expectation_totals(log: DataFrame, details: str = "details") -> DataFrame:
    """Passed and failed records per dataset and rule, out of the JSON details of event-log rows."""
    listed = F.from_json(F.get_json_object(details, "$.flow_progress.data_quality.expectations"), EXPECTATIONS)
    rows = log.select(F.explode(listed).alias("e")).select("e.*")
    return rows.groupBy("dataset", F.col("name").alias("rule")).agg(
        F.sum("passed_records").alias("passed"), F.sum("failed_records").alias("failed")
    )


def latest_update_rows(log: DataFrame, update: str = "update_id", at: str = "at", flow: str = "flow", rows: str = "rows") -> DataFrame:
    """Rows written per flow by the most recent update."""
    newest = log.agg(F.max_by(update, F.struct(at, update)).alias("u")).scalar()
    return log.where(F.col(update) == newest).groupBy(update, flow).agg(F.sum(rows).alias(rows))
