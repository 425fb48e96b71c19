"""Cleaning and deduplication queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.functions.clean import code, describe, null_counts, parse_ts, profile, standardise
from lakekit.operators.windows import latest_per_key
from lakekit.plans.inputs import (
    CLEAN_SQL, COMPACT, ISO, KIND_SQL, READINGS_SQL, TAKEN_SQL, UNIT_SQL, VOLUME_SQL, clean_readings, parse_volume, readings,
)
from lakekit.plans.registry import plan
from lakekit.session import Tables

P = "WITH " + READINGS_SQL
C = "WITH " + CLEAN_SQL


@plan(P + f"SELECT {KIND_SQL} AS kind, {UNIT_SQL} AS unit, count(*) AS n FROM readings GROUP BY ALL")
def q1_standardise(t: Tables) -> DataFrame:
    return readings(t).groupBy(standardise("kind").alias("kind"), code("unit").alias("unit")).agg(F.count(F.lit(1)).alias("n"))


@plan(P + f"SELECT entry, shown AS raw, CAST({VOLUME_SQL} AS DOUBLE) AS volume FROM readings")
def q2_parse_amount(t: Tables) -> DataFrame:
    return readings(t).select("entry", F.col("shown").alias("raw"), parse_volume("shown").cast("double").alias("volume"))


@plan(P + f"SELECT entry, strftime({TAKEN_SQL}, '%Y-%m-%d %H:%M:%S') AS taken_at FROM readings")
def q3_parse_timestamp(t: Tables) -> DataFrame:
    return readings(t).select("entry", F.date_format(parse_ts("taken", ISO, COMPACT), "yyyy-MM-dd HH:mm:ss").alias("taken_at"))


@plan("""
SELECT c_custkey, coalesce(segment, 'UNKNOWN') AS segment, coalesce(balance, 0.0) AS balance
FROM (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'MACHINES' ELSE c_mktsegment END AS segment,
             CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer) WHERE segment IS NOT NULL OR balance IS NOT NULL
""")
def q4_fill_drop_replace(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_mktsegment END AS segment",
        "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance",
    )
    kept = rows.dropna(how="all", subset=["segment", "balance"])
    return kept.replace({"MACHINERY": "MACHINES"}, subset=["segment"]).fillna({"segment": "UNKNOWN", "balance": 0.0})


@plan(P + """
SELECT 'raw' AS step, count(*) AS n FROM readings
UNION ALL SELECT 'with_key', count(*) FROM readings WHERE reading_no IS NOT NULL
UNION ALL SELECT 'distinct', count(*) FROM (SELECT DISTINCT * FROM readings WHERE reading_no IS NOT NULL)
UNION ALL SELECT 'per_key', count(DISTINCT reading_no) FROM readings
""")
def q5_exact_dedup_steps(t: Tables) -> DataFrame:
    # ingest columns such as the file name are left out of the comparison, or no two rows would be equal
    rows = readings(t).withColumn("ingested_at", F.current_timestamp()).drop("ingested_at")
    keyed = rows.where("reading_no IS NOT NULL")
    steps = {
        "raw": rows, "with_key": keyed, "distinct": keyed.distinct(), "per_key": keyed.dropDuplicates(["reading_no"]),
    }
    out = None
    for name, df in steps.items():
        part = df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@plan(P + "SELECT DISTINCT reading_no, meter FROM readings WHERE reading_no IS NOT NULL")
def q6_dedup_by_key(t: Tables) -> DataFrame:
    return readings(t).where("reading_no IS NOT NULL").dropDuplicates(["reading_no"]).select("reading_no", "meter")


@plan(P + """
SELECT DISTINCT reading_no, state, revision FROM readings WHERE reading_no IS NOT NULL QUALIFY row_number() OVER (PARTITION BY reading_no ORDER BY revision DESC) = 1
""")
def q7_latest_per_key(t: Tables) -> DataFrame:
    rows = readings(t).where("reading_no IS NOT NULL")
    return latest_per_key(rows, ["reading_no"], ["revision"]).select("reading_no", "state", "revision")


@plan(P + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS nulls, count(DISTINCT {c}) AS "distinct", true AS approx_ok FROM readings"""
    for c in ("reading_no", "shown", "unit", "state")))
def q8_profile(t: Tables) -> DataFrame:
    out = profile(readings(t), ["reading_no", "shown", "unit", "state"])
    close = F.abs(F.col("approx_distinct") - F.col("distinct")) <= 0.15 * F.col("distinct")
    return out.withColumn("approx_ok", close).drop("approx_distinct")


@plan("""
SELECT 'o_orderkey' AS "column", count(*) AS "rows", 0 AS nulls FROM orders UNION ALL
SELECT 'cancelled', count(*), count(*) - count(CASE WHEN o_orderstatus = 'P' THEN 1 END) FROM orders
""")
def p9_null_counts(t: Tables) -> DataFrame:
    return null_counts(t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderstatus = 'P' THEN 1L END AS cancelled"))


_NUMBERS, _TEXTS = ("o_orderkey", "o_custkey", "o_totalprice"), ("o_orderstatus", "o_orderpriority")


@plan(" UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", count({c}) AS count, CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS stddev,
      CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS p50, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS p75, count(DISTINCT {c}) AS "distinct" FROM orders""" for c in _NUMBERS]
    + [f"SELECT '{c}', count({c}), min({c}), max({c}), NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}) FROM orders" for c in _TEXTS]
    + ["SELECT 'o_orderdate', count(o_orderdate), strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S'), strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), NULL, NULL, NULL, NULL, NULL, count(DISTINCT o_orderdate) FROM orders"]))
def p9_summary(t: Tables) -> DataFrame:
    """All columns of the orders: counts, extremes, moments and exact percentiles, from one pass over counted values."""
    return describe(t.orders).select("column", "count", "min", "max", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "p25", "p50", "p75", "distinct")


@plan(C + """
SELECT kind, unit, count(*) AS n, count(volume) AS with_volume, CAST(coalesce(sum(volume), 0) AS DOUBLE) AS total, count(taken_at) AS with_time FROM clean GROUP BY ALL
""")
def d13_bronze_to_silver_payments(t: Tables) -> DataFrame:
    """The name is that of the feed before; the rows are meter readings now."""
    return clean_readings(t).groupBy("kind", "unit").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("volume").alias("with_volume"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("double").alias("total"),
        F.count("taken_at").alias("with_time"),
    )
