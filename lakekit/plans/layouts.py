"""Partitioning, skew and file layout queries."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators import layout as lay
from lakekit.operators.aggregates import share_of_total
from lakekit.operators.snapshots import SnapshotTable
from lakekit.plans.joins import skewed_events
from lakekit.plans.registry import plan
from lakekit.session import Tables, stored, work_path

D = "decimal(18,2)"


@plan("""
SELECT 'repartition' AS step, count(*) AS rows, CAST(12 AS BIGINT) AS partitions FROM orders UNION ALL SELECT 'by column', count(*), 12 FROM orders UNION ALL SELECT 'coalesce', count(*), 3 FROM orders
UNION ALL SELECT 'coalesce up', count(*), 12 FROM orders
""")
def l1_repartition_and_coalesce(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey").repartition(12)
    steps = {"repartition": rows, "by column": t.orders.repartition(12, "o_orderkey"), "coalesce": rows.coalesce(3), "coalesce up": rows.coalesce(50)}
    out = None
    for name, df in steps.items():
        part = lay.partition_rows(df).agg(F.lit(name).alias("step"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("partitions"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT count(*) AS rows, true AS even FROM lineitem")
def l2_rows_per_partition(t: Tables) -> DataFrame:
    counts = lay.partition_rows(t.lineitem.select("l_orderkey").repartition(16))
    return counts.agg(F.sum("rows").alias("rows"), (F.max("rows") - F.min("rows") <= 0.1 * F.max("rows")).alias("even"))


@plan("""
WITH c AS (SELECT u % 16 AS bucket, count(*) AS rows FROM (SELECT CASE WHEN event_id % 10 < 3 THEN 0 ELSE user_id END AS u FROM events) GROUP BY 1)
SELECT count(*) AS groups, min(rows) AS least, quantile_cont(rows, 0.25) AS p25, quantile_cont(rows, 0.5) AS median, quantile_cont(rows, 0.75) AS p75, max(rows) AS most,
  round(max(rows) / sum(rows), 8) AS largest_share, max(rows) > 1.5 * quantile_cont(rows, 0.75) AS skewed FROM c
""")
def l3_skew_report(t: Tables) -> DataFrame:
    counts = skewed_events(t).groupBy((F.col("user_id") % 16).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    return lay.skew_report(counts).withColumn("largest_share", F.round("largest_share", 8))


@plan("""
SELECT u AS user_id, count(*) AS rows, round(count(*) / (SELECT count(*) FROM events), 6) AS share FROM (SELECT CASE WHEN event_id % 10 < 3 THEN 0 ELSE user_id END AS u FROM events) GROUP BY 1
""")
def l4_hot_key_report(t: Tables) -> DataFrame:
    return share_of_total(skewed_events(t), ["user_id"], "rows", "share")


def _small_files(t: Tables) -> SnapshotTable:
    table = SnapshotTable(t.spark, work_path(t.spark, "small-files"))
    for i in range(6):
        table.append(t.orders.where(f"o_orderkey % 6 = {i}").select("o_orderkey", "o_totalprice").repartition(5))
    return table


@plan("""
SELECT CAST(30 AS BIGINT) AS files_before, true AS fewer_after, true AS second_run_idle, count(*) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders
""")
def l5_compaction(t: Tables) -> DataFrame:
    table = _small_files(t)
    first, second = lay.compact(table), lay.compact(table)
    return table.read().agg(
        F.lit(first["rewritten"]).cast("bigint").alias("files_before"), F.lit(first["written"] < first["rewritten"]).alias("fewer_after"),
        F.lit(second["rewritten"] == 0).alias("second_run_idle"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("o_totalprice").cast(D)).cast("double").alias("total"),
    )


@plan("""
SELECT c AS "column", CAST(64 AS BIGINT) AS plain_files, CAST(8 AS BIGINT) AS ideal_files, CAST(0 AS BIGINT) AS files_over_three_times_ideal, (SELECT count(*) FROM lineitem) AS rows,
  CASE c WHEN 'l_partkey' THEN (SELECT count(*) FROM lineitem WHERE l_partkey = (SELECT max(l_partkey) // 3 FROM lineitem)) ELSE (SELECT count(*) FROM lineitem WHERE l_suppkey = (SELECT max(l_suppkey) // 3 FROM lineitem)) END AS found
FROM (VALUES ('l_partkey'), ('l_suppkey')) AS v(c)
""")
def l6_clustering(t: Tables) -> DataFrame:
    """Files that a filter on one value must read, before and after laying the rows out on a Z-order curve over two columns.

    A square grid of 64 files has 8 in a row, so a filter on one column reads 8 at best."""
    base, columns = work_path(t.spark, "clustered"), ["l_partkey", "l_suppkey"]
    rows = t.lineitem.select("l_orderkey", *columns)
    rows.repartition(64).write.parquet(f"{base}/plain")
    lay.cluster_by(rows, columns, 64).write.parquet(f"{base}/clustered")
    zones = {kind: lay.ZoneMap(t.spark, f"{base}/zones-{kind}") for kind in ("plain", "clustered")}
    for kind, z in zones.items():
        z.build(t.spark.read.parquet(f"{base}/{kind}"), columns)
    out = None
    for c in columns:
        at = zones["plain"].zones().agg(F.floor(F.max(f"{c}_max") / 3)).first()[0]
        needed, ideal = len(zones["clustered"].files(**{c: (at, at)})), 8
        part = zones["clustered"].read(rows.schema, **{c: (at, at)}).agg(
            F.lit(c).alias("column"), F.lit(len(zones["plain"].files(**{c: (at, at)}))).cast("bigint").alias("plain_files"), F.lit(ideal).cast("bigint").alias("ideal_files"),
            F.lit(max(0, needed - 3 * ideal)).cast("bigint").alias("files_over_three_times_ideal"), zones["clustered"].zones().agg(F.sum("rows")).scalar().alias("rows"),
            F.count(F.lit(1)).alias("found"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT CAST(2 AS BIGINT) AS first_folders, CAST(1 AS BIGINT) AS second_folders, CAST(0 AS BIGINT) AS third_folders, CAST(1 AS BIGINT) AS after_compaction, count(*) AS rows FROM orders
""")
def l7_incremental_clustering(t: Tables) -> DataFrame:
    """Only folders added since the last call are clustered again, a compaction in between or not."""
    table = SnapshotTable(t.spark, work_path(t.spark, "incremental-cluster"))

    def land(i: int) -> None:
        table.append(t.orders.where(f"o_orderkey % 4 = {i}").select("o_orderkey", "o_custkey").repartition(3))

    done = []
    for i in range(3):
        land(i)
        if i:
            done.append(lay.cluster_new(table, ["o_custkey"])["rewritten_folders"])
    done.append(lay.cluster_new(table, ["o_custkey"])["rewritten_folders"])
    land(3)
    lay.compact(table)
    done.append(lay.cluster_new(table, ["o_custkey"])["rewritten_folders"])
    names = ("first_folders", "second_folders", "third_folders", "after_compaction")
    return table.read().agg(*[F.lit(n).cast("bigint").alias(c) for c, n in zip(names, done, strict=True)], F.count(F.lit(1)).alias("rows"))


@plan("""
SELECT count(*) AS rows, CAST(8 AS BIGINT) AS files, CAST(1 AS BIGINT) AS needed_by_one_key, CAST(8 AS BIGINT) AS needed_by_all, min(o_orderkey) AS least, max(o_orderkey) AS greatest,
  count(*) FILTER (WHERE o_orderkey % 9 = 0) AS nulls FROM orders
""")
def l8_file_ranges(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "ranges")
    rows = t.orders.select("o_orderkey", F.expr("CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END").alias("price"))
    lay.cluster_by(rows, ["o_orderkey"], 8).write.parquet(folder)
    ranges = lay.file_ranges(t.spark.read.parquet(folder), ["o_orderkey", "price"])
    first = t.orders.agg(F.min("o_orderkey")).first()[0]
    needed = lambda low, high: lay.files_needed(ranges, "o_orderkey", low, high).select("needed").scalar()
    return ranges.agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), needed(first, first).alias("needed_by_one_key"), needed(None, None).alias("needed_by_all"),
        F.min("o_orderkey_min").alias("least"), F.max("o_orderkey_max").alias("greatest"), F.sum("price_nulls").alias("nulls"))


@plan("""
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, o_totalprice FROM orders), m AS (SELECT min(day) + 400 AS day FROM d)
SELECT 'zones' AS layout, count(*) AS rows, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total, CAST(0 AS BIGINT) AS files_over_two_percent FROM d SEMI JOIN m USING (day)
UNION ALL SELECT 'folders', count(*), CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE), CAST(0 AS BIGINT) FROM d SEMI JOIN m USING (day)
""")
def l9_files_of_one_day(t: Tables) -> DataFrame:
    """A filter on one day over 200 files in order of the day, picked by their zones, and over a folder per day: in both it opens under 2 % of the files."""
    base = work_path(t.spark, "days")
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").cast(D).alias("price"))
    day = rows.agg(F.date_add(F.min("day"), 400)).first()[0]
    lay.cluster_by(rows, ["day"], 200).write.parquet(f"{base}/ordered")
    lay.write_partitioned(rows, f"{base}/folders", ["day"])
    zones = lay.ZoneMap(t.spark, f"{base}/zones")
    zones.build(t.spark.read.parquet(f"{base}/ordered"), ["day"])
    folders = t.spark.read.parquet(f"{base}/folders")
    chosen = {"zones": (zones.read(rows.schema, day=(day, day)), zones.zones().count()),
              "folders": (folders.where(F.col("day") == F.lit(day)), folders.select("_metadata.file_path").distinct().count())}
    out = None
    for layout, (found, files) in chosen.items():
        opened = len(zones.files(day=(day, day))) if layout == "zones" else found.select("_metadata.file_path").distinct().count()
        part = found.agg(F.lit(layout).alias("layout"), F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("price"), F.lit(0)).cast("double").alias("total"),
                         F.lit(max(0, opened - files * 2 // 100)).cast("bigint").alias("files_over_two_percent"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) AS folders, true AS tiny_files, count(*) FILTER (WHERE strftime(o_orderdate, '%Y-%m') = '1997-03') AS month_rows FROM orders
""")
def l9_partition_pruning(t: Tables) -> DataFrame:
    """One folder per month: a month's filter reads one folder, but at this size every file is tiny."""
    folder = work_path(t.spark, "by-month")
    lay.write_partitioned(t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM")), folder, ["month"])
    rows = t.spark.read.parquet(folder)
    month = rows.where("month = '1997-03'").agg(F.count(F.lit(1)).alias("n")).scalar()
    tiny = lay.layout_summary(t.spark, folder).select("tiny_files").scalar()
    return rows.agg(F.count_distinct("month").alias("folders"), tiny.alias("tiny_files"), month.alias("month_rows"))


@plan("SELECT count(*) AS rows, true AS statistics_known FROM customer")
def l11_table_statistics(t: Tables) -> DataFrame:
    """Statistics for the cost model, kept with the table."""
    name, folder = f"lakekit_l11_{uuid.uuid4().hex[:8]}", work_path(t.spark, "stats")
    t.customer.write.format("parquet").option("path", folder).saveAsTable(name)
    t.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS c_custkey, c_acctbal")
    known = t.spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Statistics' AND data_type LIKE '%rows%'")
    n = known.agg((F.count(F.lit(1)) > 0).alias("k")).scalar()
    return t.spark.table(name).agg(F.count(F.lit(1)).alias("rows"), n.alias("statistics_known"))


@plan("""
SELECT 'F' AS status, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'P', count(*) FROM orders WHERE o_orderstatus = 'P'
""")
def l13_cached_twice_used(t: Tables) -> DataFrame:
    """A frame used by two branches is persisted on disk and memory; losing an executor only recomputes its part."""
    from pyspark import StorageLevel

    rows = t.orders.select("o_orderstatus").persist(StorageLevel.MEMORY_AND_DISK)
    out = None
    for s in ("F", "P"):
        part = rows.where(F.col("o_orderstatus") == s).agg(F.lit(s).alias("status"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    out = stored(out, "cached-twice")  # used twice by now
    rows.unpersist()
    return out


@plan("SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1 ORDER BY lines DESC, l_orderkey LIMIT 20")
def l14_small_results_only(t: Tables) -> DataFrame:
    """Aggregate and limit on the executors: what a driver may fetch."""
    return t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines")).orderBy(F.desc("lines"), "l_orderkey").limit(20)
