"""Sink queries: write modes, table statements and timing sinks."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.layout import hashed_timing, write_partitioned
from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import enforce_schema
from lakekit.plans.registry import plan
from lakekit.session import settings, stored, Tables, work_path


@plan("SELECT 'append' AS mode, 2 * count(*) AS n FROM supplier UNION ALL SELECT 'overwrite', count(*) FROM supplier UNION ALL SELECT 'ignore', count(*) FROM supplier UNION ALL SELECT 'errorifexists', count(*) FROM supplier")
def k1_save_modes(t: Tables) -> DataFrame:
    """Each mode on a folder that already holds the table; the default mode refuses and leaves it as it was."""
    out = None
    for mode in ("append", "overwrite", "ignore", "errorifexists"):
        folder = work_path(t.spark, f"mode-{mode}")
        t.supplier.write.parquet(folder)
        try:
            t.supplier.write.mode(mode).parquet(folder)
        except Exception as e:
            if mode != "errorifexists" or "PATH_ALREADY_EXISTS" not in str(e):
                raise
        part = t.spark.read.parquet(folder).agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def _table(t: Tables, kind: str) -> tuple[str, str]:
    return f"lakekit_{kind}_{uuid.uuid4().hex[:8]}", work_path(t.spark, kind)


@plan("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def k2_create_table_as(t: Tables) -> DataFrame:
    """The second statement finds the table there and does nothing."""
    name, folder = _table(t, "ctas")
    t.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}' AS SELECT * FROM {{o}}", o=t.orders)
    t.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet AS SELECT * FROM {{o}} WHERE false", o=t.orders)
    out = t.spark.table(name).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    t.spark.sql(f"DROP TABLE {name}")  # the files at its location stay
    return out


@plan("SELECT CAST(n_nationkey AS BIGINT) AS a, CAST(n_regionkey AS BIGINT) AS b, way FROM nation, (VALUES ('position'), ('name'), ('insertInto')) AS v(way)")
def k3_insert_into(t: Tables) -> DataFrame:
    """By position, by name with the columns swapped, and with the writer (by position)."""
    name, folder = _table(t, "insert")
    t.spark.sql(f"CREATE TABLE {name} (a BIGINT, b BIGINT, way STRING) USING parquet LOCATION '{folder}'")
    t.spark.sql(f"INSERT INTO {name} SELECT n_nationkey, n_regionkey, 'position' FROM {{n}}", n=t.nation)
    t.spark.sql(f"INSERT INTO {name} BY NAME SELECT 'name' AS way, n_regionkey AS b, n_nationkey AS a FROM {{n}}", n=t.nation)
    t.nation.selectExpr("CAST(n_nationkey AS BIGINT)", "CAST(n_regionkey AS BIGINT)", "'insertInto'").write.insertInto(name)
    return t.spark.table(name)


@plan("SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 1")
def k4_insert_overwrite(t: Tables) -> DataFrame:
    """Content replaced, schema kept: the new rows are checked against it first."""
    name, folder = _table(t, "overwrite")
    t.customer.select("c_custkey", "c_acctbal").write.format("parquet").option("path", folder).saveAsTable(name)
    new = t.customer.where("c_custkey % 2 = 1").select("c_custkey", "c_acctbal")
    enforce_schema(new, t.spark.table(name).schema).write.insertInto(name, overwrite=True)
    return t.spark.table(name)


@plan("SELECT strftime(o_orderdate, '%Y') AS y, count(*) AS n, CASE WHEN year(o_orderdate) = 1997 THEN 'new' ELSE 'old' END AS origin FROM orders WHERE NOT (year(o_orderdate) = 1997 AND o_orderkey % 2 = 0) GROUP BY ALL")
def k5_dynamic_partition_overwrite(t: Tables) -> DataFrame:
    """Selective overwrite along partitions: only the folders that the new rows fall into are replaced."""
    folder = work_path(t.spark, "dynamic")
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy").alias("y"))
    write_partitioned(rows.withColumn("origin", F.lit("old")), folder, ["y"])
    with settings(t.spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        write_partitioned(rows.where("y = '1997' AND o_orderkey % 2 = 1").withColumn("origin", F.lit("new")), folder, ["y"], "overwrite")
    return t.spark.read.parquet(folder).groupBy(F.col("y").cast("string").alias("y"), "origin").agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT o_orderstatus, count(*) AS n, true AS one_folder_each FROM orders GROUP BY 1")
def k6_partitioned_write(t: Tables) -> DataFrame:
    folder = work_path(t.spark, "partitioned")
    write_partitioned(t.orders.select("o_orderkey", "o_orderstatus"), folder, ["o_orderstatus"])
    rows = t.spark.read.parquet(folder).select("o_orderstatus", F.col("_metadata.file_path").alias("file"))
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.contains("file", F.concat(F.lit("/o_orderstatus="), "o_orderstatus"))).alias("one_folder_each")
    )


@plan("SELECT count(*) AS rows, true AS evaluated FROM lineitem")
def k7_noop_and_hash(t: Tables) -> DataFrame:
    """Full evaluation without a result: the noop sink, and a hash over all columns."""
    t.lineitem.write.format("noop").mode("overwrite").save()
    return hashed_timing(t.lineitem).select("rows", F.col("hash").isNotNull().alias("evaluated"))


@plan("SELECT 'folder' AS sink, count(*) AS n FROM orders UNION ALL SELECT 'table', count(*) FROM orders UNION ALL SELECT 'batches', count(*) FROM orders UNION ALL SELECT 'noop', 0 UNION ALL SELECT 'memory', count(*) FROM orders")
def k8_stream_sinks(t: Tables) -> DataFrame:
    from lakekit.streaming.runs import append_to, batch_key, file_stream, run_to_end

    base, name = work_path(t.spark, "sinks"), f"lakekit_k8_{uuid.uuid4().hex[:8]}"
    t.orders.select("o_orderkey", "o_totalprice").write.parquet(f"{base}/in")
    schema = "o_orderkey BIGINT, o_totalprice DOUBLE"
    rows = file_stream(t.spark, f"{base}/in", schema)
    append_to(rows, f"{base}/folder", f"{base}/c1")
    query = rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/c2").option("path", f"{base}/table").trigger(availableNow=True).toTable(name)
    query.awaitTermination()
    table = SnapshotTable(t.spark, f"{base}/batches")
    run_to_end(rows.writeStream.option("checkpointLocation", f"{base}/c3").foreachBatch(lambda b, n: table.append(b, batch=batch_key(b, n)) and None))
    run_to_end(rows.writeStream.format("noop").option("checkpointLocation", f"{base}/c4"))
    # the memory sink keeps its rows in the driver: for a handful of totals only
    totals = rows.groupBy().agg(F.count(F.lit(1)).alias("n")).writeStream.format("memory").queryName(f"{name}_totals").outputMode("complete")
    run_to_end(totals.option("checkpointLocation", f"{base}/c5"))
    memory = stored(t.spark.table(f"{name}_totals").select(F.lit("memory").alias("sink"), "n"), "memory-sink")
    t.spark.catalog.dropTempView(f"{name}_totals")
    results = {"folder": t.spark.read.parquet(f"{base}/folder"), "table": t.spark.table(name), "batches": table.read(), "noop": rows_none(t, schema)}
    out = None
    for sink, df in results.items():
        part = df.agg(F.lit(sink).alias("sink"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out.unionByName(memory)


def rows_none(t: Tables, schema: str) -> DataFrame:
    return t.spark.createDataFrame([], schema)


@plan("SELECT 'load orders' AS task, CAST(attempt AS BIGINT) AS attempt, CASE attempt WHEN 1 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, CASE attempt WHEN 1 THEN 0 ELSE (SELECT count(*) FROM orders) END AS rows FROM (VALUES (1), (2)) AS v(attempt)")
def k9_audit_log(t: Tables) -> DataFrame:
    """One row per attempt, also for the one that fails."""
    from lakekit.operators.audit import AuditLog

    log = AuditLog(t.spark, f"{work_path(t.spark, 'audit')}/log")
    written = t.orders.agg(F.count(F.lit(1)).alias("n"))
    for attempt in (1, 2):
        with log.attempt("load orders", attempt, swallow=True) as entry:
            if attempt == 1:
                raise ConnectionError("source not reachable")
            entry["rows"] = written.first()["n"]
    return log.read().select("task", "attempt", "status", "rows")
