"""Streaming queries. Deliveries are landed as files and processed run by run with one checkpoint, so what counts as late
depends on the delivery and not on how Spark happens to order files."""

import time
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import apply_feed, change_feed, matched_update, not_matched_insert, update
from lakekit.plans.registry import plan
from lakekit.plans.table_changes import target
from lakekit.session import Tables, settings, work_path
from lakekit.streaming.changes import SourceChanged, follow_table, stream_from_now_on
from lakekit.streaming.medallion import EventMedallion
from lakekit.streaming.runs import append_to, batch_key, file_stream, replace_table, rows_read, run_to_end, upsert_table
from lakekit.streaming.state import running_totals, visits

D = "decimal(18,2)"
SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE"


def _events(t: Tables, where: str = "true") -> DataFrame:
    return t.events.where(where).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


class _Deliveries:
    """A folder that gets events in steps, with the places a stream over it needs."""

    def __init__(self, t: Tables):
        self.t, self.base = t, work_path(t.spark, "stream")
        self.folder, self.steps = f"{self.base}/in", 0

    def land(self, rows: DataFrame, fmt: str = "parquet") -> None:
        self.steps += 1
        rows.write.format(fmt).save(f"{self.folder}/step{self.steps}")

    def stream(self, fmt: str = "parquet") -> DataFrame:
        return file_stream(self.t.spark, self.folder, SCHEMA, fmt, recursiveFileLookup="true")

    def place(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.t.spark, self.place(name))


@plan("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, event_type, true AS has_lineage FROM events")
def r1_bronze_stream(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    d.land(_events(t), "json")
    rows = d.stream("json").select("*", F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("ingested_at"))
    append_to(rows, d.place("bronze"), d.place("checkpoint"))
    lineage = F.col("source_file").isNotNull() & F.col("ingested_at").isNotNull()
    return t.spark.read.parquet(d.place("bronze")).select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type", lineage.alias("has_lineage")
    )


@plan("SELECT event_id, user_id, round(value * 100, 0) AS cents FROM events WHERE event_type = 'purchase' OR event_type = 'click'")
def r2_table_to_table(t: Tables) -> DataFrame:
    """Bronze folder read as a stream, filtered and derived into silver, in two runs."""
    d = _Deliveries(t)
    for half in (0, 1):
        d.land(_events(t, f"event_id % 2 = {half}"))
        silver = d.stream().where("event_type IN ('purchase', 'click')").select("event_id", "user_id", F.round(F.col("value") * 100, 0).alias("cents"))
        append_to(silver, d.place("silver"), d.place("checkpoint"))
    return t.spark.read.parquet(d.place("silver"))


@plan("SELECT 'available_now' AS trigger, count(*) AS n FROM events UNION ALL SELECT 'micro_batches', count(*) FROM events UNION ALL SELECT 'once', count(*) FROM events UNION ALL SELECT 'processing_time', count(*) FROM events")
def r3_triggers(t: Tables) -> DataFrame:
    """All at once, one file per batch, in one single batch, and on a clock until nothing is left."""
    d = _Deliveries(t)
    d.land(_events(t, "event_id % 2 = 0"))
    d.land(_events(t, "event_id % 2 = 1"))
    out = None
    for name, options in (("available_now", {}), ("micro_batches", {"maxFilesPerTrigger": 1})):
        rows = file_stream(t.spark, d.folder, SCHEMA, recursiveFileLookup="true", **options)
        append_to(rows, d.place(name), d.place(f"{name}-checkpoint"))
    for name, trigger in (("once", {"once": True}), ("processing_time", {"processingTime": "1 second"})):
        rows = file_stream(t.spark, d.folder, SCHEMA, recursiveFileLookup="true")
        query = rows.writeStream.format("parquet").option("checkpointLocation", d.place(f"{name}-checkpoint")).option("path", d.place(name)).trigger(**trigger).start()
        query.processAllAvailable() if name == "processing_time" else query.awaitTermination()
        query.stop()
    for name in ("available_now", "micro_batches", "once", "processing_time"):
        part = t.spark.read.parquet(d.place(name)).agg(F.lit(name).alias("trigger"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


_BY_TYPE = "SELECT event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1"


def _by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(D)).alias("total"))


@plan(f"SELECT 'complete' AS mode, * FROM ({_BY_TYPE}) UNION ALL SELECT 'update', * FROM ({_BY_TYPE}) UNION ALL SELECT 'append', * FROM ({_BY_TYPE})")
def r4_output_modes(t: Tables) -> DataFrame:
    """Complete republishes all groups, update merges changed groups, append adds rows that are aggregated when read."""
    d = _Deliveries(t)
    for half in (0, 1):
        d.land(_events(t, f"event_id % 2 = {half}"))
        replace_table(_by_type(d.stream()), d.table("complete"), d.place("c1"))
        upsert_table(_by_type(d.stream()), d.table("update"), d.place("c2"), ["event_type"], [matched_update("*"), not_matched_insert("*")], mode="update")
        append_to(d.stream(), d.place("append"), d.place("c3"))
    results = {"complete": d.table("complete").read(), "update": d.table("update").read(), "append": _by_type(t.spark.read.parquet(d.place("append")))}
    out = None
    for mode, df in results.items():
        part = df.select(F.lit(mode).alias("mode"), "event_type", "n", F.col("total").cast("double").alias("total"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1")
def r5_sql_on_a_stream(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    d.land(_events(t))
    d.stream().createOrReplaceTempView("lakekit_r5_events")
    errors = t.spark.sql("SELECT user_id, count(*) AS n FROM lakekit_r5_events WHERE event_type = 'error' GROUP BY 1")
    replace_table(errors, d.table("errors"), d.place("checkpoint"))
    return d.table("errors").read()


def _window_rows(df: DataFrame) -> DataFrame:
    return df.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start_at"), "event_type", "n")


@plan("SELECT strftime(time_bucket(INTERVAL 30 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS start_at, event_type, count(*) AS n FROM events GROUP BY ALL")
def r6_tumbling_window(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    d.land(_events(t))
    counts = d.stream().groupBy(F.window("ts", "30 minutes"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    replace_table(counts, d.table("counts"), d.place("checkpoint"))
    return _window_rows(d.table("counts").read())


@plan("""
WITH w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(CAST(10 * i AS INTEGER)) AS start_at, event_type FROM events, generate_series(0, 2) AS s(i))
SELECT strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_at, event_type, count(*) AS n FROM w
WHERE start_at + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY ALL
""")
def r7_sliding_window(t: Tables) -> DataFrame:
    """Append mode: only windows that the watermark has closed are there."""
    d = _Deliveries(t)
    d.land(_events(t))
    rows = d.stream().withWatermark("ts", "1 hour")
    counts = rows.groupBy(F.window("ts", "30 minutes", "10 minutes"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    append_to(counts, d.place("counts"), d.place("checkpoint"))
    return _window_rows(t.spark.read.parquet(d.place("counts")))


@plan("""
WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_at, count(*) AS n FROM s GROUP BY user_id, sid
HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
""")
def r8_session_window(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    d.land(_events(t))
    sessions = (
        d.stream().withWatermark("ts", "1 hour")
        .groupBy("user_id", F.session_window("ts", "6 hours").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    )
    # sessions are merged inside each task before the shuffle, so a busy user sends few rows
    with settings(t.spark, spark__sql__streaming__sessionWindow__merge__sessions__in__local__partition="true"):
        append_to(sessions, d.place("sessions"), d.place("checkpoint"))
    return t.spark.read.parquet(d.place("sessions")).select("user_id", F.date_format("s.start", "yyyy-MM-dd HH:mm:ss").alias("start_at"), "n")


# events of the first twenty days whose number ends in 7 arrive in a second delivery, long after the watermark
_LATE = "event_id % 50 = 7 AND ts < timestamp_ntz'2024-01-20'"
_LATE_SQL = "event_id % 50 = 7 AND ts < TIMESTAMP '2024-01-20'"
_CLOSED = "time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _late(t: Tables, apply) -> _Deliveries:
    d = _Deliveries(t)
    for part in (f"NOT ({_LATE})", _LATE):
        d.land(_events(t, part))
        apply(d)
    return d


def _daily(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.window("ts", "1 day")).agg(F.count(F.lit(1)).alias("n"))


def _append_daily(d: _Deliveries) -> None:
    append_to(_daily(d.stream().withWatermark("ts", "1 hour")), d.place("append"), d.place("c-append"))


@plan(f"SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE NOT ({_LATE_SQL}) AND {_CLOSED} GROUP BY 1")
def r9_watermark_drops_late_rows(t: Tables) -> DataFrame:
    d = _late(t, _append_daily)
    return t.spark.read.parquet(d.place("append")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")


@plan(f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS complete, coalesce(nullif(count(*) FILTER (WHERE {_CLOSED} AND NOT ({_LATE_SQL})), 0), -1) AS appended FROM events GROUP BY 1
""")
def r10_complete_versus_append(t: Tables) -> DataFrame:
    def both(d: _Deliveries) -> None:
        _append_daily(d)
        replace_table(_daily(d.stream()), d.table("complete"), d.place("c-complete"))

    d = _late(t, both)
    appended = t.spark.read.parquet(d.place("append")).select("window", F.col("n").alias("appended"))
    full = d.table("complete").read().select("window", F.col("n").alias("complete"))
    return full.join(appended, "window", "left").select(
        F.date_format("window.start", "yyyy-MM-dd").alias("day"), "complete", F.coalesce("appended", F.lit(-1)).alias("appended")
    )


@plan("SELECT kind, event_id, event_type FROM events, (VALUES ('within_watermark'), ('with_time'), ('unbounded')) AS v(kind)")
def r11_streaming_dedup(t: Tables) -> DataFrame:
    """Every third event is sent again in the same hour; all three ways of bounding the state remove the copies."""
    d = _Deliveries(t)
    again = _events(t, "event_id % 3 = 0")
    d.land(_events(t).unionByName(again))
    s = d.stream()
    ways = {
        "within_watermark": s.withWatermark("ts", "1 hour").dropDuplicatesWithinWatermark(["event_id"]),
        "with_time": s.withWatermark("ts", "1 hour").dropDuplicates(["event_id", "ts"]),
        "unbounded": s.dropDuplicates(["event_id"]),
    }
    out = None
    for kind, rows in ways.items():
        append_to(rows, d.place(kind), d.place(f"c-{kind}"))
        part = t.spark.read.parquet(d.place(kind)).select(F.lit(kind).alias("kind"), "event_id", "event_type")
        out = part if out is None else out.unionByName(part)
    return out


@plan("SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, max(event_id) AS last_event FROM events GROUP BY 1")
def r12_foreach_batch_upsert(t: Tables) -> DataFrame:
    """Running totals merged batch by batch. The second half comes through a new checkpoint, whose batches have the numbers of
    the first again and still count; running that checkpoint once more adds nothing."""
    d = _Deliveries(t)

    def totals(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast(D)).cast("decimal(28,2)").alias("total"), F.max("event_id").alias("last_event")
        )

    clauses = [
        matched_update({"n": "t.n + s.n", "total": "t.total + s.total", "last_event": "greatest(t.last_event, s.last_event)"}),
        not_matched_insert("*"),
    ]
    d.land(_events(t, "event_id % 2 = 0"))
    upsert_table(d.stream(), d.table("totals"), d.place("checkpoint"), ["user_id"], clauses, totals)
    later = _Deliveries(t)
    later.land(_events(t, "event_id % 2 = 1"))
    for _ in range(2):
        upsert_table(later.stream(), d.table("totals"), later.place("checkpoint"), ["user_id"], clauses, totals)
    return d.table("totals").read().select("user_id", "n", F.col("total").cast("double").alias("total"), "last_event")


@plan("""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
WHERE time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY <= (SELECT min(m) FROM (SELECT max(ts) - CASE WHEN event_type = 'click' THEN INTERVAL 3 DAY ELSE INTERVAL 1 HOUR END AS m FROM events GROUP BY event_type = 'click', event_type)) GROUP BY 1
""")
def r14_multiple_watermarks(t: Tables) -> DataFrame:
    """Two streams with different delays united: the slower one decides when a window is final."""
    d = _Deliveries(t)
    d.land(_events(t))
    clicks = d.stream().where("event_type = 'click'").withWatermark("ts", "3 days")
    others = d.stream().where("event_type <> 'click'").withWatermark("ts", "1 hour")
    append_to(_daily(clicks.unionByName(others)), d.place("daily"), d.place("checkpoint"))
    return t.spark.read.parquet(d.place("daily")).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")


@plan("SELECT user_id, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS total FROM events GROUP BY 1")
def r15_custom_state(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    table = d.table("state")
    for half in (0, 1):
        d.land(_events(t, f"event_id % 2 = {half}"))
        upsert_table(
            running_totals(d.stream(), "user_id", "event_id"), table, d.place("checkpoint"), ["user_id"],
            [matched_update("*"), not_matched_insert("*")], mode="update",
        )
    return table.read().select("user_id", "n", "total")


@plan("""
WITH e AS (SELECT concat(user_id, ':', event_type) AS visitor, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS kind, epoch_us(ts) // 1000 AS tm, event_id FROM events),
     g AS (SELECT *, coalesce(CAST(tm - lag(tm) OVER w > 10 * 86400000 AS INT), 0) AS fresh FROM e WINDOW w AS (PARTITION BY visitor ORDER BY tm, event_id)),
     v AS (SELECT *, sum(fresh) OVER (PARTITION BY visitor ORDER BY tm, event_id ROWS UNBOUNDED PRECEDING) AS visit FROM g),
     s AS (SELECT visitor, visit, count(*) AS n, min(tm) AS first, max(tm) AS last, count(DISTINCT kind) AS kinds FROM v GROUP BY 1, 2)
SELECT visitor, n, first, last, kinds FROM s WHERE last + 10 * 86400000 <= (SELECT max(tm) - 60000 FROM e) OR visit < (SELECT max(visit) FROM s AS o WHERE o.visitor = s.visitor)
""")
def r15_visits_with_timers(t: Tables) -> DataFrame:
    """Visits that end ten days after their last row, by event-time timers over value and map state; deliveries of ten days in turn,
    so rows within one never lie further apart than the gap."""
    d = _Deliveries(t)
    rows = _events(t).select(F.concat_ws(":", "user_id", "event_type").alias("visitor"), F.expr("CASE WHEN value > 50 THEN 'high' ELSE 'low' END").alias("kind"), F.col("ts").alias("at"))
    first, last = rows.agg(F.date_trunc("day", F.min("at")), F.max("at")).first()
    schema = "visitor STRING, kind STRING, at TIMESTAMP"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    start = first
    # one state store per core: their number is fixed by a stream's first batch
    cores = str(t.spark.sparkContext.defaultParallelism)
    with settings(t.spark, spark__sql__streaming__stateStore__providerClass=rocks, spark__sql__shuffle__partitions=cores):
        while start <= last:
            end = start + timedelta(days=10)
            d.land(rows.where((F.col("at") >= F.lit(start)) & (F.col("at") < F.lit(end))))
            stream = file_stream(t.spark, d.folder, schema, recursiveFileLookup="true").withWatermark("at", "1 minute")
            append_to(visits(stream, "visitor", "kind", "at", 10 * 86_400_000), d.place("visits"), d.place("checkpoint"))
            start = end
    return t.spark.read.parquet(d.place("visits")).select("visitor", "n", "first", "last", "kinds")


@plan("""
SELECT mode, CASE WHEN mode = 'skip' THEN (SELECT count(*) FROM customer) ELSE (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0) END AS rows,
  CASE WHEN mode = 'skip' THEN 0 ELSE 1 END AS stops FROM (VALUES ('block'), ('skip')) AS v(mode)
""")
def r16_source_with_changes(t: Tables) -> DataFrame:
    """A table grows, is updated and grows again: a stream over its rows stops at the update, or leaves the rewritten data out."""
    d = _Deliveries(t)
    source = d.table("source")
    part = lambda i: target(t).where(f"id % 3 = {i}")
    modes, stops = ("block", "skip"), dict.fromkeys(("block", "skip"), 0)

    def run(mode: str) -> None:
        copy = d.table(mode)
        try:
            follow_table(source, d.place(f"checkpoint-{mode}"), lambda batch, key: copy.append(batch, batch=key), skip_changes=mode == "skip")
        except Exception as e:
            if SourceChanged.__name__ not in str(e):
                raise
            stops[mode] += 1

    source.publish(part(0))
    for mode in modes:
        run(mode)
    source.publish(update(source.read(), "id % 4 = 0", {"balance": "balance + 1000"}), "update")
    source.append(part(1))
    source.append(part(2))
    out = None
    for mode in modes:
        run(mode)
        found = d.table(mode).read().agg(F.lit(mode).alias("mode"), F.count(F.lit(1)).alias("rows"), F.lit(stops[mode]).alias("stops"))
        out = found if out is None else out.unionByName(found)
    return out


@plan("SELECT event_id, event_type FROM events WHERE event_id % 4 >= 2")
def i10_stream_from_now_on(t: Tables) -> DataFrame:
    """All events are landed, half before the stream's first start, which is the feature: that half is never opened. Files are archived once they are processed."""
    d = _Deliveries(t)
    for i in (0, 1):
        d.land(_events(t, f"event_id % 4 = {i}"))
    for i in (None, 2, 3):
        if i is not None:
            time.sleep(1.1)  # file times may count whole seconds
            d.land(_events(t, f"event_id % 4 = {i}"))
        stream = stream_from_now_on(t.spark, d.folder, SCHEMA, d.place("checkpoint"), archive=d.place("archive"))
        append_to(stream, d.place("out"), d.place("checkpoint"))
    return t.spark.read.schema("event_id BIGINT, event_type STRING").parquet(d.place("out"))


@plan("""
SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1000 ELSE c_acctbal END AS balance FROM customer WHERE c_custkey % 6 <> 0
""")
def r16_change_feed_as_stream(t: Tables) -> DataFrame:
    """A table with updates and deletes is followed through its change feed, landed as append-only files."""
    d = _Deliveries(t)
    v0 = target(t)
    v1 = update(v0, "id % 4 = 0", {"balance": "balance + 1000"})
    v2 = v1.where("id % 6 <> 0")
    copy = d.table("copy")
    copy.publish(v0)
    feed_schema = f"_change_type STRING, {', '.join(f'{c} {k}' for c, k in v0.dtypes)}"

    def step(batch: DataFrame, number: int) -> None:
        key = batch_key(batch, number)
        if not copy.has_batch(key):
            copy.publish(apply_feed(copy.read(), batch, ["id"]), batch=key)

    for before, after in ((v0, v1), (v1, v2)):
        d.land(change_feed(before, after, ["id"]))
        feed = file_stream(t.spark, d.folder, feed_schema, recursiveFileLookup="true")
        run_to_end(feed.writeStream.option("checkpointLocation", d.place("checkpoint")).foreachBatch(step))
    return copy.read().select("id", "balance")


@plan("""
SELECT 'first run' AS step, count(*) AS n FROM events UNION ALL SELECT 're-run', count(*) FROM events UNION ALL SELECT 'lost checkpoint', 2 * count(*) FROM events
""")
def r17_checkpoints(t: Tables) -> DataFrame:
    """With its checkpoint a re-run adds nothing; without it everything is read again."""
    d = _Deliveries(t)
    d.land(_events(t))
    out = None
    for step, checkpoint in (("first run", "c1"), ("re-run", "c1"), ("lost checkpoint", "c2")):
        def add(batch: DataFrame, number: int) -> None:
            d.table("rows").append(batch)

        run_to_end(d.stream().writeStream.option("checkpointLocation", d.place(checkpoint)).foreachBatch(add))
        part = d.table("rows").read().agg(F.lit(step).alias("step"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@plan("""
SELECT strftime(ts, '%Y-%m-%d') AS day, CASE WHEN user_id % 5 = 0 THEN 'none' ELSE 'seg' || (user_id % 4) END AS segment, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE event_type <> 'error' GROUP BY ALL
""")
def r19_streaming_medallion(t: Tables) -> DataFrame:
    """Bronze, silver and gold streams over two deliveries, the first holding re-sent events."""
    d = _Deliveries(t)
    users = t.events.select("user_id").distinct().where("user_id % 5 <> 0").selectExpr("user_id", "concat('seg', user_id % 4) AS segment")
    flow = EventMedallion(t.spark, d.folder, d.place("medallion"), SCHEMA, users, "user_id")
    middle = "timestamp_ntz'2024-01-15'"
    d.land(_events(t, f"ts < {middle}").unionByName(_events(t, f"ts < {middle} AND event_id % 4 = 0")), "json")
    flow.refresh()
    d.land(_events(t, f"ts >= {middle}"), "json")
    gold = flow.refresh()
    return gold.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("segment", F.lit("none")).alias("segment"), "events",
        F.col("total").cast("double").alias("total"),
    )


@plan("""
SELECT CAST(1 AS BIGINT) AS run, count(*) FILTER (WHERE event_id % 2 = 0) AS rows_read, count(*) AS total FROM events UNION ALL SELECT 2, count(*) FILTER (WHERE event_id % 2 = 1), count(*) FROM events UNION ALL SELECT 3, 0, count(*) FROM events
""")
def r20_rows_read_per_run(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    read = []
    for run in (1, 2, 3):
        if run < 3:
            d.land(_events(t, f"event_id % 2 = {run - 1}"))
        read.append((run, rows_read(append_to(d.stream(), d.place("rows"), d.place("checkpoint")))))
    counted = t.spark.read.parquet(d.place("rows")).agg(F.count(F.lit(1)).alias("total")).scalar()
    return t.spark.createDataFrame(read, "run BIGINT, rows_read BIGINT").withColumn("total", counted)


@plan("""
SELECT event_id, 'seg' || (user_id % 4) AS segment FROM events WHERE user_id % 5 <> 0
""")
def j15_stream_static_join(t: Tables) -> DataFrame:
    d = _Deliveries(t)
    d.land(_events(t))
    users = t.events.select("user_id").distinct().where("user_id % 5 <> 0").selectExpr("user_id", "concat('seg', user_id % 4) AS segment")
    append_to(d.stream().join(users, "user_id").select("event_id", "segment"), d.place("out"), d.place("checkpoint"))
    return t.spark.read.parquet(d.place("out"))


@plan("""
WITH c AS (SELECT event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click'), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT click_id, coalesce(p.event_id, -1) AS purchase_id FROM c JOIN (SELECT event_id, user_id FROM events) u ON u.event_id = click_id
LEFT JOIN p ON p.user_id = u.user_id AND p.ts BETWEEN click_ts AND click_ts + INTERVAL 2 HOUR
WHERE p.event_id IS NOT NULL OR click_ts + INTERVAL 2 HOUR < (SELECT least(max(ts) FILTER (WHERE event_type = 'click'), max(ts) FILTER (WHERE event_type = 'purchase')) - INTERVAL 1 HOUR FROM events)
""")
def j16_stream_stream_join(t: Tables) -> DataFrame:
    """Clicks with the purchases of the same user in the next two hours; unmatched clicks once the watermark is past."""
    d = _Deliveries(t)
    d.land(_events(t))
    # joined per user and two-hour slot: a click lies in one slot, a purchase is offered to its own and the one before, so
    # each pair meets once and a busy user's rows are shared out over the slots
    slot = "unix_timestamp({}) DIV 7200"
    clicks = d.stream().where("event_type = 'click'").selectExpr(
        "event_id AS click_id", "user_id AS click_user", "ts AS click_ts", slot.format("ts") + " AS click_slot"
    ).withWatermark("click_ts", "1 hour")
    purchases = d.stream().where("event_type = 'purchase'").selectExpr(
        "event_id", "user_id", "ts", f"explode(array({slot.format('ts')}, {slot.format('ts')} - 1)) AS slot"
    ).withWatermark("ts", "1 hour")
    joined = clicks.join(
        purchases,
        F.expr("user_id = click_user AND slot = click_slot AND ts BETWEEN click_ts AND click_ts + INTERVAL 2 HOURS"), "left",
    )
    append_to(joined.select("click_id", F.coalesce("event_id", F.lit(-1)).alias("purchase_id")), d.place("out"), d.place("checkpoint"))
    return t.spark.read.parquet(d.place("out"))
