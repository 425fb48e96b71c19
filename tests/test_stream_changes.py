"""Streams over tables that change, folders with old files, and state with timers."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from lakekit.operators.snapshots import SnapshotTable
from lakekit.operators.tables import delete, update
from lakekit.session import settings
from lakekit.streaming.changes import SourceChanged, follow_table, stream_from_now_on
from lakekit.streaming.runs import append_to
from lakekit.streaming.state import running_totals, visits


def rows_of(spark, n, first=0):
    return spark.range(first, first + n).selectExpr("id", "id * 10 AS v")


def test_a_changed_source_stops_the_stream_and_skipping_goes_on(spark, tmp_path):
    source, target = SnapshotTable(spark, f"{tmp_path}/s"), SnapshotTable(spark, f"{tmp_path}/t")

    def run(**options):
        follow_table(source, f"{tmp_path}/cp", lambda batch, key: target.append(batch, batch=key), **options)

    source.publish(rows_of(spark, 10))
    run()
    source.append(rows_of(spark, 5, 100))
    run()
    assert target.read().count() == 15
    source.publish(update(source.read(), "id = 3", {"v": "-1"}), "update")
    source.append(rows_of(spark, 2, 200))
    for _ in range(2):  # it stops again until it is told to skip
        with pytest.raises(Exception, match=f"{SourceChanged.__name__}.*update in version 2"):
            run()
    assert target.read().count() == 15
    run(skip_changes=True)
    assert sorted(r["id"] for r in target.read().collect()) == [*range(10), *range(100, 105), 200, 201]
    assert target.read().where("v < 0").isEmpty()
    source.publish(delete(source.read(), "id < 5"), "delete")
    with pytest.raises(Exception, match="delete in version 4"):
        run()
    run(skip_changes=True)
    source.append(rows_of(spark, 1, 300))
    run(skip_changes=True)
    assert target.read().count() == 18


def test_only_files_after_the_first_start(spark, tmp_path):
    folder, done = tmp_path / "in", tmp_path / "archive"
    rows_of(spark, 5).coalesce(1).write.json(f"{folder}/old")

    def run():
        stream = stream_from_now_on(spark, str(folder), "id LONG, v LONG", f"{tmp_path}/cp", "json", archive=str(done))
        append_to(stream, f"{tmp_path}/out", f"{tmp_path}/cp")

    def ids():
        return sorted(r["id"] for r in spark.read.schema("id LONG, v LONG").parquet(f"{tmp_path}/out").collect())

    run()
    assert ids() == []
    for part, first in (("b", 100), ("c", 200)):
        time.sleep(1.1)
        rows_of(spark, 3, first).coalesce(1).write.json(f"{folder}/{part}")
        run()
    assert ids() == [100, 101, 102, 200, 201, 202]
    run()
    assert len(ids()) == 6 and any(f.endswith(".json") for _, _, fs in os.walk(done) for f in fs)


def test_visits_end_by_timer_and_leave_no_state(spark, tmp_path):
    def land(step, rows):
        spark.createDataFrame(rows, "user LONG, kind STRING, at STRING").selectExpr("user", "kind", "CAST(at AS TIMESTAMP) AS at").coalesce(1).write.parquet(f"{tmp_path}/in/{step}")

    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    found = []
    with settings(spark, spark__sql__streaming__stateStore__providerClass=provider, spark__sql__shuffle__partitions="2"):
        for step, rows in enumerate([
            [(1, "a", "2026-01-01 10:00:00"), (1, "b", "2026-01-01 10:05:00"), (1, "b", "2026-01-01 10:06:00"), (2, "a", "2026-01-01 10:00:00")],
            [(1, "c", "2026-01-01 10:20:00"), (3, "a", "2026-01-01 12:00:00")],
            [(1, "a", "2026-01-01 14:00:00"), (3, "z", "2026-01-01 14:00:00")],
        ]):
            land(step, rows)
            stream = spark.readStream.schema("user LONG, kind STRING, at TIMESTAMP").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
            query = append_to(visits(stream.withWatermark("at", "1 minute"), "user", "kind", "at", 30 * 60_000), f"{tmp_path}/out", f"{tmp_path}/cp")
        found = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("user", "n", (F.col("last") - F.col("first")).alias("ms"), "kinds", "top").collect())
    assert found == [(1, 4, 20 * 60_000, 3, "b"), (2, 1, 0, 1, "a"), (3, 1, 0, 1, "a")]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] > 0


def test_rows_of_one_batch_come_in_any_order_and_frame(spark, tmp_path):
    """A batch's rows are joined to visits before the state is asked, over all frames of a bucket; keys and kinds may be null."""
    start, gap = 1_767_261_600, 30 * 60
    dice, rows = random.Random(3), []
    for user in (None, *range(12)):
        for _ in range(dice.randint(1, 30)):
            rows.append((user, dice.choice(["a", "b", None]), start + dice.randint(0, 10 * 3600)))
    expected = []
    for user in {r[0] for r in rows}:
        own = sorted(((at, kind) for u, kind, at in rows if u == user), key=lambda x: x[0])
        parts = [[own[0]]]
        for row in own[1:]:
            parts.append([row]) if row[0] > parts[-1][-1][0] + gap else parts[-1].append(row)
        expected += [(user, len(p), p[0][0] * 1000, p[-1][0] * 1000, len({kind for _, kind in p} - {None})) for p in parts]
    late = [(99, "z", start + 100 * 3600)]
    provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with settings(spark, spark__sql__streaming__stateStore__providerClass=provider, spark__sql__shuffle__partitions="2",
                  spark__sql__execution__arrow__maxRecordsPerBatch="3"):
        for step, part in enumerate((rows, late)):
            spark.createDataFrame(part, "user LONG, kind STRING, at LONG").selectExpr("user", "kind", "timestamp_seconds(at) AS at").coalesce(1).write.parquet(f"{tmp_path}/in/{step}")
            stream = spark.readStream.schema("user LONG, kind STRING, at TIMESTAMP").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
            append_to(visits(stream.withWatermark("at", "1 minute"), "user", "kind", "at", gap * 1000, buckets=4), f"{tmp_path}/out", f"{tmp_path}/cp")
    found = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("user", "n", "first", "last", "kinds").collect()]
    order = lambda r: (r[0] is not None, r)[0:1] + tuple(x or 0 for x in r)
    assert sorted(found, key=order) == sorted(expected, key=order)


def test_running_totals_keep_one_state_per_key(spark, tmp_path):
    rows = [(k, v) for k in range(5) for v in range(100)] + [(None, 3), (1, None)]
    spark.createDataFrame(rows, "k LONG, v LONG").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k LONG, v LONG").parquet(f"{tmp_path}/in")
    with settings(spark, spark__sql__shuffle__partitions="2"):
        query = running_totals(stream, "k", "v").writeStream.outputMode("update").format("memory").queryName("totals_test").option(
            "checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
    found = sorted(((r.k if r.k is not None else -1, r.n, r.total) for r in spark.table("totals_test").collect()))
    assert found == [(-1, 1, 3), (0, 100, 4950), (1, 101, 4950), *((k, 100, 4950) for k in (2, 3, 4))]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 6
