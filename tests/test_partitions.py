"""Changes by partition: rows as of the whole-table operators, untouched files keep their names."""

import json
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from lakekit.operators import tables as tb
from lakekit.operators.partitions import NULL_LABEL, PartitionedTable
from lakekit.operators.serving import MaterialisedAggregate
from lakekit.streaming.runs import upsert_table


@pytest.fixture
def table(spark, tmp_path):
    made = PartitionedTable(spark, f"{tmp_path}/t", "region", ["region"])
    made.publish(spark.range(100).selectExpr("id", "CASE WHEN id % 5 < 4 THEN concat('r/', id % 5) END AS region", "id * 10 AS amount"))
    return made


def files(table, version=None):
    return {r["file"]: unquote(unquote(r["part"])) for r in table.files(version).collect()}


def metrics(table):
    return json.loads(table.history().first()["metrics"])


def test_update_and_delete_touch_only_the_partitions_with_hits(table, rows):
    before, content = files(table), table.read().collect()
    assert set(table.partitions()) == {"r/0", "r/1", "r/2", "r/3", NULL_LABEL}
    table.update("region = 'r/1' AND id > 50", {"amount": "-1"})
    after = files(table)
    assert {p for f, p in before.items() if f not in after} == {"r/1"} and metrics(table)["folders_kept"] == 4
    assert {r["id"] for r in table.read().where("amount = -1").collect()} == {i for i in range(51, 100) if i % 5 == 1}
    table.delete("region IS NULL AND id < 50")
    assert {p for f, p in after.items() if f not in files(table)} == {NULL_LABEL}
    assert table.read().count() == 90 and sorted(table.read(0).collect()) == sorted(content)
    before = files(table)
    table.delete("id > 1000")  # nothing to do, nothing rewritten
    assert files(table) == before
    table.delete("region = 'r/2'")
    assert "r/2" not in table.partitions()


def test_merge_finds_the_partitions_of_keys(spark, table, rows):
    """The key does not tell the partition: a matched row may move to another one, an insert may open a new one."""
    before = files(table)
    source = spark.createDataFrame([(1, "r/3", 5), (6, "r/1", 7), (500, "new", 9)], "id LONG, region STRING, amount LONG")
    clauses = [tb.matched_update("*"), tb.not_matched_insert("*")]
    expected = rows(tb.merge(table.read(), source, ["id"], clauses))
    table.merge(source, ["id"], clauses)
    assert rows(table.read()) == expected
    gone = {p for f, p in before.items() if f not in files(table)}
    assert gone == {"r/1"} and len(table.partitions()["r/3"]) == 2 and "new" in table.partitions()
    again = rows(table.read())
    table.merge(source, ["id"], clauses)
    assert rows(table.read()) == again


def test_merge_by_the_label_of_the_key(spark, tmp_path, rows):
    table = PartitionedTable(spark, f"{tmp_path}/k", "pmod(id, 8)", ["id"])
    table.publish(spark.range(200).selectExpr("id", "0L AS n"))
    before = files(table)
    table.merge(spark.createDataFrame([(8, 1), (16, 1), (1001, 1)], "id LONG, n LONG"), ["id"], [tb.matched_update({"n": "t.n + s.n"}), tb.not_matched_insert("*")])
    assert {p for f, p in before.items() if f not in files(table)} == {"0", "1"}
    assert table.read().where("n = 1").count() == 3 and table.read().count() == 201
    table.merge(spark.createDataFrame([(8, 0)], "id LONG, n LONG"), ["id"], [tb.missing_delete("t.id > 100")])
    assert table.read().count() == 101


def test_a_batch_counts_once_and_unknown_columns_are_refused(spark, table):
    version = table.change(["r/0"], lambda r: r.limit(0), batch="b")
    assert version == 1 and table.change(["r/0"], lambda r: r, batch="b") is None and table.read().count() == 80
    with pytest.raises(Exception, match="more"):
        table.change(["r/1"], lambda r: r.withColumn("more", F.lit(1)))


def test_stream_upsert_rewrites_the_days_of_a_batch(spark, tmp_path):
    table = PartitionedTable(spark, f"{tmp_path}/days", "day", ["day"])
    seen = []
    for step, days in enumerate(["a b c", "c d"]):
        rows = [(d, i) for i in range(20) for d in days.split()]
        spark.createDataFrame(rows, "day STRING, v LONG").coalesce(1).write.parquet(f"{tmp_path}/in/{step}")
        stream = spark.readStream.schema("day STRING, v LONG").option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        upsert_table(stream, table, f"{tmp_path}/cp", ["day"], [tb.matched_update({"n": "t.n + s.n"}), tb.not_matched_insert("*")],
                     lambda b: b.groupBy("day").agg(F.count("*").alias("n")))
        seen.append(files(table))
    assert {p for f, p in seen[0].items() if f in seen[1]} == {"a", "b"}
    assert {r["day"]: r["n"] for r in table.read().collect()} == {"a": 20, "b": 20, "c": 40, "d": 20}


def test_aggregate_refresh_rewrites_touched_groups(spark, tmp_path, rows):
    table = PartitionedTable(spark, f"{tmp_path}/agg", "g % 4", ["g"])
    query = lambda df: df.groupBy("g").agg(F.sum("v").alias("total"))
    view = MaterialisedAggregate(table, query, {"g": "g"})
    source = spark.range(60).selectExpr("id % 12 AS g", "id AS v")
    view.refresh(source)
    before = files(table)
    changed = spark.createDataFrame([(5, 1000)], "g LONG, v LONG")
    source = source.unionByName(changed)
    view.refresh_touched(source, changed)
    assert rows(view.read()) == rows(query(source))
    assert {p for f, p in before.items() if f not in files(table)} == {"1"}
