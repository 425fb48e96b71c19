import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.operators import layout
from lakekit.operators import tables as tb
from lakekit.operators.compare import assert_same
from lakekit.operators.snapshots import SnapshotTable
from tests.plan_reading import plan_facts


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (None, "n", 0)], "id INT, name STRING, v INT")


@pytest.fixture
def source(spark):
    return spark.createDataFrame([(2, "B", 25), (3, "C", 5), (4, "D", 40), (None, "N", 1)], "id INT, name STRING, v INT")


def test_merge_clauses_in_order(target, source, rows):
    actions = tb.merge_actions(
        target, source, ["id"],
        [tb.matched_delete("s.v < 10"), tb.matched_update({"v": "t.v + s.v"}), tb.not_matched_insert("*"), tb.missing_update({"name": "'gone'"})],
    )
    assert rows(actions) == [
        ("deleted", 3, "c", 30), ("inserted", None, "N", 1), ("inserted", 4, "D", 40), ("updated", None, "gone", 0),
        ("updated", 1, "gone", 10), ("updated", 2, "b", 45),
    ]
    assert rows(tb.merge_metrics(actions)) == [(3, 2, 1, 0)]


def test_merge_refuses_several_source_rows_for_one_target_row(target, source):
    twice = source.unionAll(source)
    with pytest.raises(Exception, match="several source rows"):
        tb.merge(target, twice, ["id"], [tb.matched_update("*")]).collect()
    # copies that match nothing are no problem, and inserts keep them
    fresh = twice.where("id = 4")
    assert tb.merge(target, fresh, ["id"], [tb.matched_update("*"), tb.not_matched_insert("*")]).count() == 6


def test_merge_checks_columns(target, source):
    with pytest.raises(tb.MergeError):
        tb.merge(target, source.drop("v"), ["id"], [tb.matched_update("*")])
    with pytest.raises(tb.MergeError):
        tb.merge(target, source, ["id"], [tb.matched_update({"nope": "1"})])


def test_merge_with_new_column(target, source, rows):
    wider = source.withColumn("zone", F.lit("z"))
    out = tb.merge(target, wider, ["id"], [tb.matched_update("*"), tb.not_matched_insert("*")], evolve=True)
    assert rows(out, "id", "zone") == [(None, None), (None, "z"), (1, None), (2, "z"), (3, "z"), (4, "z")]


def test_merge_broadcasts_a_small_source(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").selectExpr("l_orderkey AS id", "l_quantity AS v")
    small = spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").selectExpr("s_suppkey AS id", "s_acctbal AS v")
    facts = plan_facts(tb.merge(big, small, ["id"], [tb.matched_update("*"), tb.not_matched_insert("*")]))
    assert "SortMergeJoin" not in facts["joins"] and "BroadcastHashJoin" in facts["joins"]


def test_random_merges_against_a_model(spark):
    r = random.Random(11)
    clauses = [tb.matched_delete("s.op = 'D'"), tb.matched_update({"v": "s.v"}, "s.v > t.v"), tb.not_matched_insert({"id": "s.id", "v": "s.v"}, "s.op <> 'D'")]
    model = {i: r.randrange(50) for i in range(30)}
    table = spark.createDataFrame(list(model.items()), "id INT, v INT")
    for _ in range(3):
        batch = {i: (r.randrange(50), r.choice("DUU")) for i in r.sample(range(45), 20)}
        src = spark.createDataFrame([(i, v, op) for i, (v, op) in batch.items()], "id INT, v INT, op STRING")
        table = tb.merge(table, src, ["id"], clauses)
        for i, (v, op) in batch.items():
            if i in model:
                if op == "D":
                    del model[i]
                elif v > model[i]:
                    model[i] = v
            elif op != "D":
                model[i] = v
        assert_same(table, spark.createDataFrame(list(model.items()), "id INT, v INT"))


def test_upsert_if_newer_is_idempotent(target, source):
    once = tb.upsert_newer(target.where("id IS NOT NULL"), source.where("id IS NOT NULL"), ["id"], "v")
    assert_same(tb.upsert_newer(once, source.where("id IS NOT NULL"), ["id"], "v"), once)


def test_delete_keeps_null_predicate_and_update_sees_old_row(target, rows):
    assert tb.delete(target, "id > 1").count() == 2
    swapped = tb.update(target, "id = 1", {"v": "length(name)", "name": "CAST(v AS STRING)"})
    assert (1, "10", 1) in rows(swapped)


def test_replace_where_guards_new_rows(target, spark):
    with pytest.raises(Exception, match="row outside"):
        tb.replace_where(target, spark.createDataFrame([(1, "x", 1)], target.schema), "id > 1").collect()


def test_change_feed_round_trip(target, source):
    before, after = target.where("id IS NOT NULL"), source.where("id IS NOT NULL")
    feed = tb.change_feed(before, after, ["id"])
    assert feed.groupBy("_change_type").count().count() == 4
    assert_same(tb.apply_feed(before, feed, ["id"]), after)


def test_schema_rules(target):
    schema = target.schema
    with pytest.raises(tb.SchemaMismatch):
        tb.enforce_schema(target.withColumn("x", F.lit(1)), schema)
    with pytest.raises(tb.SchemaMismatch):
        tb.enforce_schema(target.withColumn("v", F.lit("text")), schema)
    assert tb.enforce_schema(target.select("v", "id"), schema).where("name IS NULL").count() == 4
    with pytest.raises(tb.SchemaMismatch):
        tb.enforce_schema(target.drop("name"), StructType.fromDDL("id INT, name STRING NOT NULL, v INT"))
    assert tb.evolve_schema(schema, StructType.fromDDL("id INT, w DOUBLE")).names == ["id", "name", "v", "w"]
    with pytest.raises(tb.SchemaMismatch):
        tb.evolve_schema(schema, StructType.fromDDL("id STRING"))


def test_snapshots(spark, target, source, tmp_path, rows):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    assert table.version() is None and not table.exists()
    assert table.publish(target) == 0
    assert table.append(source, batch="b1") == 1
    assert table.append(source, batch="b1") is None, "a batch counts once"
    assert (table.read(0).count(), table.read().count()) == (4, 8)
    with pytest.raises(tb.SchemaMismatch):
        table.append(source.withColumn("x", F.lit(1)))
    table.append(source.withColumn("x", F.lit(1)), merge_schema=True)
    assert table.read().where("x IS NULL").count() == 8
    at = table.history().where("version = 1").first()["published_at"]
    assert table.read(timestamp=at).count() == 8
    table.restore(0)
    assert_same(table.read(), target)
    assert rows(table.history(), "version") == [(0,), (1,), (2,), (3,)]
    with pytest.raises(ValueError):
        table.read(99)
    assert table.read(timestamp=at.replace("T", " ")[:19] + ".999").count() == 8, "an ordinary timestamp text"


def test_compaction_and_clustering(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "c"))
    for i in range(3):
        table.append(spark.range(i * 100, i * 100 + 100).withColumn("g", F.col("id") % 7).repartition(4))
    before = table.read()
    assert layout.compact(table)["rewritten"] == 12
    assert layout.compact(table)["rewritten"] == 0
    assert_same(table.read(), before)
    assert layout.cluster_new(table, ["g"])["rewritten_folders"] == 1
    assert layout.cluster_new(table, ["g"])["rewritten_folders"] == 0
    assert_same(table.read(), before)


def test_partitioned_write_makes_few_files(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).withColumn("p", F.col("id") % 3)
    layout.write_partitioned(df, str(tmp_path / "p"), ["p"])
    assert len(list((tmp_path / "p").glob("p=*/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "p")).where("p = 1").count() == 1333


def test_clustering_narrows_file_ranges(spark, tmp_path):
    df = spark.range(20000).selectExpr("id % 101 AS a", "(id * 7919) % 97 AS b", "id")
    layout.cluster_by(df, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    back = spark.read.parquet(str(tmp_path / "z"))
    assert_same(back, df)
    ranges = layout.file_ranges(back, ["a", "b"])
    for c in ("a", "b"):
        assert layout.files_needed(ranges, c, 10, 12).first()["skipped_share"] >= 0.4


def test_change_feed_over_an_added_column(spark, rows):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    after = spark.createDataFrame([(1, "a", None), (2, "b", "new")], "id INT, v STRING, w STRING")
    feed = tb.change_feed(before, after, ["id"])
    assert rows(feed, "_change_type", "id", "w") == [("update_postimage", 2, "new"), ("update_preimage", 2, None)]


def test_insert_missing_leaves_rows_without_a_key_out(spark, rows):
    target = spark.createDataFrame([(1, "a"), (None, "old")], "id INT, v STRING")
    source = spark.createDataFrame([(1, "x"), (2, "b"), (2, "b"), (None, "n")], "id INT, v STRING")
    once = tb.insert_missing(target, source, ["id"])
    assert rows(once) == rows(tb.insert_missing(once, source, ["id"])) == [(None, "old"), (1, "a"), (2, "b")]


def test_zones_pick_files_with_null_and_open_ends(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id >= 900 THEN NULL ELSE id % 100 END AS v", "concat('k', id % 7) AS s")
    df.repartitionByRange(10, "id").write.parquet(str(tmp_path / "a b%"))  # a name that file addresses escape
    zones = layout.ZoneMap(spark, str(tmp_path / "zones"))
    zones.build(spark.read.parquet(str(tmp_path / "a b%")), ["id", "v", "s"])
    assert len(zones.files(id=(250, 260))) <= 2 and len(zones.files(id=(None, None))) == 10 and zones.files(id=(5000, None)) == []
    assert sorted(r["id"] for r in zones.read(df.schema, id=(250, 260)).collect()) == list(range(250, 261))
    assert zones.read(df.schema, id=(None, 9), s=("k3", "k3")).count() == 1
    assert zones.read(df.schema, id=(5000, None)).count() == 0
    assert len(zones.files(v=(0, 99))) == 9, "a file of NULLs alone holds no value"
    df.where("id < 5").selectExpr("id + 5000 AS id", "v", "s").write.parquet(str(tmp_path / "more"))
    zones.add(spark.read.parquet(str(tmp_path / "more")), ["id", "v", "s"])
    assert zones.read(df.schema, id=(5000, None)).count() == 5


def test_clustered_folders_survive_compaction(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"))
    for i in range(2):
        table.append(spark.range(i * 100, i * 100 + 100, 1, 4).selectExpr("id", "id % 10 AS g"))
    layout.cluster_new(table, ["g"])
    clustered = table._entry()["paths"]
    table.append(spark.range(200, 300, 1, 4).selectExpr("id", "id % 10 AS g"))
    layout.compact(table)
    assert set(clustered) <= set(table._entry()["paths"]) and table.read().count() == 300
    assert layout.cluster_new(table, ["g"])["rewritten_folders"] == 1
    assert set(clustered) <= set(table._entry()["paths"]) and layout.cluster_new(table, ["g"])["rewritten_folders"] == 0


def test_z_order_of_many_files_splits_inside_ranges(spark):
    """More files than quantile ranges: the place inside a range goes on splitting, NULLs and one-valued columns included."""
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 50 > 0 THEN id * 7919 % 10007 END AS a", "id * 104729 % 20011 AS b", "1 AS same")
    out = layout.cluster_by(df, ["a", "b", "same"], 512).withColumn("p", F.spark_partition_id())
    spans = out.groupBy("p").agg((F.max("b") - F.min("b")).alias("width"), F.count("*").alias("n"))
    assert out.count() == 20_000 and spans.agg(F.avg("width")).first()[0] < 20011 / 8
    assert spans.agg(F.max("n")).first()[0] < 1500
