import pytest
from pyspark.sql import functions as F

from lakekit.operators import layout, observe
from lakekit.operators import protect as pr
from lakekit.operators.audit import AuditLog
from lakekit.operators.columns import next_keys, surrogate_key, with_generated
from lakekit.operators.compare import assert_same
from lakekit.operators.serving import MaterialisedAggregate, MetricView, StoredCube, alert
from lakekit.operators.snapshots import SnapshotTable
from lakekit.session import settings, shared_folder, small_rows


def test_metric_view_is_not_additive(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 30)], "g STRING, c INT, v INT")
    view = MetricView(df, {"grp": "g"}, {"customers": "count(DISTINCT c)", "average": "sum(v) / count(*)"})
    fine = view.query(["grp"])
    assert fine.agg(F.sum("customers")).first()[0] == 3 and view.query([]).first()["customers"] == 2
    assert view.query([], ["average"], "grp = 'a'").first()["average"] == 15
    with pytest.raises(ValueError):
        view.query(["nope"])


def test_incremental_refresh_equals_full(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "id INT, g STRING, v INT")
    new = spark.createDataFrame([(1, "b", 5), (2, "b", 6), (4, None, 1), (5, "c", 2)], "id INT, g STRING, v INT")
    query = lambda d: d.groupBy("g").agg(F.sum("v").alias("v"))
    view = MaterialisedAggregate(SnapshotTable(spark, str(tmp_path / "v")), query, {"g": "g"})
    view.refresh(old)
    view.refresh_touched(new, old.exceptAll(new).unionByName(new.exceptAll(old)))
    assert_same(view.read(), query(new))


def test_alert_states(spark):
    one = spark.createDataFrame([(5.0,)], "v DOUBLE")
    assert alert(one, ">", 4).first()["status"] == "TRIGGERED"
    assert alert(one, "<=", 4).first()["status"] == "OK"
    assert alert(spark.createDataFrame([(None,)], "v DOUBLE"), ">", 4).first()["status"] == "UNKNOWN"
    with pytest.raises(ValueError):
        alert(one, "~", 4)


def test_keys_and_generated_columns(spark):
    df = spark.range(10)
    assert [r["sk"] for r in surrogate_key(df, ["id"], F.floor(F.col("id") / 4), "sk", 5).orderBy("id").collect()] == list(range(6, 16))
    keys = [r["sk"] for r in next_keys(df.repartition(3), "sk", 100).collect()]
    assert len(set(keys)) == 10 and min(keys) > 100
    with pytest.raises(ValueError):
        next_keys(df.withColumn("sk", F.lit(1)), "sk")
    with pytest.raises(Exception, match="generated column twice"):
        with_generated(df.withColumn("twice", F.lit(3)), {"twice": "id * 2"}).collect()


def test_protection(spark, rows):
    df = spark.createDataFrame([(1, "DE", "ann@x.org", "1234-5678"), (2, "FR", None, "9999-0000"), (3, None, "bob", "1")], "id INT, country STRING, email STRING, card STRING")
    grants = spark.createDataFrame([("u", "DE"), ("u", "DE"), ("v", "FR")], "user STRING, value STRING")
    user, admin = pr.Principal("u"), pr.Principal("x", frozenset({"admins"}))
    assert rows(pr.row_filter(df, user, grants, "country"), "id") == [(1,)]
    assert pr.row_filter(df, admin, grants, "country").count() == 3
    assert pr.row_filter(df, pr.Principal("w"), grants, "country").count() == 0
    masked = pr.mask_columns(df, user, {"email": pr.mask_email, "card": pr.mask_last4})
    assert rows(masked, "email", "card") == [(None, "****-0000"), ("a***@x.org", "****-5678"), ("b***", "****-1")]
    shown = pr.mask_unless_granted(df, user, "card", pr.mask_redacted, "country", grants)
    assert rows(shown, "id", "card") == [(1, "1234-5678"), (2, "REDACTED"), (3, "REDACTED")]
    twice = [pr.Policy("pii", mask=pr.mask_null), pr.Policy("mail", mask=pr.mask_email)]
    with pytest.raises(ValueError):
        pr.apply_policies(df, {"email": ["pii", "mail"]}, twice, user)


def test_skew_report(spark):
    even = small_rows(spark, [{"rows": 10}, {"rows": 11}, {"rows": 12}], "rows BIGINT")
    hot = small_rows(spark, [{"rows": 10}, {"rows": 11}, {"rows": 12}, {"rows": 90}], "rows BIGINT")
    assert not layout.skew_report(even).first()["skewed"] and layout.skew_report(hot).first()["skewed"]


def test_audit_log(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "log"))
    with pytest.raises(KeyError), log.attempt("t", 1):
        raise KeyError("x")
    with log.attempt("t", 2) as entry:
        entry["rows"] = 3
    assert {(r["attempt"], r["status"], r["rows"]) for r in log.read().collect()} == {(1, "FAILED", 0), (2, "SUCCEEDED", 3)}


def test_blockers(spark, rows):
    tasks = spark.createDataFrame([(1, "a", "SUCCEEDED"), (1, "b", "FAILED"), (1, "c", "UPSTREAM_FAILED"), (2, "a", "SUCCEEDED")], "run_id INT, task_key STRING, state STRING")
    assert rows(observe.blockers(tasks)) == [(1, "b", 1)]


def test_shared_folder_and_settings(spark):
    assert shared_folder(spark) == shared_folder(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, spark__sql__shuffle__partitions="3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_mask_of_text_without_at(spark):
    from lakekit.operators.protect import mask_email

    df = spark.createDataFrame([("alice@x.org",), ("alice-no-at",), (None,), ("",)], "e STRING")
    assert [r[0] for r in df.select(mask_email(F.col("e"))).collect()] == ["a***@x.org", "a***", None, "***"]


def test_stored_cube_counts_distinct_at_any_grain(spark, tmp_path, rows):
    cube = StoredCube(spark, f"{tmp_path}/cube", ["a", "b"], {"n": "1L"}, {"users": "u", "things": "t"})
    source = spark.range(2000).selectExpr("id % 3 AS a", "CASE WHEN id % 7 > 0 THEN id % 7 END AS b", "id % 101 AS u", "CASE WHEN id % 5 = 0 THEN concat('t', id % 11) END AS t")
    for half in (0, 1):
        cube.add(source.where(f"u % 2 = {half}"))
    for by in (["a"], ["b"], ["a", "b"], []):
        want = source.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct("u").alias("users"), F.count_distinct("t").alias("things"))
        assert rows(cube.query(by), *by, "n", "users", "things") == rows(want, *by, "n", "users", "things")
        near = cube.query(by, exact=False).agg(F.max("users"), F.max("things")).first()
        top = want.agg(F.max("users"), F.max("things")).first()
        assert abs(near[0] - top[0]) <= 3 and abs(near[1] - top[1]) <= 1
    with pytest.raises(ValueError, match="nowhere"):
        cube.query(["nowhere"])
