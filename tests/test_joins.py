import random

import pytest
from pyspark.sql import functions as F

from lakekit.operators import aggregates as ag
from lakekit.operators import joins as j
from lakekit.operators import windows as w
from lakekit.operators.compare import assert_same, diff
from tests.plan_reading import plan_facts


@pytest.fixture(scope="module")
def big(spark):
    r = random.Random(1)
    return spark.createDataFrame(
        [(i, 0 if i % 3 == 0 else r.choice([None, *range(1, 40)]), i % 5) for i in range(900)], "id BIGINT, k INT, x INT"
    ).cache()


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(k, f"n{k}") for k in range(30)] + [(5, "again")], "k INT, name STRING").cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(big, small, how):
    assert_same(j.salted_join(big, small, ["k"], 4, how, ["id"]), big.join(small, "k", how))


def test_salted_join_refuses_right_and_full(big, small):
    with pytest.raises(ValueError):
        j.salted_join(big, small, ["k"], 4, "full")


def test_isolated_join_equals_plain(big, small, rows):
    assert rows(j.hot_keys(big, ["k"], 0.2)) == [(0,)]
    assert_same(j.isolated_join(big, small, ["k"], 0.2, 4, ["id"]), big.join(small, "k"))


def test_salting_spreads_the_hot_key(big):
    salted = big.where("k = 0").groupBy(F.pmod(F.xxhash64("id"), F.lit(16))).count()
    assert salted.agg(F.max("count")).first()[0] < big.where("k = 0").count() / 3


def test_salted_aggregate_equals_plain(big):
    got = ag.salted_aggregate(big, ["x"], count="n", sums={"s": "id"}, distinct={"d": "k"}, n=4, salt_by=["id"])
    want = big.groupBy("x").agg(F.count("*").alias("n"), F.sum("id").alias("s"), F.count_distinct("k").alias("d"))
    assert_same(got, want)
    only = ag.salted_aggregate(big, ["x"], distinct={"d": "k"}, n=4)
    assert_same(only, big.groupBy("x").agg(F.count_distinct("k").alias("d")))


def test_pair_count_equals_self_join(big):
    a, b = big.alias("a"), big.alias("b")
    pairs = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.x") != F.col("b.x")))
    want = pairs.groupBy(F.col("a.k").alias("k")).agg(F.count("*").cast("decimal(38,0)").alias("pairs"))
    assert_same(j.self_pair_count(big, ["k"], "x"), want)


@pytest.mark.parametrize("bucket", [None, "_ts DIV 10", "_ts DIV 1000", "sampled"])
def test_asof_join(spark, bucket, monkeypatch):
    monkeypatch.setattr(w, "SLICE_ROWS", 30)
    r = random.Random(3)
    versions, facts = [], []
    for k in range(12):
        at = r.randrange(20)
        for n in range(r.randrange(1, 9)):
            end = at + r.randrange(0, 15)
            open_ = r.random() < 0.15
            versions.append((k, at, None if open_ else end, f"{k}/{n}"))
            if open_:
                break
            at = end + r.choice([0, 0, 5])  # sometimes a gap
    facts = [(i, r.randrange(14), r.randrange(120)) for i in range(400)]
    f = spark.createDataFrame(facts, "id INT, k INT, ts INT")
    v = spark.createDataFrame(versions, "k INT, a INT, b INT, name STRING")

    def at(k, ts):
        hits = [n for kk, a, b, n in versions if kk == k and a <= ts and (b is None or ts < b)]
        assert len(hits) <= 1
        return hits[0] if hits else None

    got = j.asof_join(f, v, ["k"], "ts", "a", "b", ["name"], bucket)
    want = spark.createDataFrame([(i, k, ts, at(k, ts)) for i, k, ts in facts], "id INT, k INT, ts INT, name STRING")
    assert_same(got, want)


def test_lookup_flags_unknown(spark, rows):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id INT, k STRING")
    dim = spark.createDataFrame([("a", None)], "k STRING, label STRING")
    out = j.lookup(facts, dim, ["k"], {"label": "Unknown"}, "known")
    assert rows(out, "id", "label", "known") == [(1, None, True), (2, "Unknown", False), (3, "Unknown", False)]


def test_fan_out_guard(big, small):
    with pytest.raises(Exception, match="duplicate dimension key"):
        j.unique_on(small, ["k"]).collect()
    with pytest.raises(Exception, match="duplicate dimension key"):
        big.join(j.unique_on(small, ["k"]), "k").select("id").collect()
    assert j.unique_on(small.where("name <> 'again'"), ["k"]).count() == 30


def test_join_hints_and_pushdown(spark):
    base = "/root/testdata/sf0.001"
    o, c = spark.read.parquet(f"{base}/orders.parquet"), spark.read.parquet(f"{base}/customer.parquet")
    on = o.o_custkey == c.c_custkey
    assert plan_facts(o.join(c.hint("merge"), on))["joins"] == ["SortMergeJoin"]
    assert plan_facts(o.join(c.hint("shuffle_hash"), on))["joins"] == ["ShuffledHashJoin"]
    broadcast = plan_facts(o.join(F.broadcast(c), on))
    assert broadcast["joins"] == ["BroadcastHashJoin"] and broadcast["shuffles"] == 0
    facts = plan_facts(o.where("o_totalprice > 1000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in facts["pushed"][0]
    assert facts["read"] == ["o_orderkey:bigint,o_totalprice:double"]


def test_diff_counts_copies(spark, rows):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k INT, v STRING")
    b = spark.createDataFrame([(1, None), (3, "y")], "k INT, v STRING")
    assert rows(diff(a, b)) == [("left", 1, None, 1), ("left", 2, "x", 1), ("right", 3, "y", 1)]
    with pytest.raises(AssertionError):
        assert_same(a, b)
    with pytest.raises(ValueError):
        diff(a, b.drop("v"))
