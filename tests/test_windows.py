import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakekit.operators import windows as w
from lakekit.operators.compare import assert_same
from lakekit.plans import load_all, registry
from tests import oracle
from tests.plan_reading import plan_facts


@pytest.fixture(scope="module")
def data(spark):
    """A hot key, NULL keys, NULL and repeated order values."""
    r = random.Random(5)
    rows = [
        (i, r.choice(["hot"] * 5 + ["a", "b", None]), r.choice([None, *range(30)]), r.choice([None, 1, 2, 3]))
        for i in range(600)
    ]
    return spark.createDataFrame(rows, "id BIGINT, k STRING, o INT, v INT").cache()


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "id"]])
def test_sliced_ranks_equal_plain_windows(data, order):
    band = F.floor(F.col("o") / 7) * (-1 if order[0] == "-o" else 1)
    names = dict(row_number="rn", ntile=(4, "nt"), total="n")
    assert_same(w.with_ranks(data, ["k"], order, band, **names), w.with_ranks(data, ["k"], order, None, **names))


@pytest.mark.parametrize("order", [["o"], ["-o"]])
def test_sliced_ranks_with_ties(data, order):
    band = F.floor(F.col("o") / 7) * (-1 if order[0] == "-o" else 1)
    names = dict(rank="rk", dense_rank="dr", percent_rank="pr")
    a = w.with_ranks(data, ["k"], order, band, **names).withColumn("pr", F.round("pr", 9))
    assert_same(a, w.with_ranks(data, ["k"], order, None, **names).withColumn("pr", F.round("pr", 9)))


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "id"]])
def test_sliced_running_sum_and_neighbours(data, order):
    band = F.floor(F.col("o") / 7) * (-1 if order[0] == "-o" else 1)
    assert_same(
        w.with_running_sum(data, ["k"], order, {"s": "v"}, band), w.with_running_sum(data, ["k"], order, {"s": "v"})
    )
    args = (["k"], order, {"p": "v", "pi": "id"}, {"f": "v", "fi": "id"})
    assert_same(w.with_neighbours(data, *args, band), w.with_neighbours(data, *args))


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "id"], ["-o", "-id"]])
def test_sampled_slices_give_the_plain_results(data, order, monkeypatch):
    monkeypatch.setattr(w, "SLICE_ROWS", 40)
    args = (["k"], order, {"p": "v", "pi": "id"}, {"f": "v", "fi": "id"})
    assert_same(w.with_neighbours(data, *args, w.SAMPLED), w.with_neighbours(data, *args))
    assert_same(w.with_running_sum(data, ["k"], order, {"s": "v"}, w.SAMPLED), w.with_running_sum(data, ["k"], order, {"s": "v"}))
    named = {"row_number": "rn", "rank": "rk", "dense_rank": "dr", "ntile": (4, "t"), "total": "n"}
    assert_same(w.with_ranks(data, ["k"], order, w.SAMPLED, **named), w.with_ranks(data, ["k"], order, None, **named))
    assert_same(w.with_ranks(data, ["k"], order[:1], w.SAMPLED, rank="rk", dense_rank="dr"),
                w.with_ranks(data, ["k"], order[:1], None, rank="rk", dense_rank="dr"))


def test_slices_of_a_hot_key_keep_their_size_as_the_data_grows(spark):
    """A key with 30 % of the rows, its values far from even: ten times the rows give ten times the slices."""
    largest = {}
    for n in (20_000, 200_000):
        df = spark.range(n).selectExpr("CASE WHEN id % 10 < 3 THEN -1 ELSE id % 997 END AS k", "CAST(pow(id % 1000, 3) * 1000 + id / 1000 AS BIGINT) AS o", "id")
        sliced = w.range_slices(df, ["k"], ["o", "id"], "s", rows=4000)
        sizes = sliced.groupBy("k", "s").count()
        largest[n] = sizes.agg(F.max("count")).first()[0]
        hot = sizes.where("k = -1")
        assert hot.count() >= 0.3 * n / 4000 * 0.6
        bounds = sliced.groupBy("k", "s").agg(F.min(F.struct("o", "id")).alias("a"), F.max(F.struct("o", "id")).alias("b"))
        after = bounds.withColumn("next", F.lead("a").over(Window.partitionBy("k").orderBy("s")))
        assert after.where("next <= b").isEmpty(), "slices follow the order"
    assert largest[200_000] <= 2 * 4000 and largest[20_000] <= 2 * 4000


load_all()
QUERIES_WITH_SLICES = ["w1_ranking_with_ties", "w2_lag_lead", "w3_running_total", "w5_ntile_percent_rank", "a9_exact_percentiles", "a9_filtered_median",
                       "d9_apply_changes_scd2", "d9_scd2_refresh_touched_keys", "d11_as_of_history", "j12_point_in_time_join_sliced"]


@pytest.mark.parametrize("name", QUERIES_WITH_SLICES)
def test_queries_in_many_slices(spark, name, monkeypatch):
    monkeypatch.setattr(w, "SLICE_ROWS", 700)
    df = registry.queries()[name](spark, oracle.DATA)
    cursor = oracle.connection().execute(registry.oracle_sql()[name])
    assert oracle.compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cursor.description], cursor.fetchall()) is None


def test_more_tiles_than_rows(spark):
    df = spark.range(3).withColumn("k", F.lit(1))
    band = F.col("id")
    assert_same(w.with_ranks(df, ["k"], ["id"], band, ntile=(5, "t")), w.with_ranks(df, ["k"], ["id"], None, ntile=(5, "t")))


@pytest.mark.parametrize("sliced", [False, True])
def test_exact_quantiles(data, sliced):
    bucket = F.floor(F.col("o") / 7) if sliced else None
    got = w.exact_quantiles(data, ["k"], "o", {"p25": 0.25, "p50": 0.5, "p1": 1.0}, bucket)
    want = data.groupBy("k").agg(
        F.percentile("o", 0.25).alias("p25"), F.percentile("o", 0.5).alias("p50"), F.percentile("o", 1.0).alias("p1")
    )
    assert_same(got, want)


def test_latest_per_key_and_top_k(data, rows):
    by_window = w.qualify(
        data, F.row_number().over(Window.partitionBy("k").orderBy(F.desc("o"), F.desc("id"))), "_q = 1"
    )
    assert_same(w.latest_per_key(data, ["k"], ["o", "id"]), by_window)
    top = w.top_k(data, ["k"], ["-o", "id"], 2)
    assert rows(top.groupBy("k").count()) == [(None, 2), ("a", 2), ("b", 2), ("hot", 2)]


def test_top_k_limits_groups_before_the_shuffle(data):
    assert plan_facts(w.top_k(data, ["k"], ["-o", "id"], 2))["group_limits"] == 2


def test_group_total_keeps_null_groups(data):
    got = w.with_group_total(data, ["k"], {"n": F.count("*")})
    assert_same(got, data.withColumn("n", F.count("*").over(Window.partitionBy("k"))))


def test_latest_per_key_breaks_ties_by_content(spark, rows):
    data = [(1, 5, "a"), (1, 5, "b"), (2, 1, None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, "k INT, o INT, v STRING").coalesce(1)
        assert rows(w.latest_per_key(df, ["k"], ["o"])) == [(1, 5, "b"), (2, 1, None)]
