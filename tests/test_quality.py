import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakekit.operators import quality as q
from lakekit.operators.compare import assert_same

RULES = {"v_positive": "v > 0", "k_known": "k IN ('a', 'b')"}


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, "z", -1), (4, None, 3), (5, "a", 7)], "id INT, k STRING, v INT")


def test_errors_and_reason(df, rows):
    assert rows(q.tag_errors(df, RULES).where("id IN (2, 3)"), "id", "dq_errors") == [(2, ["v_positive"]), (3, ["v_positive", "k_known"])]
    assert rows(q.first_error(df, RULES), "id", "dq_reason") == [(1, None), (2, "v_positive"), (3, "v_positive"), (4, "k_known"), (5, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_nothing_is_lost_between_valid_and_quarantine(spark, seed):
    r = random.Random(seed)
    df = spark.createDataFrame([(i, r.choice(["a", "z", None]), r.choice([None, -1, 1])) for i in range(200)], "id INT, k STRING, v INT")
    valid, bad = q.split(df, RULES)
    assert_same(valid.unionByName(bad.drop("dq_errors")), df)
    assert valid.where("v IS NULL OR k IS NULL").isEmpty()


def test_report_lists_passing_rules(df, rows):
    assert rows(q.rule_report(df, {**RULES, "id_set": "id IS NOT NULL"})) == [("id_set", 5, 0), ("k_known", 3, 2), ("v_positive", 3, 2)]


def test_expectations(df):
    seen = Observation("seen")
    rules = [q.Expectation("warned", "v > 4", "warn"), q.Expectation("dropped", "k IS NOT NULL", "drop")]
    assert q.apply_expectations(df, rules, seen).count() == 4
    assert seen.get == {"rows": 5, "warned": 3, "dropped": 1}
    with pytest.raises(Exception, match="expectation needed violated"):
        q.apply_expectations(df, [q.Expectation("needed", "v IS NOT NULL", "fail")]).collect()
    # a failing row is not excused by being dropped for another reason, nor by column pruning
    both = [q.Expectation("needed", "v IS NOT NULL", "fail"), q.Expectation("small", "id <> 2", "drop")]
    with pytest.raises(Exception, match="expectation needed violated"):
        q.apply_expectations(df, both).select("id").collect()
    with pytest.raises(ValueError):
        q.Expectation("x", "true", "explode")


def test_constraints_stop_the_write(df, tmp_path):
    with pytest.raises(q.ConstraintViolation, match="v is not null: 1 rows"):
        q.assert_constraints(df, {"id small": "id < 10"}, not_null=["v"])
    assert q.assert_constraints(df, {"id small": "id < 10"}, not_null=["id"]) is df
    with pytest.raises(Exception):
        q.checked(df, {"positive": "v > 0"}).write.parquet(str(tmp_path / "out"))


def test_gate_and_checks(spark, df, rows):
    batches = df.withColumn("batch", F.col("id") % 2)
    problems = batches.where("v IS NULL OR v < 0")
    decisions = q.gate(problems, batches, "batch", 0)
    assert rows(decisions) == [(0, 1, "held"), (1, 1, "held")]
    assert q.released(batches, q.gate(problems, batches, "batch", 1), "batch").count() == 5
    checks = q.checklist({"dups": q.duplicates(df, ["k"]), "orphans": q.orphans(df, spark.createDataFrame([("a",), ("b",)], "kk STRING"), {"k": "kk"}), "none": df.limit(0)})
    assert rows(checks) == [("dups", 1, "FAILED"), ("none", 0, "OK"), ("orphans", 1, "FAILED")]


def test_freshness_of_nothing(spark):
    empty = spark.createDataFrame([], "ts TIMESTAMP")
    assert q.freshness(empty, "ts", F.lit("2024-01-01"), 10).first()["fresh"] is False
