import random

import pytest
from pyspark.sql import functions as F

from lakekit.operators import cdc, windows
from lakekit.operators.compare import assert_same
from lakekit.operators.model import scd2_apply, scd2_start

SCHEMA = "k INT, a STRING, b INT, op STRING, seq INT"
OPTIONS = {"deletes": "op = 'D'", "leave_out": ["op"]}


def model_scd2(events, track):
    """Plain state machine over the ordered events."""
    out = []
    by_key = {}
    for e in events:
        by_key.setdefault(e[0], {})[e[4]] = e
    for k, seqs in by_key.items():
        current = None
        for seq in sorted(seqs):
            _, a, b, op, _ = seqs[seq]
            if op == "D":
                if current:
                    out.append((k, *current, seq))
                current = None
            elif current and (current[0] == a if track == ["a"] else current[:2] == (a, b)):
                current = (a, b, current[2])
            else:
                if current:
                    out.append((k, *current, seq))
                current = (a, b, seq)
        if current:
            out.append((k, *current, None))
    return out


def random_events(seed):
    r = random.Random(seed)
    return [
        (k, r.choice(["x", "y", None]), r.randrange(3), "D" if r.random() < 0.2 else "U", seq)
        for k, n in ((0, 60), (1, 8), (2, 5), (3, 1)) for seq in r.sample(range(100), n)
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("track", [None, ["a"]])
@pytest.mark.parametrize("sliced", [False, True, "sampled"])
def test_scd2_against_model(spark, seed, track, sliced, monkeypatch):
    monkeypatch.setattr(windows, "SLICE_ROWS", 10)
    events = random_events(seed)
    random.Random(seed).shuffle(events)
    df = spark.createDataFrame(events + events[:10], SCHEMA)
    bucket = sliced if isinstance(sliced, str) else F.floor(F.col("seq") / 10) if sliced else None
    got = cdc.apply_changes_scd2(df, ["k"], "seq", track=track, bucket=bucket, **OPTIONS)
    want = spark.createDataFrame(model_scd2(events, track), "k INT, a STRING, b INT, __START_AT INT, __END_AT INT")
    assert_same(got.select(*want.columns), want)


def test_late_event_finds_its_place(spark, rows):
    events = [(18, "INSERT", "Riyadh", "old"), (1020, "UPDATE", "Riyadh", "new"), (1015, "UPDATE", "Osaka", "old")]
    df = spark.createDataFrame([("C", city, mail, op, seq) for seq, op, city, mail in events], "id STRING, city STRING, mail STRING, op STRING, seq INT")
    one = cdc.apply_changes_scd1(df, ["id"], "seq", **OPTIONS)
    assert rows(one) == [("C", "Riyadh", "new")]
    two = cdc.apply_changes_scd2(df, ["id"], "seq", **OPTIONS)
    assert rows(two, "city", cdc.START, cdc.END) == [("Osaka", 1015, 1020), ("Riyadh", 18, 1015), ("Riyadh", 1020, None)]
    assert rows(cdc.as_of(two, 1016), "city") == [("Osaka",)]


@pytest.mark.parametrize("seed", [4, 5])
def test_scd1_does_not_depend_on_batches(spark, seed):
    events = random_events(seed)
    random.Random(seed).shuffle(events)
    df = spark.createDataFrame(events, SCHEMA)
    whole = cdc.apply_changes_scd1(df, ["k"], "seq", **OPTIONS)
    cut = len(events) // 3
    state = cdc.apply_changes_scd1(spark.createDataFrame(events[:cut], SCHEMA), ["k"], "seq", tombstones=True, **OPTIONS)
    for part in (events[cut:2 * cut], events[2 * cut:], events[:5]):
        state = cdc.continue_scd1(state, spark.createDataFrame(part, SCHEMA), ["k"], "seq", deletes="op = 'D'")
    assert_same(state.where("NOT _deleted").select(*whole.columns), whole)


def test_scd1_options(spark, rows):
    ev = spark.createDataFrame(
        [(1, "a", 1, "U", 1), (1, None, 2, "U", 2), (2, "x", 1, "U", 1), (2, None, None, "D", 2), (2, None, 5, "U", 3),
         (3, "old", 1, "U", 1), (9, None, None, "T", 0)], SCHEMA)
    out = cdc.apply_changes_scd1(ev, ["k"], "seq", truncates="op = 'T'", ignore_null_updates=True, **OPTIONS)
    assert rows(out) == [(1, "a", 2), (2, None, 5), (3, "old", 1)]
    later = ev.withColumn("seq", F.expr("CASE WHEN op = 'T' THEN 2 ELSE seq END"))
    out = cdc.apply_changes_scd1(later, ["k"], "seq", truncates="op = 'T'", ignore_null_updates=True, **OPTIONS)
    assert rows(out) == [(2, None, 5)]
    only = cdc.apply_changes_scd1(ev.where("k = 1"), ["k"], "seq", columns=["k", "b"], deletes="op = 'D'")
    assert rows(only) == [(1, 2)]


def test_changes_from_snapshots_rebuild_the_snapshot(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k INT, v STRING")
    b = spark.createDataFrame([(1, "a"), (3, "c"), (4, "d")], "k INT, v STRING")
    start = cdc.changes_from_snapshots(a.limit(0), a, ["k"], 1)
    steps = start.unionByName(cdc.changes_from_snapshots(a, b, ["k"], 2))
    now = cdc.apply_changes_scd1(steps, ["k"], "sequence_num", deletes="operation = 'DELETE'", leave_out=["operation"])
    assert_same(now, b)


def test_scd2_merge_null_safe_idempotent_and_strict(spark, rows):
    base = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "id INT, city STRING")
    dim = scd2_start(base, F.to_timestamp(F.lit("2024-01-01")))
    updates = spark.createDataFrame([(1, "now", "2024-02-01"), (2, "x", "2024-02-01"), (4, "new", "2024-02-01")], "id INT, city STRING, ts STRING")
    once = scd2_apply(dim, updates, ["id"], ["city"], "ts")
    assert rows(once.where("is_current"), "id", "city") == [(1, "now"), (2, "x"), (3, "y"), (4, "new")]
    assert once.count() == 5
    assert_same(scd2_apply(once, updates, ["id"], ["city"], "ts"), once)
    with pytest.raises(Exception, match="older than the current version"):
        scd2_apply(once, updates.selectExpr("id", "'z' AS city", "'2023-01-01' AS ts"), ["id"], ["city"], "ts").collect()
    with pytest.raises(Exception, match="duplicate dimension key"):
        scd2_apply(once, updates.unionAll(updates), ["id"], ["city"], "ts").collect()


def test_equal_sequence_values_do_not_depend_on_the_order_of_rows(spark, rows):
    events = [(1, "a", 5, "U"), (1, "b", 5, "U"), (2, "x", 7, "U"), (2, "y", 7, "D"), (3, None, 2, "U"), (3, "z", 2, "U"), (3, "old", 1, "U")]
    for order in (events, events[::-1], events[3:] + events[:3]):
        frame = spark.createDataFrame(order, "id INT, v STRING, seq INT, op STRING").coalesce(1)
        for ignore in (False, True):
            out = cdc.apply_changes_scd1(frame, ["id"], "seq", deletes="op = 'D'", leave_out=["op"], ignore_null_updates=ignore)
            assert rows(out, "id", "v") == [(1, "b"), (3, "z")]
