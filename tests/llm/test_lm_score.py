import random

import numpy as np
import pytest

from lakekit.llm import lm_score, queries


def test_counts_are_of_the_whole_corpus(spark):
    rows = [("a b A",), ("b  b\nc",), (None,), ("",)]
    frame = spark.createDataFrame(rows, "text string").repartition(3)
    assert lm_score.frequent_words(frame, listed=2) == [b"b", b"a"]


def test_log_chances_sum_to_one():
    net = lm_score.Network()
    around = np.repeat(np.array([[1, 2, 3, 4]]), lm_score.KINDS, axis=0)
    assert np.exp(net.log_chances(around, np.arange(lm_score.KINDS))).sum() == pytest.approx(1, abs=1e-4)
    again = lm_score.Network.unpacked(net.packed())
    assert all((a == b).all() for a, b in zip(net.weights, again.weights, strict=True))


def test_training_step_follows_the_slope(monkeypatch):
    """Slopes of all weights against differences of the loss."""
    rng = np.random.default_rng(3)
    around, target = rng.integers(0, 50, (20, 4)), rng.integers(0, 100, 20)
    slopes = {}
    monkeypatch.setattr(lm_score.Network, "_step", lambda self, i, slope, at=slice(None): slopes.setdefault(i, []).append((at, slope.copy())))
    net = lm_score.Network()
    net.train(around, target)
    loss = lambda: -net.log_chances(around, target).mean()
    for i, found in slopes.items():
        whole = np.zeros_like(net.weights[i])
        for at, slope in found:
            whole[at] += slope
        flat = whole.reshape(-1)
        for k in np.argsort(-np.abs(flat))[:5]:
            weight = net.weights[i].reshape(-1)
            was = weight[k]
            weight[k] = was + 1e-2
            up = loss()
            weight[k] = was - 1e-2
            assert flat[k] == pytest.approx((up - loss()) / 2e-2, rel=0.05, abs=1e-4)
            weight[k] = was


def test_real_order_beats_shuffled_order(spark):
    rng = random.Random(4)
    phrases = ["the cat sat on the mat", "a dog ran to the old house", "we saw many small birds there", "rain fell on the dry field all night"]
    text = lambda: " ".join(rng.choice(phrases) for _ in range(40))
    docs = spark.createDataFrame([(i, text()) for i in range(150)], "doc_id long, text string").repartition(2)
    listed = lm_score.frequent_words(docs)
    net = lm_score.train(docs, listed)
    good = text()
    words = good.split()
    rng.shuffle(words)
    tests = spark.createDataFrame([(1, good), (2, " ".join(words)), (3, None), (4, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in lm_score.score(tests, net, listed).collect()}
    assert found[1].mean_log_likelihood > found[2].mean_log_likelihood + 0.5
    assert found[1].log_likelihood == pytest.approx(found[1].mean_log_likelihood * found[1].n_tokens)
    assert (found[3].n_tokens, found[3].log_likelihood, found[3].mean_log_likelihood) == (0, 0.0, None) == tuple(found[4])[2:]


def test_weights_of_many_tasks_are_averaged(spark):
    docs = spark.createDataFrame([(f"some words number {i} of this",) for i in range(80)], "text string").repartition(40)
    listed = lm_score.frequent_words(docs)
    net = lm_score.train(docs, listed)
    assert np.isfinite(np.concatenate([w.reshape(-1) for w in net.weights])).all()
    assert lm_score.train(docs.where("false"), listed).packed() == lm_score.Network().packed()


def test_query_and_awkward_rows(spark, folder, awkward, nothing):
    found = queries.op10_language_model_scores(spark, folder).collect()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.log_likelihood < 0 for r in found if r.n_tokens)
    listed = lm_score.frequent_words(awkward)
    out = lm_score.score(awkward, lm_score.train(awkward, listed), listed)
    assert out.count() == awkward.count()
    assert lm_score.frequent_words(nothing) == [] and lm_score.score(nothing, lm_score.Network(), []).count() == 0
