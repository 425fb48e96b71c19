import numpy as np
import pyarrow as pa
import pytest

from lakekit.llm import langid, queries


@pytest.fixture(scope="module")
def field(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id % 5 = 0").collect()
    return langid.fit_field([r.text for r in rows], [r.lang for r in rows])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.op3_language_identification(spark, folder).join(documents, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_words_of_code_switched_text(field):
    text = "the and of that with this from und der die das nicht ein schlich le la des que pour dans est"
    found = langid.Vocabulary(pa.array([text]))
    chance, _ = langid.marginals(found.emissions(field)[found.codes], found.first, field.moves)
    best = [field.languages[i] for i in chance.argmax(axis=1)]
    assert best[0] == "en" and best[8] == "de" and best[-2] == "fr"
    assert field.moves.diagonal().min() > field.moves[~np.eye(len(field.languages), dtype=bool)].max()


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    scores, moves = rng.normal(size=(6, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 4, 4, 6])
    chance, expected = langid.marginals(scores, first, moves)
    by_hand, pairs = np.zeros((6, 3)), np.zeros((3, 3))
    for a, b in zip(first[:-1], first[1:], strict=True):
        paths = np.array(np.meshgrid(*[range(3)] * (b - a), indexing="ij")).reshape(b - a, -1).T if b > a else []
        weights = [np.exp(sum(scores[a + t, k] for t, k in enumerate(p)) + sum(moves[p[t], p[t + 1]] for t in range(len(p) - 1))) for p in paths]
        for p, w in zip(paths, weights, strict=True):
            for t, k in enumerate(p):
                by_hand[a + t, k] += w / sum(weights)
            for t in range(len(p) - 1):
                pairs[p[t], p[t + 1]] += w / sum(weights)
    assert np.allclose(chance, by_hand) and np.allclose(expected, pairs)


def test_awkward_rows(awkward, nothing, field):
    out = langid.predict(awkward, field)
    assert out.columns == [c for c in awkward.columns if c not in ("score", "n_words")] + ["lang_pred", "score", "n_words", "shares"]
    found = out.collect()
    assert len(found) == awkward.count()
    assert {r.doc_id: r.lang_pred for r in found if r.n_words == 0} == {2: "und", 3: "und", 4: "und"}
    assert langid.predict(nothing, field).count() == 0


def test_no_labels_and_no_letters(spark, awkward):
    empty = langid.learn(awkward.where("lang = 'xx'"))
    assert {r.lang_pred for r in langid.predict(awkward, empty).collect()} == {"und"}
    odd = spark.createDataFrame([(1, "€€ 12 …"), (2, "٣٤")], "doc_id long, text string")
    one = langid.fit_field(["some words"], ["en"])
    assert {r.lang_pred for r in langid.predict(odd, one).collect()} == {"und"}
    assert langid.predict(spark.createDataFrame([(1, "word")], "doc_id long, text string"), one).first().lang_pred == "en"


def test_the_sample_is_bounded_with_one_id_repeated(spark, monkeypatch):
    """Three thousand rows of one id, and a text beyond the bound: the driver gets one text per id, none over the bound."""
    seen = []
    monkeypatch.setattr(langid, "fit_field", lambda texts, labels: seen.append((texts, labels)))
    rows = [(1, f"one text of many {i}", "en") for i in range(3000)] + [(i, f"mots de texte {i}", "fr") for i in range(2, 1500)] + [(9999, "long " * 40_000, "fr")]
    langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6), sample=800)
    texts, labels = seen[0]
    assert labels.count("en") == 1 and labels.count("fr") == 400 and sum(map(len, texts)) < 400 * 100


def test_memory_does_not_follow_the_number_of_distinct_words(field):
    """Beyond what is returned; and a pass works on a slice of a batch, its free memory given back at the end."""
    import tracemalloc

    found = langid.Vocabulary(pa.array([" ".join(f"wort{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}q" for i in range(17_000)) + " für"] * 2))
    whole = sum(field.weights[g] for g in found.grams())
    whole = np.add.reduceat(whole, found.start[:-1], axis=0) + field.weights[found.lexicons(field)]
    tracemalloc.start()
    scores = found.emissions(field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(scores, whole) and len(found.words) > 16_000
    assert peak < 10 << 20


def test_a_pass_gives_its_memory_back(monkeypatch):
    from lakekit.llm import arrow_text

    calls = []
    monkeypatch.setattr(arrow_text, "give_back", lambda: calls.append(1))
    batch = pa.record_batch({"a": [1, 2]})
    assert [b.num_rows for b in arrow_text.frugal(lambda batches: (b.slice(1) for b in batches))(iter([batch]))] == [1] and calls == [1]
