import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from lakekit.llm import fingerprints as fp


def one(text):
    return fp._written(fp._slots([text]))[0]


def alike(a, b):
    found = fp._slots([a, b])
    return float(fp._likeness(found[:1], found[1:])[0])


def words(rng, count):
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(count))


def test_likeness_follows_shared_text_whatever_its_offset():
    rng = random.Random(1)
    text, other = words(rng, 2000), words(rng, 2000)
    assert alike(text, text) == 1.0 and alike("", "") == 1.0 and alike("", text) == 0.0
    assert alike(text, other) < 0.05
    assert alike(text, "moved by a few words: " + text) > 0.9
    half = len(text) // 2
    assert 0.15 < alike(text, text[:half] + other[:half]) < 0.55  # a third of all phrases is shared


def test_phrases_inside_equal_substrings_are_equal():
    rng = random.Random(3)
    text = words(rng, 500)
    names = []
    for lead in ("", "q", "zz top", words(rng, 40) + " "):
        codes = np.frombuffer((lead + text).encode("utf-32-le"), np.uint32)
        names.append([set(n.tolist()) for level, n, *_ in fp.parsed(codes, np.zeros(len(codes), np.int64), 1) if level <= 4])
    for other in names[1:]:
        for level, share in enumerate((0.98, 0.97, 0.95, 0.85)):
            assert len(names[0][level] & other[level]) >= share * len(names[0][level])


def test_a_fingerprint_does_not_depend_on_the_batch():
    rng = random.Random(4)
    texts = ["", "a", "aa", "ab", "a" * 500, "ab" * 300, "é😀", *(words(rng, n) for n in (1, 3, 10, 200))]
    assert fp._written(fp._slots(texts)) == [one(t) for t in texts]


def neighbours(frame, **columns):
    return {r.doc_id: r for r in fp.edited_neighbours(frame, **columns).collect()}


def test_edited_text_and_neighbours_against_plain_python(spark):
    rng = random.Random(5)
    rows = [(i * 3, words(rng, rng.choice([0, 1, 5, 60, 300]))) for i in range(120)] + [(1000, None), (2000, "é" * 401)]
    found = neighbours(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    order = sorted(((d, t or "") for d, t in rows), reverse=True)
    assert len(found) == len(rows)
    for i, (d, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = found[d]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (one(text), one(edited))
        assert (r.near_edited, r.near_next) == (alike(text, edited), alike(text, after))


def test_a_hot_id_is_spread_and_nothing_is_lost(spark):
    rows = [(7, f"text number {i} of the hot id") for i in range(400)] + [(i, f"other {i}") for i in range(8, 60)] + [(None, f"null {i}") for i in range(99)]
    found = fp.edited_neighbours(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.fingerprint for r in found) == sorted(one(t) for _, t in rows)


def test_single_document_and_empty_table(spark):
    found = neighbours(spark.createDataFrame([(1, "abcd")], "doc_id long, text string"))
    assert found[1].edited_sha256 == hashlib.sha256(b"abab").hexdigest() and found[1].near_next == 1.0
    assert fp.edited_neighbours(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_awkward_rows(awkward, nothing):
    out = fp.fingerprints(awkward)
    assert out.columns == [c for c in awkward.columns if c != "Fingerprint"] + ["fingerprint"]
    assert sorted(r.fingerprint for r in out.collect()) == sorted(one(r.text or "") for r in awkward.collect())
    assert fp.fingerprints(nothing).count() == 0
    assert fp.edited_neighbours(awkward).count() == awkward.count()


def test_likeness_of_columns(spark):
    rng = random.Random(6)
    a = words(rng, 100)
    pairs = [(a, a), (a, a + " and more " + words(rng, 30)), (a, ""), ("", "")]
    frame = spark.createDataFrame([(i, one(x), one(y)) for i, (x, y) in enumerate(pairs)], "i int, x string, y string")
    found = [r[0] for r in frame.orderBy("i").select(fp.likeness(F.col("x"), F.col("y"))).collect()]
    assert found == [alike(x, y) for x, y in pairs]
