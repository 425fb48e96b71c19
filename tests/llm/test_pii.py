import hashlib
import random
import re
import time

import numpy as np

from lakekit.llm import pii, queries
from lakekit.llm.boosting import BoostedTrees, calibrated


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    return {
        "email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)],
        "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))],
        "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))],
        "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15],
    }


def test_base_spans_are_those_of_the_rules():
    rng = random.Random(3)
    parts = ["a", "b.", "@", ".", "1", "25", "300", "-", " ", "+", "(", ")", "é", "@x.y", "1.2.3.4", "4111111111111111", "0000", "_%"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert pii.base_spans(text) == plain(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 100_000, "+" + "1 " * 100_000, "a." * 100_000 + "@"):
        base = pii.base_spans(text)
        assert pii.chosen(text, base, MODEL)["email"] == base["email"]


def test_many_candidates_take_linear_time():
    """Over ten thousand local and international numbers in one text: twice the text takes about twice the time."""
    took = []
    for n in (3000, 6000):
        text = "call 030-5551-234 or (212) 555-0199 or +49 30 5550 1234 now " * n
        base = pii.base_spans(text)
        assert len(pii.candidates(text, base)) >= 2 * n
        start = time.process_time()
        spans = pii.chosen(text, base, MODEL)
        took.append(time.process_time() - start)
        ordered = sorted(x for k in pii.KINDS for x in spans[k] if x not in base[k])
        assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:], strict=False))
    assert took[1] < 3 * took[0] + 0.5


def test_overlaps():
    spans = [(2, 4), (4, 6), (9, 12)]
    for start in range(14):
        for end in range(start + 1, 15):
            assert pii.overlaps(spans, start, end) == any(s < end and start < e for s, e in spans)


MODEL = pii.fitted()


def test_added_spans():
    def added(text):
        base = pii.base_spans(text)
        every = pii.chosen(text, base, MODEL)
        return [(k, text[s:e]) for k in pii.KINDS for s, e in every[k] if (s, e) not in base[k]]

    assert added("please call (226) 555-1909 now") == [("phone", "(226) 555-1909")]
    assert added("mail joe.b [at] example.com today") == [("email", "joe.b [at] example.com")]
    assert added("card 371449635398431 ok") == [("card", "371449635398431")]
    for clean in ("order 2020-10-11 x", "Version 2.0 of 12 34", "sha 0641917ea4e9feb9cda83477b57ac2654884f485", "in 1990 there were 250 of 300", ""):
        assert added(clean) == []


def test_query_against_plain_rules(spark, folder):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op9_personal_data(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        base = plain(texts[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k in pii.KINDS for s, e in base[k])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base[k]) for k in pii.KINDS)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))


def test_boosting_and_calibration():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(400, 4))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    trees = BoostedTrees(rounds=40).fit(rows[:300], labels[:300])
    assert ((trees.score(rows[300:]) > 0) == labels[300:]).mean() > 0.9
    assert calibrated(np.array([3.0, 2, 1, 1, 0]), np.array([1, 1, 0, 1, 0]), 1.0) == 2.0
    assert calibrated(np.array([1.0]), np.array([0.0]), 0.9) == float("inf")


def test_awkward_rows(awkward, nothing):
    out = pii.find_personal_data(awkward, redacted=True)
    found = out.collect()
    assert len(found) == awkward.count() and all(r.redacted == (r.text or "") for r in found)
    assert out.columns[:len(awkward.columns)] == awkward.columns
    assert pii.find_personal_data(nothing).count() == 0


def test_redaction(spark):
    frame = spark.createDataFrame([(1, "to é.a@b.co from 1.2.3.4, call +1 (226) 555-1909.")], "doc_id long, text string")
    assert pii.find_personal_data(frame, redacted=True).first().redacted == "to é[email] from [ip], call [phone]."
