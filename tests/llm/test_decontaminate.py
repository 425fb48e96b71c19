import hashlib
import random
import re

from lakekit.llm import queries
from lakekit.llm.decontaminate import decontaminated, find_contamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, items, size=13):
    windows = {}
    for i, item in items:
        w = words(item)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(i))
    mine, hit, found = words(text), set(), set()
    for n in {len(k) for k in windows}:
        for k in range(len(mine) - n + 1):
            if ids := windows.get(tuple(mine[k:k + n])):
                hit |= set(range(k, k + n))
                found |= ids
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(mine), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(mine)


def judged(row):
    return row.n_words, row.n_hit, row.n_items, row.items_sha256, row.contaminated


def test_query_against_all_windows(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = queries.op8_benchmark_decontamination(spark, folder).collect()
    assert {r.doc_id: judged(r) for r in found} == {d: expected(t, items) for d, t in texts.items()}
    assert any(r.contaminated for r in found)


def test_small_alphabet_in_blocks(spark):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["a", "B", "c", "É"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 13, 14, 20, 40]))) for i in range(12)] + [(90, ""), (91, None), (92, "...")]
    docs = [(i, text(rng.choice([0, 1, 5, 40, 200]))) for i in range(60)] + [(100, items[5][1]), (101, None)]
    bench = spark.createDataFrame(items + items[:3], "item_id int, text string")
    frame = spark.createDataFrame(docs, "doc_id int, text string")
    for block in (500_000, 30):  # one block, and many
        found = find_contamination(frame, bench, block_words=block).collect()
        assert {r.doc_id: judged(r) for r in found} == {d: expected(t, items) for d, t in docs}
    for r in found:
        assert sum(s.end - s.start for s in r.hit_spans) == r.n_hit


def test_longest_match_is_told(spark):
    bench = spark.createDataFrame([("x", " ".join(f"w{i}" for i in range(30)))], "item_id string, text string")
    docs = spark.createDataFrame([(1, "a " + " ".join(f"w{i}" for i in range(4, 24)) + " b"), (2, "nothing here")], "doc_id int, text string")
    found = {r.doc_id: r for r in find_contamination(docs, bench).collect()}
    assert (found[1].longest_match, found[1].n_hit, found[2].longest_match) == (13, 20, 0)
    assert [tuple(s) for s in found[1].hit_spans] == [(1, 21)]


def test_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old river bank"), (2, None), (None, "word")],
                                  "item_id int, text string")
    found = find_contamination(awkward, bench).collect()
    assert len(found) == awkward.count()
    assert {(r.doc_id, r.contaminated) for r in found if r.n_hit} == {(1, True)}
    kept = decontaminated(awkward, bench)
    assert kept.columns == awkward.columns
    assert kept.count() == awkward.count() - 2
    assert decontaminated(nothing, bench).count() == 0
    assert decontaminated(awkward, bench.where("false")).count() == awkward.count()


def test_longest_match_beyond_the_window_with_item_and_place(spark):
    """By the definition: for each document the longest run of words that an item has too, of at least a window of that item."""
    rng = random.Random(4)
    text = lambda n: [rng.choice("abcd") + rng.choice("xyz") for _ in range(n)]
    items = [(f"i{k}", text(n)) for k, n in enumerate((13, 20, 60, 200, 200))]
    docs = [(k, text(9) + items[i][1][a:b] + text(5) + items[j][1][c:d]) for k, (i, a, b, j, c, d) in enumerate(
        [(3, 0, 200, 1, 0, 20), (2, 5, 45, 4, 30, 90), (0, 0, 13, 1, 1, 15), (4, 100, 150, 4, 100, 150), (1, 0, 9, 1, 0, 9)])]
    want = {}
    for k, words_ in docs:
        best = (0, None, None)
        for name, item in items:
            for at in range(len(words_)):
                for start in range(len(item)):
                    n = 0
                    while at + n < len(words_) and start + n < len(item) and words_[at + n] == item[start + n]:
                        n += 1
                    if n >= 13 and (-n, name, at) < (-best[0], best[1] or "~", best[2] or 0):
                        best = (n, name, at)
        want[k] = best
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id string, text string")
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in docs], "doc_id int, text string")
    for block in (500_000, 30):
        found = find_contamination(frame, bench, block_words=block).collect()
        assert {r.doc_id: (r.longest_words, r.longest_item, r.longest_start) for r in found} == want
    assert want[0][0] >= 200 and want[4] == (0, None, None)
