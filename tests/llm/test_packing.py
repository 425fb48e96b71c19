"""Packing: ids against the tokenizer library, coverage, gaps, and cuts against plain dynamic programming."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lakekit.llm import packing
from lakekit.llm.queries import op12_sequence_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_query_covers_every_token_once(spark, folder, tokenizer):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op12_sequence_packing(spark, folder).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(texts)
    for doc_id, found in pieces.items():
        ids = [*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes())
        assert at == len(ids)
    padding = total = 0
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.02 * total


def plain(places, penalties, length):
    """Least cost over all cuts, each pair of places tried."""
    best = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            n = int(places[j] - places[i])
            if n <= length:
                cost = best[i] + (0 if n & (n - 1) == 0 else length - n) + int(penalties[j]) + packing.WINDOW
                best[j] = cost if best[j] is None else min(best[j], cost)
    return best[-1]


@pytest.mark.parametrize("seed", range(40))
def test_cuts_are_the_best(seed):
    dice = random.Random(seed)
    length = dice.choice([8, 16, 100])
    places = np.cumsum([0, *(dice.randint(1, min(length, dice.choice([3, 9, 60]))) for _ in range(dice.randint(1, 60)))])
    penalties = np.array([dice.choice([0, 1, 5, 40]) for _ in places])
    cuts = packing.best_cuts(places, penalties, length)
    assert cuts[0] == 0 and cuts[-1] == len(places) - 1
    sizes = np.diff(places[cuts])
    assert sizes.min() > 0 and sizes.max() <= length
    paid = sum(0 if n & (n - 1) == 0 else length - n for n in sizes.tolist()) + penalties[cuts[1:]].sum() + packing.WINDOW * len(sizes)
    assert paid == plain(places, penalties, length)


def test_word_by_word_ids_are_those_of_whole_texts(tokenizer):
    import pyarrow as pa

    dice = random.Random(7)
    parts = ["don't", "THE", "É", "é", "́", " ", "  ", "\n", "\t", " ", "　", "ΑΣ", "Σ", "ﬁ", "İ", "123", "<|endoftext|>",
             "...", "!?", "😀", "中文", "'s", "a'll", "\x00", "\x1f", " ", "각", "각", "𝔄"]
    texts = ["".join(dice.choice(parts) for _ in range(dice.randint(0, 30))) for _ in range(2000)]
    ids, ends, stops = packing.Tokens(PATH).stream(pa.array([*texts, None]))
    assert (np.diff(stops) >= 0).all()
    for text, start, end in zip([*texts, ""], np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        assert ids[start:end].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text


def test_words_of_latin_letters_are_encoded_by_the_hundred(tokenizer, monkeypatch):
    import pyarrow as pa

    letters = [chr(c) for c in range(0xC0, 0x240)]
    dice = random.Random(3)
    texts = [*letters, *("".join(dice.choice([*letters, "a", "Z", "7", ",", " "]) for _ in range(9)) for _ in range(3000))]
    ours = packing.Tokens(PATH)
    ids, ends, _ = ours.stream(pa.array(texts))
    for text, start, end in zip(texts, np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True):
        assert ids[start:end].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1], text
    calls = []
    monkeypatch.setattr(ours, "_encoded", lambda texts, of=ours._encoded: calls.append(len(texts)) or of(texts))
    ours.stream(pa.array([" ".join(f"{a}ñ{b}" for a in letters[:20] for b in letters[60:90])]))
    assert sum(calls) < 20


def test_pieces_met_often_are_not_forgotten(tokenizer, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "REMEMBERED", 50)
    ours, often = packing._tokens(PATH), "met in every text"
    assert packing._tokens(PATH) is ours  # by the next task of the worker as well
    for i in range(0, 900, 30):
        text = " ".join([often, *(f"word{chr(97 + n % 26)}{chr(97 + n // 26)}x" for n in range(i, i + 30))])
        ids, _, _ = ours.stream(pa.array([text]))
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert len(ours.known) <= 50 + 35 and all(w.encode() in ours.known for w in often.split())


def test_pieces_join_without_loss(spark):
    """Documents of very different lengths, empty ones among them."""
    import pyarrow as pa

    texts = ["one two three. four five " * n for n in (1, 700, 3, 0, 5000, 2, 90)]
    stream = packing.Tokens(PATH).stream(pa.array(texts))
    assert len(stream[1]) == len(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    rows = packing.pack(frame, PATH).collect()
    for i, text in enumerate(texts):
        found = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert [r.start for r in found] == np.cumsum([0, *(r.length for r in found)])[:-1].tolist()
        assert len(b"".join(r.ids for r in found)) == 4 * found[0].doc_tokens


def test_streams_of_many_segments(spark):
    text = "a sentence of seven plain words here. " * 180_000  # over one segment, in one document
    frame = spark.createDataFrame([(i, text if i == 1 else "short text.") for i in range(4)], "doc_id long, text string").repartition(1)
    rows = packing.pack(frame, PATH).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == next(r.doc_tokens for r in rows if r.doc_id == 1) > packing.SEGMENT
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n


def test_awkward_rows(spark, awkward, nothing):
    rows = packing.pack(awkward, PATH, keep=awkward.columns).collect()
    starts = [r for r in rows if r.start == 0]
    assert len(starts) == awkward.count()
    assert all(r.doc_tokens == 1 and np.frombuffer(r.ids, "<u4").tolist() == [1] for r in rows if r.doc_id in (2, 3, 4))
    assert {r["a.b"] for r in rows} == {"dot"}
    assert packing.pack(nothing, PATH).collect() == []
