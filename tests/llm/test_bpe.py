import hashlib
import random
import sys
import tracemalloc
from types import SimpleNamespace

import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken

from lakekit.llm import bpe, queries


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def made_texts(count):
    rng = random.Random(5)
    parts = ["'", "s", "t", "re", "ll", "ve", " ", "  ", "\n", "\t", " ", "a", "é", "1", "²", "!", "'S", "d", " ", "漢", "😀", "_", "x'", "''"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(count)] + ["", None, " ", "  ", "'"]


def test_pieces_are_the_matches_of_the_pattern():
    texts = made_texts(5000)
    words, counts = bpe.pieces(pa.array(texts, pa.string()))
    found, at = words.to_pylist(), 0
    pattern = regex.compile(public_tokenizers.PATTERN)
    for text, n in zip(texts, counts.tolist(), strict=True):
        assert found[at:at + n] == [w.encode() for w in pattern.findall(text or "")], text
        at += n
    assert at == len(found)


def test_every_code_point_has_the_librarys_class(ranks, reference):
    """Each code point before an apostrophe, after a letter and after a number, as the library cuts them: its Unicode version counts."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(points), 1 << 16):
        texts = [x for c in points[low:low + (1 << 16)] for x in (c + "'s", "a" + c, "1" + c)]
        words, counts = bpe.pieces(pa.array(texts, pa.string()))
        found, bounds = words.to_pylist(), [0, *counts.cumsum().tolist()]
        known: dict[bytes, list[int]] = {}
        for text, start, end in zip(texts, bounds, bounds[1:], strict=False):
            ids = [i for w in found[start:end] for i in known.setdefault(w, None) or known.__setitem__(w, bpe.merged_long(w, ranks)) or known[w]]
            assert ids == reference.encode_ordinary(text), text.encode()


def test_merges_of_long_pieces(ranks, reference):
    rng = random.Random(2)
    for size in (1, 2, 257, 3000):
        piece = "".join(rng.choice("abcdethonaris") for _ in range(size))
        assert bpe.merged_long(piece.encode(), ranks) == reference.encode_ordinary(piece)


def test_encoding_equals_the_library_and_decodes(spark, ranks, reference):
    texts = made_texts(1500)
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(3)
    # several slices a task, and pieces forgotten between them
    coded = bpe.encode(frame, ranks, slice_bytes=5000, remembered=300)
    for row in bpe.decode(coded, ranks).collect():
        assert row.ids == reference.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_query(spark, reference, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op1_byte_level_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = reference.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_awkward_rows(awkward, nothing, ranks, reference):
    out = bpe.encode(awkward, ranks, decoded=True)
    assert out.columns == [c for c in awkward.columns if c != "IDS"] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert all(r.ids == reference.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert bpe.encode(nothing, ranks).count() == 0


def test_incomplete_ranks_are_refused(awkward):
    with pytest.raises(ValueError, match="every byte"):
        bpe.encode(awkward, {b"a": 0})


def test_passes_hold_little():
    """The two Python passes over 4 MB of text take far less than they would with the arrays of a whole slice, and list the ranks once."""
    dice = random.Random(5)
    texts = [" ".join("".join(dice.choice("abcdefghij") for _ in range(dice.randint(1, 9))) for _ in range(2000)) for _ in range(400)]
    ranks = {bytes([b]): b for b in range(256)}
    shared = SimpleNamespace(value=ranks)
    batches = [pa.RecordBatch.from_pydict({"c0": list(range(k, k + 100)), "one": [0] * 100, "_text": texts[k:k + 100]}) for k in range(0, 400, 100)]
    bpe._classes()

    def coded():
        for row in bpe._numbered(["c0", "one", "_text"], shared, bpe.SLICE, bpe.REMEMBERED)(iter(batches)):
            columns = {("merged" if n == "open" else n): row.column(n) for n in row.schema.names}  # no two bytes merge here
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    tracemalloc.start()
    found = []
    for out in bpe._ordered(["c0", "one", "_text"], shared)(coded()):
        found += [(i, x) for i, x in zip(out.column("c0").to_pylist(), (out.column("decoded").to_pylist()), strict=True)]
    most = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert found == [(i, t.encode()) for i, t in enumerate(texts)]
    assert most < 70, most
