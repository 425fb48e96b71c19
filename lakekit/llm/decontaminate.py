"""Benchmark decontamination with suffix arrays over shards of the training text.

A shard is a slice of an Arrow batch. Its words become numbers, and the suffixes that could begin a match (those in runs of
words that the benchmark knows) are sorted by prefix doubling. Every suffix of every test item is then looked up by binary
search, which gives its longest verbatim match up to a window and the places where each window occurs; windows at consecutive
places of an item and a document are chained, which gives matches of any length. Nothing is shuffled: a
passage shared by a third of the documents costs the same in every shard as any other. Test items are sent to the tasks in
blocks of a bounded number of words, so that neither the driver nor a task holds more than one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakekit.llm.arrow_text import ALPHANUMERIC, Carried, Words, arrow_batches, chunks, spans_of, whole_row

RESULT = ("n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest_match long, "
          "items array<string>, hit_spans array<struct<start: long, end: long>>, "
          "longest_words long, longest_item string, longest_start long")


class TestItems:
    """One block of test items: their distinct words, each item's words as numbers, window lengths and ids."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        words = Words(pa.array(texts, pa.string()), ALPHANUMERIC)
        self.codes, vocabulary = words.coded()
        self.vocabulary = vocabulary.to_pylist()
        self.ids = ids
        counts = np.diff(words.first)
        self.item = np.repeat(np.arange(len(ids)), counts)
        self.left = np.repeat(words.first[1:], counts) - np.arange(len(words))  # words from here to the item's end
        self.length = np.minimum(window, counts)[self.item]  # of the window that would start here
        self.shortest = int(self.length.min()) if len(self.length) else 0


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> Iterator[TestItems]:
    """Items one after the other, cut into blocks of about ``block_words`` words; the driver holds one block."""
    ids, texts, held = [], [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).distinct()
    for row in rows.toLocalIterator():
        if row.i is None or row.t is None:
            continue
        ids.append(row.i)
        texts.append(row.t)
        held += row.t.count(" ") + 1
        if held >= block_words:
            yield TestItems(ids, texts, window)
            ids, texts, held = [], [], 0
    if ids:
        yield TestItems(ids, texts, window)


def suffix_array(codes: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` words (or more) that follow each of them in ``codes``."""
    size = len(codes)
    rank = np.append(codes + 1, 0)  # 0: after the end
    span = 1
    while span < depth:
        ahead = rank[np.minimum(np.arange(size) + span, size)]
        key = rank[:-1].astype(np.int64) * (int(rank.max()) + 1) + ahead
        _, found = np.unique(key, return_inverse=True)
        rank = np.append(found + 1, 0)
        span *= 2
    return places[np.argsort(rank[places], kind="stable")]


def _longest(codes: np.ndarray, order: np.ndarray, items: np.ndarray, left: np.ndarray, depth: int):
    """For each test suffix: its longest match in the shard up to ``depth`` words, by binary search for its place."""
    count = len(items)
    width = np.arange(depth)
    padded = np.append(items, np.full(depth, -2))
    want = padded[np.arange(count)[:, None] + width]
    want[width[None, :] >= left[:, None]] = -2  # below every word: a suffix sorts before its longer forms
    text = np.append(codes, np.full(depth, -3))

    def compared(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sign of (suffix in the shard - test suffix), and the number of words they share."""
        have = text[order[at][:, None] + width]
        differ = have != want[rows]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
        one = np.minimum(shared, depth - 1)
        pick = np.arange(len(rows))
        return np.sign(have[pick, one] - want[rows][pick, one]) * (shared < depth), shared

    low, high = np.zeros(count, np.int64), np.full(count, len(order))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        sign, _ = compared(middle, open_)
        below = sign < 0
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
    best = np.zeros(count, np.int64)
    for step in (-1, 0):  # the neighbours of the place share the most
        near = np.flatnonzero((low + step >= 0) & (low + step < len(order)))
        _, shared = compared(low[near] + step, near)
        best[near] = np.maximum(best[near], shared)
    return np.minimum(best, left)


def _range(codes: np.ndarray, order: np.ndarray, want: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place in the suffix array of suffixes that start with ``want[i][:lengths[i]]``."""
    depth = want.shape[1]
    width = np.arange(depth)
    text = np.append(codes, np.full(depth, -3))
    beyond = width[None, :] >= lengths[:, None]
    ends = []
    for after in (False, True):
        low, high = np.zeros(len(want), np.int64), np.full(len(want), len(order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            have = text[order[middle][:, None] + width]
            differ = (have != want[open_]) & ~beyond[open_]
            one = differ.argmax(axis=1)
            pick = np.arange(len(open_))
            less = np.where(differ.any(axis=1), have[pick, one] < want[open_][pick, one], after)
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        ends.append(low)
    return ends[0], ends[1]


class Shard:
    """Suffix array of a slice of documents, and what the test items hit in it."""

    def __init__(self, texts: pa.Array):
        self.words = Words(texts, ALPHANUMERIC)
        self.codes, self.dictionary = self.words.coded()
        self.size = len(self.codes)
        self.first = self.words.first
        self.hit = np.zeros(self.size + 1, np.int64)
        self.longest = np.zeros(len(texts), np.int64)
        self.found: list[tuple[np.ndarray, list[str]]] = []
        self.best: dict[int, tuple[int, str, int]] = {}  # per document: words (negative), item and place of the longest match

    def probe(self, block: TestItems, window: int) -> None:
        if not self.size or not len(block.codes):
            return
        theirs = pc.index_in(pa.array(block.vocabulary, pa.large_binary()), value_set=self.dictionary)
        mine = pc.fill_null(theirs, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = np.zeros(len(self.dictionary), dtype=bool)
        known[mine[mine >= 0]] = True
        places = self._in_runs(known[self.codes], block.shortest)
        if not len(places):
            return
        # only the neighbourhood of such places is ranked; all other words are one symbol that no item has
        near = np.zeros(self.size + 1, np.int64)
        np.add.at(near, places, 1)
        np.add.at(near, np.minimum(places + window, self.size), -1)
        text_places = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        gaps = np.append(0, np.cumsum(np.diff(text_places) > 1))
        document = np.searchsorted(self.first, text_places, side="right") - 1
        gaps += np.append(0, np.cumsum(np.diff(document) != 0))
        at = np.arange(len(text_places)) + gaps  # a hole between pieces and between documents
        codes = np.full(at[-1] + 2, -1, np.int64)
        codes[at] = self.codes[text_places]
        back = np.full(len(codes), -1, np.int64)
        back[at] = text_places
        inside = np.zeros(len(codes), dtype=bool)
        inside[at[np.isin(text_places, places)]] = True
        order = suffix_array(codes, np.flatnonzero(inside), window)

        items = mine[block.codes]
        depth = window
        best = _longest(codes, order, np.where(items < 0, -2, items), block.left, depth)
        whole = np.flatnonzero((best >= block.length) & (block.left >= block.length))
        self._note_longest(best, codes, order, items, block, back)
        if not len(whole):
            return
        width = np.arange(depth)
        want = np.append(items, np.full(depth, -2))[whole[:, None] + width]
        low, high = _range(codes, order, want, block.length[whole])
        spots = back[order[spans_of(low, high - low)]]
        lengths = np.repeat(block.length[whole], high - low)
        self._note_chains(np.repeat(whole, high - low), spots, lengths, block)
        np.add.at(self.hit, spots, 1)
        np.add.at(self.hit, spots + lengths, -1)
        documents = np.searchsorted(self.first, spots, side="right") - 1
        pairs = np.unique(documents * len(block.ids) + np.repeat(block.item[whole], high - low))
        self.found.append((pairs // len(block.ids), [block.ids[i] for i in (pairs % len(block.ids)).tolist()]))

    def _in_runs(self, known: np.ndarray, shortest: int) -> np.ndarray:
        """Places in runs of at least ``shortest`` known words of one document."""
        edge = np.zeros(self.size + 1, dtype=bool)
        edge[self.first] = True
        starts = np.flatnonzero(known & (np.append(True, ~known[:-1]) | edge[:-1]))
        ends = np.flatnonzero(known & (np.append(~known[1:], True) | edge[1:])) + 1
        long = ends - starts >= shortest
        return spans_of(starts[long], (ends - starts)[long])

    def _note_longest(self, best, codes, order, items, block: TestItems, back) -> None:
        """Longest match (up to the window) per document, from the places of every suffix's longest match."""
        some = np.flatnonzero((best > 0) & (best >= block.shortest))
        if not len(some):
            return
        width = np.arange(int(best[some].max()))
        want = np.append(items, np.full(len(width), -2))[some[:, None] + width]
        low, high = _range(codes, order, want, best[some])
        spots = back[order[spans_of(low, high - low)]]
        documents = np.searchsorted(self.first, spots, side="right") - 1
        self._note_places(documents, np.repeat(best[some], high - low), np.repeat(block.item[some], high - low), spots, block)
        np.maximum.at(self.longest, documents, np.repeat(best[some], high - low))

    def _note_chains(self, suffixes, spots, lengths, block: TestItems) -> None:
        """Windows that follow each other in an item and in a document are one match."""
        order = np.lexsort((spots, spots - suffixes))
        suffixes, spots, lengths = suffixes[order], spots[order], lengths[order]
        items = block.item[suffixes]
        documents = np.searchsorted(self.first, spots, side="right") - 1
        new = np.append(True, (np.diff(spots) != 1) | (np.diff(suffixes) != 1) | (np.diff(items) != 0) | (np.diff(documents) != 0))
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(spots)) - 1
        self._note_places(documents[head], spots[last] + lengths[last] - spots[head], items[head], spots[head], block)

    def _note_places(self, documents, lengths, items, spots, block: TestItems) -> None:
        """Keep the longest match of each document, of equal ones that of the smallest item id, then the first place."""
        most = np.zeros(len(self.longest), np.int64)
        np.maximum.at(most, documents, lengths)
        top = lengths == most[documents]
        for d, n, i, at in zip(*(x[top].tolist() for x in (documents, lengths, items, spots)), strict=True):
            match = (-n, block.ids[i], at - int(self.first[d]))
            if d not in self.best or match < self.best[d]:
                self.best[d] = match

    def result(self, share: int) -> dict[str, pa.Array]:
        covered = np.cumsum(self.hit[:-1]) > 0
        counts = np.append(0, np.cumsum(covered))
        n_words = np.diff(self.first)
        n_hit = counts[self.first[1:]] - counts[self.first[:-1]]
        items: list[list[str]] = [[] for _ in n_words]
        for documents, ids in self.found:
            for d, i in zip(documents.tolist(), ids, strict=True):
                items[d].append(i)
        items = [sorted(set(x)) for x in items]
        spans: list[list[dict]] = [[] for _ in n_words]
        for d in np.flatnonzero(n_hit).tolist():
            a, b = self.first[d], self.first[d + 1]
            flips = np.flatnonzero(np.diff(np.concatenate(([0], covered[a:b].astype(np.int8), [0]))))
            spans[d] = [{"start": int(s), "end": int(e)} for s, e in zip(flips[::2], flips[1::2], strict=True)]
        return {
            "n_words": pa.array(n_words, pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items], pa.string()),
            "contaminated": pa.array((n_hit > 0) & (share * n_hit >= n_words), pa.bool_()),
            "longest_match": pa.array(self.longest, pa.int64()),
            "items": pa.array(items, pa.list_(pa.string())),
            "hit_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "longest_words": pa.array([-self.best[d][0] if d in self.best else 0 for d in range(len(n_words))], pa.int64()),
            "longest_item": pa.array([self.best[d][1] if d in self.best else None for d in range(len(n_words))], pa.string()),
            "longest_start": pa.array([self.best[d][2] if d in self.best else None for d in range(len(n_words))], pa.int64()),
        }


def find_contamination(
    documents: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 13, share: int = 20, block_words: int = 500_000, keep: list[str] | None = None,
) -> DataFrame:
    """Every document with the benchmark windows that it holds.

    Words are lower-cased (A-Z) runs of digits, letters a-z and non-ASCII characters. A window is ``window`` consecutive words
    of an item; an item with fewer words, but not none, is one window. ``n_hit`` counts document words inside any occurrence of
    a window, ``hit_spans`` are their word ranges, ``longest_match`` is the longest verbatim match in words, up to ``window``
    (at least the shortest window; else 0). ``longest_words`` is the same without that bound, with its item (``longest_item``, of
    equal ones the smallest id) and the number of the document word where it starts (``longest_start``). ``contaminated``: n_hit > 0 and share * n_hit >= n_words.

    ``keep``: columns to return in front (all by default); a kept column with the name of a result column is left out.
    Null texts have no words; items with a null id or text, and items without words, hit nothing; repeated items count once.
    An empty benchmark leaves all documents clean. Repeated documents are judged one by one.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    blocks = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, item_id, item_text, window, block_words)]
    carried = Carried(documents, text, StructType.fromDDL(RESULT).names, keep)
    inner = carried.inner

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", 1 << 20):
                shard = Shard(part.column("_text"))
                for block in blocks:
                    shard.probe(block.value, window)
                columns = {name: part.column(name) for name in inner} | shard.result(share)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return carried.through(judged, RESULT)


def decontaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The clean documents, with their own columns and in no particular order; see ``find_contamination``."""
    own = documents.columns
    judged = find_contamination(documents.select(whole_row(documents).alias("_row"), F.col(options.pop("text", "text")).alias("_t")),
                                benchmark, text="_t", keep=["_row"], **options)
    return judged.where("NOT contaminated").select(*(F.col("_row")[c].alias(c) for c in own))
