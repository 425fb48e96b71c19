"""Packing of whole documents into sequences of bounded length, in order, with little padding.

The token streams of a task's documents are laid end to end, each document closed by an end token. A window of the stream is a
sequence. Windows may be cut where a document ends (free), where a sentence or line ends (``SENTENCE``), and every ``STRETCH``
tokens of a longer sentence (``INSIDE``); the figures are penalties, in tokens of padding. A window of n tokens is padded to the
sequence length unless n is a power of two. The cuts minimise padding plus penalties by dynamic programming over the places to cut:

    cost(j) = penalty(j) + WINDOW + min( over i within one length: cost(i) + length - (x[j] - x[i]),
                                         over p with x[i] = x[j] - 2**p: cost(i) )

The first minimum is one of cost(i) + x[i] over a sliding window, so a monotone queue gives it in constant time a place; the
second has at most twelve members, found by binary search for all places at once.

A task packs its own documents, so nothing is shuffled and a task that is run again gives the same rows. It holds ``SEGMENT``
tokens and one slice of documents (a longer document is a slice of its own); the last ``TAIL`` windows of a segment are cut anew
with the next one. A task's last window ends where its last document does.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lakekit.llm.arrow_text import LOWER, NOT_SPACE, Carried, Words, arrow_batches, chunks, spans_of

LENGTH, END_ID = 2048, 1
SENTENCE, INSIDE, WINDOW, STRETCH = 16, 64, 2, 256
SEGMENT, TAIL, REMEMBERED = 1 << 20, 4, 300_000
#: Bytes by kind.
SPACE, LETTER, DIGIT, MARK, FOREIGN = range(5)
KINDS = np.full(256, MARK, np.uint8)
KINDS[32], KINDS[48:58], KINDS[65:91], KINDS[97:123], KINDS[128:] = SPACE, DIGIT, LETTER, LETTER, FOREIGN
KINDS[124] = FOREIGN  # control tokens have bars
#: A piece that the vocabulary's pattern does not cut, and that neither normalisation nor case changes.
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf])+|[0-9]|[\x00-/:-@\[-`{-\x7f]+")
STOP, CLOSER = np.zeros(256, bool), np.zeros(256, bool)
STOP[list(b".!?")] = CLOSER[list(b"\"')]")] = True
#: Sentence marks of other scripts, as the last three bytes of a word.
FOREIGN_STOPS = ["。", "！", "？", "…"]

#: First bytes of U+00C0 to U+023F, and the two bytes of those that are no letter (the times and division signs) or become two characters in
#: lower case (the dotted I). All others there are letters, and none of them combines with a neighbour.
LATIN = np.zeros(256, bool)
LATIN[0xC3:0xC9] = True
NOT_LATIN = [0xC397, 0xC3B7, 0xC4B0]

RESULT = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int = LENGTH) -> list[int]:
    """Numbers of the places (rising, from 0 to the end, at most ``length`` apart) where windows begin and end, at least cost."""
    n = len(places)
    match_to, match_from = [], []
    power = 1
    while power <= length:
        at = np.searchsorted(places, places - power)
        good = np.flatnonzero(places[np.minimum(at, n - 1)] == places - power)
        match_to.append(good)
        match_from.append(at[good])
        power *= 2
    to = np.concatenate(match_to)
    order = np.argsort(to, kind="stable")
    exact = np.concatenate(match_from)[order].tolist()
    first = np.searchsorted(to[order], np.arange(n + 1)).tolist()
    x, extra = places.tolist(), (penalties + WINDOW).tolist()
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, number), both rising
    for j in range(1, n):
        here = x[j]
        while here - x[queue[0][1]] > length:
            queue.popleft()
        low, source = queue[0]
        low += length - here
        for i in exact[first[j]:first[j + 1]]:
            if cost[i] < low:
                low, source = cost[i], i
        cost[j], back[j] = low + extra[j], source
        value = cost[j] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    chosen = [n - 1]
    while chosen[-1]:
        chosen.append(back[chosen[-1]])
    return chosen[::-1]


def cut_places(ends: np.ndarray, sentences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut, with their penalties: document ends, sentence ends, and places inside long sentences."""
    natural = np.unique(np.concatenate([[0], ends, sentences]))
    gaps = np.diff(natural)
    more = (gaps - 1) // STRETCH
    inside = np.repeat(natural[:-1], more) + STRETCH * (1 + spans_of(np.zeros(len(more), np.int64), more))
    places = np.unique(np.concatenate([natural, inside]))
    penalties = np.full(len(places), INSIDE, np.int64)
    penalties[np.searchsorted(places, natural)] = SENTENCE
    penalties[np.searchsorted(places, ends)] = 0
    return places, penalties


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte; both bytes of a Latin letter are letters."""
    out = KINDS[data]
    at = np.flatnonzero(LATIN[data])
    at = at[~np.isin(data[at].astype(np.int32) << 8 | data[at + 1], NOT_LATIN)] if len(at) else at
    out[at] = out[at + 1] = LETTER
    return out


def sentence_ends(words: Words) -> np.ndarray:
    """Whether a word ends with a sentence mark, up to two closing quotes or brackets aside."""
    data = np.concatenate([np.full(4, 32, np.uint8), words.data])
    last = words.end + 3
    out = STOP[data[last]]
    for skip in (1, 2):
        out |= STOP[data[last - skip]] & CLOSER[data[last]] & (CLOSER[data[last - 1]] if skip == 2 else True)
    foreign = np.flatnonzero(data[last] >= 128)
    last = last[foreign]
    three = data[last - 2].astype(np.int64) << 16 | data[last - 1].astype(np.int64) << 8 | data[last]
    out[foreign] |= np.isin(three, [int.from_bytes(c.encode(), "big") for c in FOREIGN_STOPS])
    return out


@lru_cache(maxsize=1)
def _tokens(path: str) -> Tokens:
    """One for all tasks of a Python worker, so that a task finds the pieces of those before it."""
    return Tokens(path)


class Tokens:
    """Token ids of texts, by distinct pieces of words, none of which a token of the vocabulary crosses.

    Words of ASCII and Latin letters (U+00C0 to U+023F) without an apostrophe or a bar (which may begin a control token) are lower-cased
    in ASCII and cut into runs of letters, single digits and runs of other characters, as the vocabulary's pattern does; what the tokenizer makes of one ends with a token of a
    word's end, so hundreds are encoded in one call. Other words are left to the tokenizer as they are, save up to eight ASCII marks
    after an ASCII letter or digit at their end. A bounded number of pieces, those met most often, is remembered with their ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_end = np.zeros(1 << 17, bool)
        self.word_end[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.known: dict[bytes, int] = {}
        self.table, self.sizes = np.array([END_ID], np.uint32), np.array([1])  # number 0 is the end token
        self.met = np.zeros(1, np.int64)  # in how many slices of documents a piece was

    def _thin(self) -> None:
        """Forget the pieces that were met least often, half of them at least."""
        least = 2
        while np.count_nonzero(self.met >= least) > REMEMBERED // 2:
            least += 1
        kept = np.append(0, np.flatnonzero(self.met >= least))
        pieces = list(self.known)  # in the order of their numbers, from 1
        self.known = {pieces[i - 1]: n for n, i in enumerate(kept.tolist()) if n}
        self.table = self.table[spans_of((np.cumsum(self.sizes) - self.sizes)[kept], self.sizes[kept])]
        self.sizes, self.met = self.sizes[kept], self.met[kept] // 2

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        simple = [p for p in pieces if PLAIN.fullmatch(p)]
        ids = [np.array(x, np.uint32) for x in self._encoded([b" ".join(simple[i:i + 200]).decode() for i in range(0, len(simple), 200)])]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(simple):  # another kind of vocabulary
            simple, ids, ends = [], ids[:0], ends[:0]
        done = set(simple)
        rest = [p for p in pieces if p not in done]
        found = self._encoded([p.decode() for p in rest])
        flat = np.fromiter((i for x in found for i in x), np.uint32)
        self.known.update(zip([*simple, *rest], range(len(self.sizes), len(self.sizes) + len(pieces)), strict=True))
        self.table = np.concatenate([self.table, ids, flat])
        self.sizes = np.concatenate([self.sizes, np.diff(ends, prepend=0), np.array([len(x) for x in found], np.int64)])
        self.met = np.append(self.met, np.zeros(len(pieces), np.int64))

    def _look_up(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of the pieces."""
        if len(self.known) > REMEMBERED:
            self._thin()
        if new := [p for p in pieces if p not in self.known]:
            self._learn(new)
        number = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        self.met[number] += 1
        return number

    def stream(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the end token after each; where each text ends; where sentences or lines end inside texts."""
        words = Words(texts, NOT_SPACE, lower=False)
        data, n = words.data, len(words)
        kind = kinds(data)
        plain = np.ones(n, bool)
        plain[np.searchsorted(words.start, np.flatnonzero((kind == FOREIGN) | (data == 39)), side="right") - 1] = False
        others = spans_of(words.start[~plain], (words.end - words.start)[~plain] + 1)
        inside, low = np.ones(len(data), bool), LOWER[data]
        inside[others], low[others] = False, data[others]
        before = np.append(np.uint8(SPACE), kind[:-1])
        start = inside & (kind != SPACE) & ((kind != before) | (kind == DIGIT))
        start[words.start] = True
        # up to eight marks at the end of other words, where only they follow a letter or digit
        tails = words.end[~plain]
        heads = words.start[~plain]
        for _ in range(8):
            tails = tails - ((kind[tails - 1] == MARK) & (tails > heads))
        tails = tails[(tails > heads) & (tails < words.end[~plain]) & ((kind[tails - 1] == LETTER) | (kind[tails - 1] == DIGIT))]
        start[tails] = True
        first = np.flatnonzero(start)
        heading = np.zeros(len(data), bool)
        heading[words.start] = True
        heading = heading[first]  # whether a piece begins its word
        bounds = np.append(first - np.cumsum(heading) + 1, len(data) - n).astype(np.int64)  # a space less for each word before
        cut = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(low[kind != SPACE])]).dictionary_encode()
        number = self._look_up(cut.dictionary.to_pylist())[cut.indices.to_numpy(zero_copy_only=False)]
        of_word = np.flatnonzero(heading)  # the first piece of each word
        closing = np.append(of_word, len(first))[words.first[1:]]
        stops = np.zeros(len(first), bool)
        stops[np.append(of_word[1:], len(first)) - 1] = sentence_ends(words) | np.append(words.new_line()[1:], False) if n else False
        number, stops = np.insert(number, closing, 0), np.insert(stops, closing, False)
        stops[:-1] &= number[1:] != 0
        counts = self.sizes[number]
        ids = self.table[spans_of((np.cumsum(self.sizes) - self.sizes)[number], counts)]
        after = np.cumsum(counts)
        return ids, after[number == 0], after[stops]


def pack(documents: DataFrame, tokenizer_path: str, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None,
         length: int = LENGTH) -> DataFrame:
    """One row per piece of a document: the kept columns (``doc_id`` alone by default), ``start`` (the document's tokens before
    it), ``length``, ``doc_tokens`` (with the end token), ``sequence_id``, ``offset`` (its place there) and ``ids``, the token ids
    as little-endian unsigned 32-bit numbers.

    Every token of a document lies in exactly one piece; pieces of a sequence follow each other without gaps, in the order of the
    documents. A null or empty text is the end token alone. Repeated rows are documents of their own. No documents give no
    rows. Kept columns with the name of a result are left out. ``sequence_id`` has the task's number in its high bits.
    """
    arrow_batches(documents.sparkSession)
    carried = Carried(documents, text, [f.split()[0] for f in RESULT.split(", ")], [doc_id] if keep is None else keep)
    inner = carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(tokenizer_path)
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []  # the columns of the documents that are not packed yet
        ids, ends, stops = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        before = 0  # tokens of the first of them that are packed already

        def packed(last: bool) -> pa.RecordBatch | None:
            nonlocal held, ids, ends, stops, before, made
            places, penalties = cut_places(ends, stops)
            cuts = places[best_cuts(places, penalties, length)]
            if not last:
                cuts = cuts[:-TAIL]
            if len(cuts) < 2:
                return None
            done = int(cuts[-1])
            edges = np.unique(np.concatenate([cuts, ends[ends <= done]]))
            head, tail = edges[:-1], edges[1:]
            owner = np.searchsorted(ends, head, side="right")
            window = np.searchsorted(cuts, head, side="right") - 1
            begins = np.append(-before, ends[:-1])
            data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            columns = pa.Table.from_batches(held).combine_chunks().to_batches()[0] if inner else None
            out = pa.RecordBatch.from_arrays([
                *(columns.column(c).take(pa.array(owner)) for c in inner),
                pa.array(head - begins[owner]), pa.array(tail - head), pa.array((ends - begins)[owner]),
                pa.array(base + made + window), pa.array(head - cuts[window]),
                pa.array([bytes(data[4 * s:4 * e]) for s, e in zip(head.tolist(), tail.tolist(), strict=True)], pa.binary()),
            ], names=[*inner, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            made += len(cuts) - 1
            kept = int(np.searchsorted(ends, done, side="right"))
            before = int(done - begins[kept]) if kept < len(ends) else 0
            held = [columns.slice(kept)] if inner else []
            ids, ends, stops = ids[done:], ends[kept:] - done, stops[stops > done] - done
            return out

        for batch in batches:
            for part in chunks(batch, "_text", 4 << 20):
                new, new_ends, new_stops = tokens.stream(part.column("_text"))
                ends, stops = np.append(ends, new_ends + len(ids)), np.append(stops, new_stops + len(ids))
                ids = np.append(ids, new)
                held.append(part.select(inner))
                if len(ids) >= SEGMENT and (out := packed(last=False)) is not None:
                    yield out
        if len(ends):
            yield packed(last=True)

    return carried.through(run, RESULT)

