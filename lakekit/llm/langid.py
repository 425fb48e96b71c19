"""Language of every word by a linear-chain conditional random field, and of the document by its words.

A word's features are its character n-grams with both ends marked (so those at the ends are its affixes), hashed, and the
learned languages whose lexicon has it. Transition weights between neighbouring words are learned with them, and
forward-backward gives each word's chance of each language, also where a text changes its language.

The field is fitted on the driver to a bounded sample: ``SAMPLE`` labelled documents in all, the same number of each language
(at least ``LEAST``), chosen by a hash of their ids, with their whole texts of at most ``SAMPLE_BYTES``. Training sequences join pieces of two documents,
so that changes of language occur in them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakekit.llm.arrow_text import Carried, Words, arrow_batches, chunks, give_back

SAMPLE, LEAST, SAMPLE_BYTES = 800, 25, 1 << 16
ORDERS, ROWS, PIECE, ROUNDS, UNKNOWN = (1, 2, 3, 4), 1 << 17, 16, 25, "und"
#: Letters scored at a time, and bytes of text that a task works on: these set the memory of a Python worker.
BLOCK, SLICE = 1 << 16, 1 << 20

LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True


@dataclass
class Field:
    """Languages in order, weights of hashed n-grams and lexicons, transition weights, sorted hashes of lexicon words."""

    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray
    lexicon_language: np.ndarray


class Vocabulary:
    """Words of a batch that hold a letter: per document their numbers, and the distinct words as code points."""

    def __init__(self, texts: pa.Array):
        words = Words(texts, LETTERS, lower=False)
        codes, distinct = words.coded()
        spelled = [w.decode("utf-8", "replace").lower() for w in distinct.to_pylist()]
        lettered = np.array([w.isascii() or any(map(str.isalpha, w)) for w in spelled], dtype=bool)
        self.words = spelled
        kept = lettered[codes] if len(codes) else np.zeros(0, dtype=bool)
        self.codes = codes[kept]
        self.first = np.append(0, np.cumsum(kept))[words.first]
        text = "".join(f"\1{w}\2" for w in spelled)
        self.letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
        self.start = np.append(0, np.cumsum([len(w) + 2 for w in spelled])).astype(np.int64)

    def grams(self, low: int = 0, high: int | None = None) -> list[np.ndarray]:
        """Per order: the feature of the n-gram at each letter of the words from ``low`` to ``high`` (all by default); ``ROWS`` where none starts."""
        start = self.start[low:(len(self.words) if high is None else high) + 1]
        letters = self.letters[start[0]:start[-1]]
        size = len(letters)
        end = np.repeat(start[1:] - start[0], np.diff(start))
        place = np.arange(size)
        out, hashed = [], np.zeros(size, np.uint64)
        with np.errstate(over="ignore"):
            for order in range(1, max(ORDERS) + 1):
                ahead = np.zeros(size, np.uint64)
                if size >= order:
                    ahead[:size - order + 1] = letters[order - 1:]
                hashed = (hashed + ahead + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
                hashed ^= hashed >> np.uint64(32)
                if order in ORDERS:
                    found = (hashed % np.uint64(ROWS)).astype(np.int64)
                    found[place + order > end] = ROWS
                    out.append(found)
        return out

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        if not self.words:
            return np.zeros(0, np.uint64)
        size = np.diff(self.start)
        place = np.arange(len(self.letters)) - np.repeat(self.start[:-1], size)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(size.max()), 0xD1342543DE82EF95, np.uint64))
            out = np.add.reduceat(self.letters * powers[place], self.start[:-1])
            out ^= out >> np.uint64(29)
            return out * np.uint64(0xBF58476D1CE4E5B9)

    def lexicons(self, field: Field) -> np.ndarray:
        """Feature row of each distinct word's lexicon; ``ROWS`` if it is in none."""
        hashed = self.hashes()
        out = np.full(len(hashed), ROWS, np.int64)
        if len(field.lexicon):
            at = np.minimum(np.searchsorted(field.lexicon, hashed), len(field.lexicon) - 1)
            known = field.lexicon[at] == hashed
            out[known] = ROWS + 1 + field.lexicon_language[at[known]]
        return out

    def emissions(self, field: Field) -> np.ndarray:
        """Score of each distinct word for each language, ``BLOCK`` letters at a time."""
        out = np.zeros((len(self.words), len(field.languages)), field.weights.dtype)
        low = 0
        while low < len(self.words):
            high = max(low + 1, int(np.searchsorted(self.start, self.start[low] + BLOCK, side="right")) - 1)
            total = sum(field.weights[g] for g in self.grams(low, high))
            out[low:high] = np.add.reduceat(total, self.start[low:high] - self.start[low], axis=0)
            low = high
        return out + field.weights[self.lexicons(field)]


def marginals(scores: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over many sequences at once: chances of each word's language, and expected numbers of moves."""
    size, kinds = scores.shape
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    begin, sorted_lengths = first[:-1][order], lengths[order]
    fit = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    step = np.exp(moves - moves.max())
    ahead, back = np.empty((size, kinds)), np.ones((size, kinds))
    longest = int(lengths.max(initial=0))
    active = np.searchsorted(-sorted_lengths, -np.arange(longest), side="left")  # sequences longer than t
    state = None
    for t in range(longest):
        at = begin[:active[t]] + t
        state = fit[at] if state is None else (state[:active[t]] @ step) * fit[at]
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    expected = np.zeros((kinds, kinds))
    for t in range(longest - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        inner = fit[at + 1] * back[at + 1]
        now = inner @ step.T
        scale = now.sum(axis=1, keepdims=True)
        back[at] = now / scale
        total = (ahead[at] * now).sum(axis=1, keepdims=True)
        expected += step * ((ahead[at] / total).T @ inner)
    chance = ahead * back
    return chance / chance.sum(axis=1, keepdims=True), expected


def fit_field(texts: list[str], labels: list[str], rounds: int = ROUNDS) -> Field:
    """A field for the languages of ``labels``, by gradient ascent with a step size per weight."""
    languages = sorted(set(labels))
    kinds = len(languages)
    found = Vocabulary(pa.array(texts, pa.string()))
    label = np.repeat([languages.index(x) for x in labels], np.diff(found.first))
    field = Field(languages, np.zeros((ROWS + 1 + kinds, kinds)), np.zeros((kinds, kinds)), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    if not len(found.codes):
        return field
    # lexicons: words seen at least three times, nine in ten of them in one language
    counts = np.zeros((len(found.words), kinds))
    np.add.at(counts, (found.codes, label), 1)
    total = counts.sum(axis=1)
    listed = np.flatnonzero((total >= 3) & (counts.max(axis=1) >= 0.9 * total))
    hashed = found.hashes()[listed]
    order = np.argsort(hashed)
    field.lexicon, field.lexicon_language = hashed[order], counts[listed].argmax(axis=1)[order]
    # sequences of two pieces of documents
    cuts = np.unique(np.concatenate([found.first, np.concatenate([np.arange(a, b, PIECE) for a, b in zip(found.first[:-1], found.first[1:], strict=True)])]))
    begins, sizes = cuts[:-1], np.diff(cuts)
    mixed = np.random.default_rng(0).permutation(len(begins))
    words = np.concatenate([np.arange(begins[i], begins[i] + sizes[i]) for i in mixed])
    ends = np.append(0, np.cumsum(sizes[mixed]))
    first = np.unique(np.append(ends[::2], ends[-1]))
    codes, label = found.codes[words], label[words]
    truth = np.eye(kinds)[label]
    inside = np.ones(len(codes), dtype=bool)
    inside[first[:-1]] = False
    seen = np.zeros((kinds, kinds))
    np.add.at(seen, (label[:-1][inside[1:]], label[1:][inside[1:]]), 1)
    grams, lexicons = found.grams(), found.lexicons(field)
    owner = np.repeat(np.arange(len(found.words)), np.diff(found.start))
    used = np.flatnonzero(np.bincount(np.concatenate(grams), minlength=ROWS + 1))
    narrow = np.full(ROWS + 1, -1)
    narrow[used] = np.arange(len(used))
    grams = [narrow[g] for g in grams]
    past, past_moves = np.full(field.weights.shape, 1e-6), np.full((kinds, kinds), 1e-6)
    for _ in range(rounds):
        scores = found.emissions(field)[codes]
        chance, expected = marginals(scores, first, field.moves)
        missed = truth - chance
        by_word = np.stack([np.bincount(codes, missed[:, k], len(found.words)) for k in range(kinds)], axis=1)
        slope = np.zeros_like(field.weights)
        for k in range(kinds):
            spread = by_word[owner, k]
            slope[used, k] = sum(np.bincount(g, spread, len(used)) for g in grams)
            slope[:, k] += np.bincount(lexicons, by_word[:, k], len(slope))
        slope -= 1e-2 * field.weights
        slope[ROWS] = 0
        past += slope ** 2
        field.weights += 0.3 * slope / np.sqrt(past)
        turn = seen - expected - 1e-2 * field.moves
        past_moves += turn ** 2
        field.moves += 0.3 * turn / np.sqrt(past_moves)
    field.weights = field.weights.astype(np.float32)
    return field


def learn(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE,
          most_bytes: int = SAMPLE_BYTES) -> Field:
    """A field fitted to a bounded sample of the documents with an id, a text and a label.

    At most ``sample`` documents (but ``LEAST`` of each language), none of over ``most_bytes`` in UTF-8, reach the driver. Of documents with
    one id and label, however many, one text counts.
    """
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.octet_length("text") <= most_bytes))
    slim = rows.select("doc_id", "lang").distinct().withColumn("order", F.xxhash64("doc_id"))
    kinds = slim.select("lang").distinct().count()
    each = max(LEAST, sample // max(kinds, 1))
    ranked = slim.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))).where(F.col("n") <= each)
    chosen = ranked.select("doc_id", "lang")
    one = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    found = sorted((r.text, r.lang) for r in one.collect())
    field = fit_field([t for t, _ in found], [x for _, x in found])
    give_back()
    return field


RESULT = "lang_pred string, score double, n_words long, shares array<double>"


def predict(documents: DataFrame, field: Field, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default) with ``lang_pred``, ``score``, ``n_words`` and ``shares``, the part of each of
    ``field.languages`` in the words' chances. Kept columns with these names are left out.

    ``score`` is the largest share; of equal shares the first language wins. A null text, a text without a letter, and a field
    without languages give ``und``, score 0 and no shares. Only the text is looked at.
    """
    spark = documents.sparkSession
    arrow_batches(spark, 500, 2 << 20)
    own = [x.split()[0] for x in RESULT.split(", ")]
    carried = Carried(documents, text, own, keep)
    inner = carried.inner
    shared = spark.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Field = shared.value
        for batch in batches:
            for part in chunks(batch, "_text", SLICE):
                found = Vocabulary(part.column("_text"))
                counts = np.diff(found.first)
                shares = np.zeros((len(counts), len(model.languages)))
                if len(found.codes) and model.languages:
                    chance, _ = marginals(found.emissions(model)[found.codes], found.first, model.moves)
                    some = np.flatnonzero(counts)
                    shares[some] = np.add.reduceat(chance, found.first[some], axis=0) / counts[some][:, None]
                known = (counts > 0) & bool(model.languages)
                best = shares.argmax(axis=1) if model.languages else np.zeros(len(counts), int)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(i) for i in inner),
                    pa.array([model.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()),
                    pa.array(np.where(known, np.minimum(shares.max(axis=1, initial=0), 1.0), 0.0), pa.float64()),
                    pa.array(counts, pa.int64()),
                    pa.array([s.tolist() if k else [] for s, k in zip(shares, known, strict=True)], pa.list_(pa.float64())),
                ], names=[*inner, *own])

    return carried.through(run, RESULT)
