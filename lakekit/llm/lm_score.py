"""Document scores by masked pseudo-likelihood.

A window network predicts every word from the two words on either side: position-wise word tables are summed, passed through
tanh, and read out by a softmax in two steps (the group of a word, then the word in its group). A document's score is the sum
of the conditional log-probabilities of all its words, each masked in turn.

Words are the ``LISTED`` most frequent of the whole corpus, and ``BUCKETS`` buckets, by CRC-32, of all others. The network is
trained in numpy on all documents: each task makes one pass over its part from the same start, and the weights are averaged by
number of words, sixteen at a time, so that no place ever holds more than a few of them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import NOT_SPACE, Carried, Words, arrow_batches, chunks
from lakekit.session import stored

#: Class 0 stands for what is beyond a document's edge. 1 + LISTED + BUCKETS = GROUP * GROUP.
LISTED, BUCKETS, GROUP, WIDTH, REACH = 767, 256, 32, 24, 2
KINDS = GROUP * GROUP
PLACES = [p for p in range(-REACH, REACH + 1) if p]
BATCH, RATE, MERGED = 8192, 0.1, 16


class Network:
    """Tables per place, read-out of groups and of words in groups; each with the sums of squares for its step sizes."""

    NAMES = ("tables", "shift", "groups", "group_bias", "words", "word_bias")

    def __init__(self, weights: list[np.ndarray] | None = None):
        if weights is None:
            rng = np.random.default_rng(7)
            weights = [
                rng.normal(0, 0.1, (len(PLACES), KINDS, WIDTH)), np.zeros(WIDTH), rng.normal(0, 0.1, (WIDTH, GROUP)), np.zeros(GROUP),
                rng.normal(0, 0.1, (GROUP, WIDTH, GROUP)), np.zeros((GROUP, GROUP))]
        self.weights = [np.array(w, np.float32) for w in weights]
        self.past = [np.full(w.shape, 1e-6, np.float32) for w in self.weights]

    def packed(self) -> bytes:
        return b"".join(w.tobytes() for w in self.weights)

    @classmethod
    def unpacked(cls, data: bytes) -> Network:
        made, at = cls(), 0
        for i, w in enumerate(made.weights):
            made.weights[i] = np.frombuffer(data, np.float32, w.size, at).reshape(w.shape).copy()
            at += w.nbytes
        return made

    def hidden(self, around: np.ndarray) -> np.ndarray:
        tables, shift = self.weights[:2]
        total = tables[0][around[:, 0]] + shift
        for k in range(1, len(PLACES)):
            total += tables[k][around[:, k]]
        return np.tanh(total)

    @staticmethod
    def _softmax(x: np.ndarray, most: float) -> np.ndarray:
        """``most``: bound of the absolute values; small ones need no shift."""
        x = np.exp(x if most < 60 else x - x.max(axis=1, keepdims=True))
        x /= (x @ np.ones(x.shape[1], x.dtype))[:, None]
        return x

    @staticmethod
    def _bound(weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Largest absolute value that a read-out can have, as hidden values are in [-1, 1]."""
        return (np.abs(weights).sum(axis=-2) + np.abs(bias)).max(axis=-1)

    def log_chances(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of each target given the words around it."""
        _, _, groups, group_bias, words, word_bias = self.weights
        order = np.argsort((target // GROUP).astype(np.uint16), kind="stable")
        target = target[order]
        h = self.hidden(around[order])
        group, inner = target // GROUP, target % GROUP
        chance = self._softmax(h @ groups + group_bias, self._bound(groups, group_bias))[np.arange(len(target)), group]
        ends, most = np.searchsorted(group, np.arange(GROUP + 1)), self._bound(words, word_bias)
        for g in range(GROUP):
            low, high = ends[g], ends[g + 1]
            if low < high:
                inside = self._softmax(h[low:high] @ words[g] + word_bias[g], most[g])
                chance[low:high] *= inside[np.arange(high - low), inner[low:high]]
        out = np.empty(len(target))
        out[order] = np.log(np.maximum(chance, 1e-30))
        return out

    def _step(self, i: int, slope: np.ndarray, at=slice(None)) -> None:
        self.past[i][at] += slope * slope
        self.weights[i][at] -= RATE * slope / np.sqrt(self.past[i][at])

    def train(self, around: np.ndarray, target: np.ndarray) -> None:
        """One step on a batch."""
        _, _, groups, group_bias, words, word_bias = self.weights
        size = np.float32(1 / len(target))
        order = np.argsort((target // GROUP).astype(np.uint16), kind="stable")
        around, target = around[order], target[order]
        h = self.hidden(around)
        group, inner = target // GROUP, target % GROUP
        wrong = self._softmax(h @ groups + group_bias, self._bound(groups, group_bias))
        wrong[np.arange(len(target)), group] -= 1
        wrong *= size
        back = wrong @ groups.T
        slopes = (h.T @ wrong, wrong.sum(axis=0))
        ends, most = np.searchsorted(group, np.arange(GROUP + 1)), self._bound(words, word_bias)
        for g in range(GROUP):
            low, high = ends[g], ends[g + 1]
            if low < high:
                off = self._softmax(h[low:high] @ words[g] + word_bias[g], most[g])
                off[np.arange(high - low), inner[low:high]] -= 1
                off *= size
                back[low:high] += off @ words[g].T
                self._step(4, h[low:high].T @ off, g)
                self._step(5, off.sum(axis=0), g)
        back *= 1 - h * h
        self._step(2, slopes[0])
        self._step(3, slopes[1])
        self._step(1, back.sum(axis=0))
        for k in range(len(PLACES)):
            order = np.argsort(around[:, k].astype(np.uint16), kind="stable")
            sorted_ = around[order, k]
            first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            self._step(0, np.add.reduceat(back[order], first, axis=0), (k, sorted_[first]))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "_text"):
            codes, distinct = Words(part.column("_text"), NOT_SPACE).coded()
            yield pa.RecordBatch.from_arrays(
                [distinct.cast(pa.binary()), pa.array(np.bincount(codes, minlength=len(distinct)))], names=["word", "n"])


def frequent_words(documents: DataFrame, text: str = "text", listed: int = LISTED) -> list[bytes]:
    """The most frequent words over all documents, of equal ones the smaller first."""
    arrow_batches(documents.sparkSession)
    counts = documents.select(F.col(text).alias("_text")).mapInArrow(_word_counts, "word binary, n long")
    top = counts.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(listed)
    return [bytes(r.word) for r in top.collect()]


def _classes(texts: pa.Array, listed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each word, classes around it, and offsets of the documents."""
    words = Words(texts, NOT_SPACE)
    codes, distinct = words.coded()
    found = pc.index_in(distinct, value_set=listed)
    kind = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int32) + 1
    rare = np.flatnonzero(kind == 0)
    kind[rare] = [1 + LISTED + zlib.crc32(w) % BUCKETS for w in distinct.take(pa.array(rare)).to_pylist()]
    target = kind[codes] if len(codes) else np.zeros(0, np.int32)
    counts = np.diff(words.first)
    padded = np.zeros(len(target) + REACH * (len(counts) + 1), np.int32)  # edges between documents
    at = np.arange(len(target)) + np.repeat(REACH * (np.arange(len(counts)) + 1), counts)
    padded[at] = target
    around = np.stack([padded[at + p] for p in PLACES], axis=1) if len(target) else np.zeros((0, len(PLACES)), np.int32)
    return target, around, words.first


def _trained(listed_of):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, seen = Network(), 0
        listed = pa.array(listed_of.value, pa.large_binary())
        for batch in batches:
            for part in chunks(batch, "_text", 4 << 20):
                target, around, _ = _classes(part.column("_text"), listed)
                order = np.random.default_rng(seen).permutation(len(target))
                for low in range(0, len(target), BATCH):
                    rows = order[low:low + BATCH]
                    net.train(around[rows], target[rows])
                seen += len(target)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([net.packed()], pa.binary())], names=["n", "weights"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, mean = 0, None
    for batch in batches:
        for n, data in zip(batch.column("n").to_pylist(), batch.column("weights"), strict=True):
            flat = np.frombuffer(data.as_buffer(), np.float32).astype(np.float64)
            mean = flat * n if mean is None else mean + flat * n
            total += n
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array([total]), pa.array([(mean / total).astype(np.float32).tobytes()], pa.binary())], names=["n", "weights"])


def train(documents: DataFrame, listed: list[bytes], text: str = "text") -> Network:
    """The network after one pass over all documents; without any word, its start."""
    spark = documents.sparkSession
    arrow_batches(spark)
    shared = spark.sparkContext.broadcast(listed)
    rows = stored(documents.select(F.col(text).alias("_text")).mapInArrow(_trained(shared), "n long, weights binary"), "lm-weights")
    while (count := rows.count()) > MERGED:
        rows = stored(rows.repartition(-(-count // MERGED)).mapInArrow(_averaged, "n long, weights binary"), "lm-weights")
    found = [(r.n, bytes(r.weights)) for r in rows.collect()]
    if not found:
        return Network()
    total = sum(n for n, _ in found)
    mean = sum(np.frombuffer(w, np.float32).astype(np.float64) * (n / total) for n, w in sorted(found))
    return Network.unpacked(mean.astype(np.float32).tobytes())


RESULT = "n_tokens long, log_likelihood double, mean_log_likelihood double"


def score(documents: DataFrame, net: Network, listed: list[bytes], *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default; those with names of results are left out) with the number of words, the summed
    conditional log-probability of all of them, and its mean per word.

    A null text, or one without words, has 0 words, a sum of 0 and a null mean. Repeated rows stay.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    own = [x.split()[0] for x in RESULT.split(", ")]
    carried = Carried(documents, text, own, keep)
    inner = carried.inner
    shared = spark.sparkContext.broadcast((net.packed(), listed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, words = shared.value
        model, words = Network.unpacked(packed), pa.array(words, pa.large_binary())
        for batch in batches:
            for part in chunks(batch, "_text", 4 << 20):
                target, around, first = _classes(part.column("_text"), words)
                each = np.zeros(len(target))
                for low in range(0, len(target), BATCH):
                    each[low:low + BATCH] = model.log_chances(around[low:low + BATCH], target[low:low + BATCH])
                counts = np.diff(first)
                sums = np.zeros(len(counts))
                some = np.flatnonzero(counts)
                if len(some):
                    sums[some] = np.add.reduceat(each, first[some])
                means = pa.array(np.where(counts > 0, sums / np.maximum(counts, 1), np.nan), pa.float64(), mask=counts == 0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in inner), pa.array(counts, pa.int64()), pa.array(sums), means], names=[*inner, *own])

    return carried.through(run, RESULT)
