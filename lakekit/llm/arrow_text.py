"""Vectorised words of Arrow text columns, shared by the operators of this package.

Every helper works on one batch: texts are joined with one space after each, so no word crosses two documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: ASCII A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of a word for ``[^\x20\x09-\x0D]+`` and for ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True


def arrow_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """Keep Arrow batches small enough for documents of many kilobytes, unless the session already does."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark._jsparkSession.sessionState().conf().getConfString(name, str(most))
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def chunks(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text each (a longer text is a slice of its own)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    yield batch.slice(start)


def give_back() -> None:
    """Free memory of this process, numpy's and Arrow's, back to the system, which the allocators would keep otherwise."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
        pool.release_unused()


def frugal(run):
    """A pass over batches that leaves no free memory with its Python worker: idle workers count with those of the next stage."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return passed


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a space after each, and the offsets of the texts in them (null: empty)."""
    filled = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(filled.type) else np.int32
    _, offsets, data = filled.buffers()
    if not len(filled):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind)[filled.offset:filled.offset + len(filled) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


class Words:
    """Words of a batch: ``data`` holds every word and one space after it, words i is ``data[start[i]:end[i]]``.

    ``first`` has the number of the first word of each document, and the number of words at its end.
    """

    def __init__(self, texts: pa.Array, word_bytes: np.ndarray, lower: bool = True):
        data, offsets = joined(texts)
        if lower:
            data = LOWER[data]
        inside = word_bytes[data]
        before = np.zeros(len(inside), dtype=bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & ~before)
        self.first = np.searchsorted(starts, offsets)
        self.source_start = starts
        self._source = data
        kept = inside | before
        place = np.cumsum(kept, dtype=np.int64) - 1
        self.data = data[kept]
        self.start = place[starts]
        self.end = np.append(self.start[1:], len(self.data)) - 1 if len(starts) else np.zeros(0, np.int64)
        self.data[self.end] = 32

    def __len__(self) -> int:
        return len(self.start)

    def new_line(self) -> np.ndarray:
        """Whether a line feed lies between a word and the word before it (of the same batch)."""
        feeds = np.searchsorted(np.flatnonzero(self._source == 10), self.source_start)
        return np.append(False, feeds[1:] != feeds[:-1])

    def array(self) -> pa.LargeBinaryArray:
        """The words as an Arrow array."""
        letters = np.ones(len(self.data), dtype=bool)
        letters[self.end] = False
        offsets = np.append(0, np.cumsum(self.end - self.start)).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[letters])])

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """Number of each word among the batch's distinct words, and those words."""
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def spans_of(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices first[i] .. first[i] + lengths[i] - 1, one after the other."""
    if not len(first):
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1]) + np.repeat(first - (ends - lengths), lengths)


def whole_row(table: DataFrame, columns: list[str] | None = None) -> Column:
    """All columns (or some) in one struct, whatever their names; ``F.col("_row")[name]`` gives one back."""
    return F.struct(*(F.col(f"`{c}`") for c in (table.columns if columns is None else columns)))


class Carried:
    """Columns that go through a Python pass unchanged, under plain names, next to the one that the pass works on.

    ``frame`` has the columns c0, c1, ... and ``_text``. Columns whose names a result has (letter case aside) are left out, so
    any other name can be carried, also one that an operator uses inside.
    """

    def __init__(self, table: DataFrame, text: str, results: list[str], keep: list[str] | None = None, without: tuple[str, ...] = ()):
        taken = {x.lower() for x in results}
        self.names = [c for c in (table.columns if keep is None else keep) if c.lower() not in taken and c not in without]
        self.inner = [f"c{i}" for i in range(len(self.names))]
        self.frame = table.select(
            *(table[f"`{n}`"].alias(i) for n, i in zip(self.names, self.inner, strict=True)), table[f"`{text}`"].alias("_text"))
        self.fields = [f"{f.name}: {f.dataType.simpleString()}" for f in self.frame.schema.fields[:-1]]

    def through(self, run, results: str) -> DataFrame:
        """The frame after a pass that returns the carried columns and ``results`` (DDL), under their own names."""
        schema = StructType([*self.frame.schema.fields[:-1], *StructType.fromDDL(results).fields])
        return self.named(self.frame.mapInArrow(frugal(run), schema))

    def named(self, passed: DataFrame) -> DataFrame:
        made = [c for c in passed.columns if c not in self.inner]
        return passed.select(*(F.col(i).alias(n) for n, i in zip(self.names, self.inner, strict=True)), *made)
