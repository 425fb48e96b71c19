"""Byte-level byte-pair encoding and decoding.

Three steps, none of which shuffles. A task cuts slices of documents into pieces by the pre-tokeniser's pattern and numbers
the distinct ones, each of which it hands on once (it remembers a bounded number of them). Spark higher-order functions then fold the merges over the bytes of each distinct piece: of all adjacent
pairs the one of lowest rank is merged, until no pair has a rank. The ranks are a literal map of pairs, cut into small maps
since Spark searches a map from its start. Pieces that have a rank themselves need no merges, and those of over ``LONG`` bytes
are merged with a heap, as the fold's cost grows with the square of the length. Last, the ids of the pieces are put in the order of the texts. Decoding
concatenates the binary pieces of the ids.
"""

from __future__ import annotations

import base64
import json
import sys
from collections.abc import Iterator
from functools import cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import Carried, arrow_batches, chunks, frugal, give_back, joined, spans_of

LETTER, NUMBER, SPACE, OTHER, END = range(5)
#: Bytes of text in a slice of documents, distinct pieces that a task remembers, bytes of a piece above which a heap is used.
SLICE, REMEMBERED, LONG = 1 << 20, 500_000, 256
#: Bytes of text that are cut into pieces at a time, and pieces that are put in order at a time: each byte takes some sixty on the way.
PART, PIECES = 1 << 17, 1 << 15
#: Bits of an id, lowest bit of a rank in the fold's state, and how pairs are dealt to the small maps.
BITS, RANK, BUCKETS, SPREAD = 17, 46, 1 << 16, 40503


@cache
def _classes() -> np.ndarray:
    """Class of every code point for the pattern: letter, number, white space or other, by the tokenizer library's Unicode version.

    The library drops what a pattern does not match, so it tells the members of a class from a text of all code points; a block of
    them at a time keeps that small.
    """
    import tiktoken

    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    ranks = {bytes([i]): i for i in range(256)}
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for first in range(0, sys.maxunicode + 1, 1 << 14):
            text = "".join(chr(c) for c in range(first, first + (1 << 14)) if not 0xD800 <= c < 0xE000)
            members = bytes(probe.encode_ordinary(text)).decode()
            out[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    return out


def pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Matches of the pattern ``public_tokenizers.PATTERN`` in all texts, and how many each text has.

    Vectorised over the code points: a run of letters, of numbers, or of other characters is one piece, with one space before
    it if there is one; white space before that is a piece, and so is all of it at a text's end; an apostrophe that begins a
    piece takes s, t, m, d, re, ve or ll with it.
    """
    data, offsets = joined(texts)
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)  # byte of every code point
    code = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = _classes()[code]
    closing = np.searchsorted(at, offsets[1:] - 1)  # the space that ``joined`` put after each text
    kind[closing] = END
    before = np.append(np.uint8(END), kind[:-1])
    after = np.append(kind[1:], np.uint8(END))
    blank = np.append(False, code[:-1] == 32)  # the code point before is a plain space
    white = kind == SPACE
    spaced = ~white & (before == SPACE)
    start = (kind != before) & ~(spaced & blank & (kind != END)) | (kind == END)
    start |= white & (before == SPACE) & (after != SPACE) & (after != END)  # the last one of white space goes with what follows
    tick = np.flatnonzero(start & (code == 39))
    if len(tick):
        padded = np.append(code, [0, 0])
        one, two = padded[tick + 1], padded[tick + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ~short & (((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((two == ord("l")) & (one == ord("l"))))
        start[tick[short | long] + 1] = False
        start[tick[short] + 2] = True
        start[tick[long] + 3] = True
    first = np.flatnonzero(start)
    ends = kind[first] == END
    kept = first[~ends]
    counts = np.diff(np.append(0, np.searchsorted(kept, closing)))
    bounds = np.append(at[first], len(data)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return words.filter(pa.array(~ends)).dictionary_encode(), counts


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with lines of base64 text and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def _pair_ranks(ranks: dict[bytes, int]) -> Column:
    """A literal array of ``BUCKETS`` maps: two ids that merge, as one number in text, to the rank of what they make."""
    dealt: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        for cut in range(1, len(piece)):
            a, b = ranks.get(piece[:cut]), ranks.get(piece[cut:])
            if a is not None and b is not None:
                dealt[(a * SPREAD + b) % BUCKETS][str((a << BITS) + b)] = rank
    return F.expr(f"from_json('{json.dumps(dealt)}', 'array<map<string, int>>')")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged(start: Column, table: Column) -> Column:
    """Tokens of a piece: the adjacent pair of lowest rank, the first of equals, is merged until no pair has a rank.

    The fold's state has one long per token, at first per byte (``start``): rank of its merge with the next token, its place
    in the piece, its id in the low ``BITS`` bits. The smallest long is the next merge, its rank the new token's id.
    """
    none = F.lit((1 << BITS) - 1)
    rest, tail = F.lit((1 << RANK) - 1), F.lit((1 << RANK) - (1 << BITS))
    token = F.lit((1 << BITS) - 1)

    def rank(a: Column, b: Column) -> Column:
        bucket = F.get(table, (a * SPREAD + b).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
        return F.shiftleft(F.coalesce(F.try_element_at(bucket, (F.shiftleft(a, BITS) + b).cast("string")), none).cast("long"), RANK)

    def at(acc: Column, least: Column):
        def replaced(k: Column) -> Column:
            new = F.shiftright(least, RANK)
            own = rank(new, F.get(acc, k + 1).bitwiseAND(token)) + least.bitwiseAND(tail) + new
            before = F.get(acc, k - 2)
            left = F.array(rank(before.bitwiseAND(token), new) + before.bitwiseAND(rest), own)
            return F.when(k > 1, F.concat(F.slice(acc, F.lit(1), k - 2), left, F.slice(acc, k + 2, LONG))).otherwise(
                F.concat(F.array(own), F.slice(acc, F.lit(3), LONG)))

        return replaced

    def step(acc: Column, _: Column) -> Column:
        return _let(F.array_min(acc), lambda least: F.when(least >= F.shiftleft(none.cast("long"), RANK), acc).otherwise(
            _let(F.array_position(acc, least).cast("int"), at(acc, least))))

    return F.aggregate(F.slice(start, F.lit(2), LONG), start, step)


def merged_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one long piece, with a heap: n log n, where the fold copies its state at each merge."""
    ends = list(range(1, len(piece) + 1))  # of the token that starts at each place
    prior = list(range(-1, len(piece)))
    alive = [True] * len(piece)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = ends[i]
        if j < len(piece) and (r := ranks.get(piece[i:ends[j]])) is not None:
            heappush(heap, (r, i, ends[j]))

    for i in range(len(piece)):
        offer(i)
    while heap:
        _, i, end = heappop(heap)
        if not alive[i] or ends[i] == end or (j := ends[i]) >= len(piece) or ends[j] != end:
            continue
        alive[j] = False
        ends[i] = end
        if end < len(piece):
            prior[end] = i
        offer(i)
        if prior[i] >= 0:
            offer(prior[i])
    out, i = [], 0
    while i < len(piece):
        out.append(ranks[piece[i:ends[i]]])
        i = ends[i]
    return out


def _byte_ranks(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the single bytes, and of all pairs of two."""
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    return single, np.array([ranks.get(bytes([a, b]), (1 << BITS) - 1) for a in range(256) for b in range(256)], np.int64)


def _first_state(data: np.ndarray, bounds: np.ndarray, single: np.ndarray, double: np.ndarray) -> np.ndarray:
    """The fold's first state: one long per byte of the pieces; what it takes is as large again, so it is made in place."""
    pair = double[data.astype(np.int64) * 256 + np.append(data[1:], 0)] if len(data) else np.zeros(0, np.int64)
    pair[bounds[1:] - 1] = (1 << BITS) - 1
    pair <<= RANK
    place = np.arange(len(data))
    place -= np.repeat(bounds[:-1], np.diff(bounds))
    place <<= BITS
    pair += place
    pair += single[data]
    return pair


def _numbered(names: list[str], ranks_of, slice_bytes: int, remembered: int):
    """One row per slice of documents: their kept columns, the numbers of their pieces in order, the distinct pieces that
    need merges as arrays of bytes, and the ids of the others (pieces with a rank of their own, and long ones)."""

    def made(held: list[pa.RecordBatch], ranks: dict[bytes, int], ranked: pa.Array, byte_ranks: tuple[np.ndarray, np.ndarray],
             known: pa.Array) -> tuple[pa.RecordBatch, pa.Array]:
        rows = pa.StructArray.from_arrays([pa.concat_arrays([b.column(n) for b in held]) for n in names], names=names)
        parts = [pieces(part.column("_text")) for b in held for part in chunks(b, "_text", PART)]
        words = pa.chunked_array([w for w, _ in parts]).unify_dictionaries()
        codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in words.chunks]).astype(np.int32)
        counts = np.concatenate([c for _, c in parts]).astype(np.int32)
        distinct = words.chunk(0).dictionary
        fresh = len(known) > remembered  # then both sides of the merges forget all pieces
        known = known[:0] if fresh else known
        place = pc.fill_null(pc.index_in(distinct, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        unseen = np.flatnonzero(place < 0)
        new = distinct.take(pa.array(unseen))
        done = pc.or_(pc.is_in(new, value_set=ranked), pc.greater(pc.binary_length(new), LONG))
        is_done = done.to_numpy(zero_copy_only=False)
        order = np.argsort(is_done, kind="stable")
        place[unseen[order]] = len(known) + np.arange(len(unseen))
        open_, whole = new.filter(pc.invert(done)), new.filter(done)
        others = [[ranks[w]] if w in ranks else merged_long(w, ranks) for w in whole.to_pylist()]
        open_ = pa.concat_arrays([open_])
        _, bounds, data = open_.buffers()
        bounds = np.frombuffer(bounds, np.int64)[:len(open_) + 1] if len(open_) else np.zeros(1, np.int64)
        data = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]] if len(open_) else np.zeros(0, np.uint8)
        bounds = bounds - bounds[0]
        merges = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(_first_state(data, bounds, *byte_ranks), pa.int64()))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        row = pa.RecordBatch.from_arrays(
            [one(rows), pa.array([counts.tobytes()]), pa.array([place[codes].tobytes()]), one(merges),
             pa.array([others], pa.list_(pa.list_(pa.int32()))), pa.array([fresh])],
            names=["rows", "counts", "codes", "open", "others", "fresh"])
        return row, pa.concat_arrays([known, open_, whole])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of.value
        ranked, byte_ranks = pa.array(ranks, pa.large_binary()), _byte_ranks(ranks)
        held, size, known = [], 0, pa.array([], pa.large_binary())
        for batch in batches:
            for part in chunks(batch, "_text", slice_bytes):
                held.append(part)
                size += part.column("_text").nbytes
                if size >= slice_bytes:
                    row, known = made(held, ranks, ranked, byte_ranks, known)
                    held, size = [], 0
                    yield row
                    give_back()
        if held:
            yield made(held, ranks, ranked, byte_ranks, known)[0]

    return run


def _ordered(names: list[str], ranks_of=None):
    """The documents of each slice with their ids, and with the bytes of those if ranks are given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Pieces(ranks_of.value) if ranks_of else None
        values, bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)  # ids of the pieces so far, in the order of their numbers
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("fresh")[i].as_py():
                    values, bounds = values[:0], bounds[:1]
                rows = batch.column("rows").slice(i, 1).flatten()
                counts = np.frombuffer(batch.column("counts")[i].as_py(), np.int32)
                codes = np.frombuffer(batch.column("codes")[i].as_py(), np.int32)
                for name in ("merged", "others"):
                    words = batch.column(name).slice(i, 1).flatten()
                    ids = words.flatten().to_numpy(zero_copy_only=False)
                    values = np.append(values, (ids & ((1 << BITS) - 1)).astype(np.int32))
                    sizes = words.value_lengths().to_numpy(zero_copy_only=False)
                    bounds = np.append(bounds, bounds[-1] + np.cumsum(sizes, dtype=np.int64))
                ends = np.append(0, np.cumsum(counts, dtype=np.int64))
                low = 0
                while low < len(counts):  # so many pieces at a time, since their bytes are gathered by place
                    high = max(low + 1, int(np.searchsorted(ends, ends[low] + PIECES, side="right")) - 1)
                    part = codes[ends[low]:ends[high]]
                    lengths = bounds[part + 1] - bounds[part]
                    ids = values[spans_of(bounds[part], lengths)]
                    total = np.append(0, np.cumsum(lengths))[ends[low:high + 1] - ends[low]]
                    lists = pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(ids, pa.int32()))
                    kept = rows.slice(low, high - low).flatten()
                    made = {"ids": lists} | ({"decoded": table.gathered(lists)} if table else {})
                    yield pa.RecordBatch.from_arrays([*kept, *made.values()], names=[*names, *made])
                    low = high

    return run


def _short_plan_texts(spark: SparkSession, most: int = 1 << 20) -> None:
    """Keep the texts of plans, which Spark holds for its listeners and which repeat the literal map, to ``most`` characters."""
    name = "spark.sql.maxPlanStringLength"
    now = spark.conf.get(name).removesuffix("b")  # bytes by default
    if not now.isdigit() or int(now) > most:
        spark.conf.set(name, str(most))


def encode(documents: DataFrame, ranks: dict[bytes, int], *, text: str = "text", keep: list[str] | None = None,
           decoded: bool = False, slice_bytes: int = SLICE, remembered: int = REMEMBERED) -> DataFrame:
    """The kept columns (all by default; one named ``ids`` is left out) and ``ids``, the token ids of the whole text.

    With ``decoded``, also the bytes that the ids decode to, as column ``decoded``, in the same pass as ``decode`` would.

    Special tokens are ordinary text. A null or empty text has no ids. Every byte must have a rank. Repeated rows stay.
    """
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing or max(ranks.values()) >= (1 << BITS) - 1:
        raise ValueError("every byte must have a rank, and ranks must be below 131071")
    arrow_batches(documents.sparkSession, 500, 2 << 20)
    _short_plan_texts(documents.sparkSession)
    carried = Carried(documents, text, ["ids", "decoded"][:1 + decoded], keep)
    inner = [*carried.inner, "one"]  # never a struct without fields
    fields = ", ".join([*carried.fields, "one: int"])
    table = _pair_ranks(ranks)
    shared = documents.sparkSession.sparkContext.broadcast(ranks)
    slices = carried.frame.withColumn("one", F.lit(0)).mapInArrow(frugal(_numbered(inner, shared, slice_bytes, remembered)), f"rows array<struct<{fields}>>, counts binary, codes binary, "
                              "open array<array<bigint>>, others array<array<int>>, fresh boolean")
    # one literal, bound once: each mention of the table would be folded to a copy of its own
    folded = _let(table, lambda t: F.transform("open", lambda w: merged(w, t)))
    coded = slices.select("rows", "counts", "codes", "others", "fresh", folded.alias("merged"))
    out = coded.mapInArrow(frugal(_ordered(inner, shared if decoded else None)), f"{fields}, ids array<int>{', decoded binary' * decoded}")
    return carried.named(out.drop("one"))


class Pieces:
    """The bytes of every rank, end to end, to be gathered by id."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        for piece, rank in ranks.items():
            lengths[rank] = len(piece)
        self.start = np.append(0, np.cumsum(lengths))
        self.data = np.zeros(self.start[-1], np.uint8)
        for piece, rank in ranks.items():
            self.data[self.start[rank]:self.start[rank + 1]] = np.frombuffer(piece, np.uint8)

    def gathered(self, lists: pa.Array) -> pa.Array:
        """Each list of ids as the bytes of its pieces; null: null."""
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        lengths = self.start[ids + 1] - self.start[ids]
        data = self.data[spans_of(self.start[ids], lengths)]
        bounds = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(sizes))]
        out = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        return pc.if_else(lists.is_valid(), out, None).cast(pa.binary())


def decode(encoded: DataFrame, ranks: dict[bytes, int], *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and ``into``, the bytes of the pieces of ``ids`` one after the other (null: null, no ids: empty).

    A column of the name ``into`` is replaced. An id without a piece fails.
    """
    arrow_batches(encoded.sparkSession)
    carried = Carried(encoded, ids, [into])
    inner = carried.inner
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = table or Pieces(shared.value)
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], table.gathered(part.column("_text"))], names=[*inner, into])

    return carried.through(run, f"`{into}` binary")
