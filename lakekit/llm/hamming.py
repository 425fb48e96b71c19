"""Links between 64-bit fingerprints that differ in few bits: candidates share a bucket, and are verified there.

Buckets arrive sorted by key, so a task compares one bucket after the other. It never emits all pairs of a bucket: the links
of a batch are reduced to a forest with the same connected components, at most one row per fingerprint and batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.session import stored

INDEX, PROBE = 1, 2
#: Buckets above this many rows are split by further bits, and pairs are compared in blocks of at most this many.
HOT, SMALL, BLOCK = 1 << 16, 32, 512


def mixed(*parts: np.ndarray) -> np.ndarray:
    """One well-spread 64-bit number of several."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(parts[0]), np.uint64)
        for p in parts:
            out = (out ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
            out *= np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(32)
    return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) with the connected components of the links (a, b); root is the smallest of its component."""
    if not len(a):
        return a, b
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while not np.array_equal(nearer := new[new], new):
            new = nearer
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _pairs(key: np.ndarray, fp: np.ndarray, role: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links within the buckets of sorted keys."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    found_a, found_b, held = [], [], 0

    def note(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal found_a, found_b, held
        near = (np.bitwise_count(fp[i] ^ fp[j]) <= most) & ((role[i] & role[j]) | (role[i] | role[j]) == 3) & (fp[i] != fp[j])
        i, j = i[near], j[near]
        found_a.append(fp[i])
        found_b.append(fp[j])
        held += len(i)
        if held > 1 << 20:
            x, y = forest(np.concatenate(found_a), np.concatenate(found_b))
            found_a, found_b, held = [x], [y], len(x)

    size_of = np.repeat(sizes, sizes)
    small = np.flatnonzero((size_of > 1) & (size_of <= SMALL))
    for step in range(1, SMALL):
        other = small + step
        inside = other < len(key)
        i, j = small[inside], other[inside]
        same = key[i] == key[j]
        if not same.any():
            break
        note(i[same], j[same])
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for low in range(s, s + n, BLOCK):
            rows = np.arange(low, min(low + BLOCK, s + n))
            i, j = np.nonzero(np.bitwise_count(fp[rows][:, None] ^ fp[None, low:s + n]) <= most)
            after = low + j > rows[i]
            note(rows[i[after]], low + j[after])
    if not found_a:
        return fp[:0], fp[:0]
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def _grid(most: int, hot: int | None):
    """Rows (a, b, n) of sorted rows (key, fp): a forest of links, n null; and the keys (a) of buckets of more than ``hot`` different
    rows with their number n. Such a bucket is counted, not compared, and never held as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        over, last, counted = None, None, 0  # the hot bucket that goes on, its last row, its rows so far

        def unlike(key, fp):
            return np.append(np.ones(min(len(key), 1), bool), (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]))

        def out(key, fp, marks):
            starts = np.flatnonzero(np.append(np.ones(min(len(key), 1), bool), key[1:] != key[:-1]))
            sizes = np.diff(np.append(starts, len(key)))
            large = sizes > (hot or len(key))
            marks = marks + list(zip(key[starts[large]].tolist(), sizes[large].tolist(), strict=True))
            rest = ~np.repeat(large, sizes)
            a, b = _pairs(key[rest], fp[rest].view(np.uint64), np.full(int(rest.sum()), INDEX | PROBE), most) if rest.any() else (fp[:0], fp[:0])
            none = [None] * len(marks)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64).tolist() + [k for k, _ in marks], pa.int64()), pa.array(b.view(np.int64).tolist() + none, pa.int64()),
                 pa.array([None] * len(a) + [n for _, n in marks], pa.int64())], names=["a", "b", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new_key, new_fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
            marks = []
            if over is not None:
                end = int(np.searchsorted(new_key, over, side="right"))
                if end:
                    own = new_fp[:end]
                    counted += int(unlike(new_key[:end], own).sum()) - int(own[0] == last)
                    last, new_key, new_fp = own[-1], new_key[end:], new_fp[end:]
                if not len(new_key):
                    continue
                marks, over = [(over, counted)], None
            key, fp = np.append(key, new_key), np.append(fp, new_fp)
            if len(key) < 200_000 and not marks:
                continue
            new = unlike(key, fp)  # copies are neighbours
            key, fp = key[new], fp[new]
            cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
            if cut or marks:
                yield out(key[:cut], fp[:cut], marks)
                key, fp = key[cut:], fp[cut:]
            if hot and len(key) > hot:
                over, last, counted = int(key[0]), fp[-1], len(key)
                key, fp = key[:0], fp[:0]
        new = unlike(key, fp)
        if len(key) or over is not None:
            yield out(key[new], fp[new], [(over, counted)] if over is not None else [])

    return run


def grid_links(rows: DataFrame, most: int, name: str, hot: int = HOT) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints at ``most`` or fewer bits, a large number, that meet in a bucket.

    ``rows``: key, fp long. The rows go through one shuffle, are not written and not counted beforehand. A bucket with over ``hot`` different
    fingerprints is told by its comparing task; its rows are dealt out once more in parts, each two of which meet in a bucket of their own.
    """
    compared = lambda rows, hot: rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(
        _grid(most, hot), "a long, b long, n long")
    found = stored(compared(rows, hot), name)
    links, large = found.where("n IS NULL").select("a", "b"), found.where("n IS NOT NULL").select(F.col("a").alias("key"), "n")
    if large.isEmpty():
        return links
    # half of ``hot`` rows of two parts together, so that no part is hot again
    cut = rows.join(large, "key").withColumn("parts", F.ceil(F.col("n") * 4 / F.lit(hot))).withColumn("p", F.pmod(F.xxhash64("fp"), F.col("parts")))
    cut = cut.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cut = cut.select(F.xxhash64("key", F.least("p", "q"), F.greatest("p", "q")).alias("key"), "fp")
    return links.unionByName(compared(cut, None).select("a", "b"))


def _compared(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0

        def out(key, fp, role):
            new = np.append(True, (key[1:] != key[:-1]) | (fp[1:] != fp[:-1]) | (role[1:] != role[:-1]))  # copies are neighbours
            key, fp, role = key[new], fp[new], role[new]
            a, b = _pairs(key, fp, role, most)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp", "role")))
            rows += batch.num_rows
            if rows >= 200_000:
                key, fp, role = (np.concatenate(x) for x in zip(*held, strict=True))
                cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
                if cut:
                    yield out(key[:cut], fp[:cut].view(np.uint64), role[:cut])
                held, rows = [(key[cut:], fp[cut:], role[cut:])], len(key) - cut
        if rows:
            key, fp, role = (np.concatenate(x) for x in zip(*held, strict=True))
            yield out(key, fp.view(np.uint64), role)

    return run


def _split(batches: Iterator[pa.RecordBatch], blocks: int) -> Iterator[pa.RecordBatch]:
    """Rows of hot buckets, once for each of ``blocks`` groups of the bits that the bucket has not fixed yet."""
    for batch in batches:
        key, fp, fixed = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("key", "fp", "fixed"))
        role = batch.column("role").to_numpy(zero_copy_only=False)
        for j in range(blocks):
            mask = np.zeros(len(fp), np.uint64)
            seen = np.zeros(len(fp), np.int64)
            for bit in range(64):
                free = (fixed >> np.uint64(bit)) & np.uint64(1) == 0
                mask |= np.where(free & (seen % blocks == j), np.uint64(1 << bit), np.uint64(0))
                seen += free
            new = mixed(key, np.full(len(fp), j, np.uint64), fp & mask)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (new.view(np.int64), fp.view(np.int64), role, (fixed | mask).view(np.int64))],
                names=["key", "fp", "role", "fixed"])


def near_links(rows: DataFrame, most: int, name: str, hot: int = HOT) -> DataFrame:
    """Links (a, b) whose components are those of all fingerprints at ``most`` or fewer bits that meet in a bucket.

    ``rows``: key, fp, fixed long, role int (INDEX, PROBE or both; an index row meets a probe row), fixed being the bits that
    the bucket settles. A bucket with over ``hot`` rows is dealt out again by ``most`` + 1 groups of its free bits: two
    fingerprints that differ in ``most`` bits agree on one of them, so no link is lost; this repeats while a bucket is hot.
    """
    rows, found = stored(rows, name), None
    schema = "key long, fp long, role int, fixed long"
    while True:
        # a bucket with no free bits holds copies of one fingerprint only
        large = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("fixed").alias("f")).where(f"n > {hot} AND f <> -1")
        large = stored(large.select("key", "n"), name)
        more = not large.isEmpty()
        rest = rows.join(large, "key", "left_anti") if more else rows
        links = rest.select("key", "fp", "role").repartition("key").sortWithinPartitions("key", "fp")
        links = links.mapInArrow(_compared(most), "a long, b long")
        found = links if found is None else found.unionByName(links)
        if not more:
            return found
        rows = stored(rows.join(large, "key", "left_semi").select("key", "fp", "role", "fixed")
                      .mapInArrow(lambda b: _split(b, most + 1), schema), name)
