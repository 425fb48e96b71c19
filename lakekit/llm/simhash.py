"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made per batch. Distinct fingerprints (copies collapse before any shuffle of theirs) are linked when they
differ in few bits: correlated bits are grouped into partitions, each partition gets its own threshold, chosen by dynamic
programming on the estimated number of candidates, and rows are dealt to buckets of (partition, value), a probe row for each
value within the threshold. Thresholds t_i with sum(t_i + 1) = most + 1 find every pair: one that differs by more than t_i in
each partition differs in at least most + 1 bits. Only 64 x 64 sums of bits reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import NOT_SPACE, Carried, Words, arrow_batches, chunks, whole_row
from lakekit.llm.components import components
from lakekit.llm.hamming import INDEX, PROBE, mixed, near_links
from lakekit.session import stored

SHINGLE, SEED, MOST = 3, 42, 3


#: For each byte, its eight bits as the eight bytes of a number.
SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per group of 64-bit hashes (``first``: offsets): the bits set in over half of them; no hashes: zero.

    Eight counts are added up in one number, for at most 255 hashes at a time.
    """
    out = np.zeros(len(first) - 1, np.uint64)
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    if not len(some):
        return out
    pieces = -(-sizes[some] // 255)
    head = np.append(0, np.cumsum(pieces))[:-1]
    starts = np.repeat(first[some], pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(head, pieces))
    octets = hashes.view(np.uint8).reshape(-1, 8)
    chosen = np.empty((len(some), 8, 8), np.uint8)
    for k in range(8):
        counts = np.add.reduceat(SPREAD[octets[:, k]], starts).view(np.uint8).reshape(-1, 8)
        if len(starts) > len(some):
            counts = np.add.reduceat(counts, head, axis=0, dtype=np.int64)
        chosen[:, k] = 2 * counts.astype(np.int64) > sizes[some][:, None]
    out[some] = np.packbits(chosen.reshape(-1, 64), axis=1, bitorder="little").reshape(-1).view(np.uint64)
    return out


def shingle_hashes(words: Words, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of ``size`` words (a shorter text is one shingle), and the offsets per document."""
    counts = np.diff(words.first)
    shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    first = np.append(0, np.cumsum(shingles))
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], shingles)
    last = at + np.repeat(np.minimum(counts, size) - 1, shingles)
    data, digest = words.data.tobytes(), xxhash.xxh64_intdigest
    made = [digest(data[s:e], seed) for s, e in zip(words.start[at].tolist(), words.end[last].tolist(), strict=True)]
    return np.array(made, np.uint64), first


def fingerprints(documents: DataFrame, *, text: str = "text", keep: list[str] | None = None, size: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """The kept columns (all by default; one of the name ``fingerprint`` is left out) and ``fingerprint``, a long.

    Texts are lower-cased (A-Z), cut at ASCII white space, and hashed by shingles, repeats included. A text without words, or
    a null one, has fingerprint zero.
    """
    arrow_batches(documents.sparkSession, size=2 << 20)
    carried = Carried(documents, text, ["fingerprint"], keep)
    inner = carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", 1 << 19):
                made = majority(*shingle_hashes(Words(part.column("_text"), NOT_SPACE), size, seed))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in inner), pa.array(made.view(np.int64))], names=[*inner, "fingerprint"])

    return carried.through(run, "fingerprint long")


def _bit_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: how many fingerprints it saw, and how often two bits were set together (the diagonal: one bit)."""
    n, together = 0, np.zeros((64, 64), np.int64)
    for batch in batches:
        if batch.num_rows:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
            together += (bits.T @ bits).astype(np.int64)
            n += batch.num_rows
    flat = together.reshape(-1)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, 4096)), pa.array(np.append(n, flat))], names=["k", "v"])


def grouped_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """``parts`` groups of nearly equal size: each starts with a bit and takes those that correlate most with the group."""
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs((together / n - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(strength, 0)
    left, groups = list(range(64)), []
    for k in range(parts):
        room = len(left) // (parts - k)
        group = [max(left, key=lambda b: (strength[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < room:
            best = max(left, key=lambda b: (strength[b, group].sum(), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def thresholds(groups: list[list[int]], differ: np.ndarray, n: int, most: int) -> tuple[float, list[int]]:
    """The cheapest thresholds (-1: partition unused) with sum(t + 1) = most + 1, and their cost.

    Cost counts rows to shuffle, and candidates at a hundredth of a row. The share of pairs within t bits of a partition is
    estimated from ``differ``, the chance that two fingerprints differ in each bit.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        chance = np.zeros(len(group) + 1)  # of a number of differing bits
        chance[0] = 1
        for b in group:
            chance[1:] = chance[1:] * (1 - differ[b]) + chance[:-1] * differ[b]
            chance[0] *= 1 - differ[b]
        new: dict[int, tuple[float, list[int]]] = {}
        for t in range(-1, most + 1):
            probes = sum(1.0 for k in range(t + 1) for _ in combinations(group, k))
            price = n * (probes + (t > 0)) + n * n / 2 * chance[:t + 1].sum() / 100 if t >= 0 else 0.0
            for spent, (cost, chosen) in best.items():
                if spent + t + 1 <= most + 1 and (spent + t + 1 not in new or cost + price < new[spent + t + 1][0]):
                    new[spent + t + 1] = (cost + price, [*chosen, t])
        best = new
    return best[most + 1]


def _bucket_rows(groups: list[list[int]], limits: list[int]):
    masks = [sum(1 << b for b in g) for g in groups]
    flips = [[sum(1 << b for b in c) for k in range(t + 1) for c in combinations(g, k)] for g, t in zip(groups, limits, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (mask, flip) in enumerate(zip(masks, flips, strict=True)):
                for x in flip:
                    key = mixed(np.full(len(fp), k + 1, np.uint64), (fp ^ np.uint64(x)) & np.uint64(mask))
                    role = np.full(len(fp), PROBE if x else INDEX | PROBE, np.int32)
                    fixed = np.full(len(fp), mask, np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v) for v in (key.view(np.int64), fp.view(np.int64), role, fixed.view(np.int64))],
                        names=["key", "fp", "role", "fixed"])

    return run


def fingerprint_links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """Links (a, b) that connect all fingerprints of column ``fp`` (distinct, not null) at ``most`` or fewer bits."""
    sums = {r.k: r.v for r in distinct.select("fp").mapInArrow(_bit_sums, "k long, v long")
            .groupBy("k").agg(F.sum("v").alias("v")).collect()}  # 4097 rows, whatever the input
    n = sums.get(-1, 0)
    if not n:
        return distinct.sparkSession.createDataFrame([], "a long, b long")
    together = np.array([sums[k] for k in range(4096)], float).reshape(64, 64)
    p = np.diag(together) / n
    plans = []
    for parts in range(2, 2 * most + 1):
        groups = grouped_bits(together, n, parts)
        cost, limits = thresholds(groups, 2 * p * (1 - p), n, most)
        plans.append((cost, groups, limits))
    _, groups, limits = min(plans, key=lambda x: x[0])
    rows = distinct.select("fp").mapInArrow(_bucket_rows(groups, limits), "key long, fp long, role int, fixed long")
    return near_links(rows, most, "simhash-buckets")


def near_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id): documents linked by fingerprints at ``most`` or fewer bits.

    component_id is the smallest doc_id that can be reached, the document's own included. A null doc_id counts only where no
    other is in the component. Repeated rows stay repeated. No documents give no rows.
    """
    marked = stored(fingerprints(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_t")), text="_t", keep=["doc_id"]),
                    "simhash")
    return groups_of(marked, most).select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def groups_of(marked: DataFrame, most: int = MOST) -> DataFrame:
    """``marked`` (stored: doc_id, fingerprint, other columns) with ``component`` (its least fingerprint) and ``component_id``."""
    distinct = stored(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")), "simhash-distinct")
    found = stored(components(fingerprint_links(distinct, most)), "simhash-components")
    labelled = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("fp", "component", "component_id")
    return marked.join(named, marked.fingerprint == named.fp).drop("fp")


def without_near_duplicates(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """One document of each group: that with the smallest doc_id (nulls last), then fingerprint, then text digest.

    All columns are kept. Of fully equal survivors one stays. Text digests and fingerprints decide; the texts move once.
    """
    own = documents.columns
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    marked = stored(
        fingerprints(documents.select(F.col(doc_id).alias("doc_id"), digest.alias("digest"), F.col(text).alias("_t")), text="_t",
                     keep=["doc_id", "digest"]), "simhash")
    grouped = groups_of(marked, most)
    first = grouped.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "fingerprint", "digest")).alias("first"))
    chosen = stored(first.select("first.doc_id", "first.digest").distinct(), "simhash-kept")
    rows = documents.select(whole_row(documents).alias("_row"), F.col(doc_id).alias("_id"), digest.alias("_digest"))
    kept = rows.join(chosen, rows._id.eqNullSafe(chosen.doc_id) & (rows._digest == chosen.digest), "left_semi")
    kept = kept.dropDuplicates(["_id", "_digest"])
    return kept.select(*(F.col("_row")[c].alias(c) for c in own))
