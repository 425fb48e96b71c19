"""Document fingerprints by locally consistent parsing.

On every level the sequence of names is cut into phrases by local rules only: runs of one name become a phrase, and between
them deterministic coin tossing (the lowest bit in which a name differs from the one before, repeated until few labels are
left) marks local maxima as phrase starts. A phrase is named by a hash of its names, so equal substrings get equal phrases
inside, whatever stands before them; the next level parses the names. A fingerprint holds one small hash per slot: the least
of the names of level ``LEVEL`` and above that fall into the slot, over all phrases of the text. The likeness of two fingerprints, the share
of slots that agree, estimates how much of their phrases two texts share.

A batch is parsed as one sequence in numpy; boundaries of texts always start a phrase, and a name never depends on its place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import Carried, arrow_batches, chunks, joined

SLOTS, LEVEL, RADIX = 64, 3, np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _tossed() -> np.ndarray:
    """Label of a byte after another: twice the lowest differing bit, plus that bit of the byte."""
    a, b = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")  # a before b
    differ = a ^ b
    low = np.zeros_like(differ)
    for bit in range(7, -1, -1):
        low[(differ >> bit) & 1 == 1] = bit
    return (2 * low + ((b >> low) & 1)).astype(np.uint8).reshape(-1)


TOSSED = _tossed()


def _cuts(names: np.ndarray, head: np.ndarray) -> np.ndarray:
    """True where a phrase starts; ``head``: where a text starts (always a phrase start). Equal neighbours are not cut."""
    size = len(names)
    new = np.ones(size, dtype=bool)  # differs from the one before, or starts a text
    np.not_equal(names[1:], names[:-1], out=new[1:])
    new |= head
    at = np.flatnonzero(new)
    run = np.zeros(len(at), dtype=bool)
    run[np.diff(np.append(at, size)) > 1] = True
    name, first = names[at], head[at]
    # labels of one byte: first from whole names, then twice from labels; a text's first name has nothing before it
    differ = name ^ np.append(name[:1], name[:-1])
    low = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)).astype(np.uint8)  # 64 if nothing differs
    label = (2 * low).astype(np.uint8) + ((name >> np.minimum(low, 63).astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    label[first] = (name[first] & np.uint64(127)).astype(np.uint8)
    for _ in range(2):
        joint = np.append(np.uint8(0), label[:-1]).astype(np.uint16) * np.uint16(256) + label
        label = np.where(first, label & np.uint8(7), TOSSED[joint])
    before, after = np.append(np.uint8(255), label[:-1]), np.append(label[1:], np.uint8(255))
    after[np.append(first[1:], True)] = 255  # nor does a text's last name depend on the next text
    cut = (label > before) & (label >= after)
    # a run is a phrase of its own
    cut |= run | first
    cut[1:] |= run[:-1]
    out = np.zeros(size, dtype=bool)
    out[at[cut]] = True
    return out


def parsed(names: np.ndarray, text: np.ndarray, texts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per level from 1: the level, its phrase names, their text, and whether the text ends with this single phrase."""
    level = 0
    names = _mix(names.astype(np.uint64) + np.uint64(1))
    while len(names):
        head = np.append(True, text[1:] != text[:-1])
        starts = np.flatnonzero(_cuts(names, head))
        sizes = np.diff(np.append(starts, len(names)))
        place = np.arange(len(names)) - np.repeat(starts, sizes)
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(int(sizes.max()) + 1, RADIX))
            names = np.add.reduceat(names * powers[place], starts)
            names = _mix(names + sizes.astype(np.uint64) * RADIX)
        text = text[starts]
        level += 1
        alone = np.bincount(text, minlength=texts)[text] == 1
        yield level, names, text, alone
        names, text = names[~alone], text[~alone]


def slots_of(codes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Slots (0: empty) of the fingerprints of texts given as code points, with the number of the text of each."""
    kept: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for level, names, of, alone in parsed(codes, text, texts):
        chosen = slice(None) if level >= LEVEL else alone  # a short text is known by its one phrase
        kept.append(names[chosen])
        owner.append(of[chosen])
    out = np.zeros((texts, SLOTS), np.uint16)
    if kept:
        with np.errstate(over="ignore"):
            hashed = _mix(np.concatenate(kept) * RADIX)
        key = np.concatenate(owner) * SLOTS + (hashed >> np.uint64(58)).astype(np.int64)
        order = np.lexsort((hashed, key))
        first = order[np.flatnonzero(np.append(True, np.diff(key[order]) != 0))]
        out.reshape(-1)[key[first]] = 1 + hashed[first] % np.uint64(65535)
    return out


def _codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a space after each, and their offsets."""
    data, offsets = joined(texts)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32), np.searchsorted(at, offsets)


def _written(slots: np.ndarray) -> list[str]:
    text = slots.astype(">u2").tobytes().hex()
    width = 4 * SLOTS
    return [text[i:i + width] for i in range(0, len(text), width)]


def _likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the slots filled in either that agree; two empty fingerprints are alike."""
    filled = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    return np.where(filled > 0, same / np.maximum(filled, 1), 1.0)


def fingerprint(texts: pa.Array) -> pa.Array:
    """Fingerprints of an Arrow column of texts (null: empty)."""
    codes, offsets = _codes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    inside = np.ones(len(codes), dtype=bool)
    inside[offsets[1:] - 1] = False
    return pa.array(_written(slots_of(codes[inside], owner[inside], len(texts))), pa.string())


def fingerprints(documents: DataFrame, *, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """All columns and ``into``: the fingerprint of the whole text, hex digits. A null text counts as empty, an empty text has
    no phrases and the fingerprint of zeros; equal texts have equal fingerprints. A column named ``into`` is replaced."""
    arrow_batches(documents.sparkSession)
    carried = Carried(documents, text, [into])
    inner = carried.inner

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text", 4 << 20):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in inner), fingerprint(part.column("_text"))], names=[*inner, into])

    return carried.through(run, f"`{into}` string")


def likeness(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """Likeness of two fingerprints, from 0 to 1 (null if either is null)."""
    part = lambda x, i: F.substring(x, i * 4 + 1, F.lit(4))
    places = F.sequence(F.lit(0), F.lit(slots - 1))
    filled = F.size(F.filter(places, lambda i: (part(a, i) != "0000") | (part(b, i) != "0000")))
    same = F.size(F.filter(places, lambda i: (part(a, i) == part(b, i)) & (part(a, i) != "0000")))
    return F.when(a.isNull() | b.isNull(), None).when(filled == 0, 1.0).otherwise(same / filled)


NEIGHBOURS = ("doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def _slots(texts: list[str]) -> np.ndarray:
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return slots_of(codes, owner, len(texts))


def _beside_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, then the first row of the next range, marked ``ahead``; every row but those is returned."""
    ids, ahead, texts, slots = [], [], [], np.zeros((0, SLOTS), np.uint16)
    kind = None
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for part in chunks(batch, "text", 2 << 20):
            ids += part.column("doc_id").to_pylist()
            ahead += part.column("ahead").to_pylist()
            new = part.column("text").to_pylist()
            texts += new
            slots = np.concatenate([slots, _slots(new)])
            last = len(ids) - 1  # waits for the row after it
            here = next((i for i in range(last) if ahead[i]), last)
            edited = []
            for text, after in zip(texts[:here], texts[1:here + 1], strict=True):
                half = len(text) // 2
                edited.append(text[:len(text) - half] + after[:half])
            changed = _slots(edited)
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[:here], kind),
                pa.array([len(t) for t in texts[:here]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(_written(slots[:here]), pa.string()),
                pa.array(_written(changed), pa.string()),
                pa.array(_likeness(slots[:here], changed), pa.float64()),
                pa.array(_likeness(slots[:here], slots[1:here + 1]), pa.float64()),
            ], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            if ahead[last] and here < last:
                return
            ids, ahead, texts, slots = ids[here:], ahead[here:], texts[here:], slots[here:]


def edited_neighbours(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside the next by descending doc_id (after the last the first): doc_id, n_chars, edited_sha256, the
    fingerprints of its text and of the text whose last half is replaced by the start of the next, and the two likenesses.

    Rows with equal doc_id are ordered by a hash of their text, then the text; null ids come last; null texts are empty. A
    single document is its own next. No documents give no rows. doc_id must be a whole number.

    The order is cut into ranges of about equal size; an id with many rows (or null) is cut further by the hash. So the texts
    move once, and each range also gets the first row of the range after it. One number per range reaches the driver.
    """
    spark = documents.sparkSession
    arrow_batches(spark)
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [i / wanted for i in range(1, wanted)]
    quantiles = [int(x) for x in given.stat.approxQuantile("doc_id", shares, 0.2 / wanted)] if shares else []
    edges = sorted(set(quantiles), reverse=True)
    heavy = sorted({x for x in edges if quantiles.count(x) > 1})
    numbers = lambda x: F.lit(x).cast("array<bigint>")
    place = F.when(F.col("doc_id").isNull(), len(edges) + 1).otherwise(F.size(F.filter(numbers(edges), lambda e: e > F.col("doc_id"))))
    alone = F.col("doc_id").isNull() | F.array_contains(numbers(heavy), F.col("doc_id"))
    part = F.when(alone, F.shiftright("hash", 58) + 32).otherwise(64)
    ranged = given.withColumn("hash", F.xxhash64("text")).withColumn("range", (place * 65 + part).cast("int"))
    first = ranged.groupBy("range").agg(
        F.max("doc_id").alias("doc_id"), F.min(F.struct(-F.col("doc_id").cast("decimal(20)"), "hash")).alias("least"))
    found = sorted(first.select("range", "doc_id", "least.hash").collect(), key=lambda r: r[0])
    if not found:
        found = [(0, None, 0)]
    number = spark.createDataFrame([(r[0], i) for i, r in enumerate(found)], "range int, part int")
    before = spark.createDataFrame(
        [(r[1], r[2], (i or len(found)) - 1) for i, r in enumerate(found)], "id long, first long, before int")
    rows = ranged.join(F.broadcast(number), "range").join(  # as many rows as ranges
        F.broadcast(before), F.col("doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("hash") == F.col("first")), "left")
    own = F.struct(F.col("part"), F.lit(False).alias("ahead"))
    both = F.array(own, F.struct(F.col("before").alias("part"), F.lit(True).alias("ahead")))
    dealt = rows.select("doc_id", "text", "hash", F.inline(F.when(F.col("before").isNull(), F.array(own)).otherwise(both)))
    sorted_ = dealt.repartitionById(len(found), F.col("part")).sortWithinPartitions(
        "ahead", F.col("doc_id").desc_nulls_last(), "hash", "text")
    return sorted_.select("doc_id", "text", "ahead").mapInArrow(
        _beside_next, NEIGHBOURS.format(kind=given.schema["doc_id"].dataType.simpleString()))
