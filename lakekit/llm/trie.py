"""Trie of conversation prefixes, built and summed up by halving depths.

Every sequence is cut at half its (padded) depth, and so are both halves, down to single turns. A prefix that ends at a cut is
named by the name of the prefix before its half and the name of the half itself, so the trie above a cut and the forest below it are
named in parallel: all cuts of a level, in all sequences, in one job. Level k has the depths that are odd multiples of 2**k, a
2**-k of the turns, so all levels together handle each turn a fixed number of times, and their number is the logarithm of the
longest sequence.

* Halves: names of blocks of 2**k turns, from those of their two halves (as long as both are complete).
* Cuts: names of prefixes at depth s + 2**k, from the prefix at s and the block of 2**k turns after it.
* Grafting: first each node of level k is added, with what has been grafted on it, to the node at its cut (what lies between two cuts of a level is summed up then);
  from the root down, each node of level k takes the totals of its descendants 2**k turns below, which are complete.

Names are 128 bits of SHA-256, so two prefixes are one node if they are equal (chance of another pair n^2 / 2^129). Nothing is
gathered by conversation or node: a long sequence is spread by (sequence, block), a node with many members or children is
combined before the shuffle. The ids that end at a node are digested as a stream of sorted pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakekit.llm.arrow_text import arrow_batches
from lakekit.operators.windows import with_ranks
from lakekit.session import stored

#: Name of the root, and ids in one piece of a node's list of ends.
ROOT, PIECE = "00" * 16, 4096


def _name(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def numbered(conversations: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place from 1, token, size): each conversation's turns in order of ``turn`` (null first), then role and text digest.

    ``token`` names role and text, ``size`` is the text in UTF-8 bytes; a null role or text is empty. Rows without a
    conversation are left out, since they cannot be members. A conversation over several range partitions is numbered piecewise.
    """
    said, who = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), who.alias("who"),
        _name(F.encode(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said), "UTF-8")).alias("token"),
        F.octet_length(said).cast("long").alias("size"))
    rows = stored(rows, "trie-turns")
    order = ["turn", "who", "token"]
    ranged = stored(rows.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id()), "trie-ranged")
    return with_ranks(ranged, ["conv_id"], order, F.col("range"), row_number="place", not_null=True).select(
        "conv_id", F.col("place").cast("long").alias("place"), "token", "size")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _named(turns: DataFrame, members: DataFrame, levels: int) -> list[DataFrame]:
    """Per level (conv_id, depth, name, cut): the prefixes whose depth is an odd multiple of 2**level, and the prefix before their half."""
    blocks = [turns.select("conv_id", (F.col("place") - 1).alias("block"), F.col("token").alias("name"))]
    for _ in range(levels - 1):
        side = lambda odd: F.max(F.when(F.col("block") % 2 == odd, F.col("name")))
        pairs = blocks[-1].groupBy("conv_id", F.floor(F.col("block") / 2).alias("block")).agg(side(0).alias("left"), side(1).alias("right"))
        blocks.append(stored(pairs.where("left IS NOT NULL AND right IS NOT NULL").select("conv_id", "block", _name(F.col("left"), F.col("right")).alias("name")), "trie-blocks"))
    known = [members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(ROOT)).alias("name"))]
    found: list[DataFrame] = []
    for k in range(levels - 1, -1, -1):
        half = 1 << k
        after = blocks[k].where("block % 2 = 0").select("conv_id", (F.col("block") * half).alias("depth"), F.col("name").alias("block_name"))
        level = _union(known).join(after, ["conv_id", "depth"]).select(
            "conv_id", (F.col("depth") + half).alias("depth"), _name(F.col("name"), F.col("block_name")).alias("name"), F.col("name").alias("cut"))
        level = stored(level, "trie-level")
        known.append(level.select("conv_id", "depth", "name"))
        found.insert(0, level)
    return found


def _grafted(nodes: DataFrame, named: list[DataFrame], levels: int) -> DataFrame:
    """(name, leaves, saved): sums of each node's subtree. ``nodes``: name, conv_id, depth, cut, leaves, saved of the node alone."""
    below, now = [], nodes
    for k in range(levels):
        here = F.col("depth") % (2 << k) != 0
        mine = stored(now.where(here), "trie-part")
        sums = mine.groupBy(F.col("cut").alias("name")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        plus = lambda own, more: (F.col(own) + F.coalesce(F.col(more), F.lit(0))).alias(own)
        now = now.where(~here).join(sums, "name", "left").select("name", "conv_id", "depth", "cut", plus("leaves", "l"), plus("saved", "s"))
        now = stored(now, "trie-above")
        below.append(mine)
    done = [now]  # the root
    for k in range(levels - 1, -1, -1):
        above = named[k].select("conv_id", "depth", F.col("name").alias("upper"))
        lower = _union(done).select("conv_id", (F.col("depth") - (1 << k)).alias("depth"), "leaves", "saved").where("depth > 0")
        sums = lower.join(above, ["conv_id", "depth"]).groupBy(F.col("upper").alias("name")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        whole = below[k].join(sums, "name", "left").select("name", "conv_id", "depth", "cut", plus("leaves", "l"), plus("saved", "s"))
        done.append(stored(whole, "trie-total"))
    return _union(done).select("name", "leaves", "saved")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (name, conv_id) as pieces of a node's list: name, first id, ids joined by commas."""
    name, ids = None, []
    for batch in batches:
        out = []
        for n, c in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (n != name or len(ids) >= PIECE):
                out.append((name, ids[0], ",".join(map(str, ids))))
                ids = []
            name = n
            ids.append(c)
        if out:
            yield _rows(out, [pa.binary(), pa.int64(), pa.string()], ["name", "first", "ids"])
    if ids:
        yield _rows([(name, ids[0], ",".join(map(str, ids)))], [pa.binary(), pa.int64(), pa.string()], ["name", "first", "ids"])


def _rows(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list, from its pieces in order."""
    name, state = None, None
    for batch in batches:
        out = []
        for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if state is not None and n == name:
                state.update(b",")
            else:
                if state is not None:
                    out.append((name, state.hexdigest()))
                name, state = n, hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield _rows(out, [pa.binary(), pa.string()], ["name", "ends_sha256"])
    if state is not None:
        yield _rows([(name, state.hexdigest())], [pa.binary(), pa.string()], ["name", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256) of (name, conv_id)."""
    arrow_batches(ends.sparkSession)
    ordered = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = stored(ordered.mapInArrow(_pieces, "name binary, first long, ids string"), "trie-pieces")
    return pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(_sums, "name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per distinct prefix: conv_id (its smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves and saved_tokens (sums over its subtree, itself included) and ends_sha256, the digest of the sorted members that end there.

    ``turns``: conv_id, place (1, 2, ... without gaps), token, size. ``members``: every conv_id once, with its length; one
    without turns is a member of the root only. A node saves (n_convs - 1) * size of its last turn. No members give no rows.
    """
    longest = members.agg(F.max("length")).first()[0] or 0
    levels = int(longest).bit_length()
    named = _named(turns, members, levels)
    root = members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(ROOT)).alias("name"), F.lit(None).cast("binary").alias("cut"))
    every = _union([root, *named])
    nodes = stored(every.groupBy("name").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("cut").alias("cut"),
                                             F.count("*").alias("n_convs")), "trie-nodes")
    sizes = turns.select("conv_id", F.col("place").alias("depth"), "size")
    above = every.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = stored(nodes.join(sizes, ["conv_id", "depth"], "left").join(above, ["conv_id", "depth"], "left"), "trie-parents")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-children")
    own = nodes.select("name", "conv_id", "depth", "cut", (F.col("n_children") == 0).cast("long").alias("leaves"),
                       F.coalesce((F.col("n_convs") - 1) * F.col("size"), F.lit(0)).alias("saved"))
    totals = _grafted(own, named, levels)
    ends = _ends(every.join(members.withColumnRenamed("length", "depth"), ["conv_id", "depth"], "left_semi").select("name", "conv_id"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(totals, "name").join(parents, "parent", "left").join(ends, "name", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
