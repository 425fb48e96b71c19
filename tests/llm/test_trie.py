"""The trie of conversation prefixes against plain dictionaries of prefixes."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from lakekit.llm import trie
from lakekit.llm.queries import _rebuilt, op13_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rebuilt):
    """Rows of the contract for {conv_id: list of (role, text)}."""
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for prefix in members:
        if prefix:
            children.setdefault(prefix[:-1], []).append(prefix)
    saved = {p: (len(m) - 1) * len(p[-1][1].encode()) if p else 0 for p, m in members.items()}
    leaves = {p: int(p not in children) for p in members}
    for p in sorted(members, key=len, reverse=True):
        if p:
            saved[p[:-1]] += saved[p]
            leaves[p[:-1]] += leaves[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def contract(rows):
    """Rebuilt conversations of rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, role or "", text or ""))
    own = {c: [x[1:] for x in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def found(frame):
    rows = [tuple(r[n] for n in COLUMNS) for r in frame.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1]))


def test_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert found(op13_prefix_trie(spark, folder)) == plain(contract([tuple(r) for r in rows]))


def test_query_on_awkward_conversations(spark, tmp_path):
    dice = random.Random(11)
    rows = []
    for c in [*range(0, 60), 77, 1003]:
        if c in (15, 30):  # an absent source
            continue
        for turn in range(dice.choice([1, 2, 5, 12])):
            rows.append((c, turn or None, dice.choice(["user", "user", None]), dice.choice(["same", "same", "other", "", None, "ü" * 50])))
    rows += [(100 + i, t, "user", f"turn {t}") for i in range(40) for t in range(20)]  # copies of one conversation
    rows += [(200, t, "user", f"turn {t}") for t in range(700)] + [(201, t, "user", f"turn {t}") for t in range(650)]
    rows += [(None, 0, "user", "no conversation")] * 2
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("name", F.lit("x")).repartition(5)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    expected = plain(contract(rows))
    assert any(r[1] > 600 for r in expected)
    assert found(op13_prefix_trie(spark, str(tmp_path))) == expected
    frame.where("false").write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert op13_prefix_trie(spark, f"{tmp_path}/none").collect() == []


def test_random_sequences(spark):
    """Few different turns, so that prefixes branch at every depth; members without turns; a node with many ends."""
    dice = random.Random(2)
    given = {c: [("u", dice.choice("ab")) for _ in range(dice.choice([0, 1, 3, 4, 7, 8, 9, 17]))] for c in range(-5, 300)}
    given |= {c: [("u", "a")] * 3 for c in range(1000, 7000)}
    rows = [(c, i, r, t) for c, turns in given.items() for i, (r, t) in enumerate(turns)]
    turns = trie.numbered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    members = spark.createDataFrame([(c, len(t)) for c, t in given.items()], "conv_id long, length long")
    assert found(trie.prefix_trie(turns, members)) == plain(given)


def test_only_members_without_turns(spark):
    members = spark.createDataFrame([(4, 0), (3, 0)], "conv_id long, length long")
    turns = spark.createDataFrame([], "conv_id long, place long, token binary, size long")
    assert found(trie.prefix_trie(turns, members)) == plain({3: [], 4: []})


def test_numbers_go_on_over_range_partitions(spark):
    rows = spark.range(20_000).selectExpr("1L AS conv_id", "id AS turn", "'u' AS role", "CAST(id AS STRING) AS text")
    places = trie.numbered(rows.repartition(8)).select("place", "size").collect()
    assert sorted(r.place for r in places) == list(range(1, 20_001))
    assert _rebuilt(trie.numbered(rows))[1].collect()[0].length <= 20_000
